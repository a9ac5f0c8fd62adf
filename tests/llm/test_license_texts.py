"""Templates of any length, whole license texts among them, against the rule stated in plain Python."""

import math

import numpy as np

from tessera.llm import licenses

RNG = np.random.default_rng(17)
TEMPLATES = [(" ".join(f"t{k}w{i}" for i in range(n)), f"l{n}") for k, n in enumerate((6, 24, 25, 60, 400))]


def _part(template, share, filler):
    """The first ``share`` of a template's words with other words around them."""
    words = template.split()
    return [*filler(int(RNG.integers(0, 90))), *words[:math.ceil(share * len(words) - 1e-9) if share >= 0.8 else int(share * len(words))], *filler(int(RNG.integers(0, 90)))]


def _brute(words, threshold=0.8):
    labels, score = set(), 0.0
    for text, label in TEMPLATES:
        wanted = set(text.split())
        size = licenses.STRIDE
        while size < len(text.split()):
            size *= 2
        for s in range(0, max(len(words) - size - 1, 0) + 1, size):
            shared = len(wanted & set(words[s:s + 2 * size]))
            if shared >= math.ceil(threshold * len(wanted) - 1e-9):
                labels.add(label)
                score = max(score, shared / len(wanted))
    return ",".join(sorted(labels)), score


def test_templates_of_any_length(spark):
    filler = lambda n: [f"f{i}" for i in RNG.integers(0, 500, n)]
    texts = [_part(t, share, filler) for t, _ in TEMPLATES for share in (1.0, 0.9, 0.8, 0.7, 0.3) for _ in range(3)]
    texts += [_part(TEMPLATES[0][0], 1.0, filler) + _part(TEMPLATES[4][0], 0.85, filler), []]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(docs, templates=TEMPLATES).collect()}
    for i, words in enumerate(texts):
        labels, score = _brute(words)
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-12, i
    for n, (text, label) in enumerate(TEMPLATES):  # a whole template is found wherever it stands, less than 0.8 of it is not
        assert all(label in got[i][0].split(",") for i in range(15 * n, 15 * n + 9))
        assert not any(got[i][0] for i in range(15 * n + 9, 15 * n + 15))
    assert got[75][0] == "l400,l6" and got[76] == ("", 0.0)
