"""Mixing, clustering and fill-in-middle against brute force, on tables with
nulls, empty and long texts, ties, repeated rows, clashing extra columns, and
on empty tables."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import centroids, infill, mixing

# the extra columns clash with names the operators derive
DOCS = "doc_id long, text string, source string, sid int, size int, n int, form string, target string, copies int, rate string"
VECTORS = "vec_id long, embedding array<float>, cluster string, chunk int, block int, data string, ids int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x", "y", 4, "z") for r in rows], DOCS)


# ---------------------------------------------------------------- mixing
def water(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by source, straight from the rule."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    full, out, total = set(), {}, sum(sizes.values()) * share
    while True:
        left = total - sum(most * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / free for s in order}
        above = {s for s in order if s not in full and out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


def tilted(sizes, target, most=2.0):
    """Rates by bisection on the tilt."""
    z = np.array(sizes) / np.mean(sizes)
    low, high = -1e4, 1e4
    for _ in range(300):
        t = (low + high) / 2
        if (np.minimum(most, np.exp(np.minimum(t * z, 700))) * sizes).sum() < target:
            low = t
        else:
            high = t
    return np.minimum(most, np.exp(np.minimum(high * z, 700)))


def corpus():
    rng = np.random.default_rng(5)
    rows = [(0, None, "b"), (1, "", "b"), (2, " \t\x0b ", None), (3, "long " * 30000, "b"), (None, "no id here", None), (None, None, None)]
    for i in range(4, 400):
        source = [None, "a", "b", "hot", "hot", "é", "Z"][i % 7]
        rows.append((i, "w " * int(rng.integers(1, 400)), source))
    return rows + [rows[-1], rows[-1], (500, "lone source of five words", "zz")]


def test_mixing_meets_its_targets(spark):
    rows = corpus()
    out = mixing.mix(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in out) == sorted((d or -1, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in rows)
    size, taken, docs = {}, {}, {}
    for r in out:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        docs.setdefault(r["source"], []).append((r["size"], r["rate"], r["target"], r["source_size"]))
        assert 0 <= r["copies"] <= 2 and (r["size"] or not r["copies"])
    wanted = water(size)
    for s, held in docs.items():
        assert all(t == pytest.approx(wanted[s]) and n == size[s] for _, _, t, n in held)
        some = [(n, r) for n, r, _, _ in held if n]
        if some:
            assert np.allclose([r for _, r in some], tilted([n for n, _ in some], wanted[s]), rtol=1e-4, atol=1e-6)
            # whole copies: where one document is larger than half the target, its size bounds the miss
            largest = max((n for n, _ in some), default=0)
            assert abs(taken[s] - wanted[s]) <= max(0.01 * wanted[s], 3, largest / 2 if 2 * largest > wanted[s] else 0)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5)).collect()
    key = lambda r: (r["doc_id"] or -1, r["size"], r["copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mixing_of_small_tables(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [(r["target"], r["copies"]) for r in mixing.mix(documents(spark, [(1, None, None), (2, "", "x")])).collect()] == [(0.0, 0)] * 2
    one = mixing.mix(documents(spark, [(1, "a b c d", "x")])).first()
    assert one["target"] == 6.0 and one["copies"] in (1, 2)
    copies = [(i, "same text of six words here", "x") for i in range(40)]
    assert sum(r["copies"] for r in mixing.mix(documents(spark, copies)).collect()) == 60


def test_mixing_stays_in_the_jvm(spark, capsys):
    mixing.mix(documents(spark, corpus()[:20])).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


# ---------------------------------------------------------------- clustering
def lloyd(vectors, k, rounds, dims, scale=256, seed=2):
    kept = [(i, [int(np.floor(scale * np.float64(np.float32(x)))) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    held = [c for _, c in start[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(held))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        held = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else m for j, m in enumerate(held)]
    return [(i, *nearest(x)[::-1]) for i, x in kept], held


@pytest.mark.parametrize("k,blocks,chunk_rows", [(7, 3, 16), (40, 1, 1000), (3, 8, 5)])
def test_clusters_equal_brute_force(spark, k, blocks, chunk_rows):
    rng = np.random.default_rng(k)
    vectors = [(i, rng.normal(i % 4, 0.5, 6).astype(np.float32).tolist()) for i in range(90)]
    vectors += [vectors[3]] * 20 + [(100, None), (101, []), (102, [1.0] * 5), (103, [float("nan")] * 6), (104, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
                                    (105, [float("inf")] * 6), (106, [0.0] * 6), (None, [-0.001] * 6)]
    df = spark.createDataFrame([(*v, "c", 1, 2, "d", 3) for v in vectors], VECTORS)
    out = centroids.cluster(df, k=k, rounds=4, dims=6, blocks=blocks, chunk_rows=chunk_rows).collect()
    want, held = lloyd(vectors, k, 4, 6)
    assert sorted((repr(r["vec_id"]), r["cluster"], r["distance"]) for r in out) == sorted((repr(i), j, d) for i, j, d in want)
    total = sum(d for _, _, d in want)
    for r in out:
        assert r["inertia"] == total and r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"]) and r["centroid"] == held[r["cluster"]]


def test_clusters_of_small_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert centroids.cluster(empty).count() == 0 and "centroid" in centroids.cluster(empty).columns
    large = [[2.0 ** 18, -2.0 ** 18], [2.0 ** 18 - 1, 0.5], [-2.0 ** 18, 2.0 ** 18]]  # products beyond 2^53
    df = spark.createDataFrame([(i, v, "", 1, 1, "", 1) for i, v in enumerate(large)], VECTORS)
    want, held = lloyd(list(enumerate(large)), 2, 2, 2)
    out = centroids.cluster(df, k=2, rounds=2, dims=2).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in out) == sorted(want)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0], "", 1, 1, "", 1)], VECTORS), dims=2)


# ---------------------------------------------------------------- fill-in-middle
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def infilled(doc_id, text, rate=50, spm=80):
    tokens = TOKEN.findall(text or "")
    s = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(s[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(tokens), "plain", None, None, text or ""
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, x = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < spm:
        return len(tokens), "spm", len(p), len(m), f"<S>{x}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{x}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    alphabet = list(" \t\n\x0b\x0cab\x00é漢\U0001f600x\x08\x0e\x1f! <>PSM")
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(0, 60)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "a <P> b"), (1003, "<S>"), (1004, "<<M>>"), (1005, "< P>"), (None, "no id at all"), (None, None),
             (1006, "漢字 " * 60000), (1007, "x" * 300000), (1008, " " * 100001)] + [(7, "one two three")] * 5
    rows += [(2000 + i, "<P" + " <S " * i + "M>") for i in range(10)]
    for rate, spm in ((50, 80), (100, 30)):
        out = infill.fill_in_middle(documents(spark, [(*r, None) for r in rows]), rate, spm)
        out = out.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
        key = lambda r: (repr(r[0]), r[-1])
        got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in out), key=key)
        want = sorted(((i, *infilled(i, t, rate, spm)) for i, t in rows), key=key)
        assert got == want
        assert sorted((repr(r["doc_id"]), r["back"]) for r in out) == sorted((repr(i), t or "") for i, t in rows)
    assert infill.fill_in_middle(documents(spark, [])).count() == 0


def test_select_in_words():
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("  \néab\U0001f600"), rng.integers(1, 50))) for _ in range(200)]
    raw = [t.encode() for t in texts]
    size = np.array([len(t) for t in raw])
    words = infill.Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size)
    for i, t in enumerate(texts):
        tokens = TOKEN.findall(t)
        assert words.counts()[i] == len(tokens)
        at = words.select(np.full(len(tokens) + 1, i), np.arange(len(tokens) + 1))
        heads = ["".join(tokens[:k]) for k in range(len(tokens) + 1)]
        assert at.tolist() == [len(h.encode()) for h in heads]
        assert words.characters(np.full(len(at), i), at).tolist() == [len(h) for h in heads]
