"""The operators against brute force on small tables with nulls, empty texts,
repeated rows, clashing extra columns, and on empty tables."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, forest, langid, licenses, packing, passages, simhash, syncmers, warc, wrapper

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key int, piece int"


def words(seed, n):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 9))) for _ in range(n)]


PASSAGE = " ".join(words(1, 70))
TEXTS = {
    1: " ".join(words(2, 120)), 2: None, 3: "", 4: " ".join(words(2, 120)), 5: " \n\t ", 6: "It's they'll été \U0001f600 \n\n  x's",
    7: " ".join(words(3, 60)) + " " + PASSAGE + " " + " ".join(words(4, 40)),
    8: " ".join(words(5, 30)) + "\n" + " ".join([*PASSAGE.split()[:30], "changed", *PASSAGE.split()[31:]]) + " " + " ".join(words(6, 200)),
    9: "Released UNDER the MIT  License. under the mit license; CC-BY-NC", 10: "=" * 5000 + "ab" * 3000, 11: "short text"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else "fr", "s", 0, 1, 2) for k, t in TEXTS.items()]
    return spark.createDataFrame(rows + [rows[0], (None, "no id", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, empty):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    out = packing.pack_documents(docs, path, capacity=64).toPandas()
    for k, t in TEXTS.items():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        got = out[out.doc_id == k].sort_values("piece").drop_duplicates("piece")
        assert got.length.sum() == len(ids) and (got.length.iloc[1:] == 64).all()
        assert [zlib.crc32(ids[s:s + n]) for s, n in zip(got.start, got.length)] == got.ids_crc32.tolist()
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert (seq.length.cumsum() - seq.length == seq.offset).all() and seq.length.sum() <= 64
    assert packing.pack_documents(empty, path).count() == 0


def test_simhash_components_equal_brute_force(spark, docs, empty):
    base = words(7, 300)
    near = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in range(0, 300, 6)]
    many = spark.createDataFrame([(100 + i, t) for i, t in enumerate(near)], "doc_id long, text string").union(docs.select("doc_id", "text"))
    rows = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(many).collect()}

    def fingerprint(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    texts = {**TEXTS, **{100 + i: t for i, t in enumerate(near)}}
    prints = {k: fingerprint(t) for k, t in texts.items()}
    label = {k: k for k in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    assert all(rows[k, f"{p:016x}"] == label[k] for k, p in prints.items())
    assert simhash.near_duplicates(empty).count() == 0


def test_allocation_covers_the_distance():
    cost = np.random.default_rng(0).random((50, 3, 6))
    chosen = simhash.allocate(cost)
    assert ((chosen + 1).sum(axis=1) == 5).all() and (chosen >= -1).all()


def test_passages(docs, empty):
    rows = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert rows[8]["class_id"] == 7 and rows[7]["n_links"] == 1 and rows[7]["spans"] == []
    assert [(s["begin"], s["end"]) for s in rows[8]["spans"]] == [(30, 100)]
    assert rows[4]["class_id"] == 1 and rows[11]["class_id"] == 11 and rows[11]["n_links"] == 0 and rows[None]["class_id"] is None
    assert passages.repeated_passages(empty).count() == 0
    left = passages.without_spans(TEXTS[8], rows[8]["spans"])
    assert left.split() == words(5, 30) + words(6, 200)


def test_compact_windows_equal_brute_force():
    h = np.random.default_rng(3).integers(0, 40, 300).astype(np.uint64) << np.uint64(50)
    live = np.ones(300, bool)
    live[[0, 120, 121, 299]] = False
    got = set(zip(*(x.tolist() for x in passages.compact_windows(h, live, 9))))
    want = set()
    for a, b in ((1, 120), (122, 299)):
        for c in range(a, b):
            lo = c
            while lo > a and h[lo - 1] > h[c]:
                lo -= 1
            hi = c
            while hi + 1 < b and h[hi + 1] >= h[c]:
                hi += 1
            if hi - lo + 1 >= 9:
                want.add((c, lo, hi))
    assert got == want


def test_passages_of_a_repeated_line(spark):
    line, single = " ".join(words(11, 9)), " ".join(["on"] * 60)
    texts = {1: " ".join(words(12, 40)) + " " + " ".join([line] * 30) + " " + " ".join(words(13, 30)),
             2: " ".join(words(14, 25)) + " " + " ".join([line] * 50) + " " + " ".join(words(15, 60)),
             3: " ".join(words(16, 20)) + " on on on on on on x " + single + " " + " ".join(words(17, 20)),
             4: " ".join(words(18, 33)) + " " + single + " " + " ".join(words(19, 20))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert [rows[k]["class_id"] for k in texts] == [1, 1, 3, 3]
    assert [(s["begin"], s["end"]) for s in rows[2]["spans"]] == [(25, 25 + 9 * 50)]
    assert [(s["begin"], s["end"]) for s in rows[4]["spans"]] == [(33, 93)]
    found = passages.windows(docs, 46, 6)
    assert found.groupBy("key", "doc").count().agg({"count": "max"}).first()[0] <= 2


def test_passages_that_hold_a_very_common_line(spark):
    line = " ".join(words(21, 45))
    texts = {}
    for i in range(240):  # a third of the rows hold the line; two of them at a time share the passage around it
        own = " ".join(words(1000 + i, 25))
        if i % 3 == 0:
            around = words(5000 + i // 3 % 20, 15) if i < 120 else words(9000 + i, 15)
            own += " " + " ".join(around[:8]) + " " + line + " " + " ".join(around[8:])
        texts[i] = own + " " + " ".join(words(3000 + i, 25))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in passages.repeated_passages(docs).collect()}
    assert all(rows[i + 60]["class_id"] == i and [(s["begin"], s["end"]) for s in rows[i + 60]["spans"]] == [(25, 85)] for i in range(0, 60, 3))
    assert all(rows[i]["class_id"] == i for i in range(240) if i % 3 or i >= 120)


def test_joined_windows_equal_brute_force():
    rng = np.random.default_rng(8)
    h = rng.integers(0, 6, 400).astype(np.uint64) << np.uint64(50)
    c, left, right = passages.compact_windows(h, np.ones(400, bool), 5)
    want = {}
    for x, lo, hi in zip(c.tolist(), left.tolist(), right.tolist()):
        first, last, low = want.get((int(h[x]), hi), (x, x, lo))
        want[int(h[x]), hi] = (min(first, x), max(last, x), min(low, lo))
    got = {(int(v), r): (f, e, lo) for v, f, e, lo, r in zip(*(x.tolist() for x in passages.runs_joined(h[c], c, left, right)))}
    assert got == want


def test_byte_bpe_round_trip(docs, empty):
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    ref = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r["doc_id"]: r for r in bpe.encode_and_decode(docs, path, P.PATTERN).collect()}
    for k, t in TEXTS.items():
        ids = ref.encode_ordinary(t or "")
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[k]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_and_decode(empty, path, P.PATTERN).count() == 0


def test_language(spark, docs, empty):
    fr = [(i, "le chat et la souris dans une maison " * 3 + str(i), "fr") for i in range(0, 40, 2)]
    en = [(i, "the cat and this mouse within that house " * 3 + str(i), "en") for i in range(1, 40, 2)]
    model = langid.train(spark.createDataFrame(fr + en, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "la maison et le chat"), (2, "that house and the cat"), (3, None), (4, "12 ?"), (4, "12 ?")], "doc_id long, text string")
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.identify(asked, model).orderBy("doc_id").collect()]
    assert got == [(1, "fr"), (2, "en"), (3, "und"), (4, "und"), (4, "und")]
    assert langid.identify(empty, langid.train(empty)).count() == 0
    assert all(r["lang_pred"] == "und" for r in langid.identify(docs, langid.train(empty)).collect())


def test_licenses(docs, empty):
    rows = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert (rows[9]["n_base"], rows[9]["first_word"], rows[9]["last_word"], rows[9]["base_labels"]) == (3, 1, 9, "cc-by-nc,mit")
    assert rows[2]["n_words"] == 0 and rows[2]["first_word"] is None and rows[2]["labels"] == "" and rows[2]["score"] == 0
    assert licenses.scan(empty).count() == 0


def test_syncmers(docs, empty):
    rows = {(r["doc_id"]): r for r in syncmers.fingerprints(docs).collect()}
    assert rows[1]["fingerprint"] == rows[4]["fingerprint"] and 0.2 < rows[7]["near_edited"] < 0.9
    order = sorted(TEXTS, reverse=True)
    for a, b in zip(order, order[1:]):
        t, n = TEXTS[a] or "", TEXTS[b] or ""
        half = len(t) // 2
        assert rows[a]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + n[:half]).encode()).hexdigest()
    assert syncmers.fingerprints(empty).count() == 0


def test_texts_without_a_closed_syncmer(spark):
    texts = [" ".join(words(700 + i, 6 + i % 3)) for i in range(60)]
    rows = syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert all(r["fingerprint"] for r in rows) and len({r["fingerprint"] for r in rows}) == len(set(texts))
    assert max(r["near_next"] for r in rows) == 0


def test_wrapper(spark):
    page = "<html><head><title>t</title></head><body><nav><a href='/'>Menu</a></nav><div class='ad'>Buy</div><article><h1>T{0}</h1><p><b>A{0} &amp; b<br><p>second\n  line</article><div class=comments>Nice</div><footer>foot</footer>"
    rows = [(i, "http://a.b/x", page.format(i)) for i in range(4)] + [(7, None, None), (8, "x", ""), (8, "x", ""), (9, "http://c.d", "plain text")]
    got = {r["page_id"]: r["text"] for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == "T2\nA2 & b\nsecond line" and got[7] == "" and got[8] == "" and got[9] == "plain text"


def test_warc(spark):
    rows = [(3, "u", "same"), (1, "v", "same"), (2, None, None), (5, "w", ""), (6, "z", "x" * 100_000), (1, "v", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"], r["payload_digest"]) for r in warc.archive_pages(pages).collect())
    digest = {t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in ("same", "", "x" * 100_000)}
    assert [g[:4] for g in got] == [(1, 4, "response", None)] * 2 + [(2, 0, "response", None), (3, 4, "revisit", 1), (5, 0, "revisit", 2), (6, 100_000, "response", None)]
    assert got[0][4] == digest["same"] and got[2][4] == digest[""]
    assert warc.archive_pages(pages.where("page_id > 99")).count() == 0


def test_forest(spark):
    x = np.random.default_rng(5).standard_normal((600, 16))
    x[7] = x[3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = forest.nearest(v, v.where("vec_id % 50 = 0 OR vec_id = 3"), shard_rows=200).collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in {r["query_id"] for r in got}:
        s = u @ u[q]
        s[q] = -9
        top = set(np.lexsort((np.arange(600), -s))[:5].tolist())
        hits += len(top & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 5 * 13 and len(got) == 5 * 13
    assert [r["vec_id"] for r in got if r["query_id"] == 3 and r["rank"] == 1] == [7]


def test_pipeline_stages(spark, docs, empty):
    for table in (docs, empty):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            before, out = out, stage(spark, out, "/root/testdata/sf0.001")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == before.columns
        assert out.columns[:2] == ["doc_id", "piece"]


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    base = words(8, 300)
    a, b, c = " ".join(base), " ".join([*base[:-1], "other"]), " ".join(words(9, 80))
    near = (simhash.text_fingerprint(a) ^ simhash.text_fingerprint(b)).bit_count() <= 4
    rows = [(5, a, 1), (3, a, 1), (3, a, 1), (None, a, 1), (None, c, 1), (None, c, 1), (None, None, 1), (None, "", 1), (9, words(10, 1)[0], 1)]
    kept = corpus_pipeline.stages.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, fp int"), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == sorted([(3, a), (9, words(10, 1)[0]), (0, c), (0, "")])
    if near:
        rows = [(None, a, 1), (None, b, 1)]
        assert corpus_pipeline.stages.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, fp int"), "").count() == 1
