"""Vocabulary table against Spark's own counter and scaler; readings with units; two text fields."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer, StandardScaler, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F
from tessera.functions.stopwords import ENGLISH
from tessera.functions.text import parse_measure
from tessera.ml import vocabulary as V
from tessera.plans.bindings.ml import articles

TEXTS = ["the Cat sat\ton the mat", "a cat and a dog", "dog  dog\ndog", "", None, "élan ÉLAN cat", "the of and"]


def test_counts_and_scaling_equal_the_ml_stages(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, t string")
    counts = V.term_counts(df, "id", "t")
    terms = V.vocabulary(counts, len(TEXTS))
    ids = {r.term: r.term_id for r in terms.collect()}
    assert [t for t, _ in sorted(ids.items(), key=lambda x: x[1])] == ["dog", "cat", "élan", "mat", "sat"]
    got = {r.id: dict(zip(r.term_ids, r.counts)) for r in V.sparse_rows(V.scaled_counts(counts, terms)).collect()}

    full = df.fillna("", ["t"])
    stages = [Tokenizer(inputCol="t", outputCol="w"), StopWordsRemover(inputCol="w", outputCol="k", stopWords=list(ENGLISH)),
              CountVectorizer(inputCol="k", outputCol="c"), StandardScaler(inputCol="c", outputCol="s")]
    model = Pipeline(stages=stages).fit(full)
    names = model.stages[2].vocabulary
    for r in model.transform(full).collect():
        want = {ids[names[i]]: x for i, x in zip(r.s.indices.tolist(), r.s.values.tolist()) if names[i]}
        assert got.get(r.id, {}).keys() == want.keys()
        assert np.allclose([got[r.id][k] for k in want], list(want.values()))


def test_vocabulary_of_few_rows(spark):
    none = spark.createDataFrame([], "id long, t string")
    assert V.vocabulary(V.term_counts(none, "id", "t"), 0).count() == 0
    one = V.term_counts(spark.createDataFrame([(1, "cat")], "id long, t string"), "id", "t")
    terms = V.vocabulary(one, 1)
    assert terms.first().sd is None
    assert [tuple(r) for r in V.scaled_counts(one, terms).collect()] == [(1, 0, 1, 0.0)]


def test_counts_of_rows_with_an_id_of_their_own_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(TEXTS)], "id long, t string")
    alone = V.term_counts(df, "id", "t")
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    shared = V.term_counts(df.union(spark.createDataFrame([(1, "dog a"), (None, "dog"), (None, "dog")], "id long, t string")), "id", "t")
    want = {(0, "cat"): 1, (0, "sat"): 1, (0, "mat"): 1, (1, "cat"): 1, (1, "dog"): 1, (2, "dog"): 3, (5, "élan"): 2, (5, "cat"): 1}
    assert {(r.id, r.term): r.n for r in alone.collect()} == want
    assert {(r.id, r.term): r.n for r in shared.collect()} == want | {(1, "dog"): 2, (None, "dog"): 2}


def test_counts_of_sliced_batches():
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8, None, 9, 4]), pa.array([["b", "a", "b"], [], ["a"], None, ["x", "b"]])], names=["id", "tokens"])
    for at_once in (1, 2, 100):
        got = [tuple(r.values()) for b in V._counted(["x"], at_once)(iter([batch.slice(0, 0), batch, batch.slice(2)])) for r in b.to_pylist()]
        part = [(None, "a", 1), (4, "b", 1)]
        assert sorted(got, key=str) == sorted([(7, "a", 1), (7, "b", 2), *part, *part], key=str)


def test_terms_beyond_the_frequent_ones_are_joined(spark, monkeypatch):
    df = spark.createDataFrame([(i, t or "") for i, t in enumerate(TEXTS)], "id long, t string")
    counts = V.term_counts(df, "id", "t")
    terms = V.vocabulary(counts, len(TEXTS))
    want = sorted(map(tuple, V.scaled_counts(counts, terms).collect()))
    for name, value in (("FREQUENT_TERMS", 1), ("FREQUENT_LENGTH", 3)):
        monkeypatch.setattr(V, name, value)
        assert sorted(map(tuple, V.scaled_counts(counts, terms).collect())) == want
    assert len(want) == 8


def test_token_query_keeps_no_vocabulary_on_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.ml.feature import CountVectorizer
    from tessera.plans.bindings.ml import m18_m20_tokens_and_counts
    monkeypatch.setattr(CountVectorizer, "_fit", lambda *_: pytest.fail("a counter holds its vocabulary on the driver"))
    rows = [(1, "The cat  sat. a DOG", "en"), (2, "dog", "en"), (2, "cat dog", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, m18_m20_tokens_and_counts(spark, str(tmp_path)).collect()))
    assert got == [(1, 6, 4, 4, 4), (2, 1, 1, 1, 4), (2, 2, 2, 2, 4)]  # the empty token is a term


@pytest.mark.parametrize("text,want", [
    ("120/80", (120.0, 80.0, None)), (" 120 / 80 mmHg ", (120.0, 80.0, "mmHg")), ("36.8", (36.8, None, None)),
    ("36.8 °C", (36.8, None, "°C")), ("95mg/dL", (95.0, None, "mg/dL")), ("-1.5e-3 x10^9/L", (-0.0015, None, "x10^9/L")),
    ("n/a", (None, None, None)), ("", (None, None, None)), (None, (None, None, None)), ("1/2/3", (None, None, None)), ("98 %", (98.0, None, "%"))])
def test_reading_with_unit(spark, text, want):
    r = spark.createDataFrame([(text,)], "t string").select(parse_measure(F.col("t")).alias("m")).select("m.*").first()
    assert tuple(r) == want


def test_summary_is_another_field(spark, tmp_path):
    rows = [(1, "Short one. This is the longest sentence here. End", "en"), (2, "aa bb! cc dd", "en"), (3, None, "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.summary, r.documents) for r in articles(spark, str(tmp_path)).collect()}
    assert got == {1: ("This is the longest sentence here", rows[0][1]), 2: ("aa bb", "aa bb! cc dd"), 3: (None, None)}
