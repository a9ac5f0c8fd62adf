"""Exact quantiles by every method equal numpy's linear interpolation."""

import numpy as np

from tessera.operators import stats as S


def test_quantile_methods(spark):
    rnd = np.random.default_rng(11)
    a = np.round(rnd.normal(10, 3, 3000), 1)          # many ties
    b = rnd.exponential(5, 3000)
    b[rnd.random(3000) < 0.1] = np.nan                  # NaN ignored
    rows = [(float(x), None if np.isnan(y) else float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double")
    qs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    exp = {("a", q): np.quantile(a, q) for q in qs}
    exp.update({("b", q): np.quantile(b[~np.isnan(b)], q) for q in qs})
    for kw in ({}, {"few": 1}, {"few": 10, "accuracy": 20}, {"few": 100}):
        got = {(r["column"], round(r["q"], 6)): r["value"] for r in S.quantiles(df, ["a", "b"], qs, **kw).collect()}
        for k, v in exp.items():
            assert abs(got[(k[0], round(k[1], 6))] - v) < 1e-9, (kw, k)


def test_skewness_and_histogram(spark):
    rnd = np.random.default_rng(2)
    x = rnd.gamma(2, 2, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    n = len(x)
    m = x - x.mean()
    g1 = (m ** 3).mean() / (m ** 2).mean() ** 1.5
    G1 = g1 * np.sqrt(n * (n - 1)) / (n - 2)
    assert abs(S.skewness(df, ["x"]).collect()[0]["skew"] - G1) < 1e-9
    h = {r["bin"]: r["count"] for r in S.histogram(df, ["x"], 20).collect()}
    ref, _ = np.histogram(x, bins=20)
    assert [h[i] for i in range(20)] == list(ref)


def test_quantiles_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(n=st.integers(1, 400), accuracy=st.integers(3, 70), few=st.sampled_from([1, 5, 10_000_000]),
           decimals=st.integers(0, 3), seed=st.integers(0, 10_000))
    def check(n, accuracy, few, decimals, seed):
        rnd = np.random.default_rng(seed)
        x = np.round(rnd.normal(0, 10, n), decimals)
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        qs = (0.0, 0.33, 0.5, 0.9, 1.0)
        got = {round(r["q"], 6): r["value"] for r in
               S.quantiles(df, ["x"], qs, accuracy=accuracy, few=few).collect()}
        for q in qs:
            assert abs(got[round(q, 6)] - np.quantile(x, q)) < 1e-9

    check()


def test_box_stats_keep_a_column_without_values(spark):
    from tessera.operators import stats as S
    df = spark.createDataFrame([(float(i), None) for i in range(9)] + [(100.0, None)], "a double, b double")
    got = {r["column"]: (r["q1"], r["n_outliers"]) for r in S.box_stats(df, ["a", "b"]).collect()}
    assert got["a"][1] == 1 and got["b"] == (None, 0)


def test_quantiles_do_not_shuffle_values(spark):
    """A hot value, few distinct values, infinities, and every rank of a small column."""
    rng = np.random.default_rng(3)
    x = np.concatenate([np.full(40_000, 7.0), rng.normal(7, 1, 30_000), rng.integers(0, 5, 30_000), [1e300, -1e300]])
    rng.shuffle(x)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    qs = [0.0, 0.001, 0.2, 0.31, 0.4, 0.5, 0.77, 0.9, 0.99999]
    for few in (1, 50, 10_000):
        got = {r["q"]: r["value"] for r in S.quantiles(df, ["x"], qs, few=few).collect()}
        for q in qs:
            assert np.isclose(got[q], np.quantile(x, q), rtol=1e-12)
