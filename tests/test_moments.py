"""Mergeable moments: correlations of many columns and the fold engine."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.ml import models as MD
from tessera.operators import comoments as C
from tessera.operators import stats as S


def test_correlations_of_300_columns_in_one_pass(spark, capsys):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 300)) @ rng.normal(size=(300, 300)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 5.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], [f"c{i}" for i in range(300)]).repartition(6)
    out = S.correlation_matrix(df, df.columns)
    out.explain()
    assert capsys.readouterr().out.count("Scan") == 1
    got = {(r["col_a"], r["col_b"]): r["r"] for r in out.collect()}
    assert len(got) == 90000 and got["c7", "c3"] is None and got["c7", "c7"] == 1.0
    for i, j in rng.integers(0, 300, (60, 2)):
        if 7 in (i, j):
            continue
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_pairs_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (2.0, None, 4.5), (None, 1.0, float("nan")), (None, 3.0, 1.0)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in S.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None and got["b", "c"] is None and got["a", "c"] == pytest.approx(1.0)
    assert all(r["r"] is None for r in S.correlation_matrix(df.limit(0), ["a", "b"]).where("col_a <> col_b").collect())


def test_moments_merge_in_any_order():
    x = np.random.default_rng(2).normal(1e7, 1, (90, 3))
    parts = [C.Moments.of(p) for p in np.split(x, [10, 11, 50])]
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        m = parts[order[0]]
        for i in order[1:]:
            m = m.merged(parts[i])
        assert m.n == 90 and np.allclose(m.mean, x.mean(axis=0)) and np.allclose(m.c, (x - x.mean(0)).T @ (x - x.mean(0)), rtol=1e-6)


def _scores(x, y, train, test, penalty, degree=1):
    z = (x - x[train].mean(0)) / x[train].std(0)
    v = np.column_stack([np.prod(z ** np.array(e), axis=1) for e in MD.monomials(x.shape[1], degree)])
    vc, yc = v[train] - v[train].mean(0), y[train] - y[train].mean()
    w = np.linalg.solve(vc.T @ vc + penalty * np.eye(v.shape[1]), vc.T @ yc)
    p = y[train].mean() + (v - v[train].mean(0)) @ w
    return [1 - ((y[i] - p[i]) ** 2).sum() / ((y[i] - y[i].mean()) ** 2).sum() for i in (train, test)]


@pytest.fixture(scope="module")
def regression(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1, 100, 1e-3] + [1e3, -50, 0]
    y = 3 * (x[:, 0] - 1e3) + 0.02 * x[:, 1] * (x[:, 0] - 1e3) + 500 * x[:, 2] + rng.normal(size=300) + 1e5
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(300)]
    return x, y, spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


def test_folds_of_all_kinds_equal_direct_fits(spark, regression):
    x, y, df = regression
    fold = {r["id"]: (r["fold"], r["__rank"]) for r in MD.assign_folds(df, ["id"], 4).collect()}
    f, rank = np.array([fold[i][0] for i in range(300)]), np.array([fold[i][1] for i in range(300)])
    for degree, penalty, alpha in ((1, MD.Penalty(), 0.0), (2, MD.Penalty(), 0.0), (3, MD.ridge(5.0), 5.0), (1, MD.ridge(40.0), 40.0)):
        for r in MD.cross_validate(df, ["a", "b", "c"], "y", ["id"], 4, penalty=penalty, degree=degree).collect():
            want = _scores(x, y, f != r["fold"], f == r["fold"], alpha, degree)
            assert [r["r2_train"], r["r2_test"]] == pytest.approx(want, abs=1e-7)
    some = {r["variant"]: r for r in MD.feature_ablation(df, ["a", "b", "c"], "y", ["id"], [["b"], ["a", "c"]], 4).collect()}
    for variant, keep in (("all", [0, 1, 2]), ("without b", [0, 2]), ("without a, c", [1])):
        want = np.mean([_scores(x[:, keep], y, f != i, f == i, 0.0) for i in range(4)], axis=0)
        assert [some[variant]["mean_train"], some[variant]["mean_test"]] == pytest.approx(want, abs=1e-8)
    for r in MD.learning_curve(df, ["a", "b", "c"], "y", ["id"], (0.1, 0.5, 1.0), 4).collect():
        want = []
        for i in range(4):
            order = np.argsort(rank)
            train = [j for j in order if f[j] != i]
            held = np.zeros(300, bool)
            held[train[:max(int(r["train_share"] * len(train)), 2)]] = True
            want.append(_scores(x, y, held, f == i, 0.0))
        assert [r["mean_train"], r["mean_test"]] == pytest.approx(np.mean(want, axis=0), abs=1e-7)


def test_lasso_on_the_gram_matrix():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 5))
    x[:, 4] = x[:, 3] + 0.01 * rng.normal(size=400)
    z, y = (x - x.mean(0)) / x.std(0), x @ [3, -2, 0.05, 1, 0] + rng.normal(size=400)
    for alpha, ratio in ((0.1, 1.0), (0.5, 0.5), (2.0, 0.9), (0.0, 0.5)):
        w = MD.solve(z.T @ z / 400, z.T @ (y - y.mean()) / 400, 400, MD.elastic_net(alpha, ratio))
        slope = z.T @ (z @ w - (y - y.mean())) / 400 + alpha * (1 - ratio) * w  # optimality
        assert np.all(np.where(w != 0, np.abs(slope + alpha * ratio * np.sign(w)), np.maximum(np.abs(slope) - alpha * ratio, 0)) < 1e-8)


def test_missing_features_and_constant_labels(spark, regression):
    x, y, df = regression
    holed = df.withColumn("a", F.when(F.col("id") % 5 == 0, float("nan")).when(F.col("id") % 5 == 1, None).otherwise(F.col("a")))
    for r in MD.cross_validate(holed, ["a", "b"], "y", ["id"], 3).collect():
        assert 0 < r["r2_train"] < 1
    flat = df.withColumn("y", F.lit(4.0))
    assert all(r["r2_train"] is None for r in MD.cross_validate(flat, ["a"], "y", ["id"], 3).collect())
    sweep = MD.regularization_sweep(flat, ["a"], "y", ["id"], MD.ridge_lasso_candidates("ridge", [1.0, 2.0]), 3).collect()
    assert [(r["mean_train"], r["gap"], r["chosen"]) for r in sweep] == [(None, None, False)] * 2
    assert MD.learning_curve(flat, ["a"], "y", ["id"], k=3).where("mean_train IS NOT NULL").count() == 0
    assert MD.holdout_evaluation(df.limit(0), ["a"], "y", ["id"]).where("r2_train IS NOT NULL").count() == 0
    one = MD.cross_validate(df.withColumn("k", F.lit(1.0)), ["a", "k"], "y", ["id"], 3).collect()
    assert all(r["r2_train"] > 0 for r in one)


def test_moments_by_column_of_expanded_values(spark):
    """One pass for any number of lambdas; each column by its own present values."""
    from tessera.ml.prep import yeo_johnson, yeo_johnson_points
    from tessera.operators.comoments import moments_by_column
    rows = [(-2.5, 1.0), (0.0, None), (None, 700.0), (3.0, 2.0), (float("nan"), 5.0), (40.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(3)
    lams = [-1.0, 0.0, 1.0, 2.0, 2.5]
    held = moments_by_column(df, {0: yeo_johnson_points(lams), 1: yeo_johnson_points([500.0] * 5)}, 10)
    for k, lam in enumerate(lams):
        y = [r[0] for r in df.where("x is not null and not isnan(x)").select(yeo_johnson(df.x, lam)).collect()]
        up = [r[0] for r in df.where("x is not null and not isnan(x)").select(yeo_johnson(df.x, lam + 1e-6)).collect()]
        slope = (np.array(up) - np.array(y)) / 1e-6
        assert held[0].n == 4 and np.isclose(held[0].mean[2 * k], np.mean(y))
        assert np.isclose(held[0].c[2 * k, 2 * k] / 4, np.var(y))
        assert np.isclose(held[0].c[2 * k, 2 * k + 1] / 4, np.mean((y - np.mean(y)) * (slope - np.mean(slope))), rtol=1e-4, atol=1e-4)
    assert held[1].n == 5 and not np.isfinite(held[1].c).any()  # beyond the range of doubles: no number
