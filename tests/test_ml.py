"""Feature preparation and model helpers against closed forms in numpy."""

import os

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.ml import models as MD
from tessera.ml import prep as PR


def _frame(spark, n=400, seed=3):
    rnd = np.random.default_rng(seed)
    x = rnd.lognormal(0, 0.8, n)
    y = rnd.normal(5, 2, n)
    z = rnd.exponential(2, n)
    g = rnd.choice(["A", "B", "C"], n, p=[0.5, 0.3, 0.2])
    t = (x + rnd.normal(0, 0.5, n) > 1.2).astype(int)
    rows = [(i, float(a), float(b), float(c), str(d), int(e)) for i, (a, b, c, d, e) in enumerate(zip(x, y, z, g, t))]
    return spark.createDataFrame(rows, "id long, x double, y double, z double, g string, t int"), (x, y, z, g, t)


def _yj(x, lam):
    out = np.empty_like(x)
    p = x >= 0
    out[p] = np.log1p(x[p]) if abs(lam) < 1e-12 else ((x[p] + 1) ** lam - 1) / lam
    out[~p] = -np.log1p(-x[~p]) if abs(lam - 2) < 1e-12 else -((1 - x[~p]) ** (2 - lam) - 1) / (2 - lam)
    return out


def _llf(x, lam):
    return -len(x) / 2 * np.log(_yj(x, lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_yeo_johnson_lambda(spark):
    df, (x, y, z, g, t) = _frame(spark)
    lam = PR.fit_yeo_johnson(df, ["x", "z"])
    for col, arr in (("x", x), ("z", z)):
        grid = np.linspace(-3, 3, 60001)
        best = grid[np.argmax([_llf(arr, v) for v in grid])]
        assert abs(lam[col] - best) < 2e-4
    out = PR.PowerTransformer(inputCols=["x"]).fit(df).transform(df).select("x").toPandas()["x"].to_numpy()
    assert abs(out.mean()) < 1e-9 and abs(out.std() - 1) < 1e-9


def test_imputers_scalers(spark):
    df, (x, *_r) = _frame(spark)
    holes = df.withColumn("x", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("x")))
    xs = np.array([v for i, v in enumerate(x) if i % 5])
    med = PR.Imputer(inputCols=["x"], strategy="median").fit(holes).getState()["x"]
    assert abs(med - np.median(xs)) < 1e-12
    mean = PR.Imputer(inputCols=["x"], strategy="mean").fit(holes).getState()["x"]
    assert abs(mean - xs.mean()) < 1e-9
    mode = PR.Imputer(inputCols=["g"], strategy="most_frequent").fit(df).getState()["g"]
    assert mode == "A"
    st = PR.Standardizer(inputCols=["x"]).fit(df).transform(df).toPandas()["x"].to_numpy()
    assert abs(st.std() - 1) < 1e-9


def test_binning_chi2_pca(spark):
    df, (x, y, z, g, t) = _frame(spark)
    b = PR.UniformBinner(inputCols=["x"], numBins=20).fit(df).transform(df).toPandas()["x"].to_numpy()
    edges = np.linspace(x.min(), x.max(), 21)
    assert (b == np.clip(np.digitize(x, edges[1:-1]), 0, 19)).all()
    scores = {r["column"]: r["chi2"] for r in PR.chi2_scores(df, ["x", "y", "z"], "t").collect()}
    X = np.column_stack([x, y, z])
    Y = np.column_stack([t == 0, t == 1]).astype(float)
    obs = Y.T @ X
    exp = np.outer(Y.mean(0), X.sum(0))
    ref = ((obs - exp) ** 2 / exp).sum(0)
    assert np.allclose([scores["x"], scores["y"], scores["z"]], ref)
    sel = PR.ChiSquareSelector(inputCols=["x", "y", "z"], k=1, labelCol="t").fit(df)
    assert set(sel.transform(df).columns) & {"x", "y", "z"} == {["x", "y", "z"][int(np.argmax(ref))]}
    pca = PR.VariancePCA(inputCols=["x", "y", "z"], share=0.8).fit(df)
    comps = np.array(pca.getState()["components"])
    C = np.cov(X.T)
    w, v = np.linalg.eigh(C)
    order = np.argsort(w)[::-1]
    share = np.cumsum(w[order]) / w.sum()
    k = int(np.searchsorted(share, 0.8, side="right") + 1)
    assert comps.shape[0] == k
    top = v[:, order[0]]
    top = top if top[np.argmax(np.abs(top))] > 0 else -top
    assert np.allclose(comps[0], top, atol=1e-6)


def test_pipeline_persistence(spark, tmp_dir):
    df, _ = _frame(spark)
    pipe = Pipeline(stages=[PR.Imputer(inputCols=["x"], strategy="median"), PR.PowerTransformer(inputCols=["x"]),
                            PR.OneHotEncoder(inputCol="g", categories=["C", "B", "A"])])
    model = pipe.fit(df)
    path = os.path.join(tmp_dir, "pipe")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = model.transform(df).select("x", "g_B", "g_A").collect()
    b = loaded.transform(df).select("x", "g_B", "g_A").collect()
    assert a == b


def test_ols_and_ridge_mapping(spark):
    rnd = np.random.default_rng(1)
    n = 300
    X = rnd.normal(size=(n, 3))
    yv = X @ np.array([1.5, -2.0, 0.3]) + 4 + rnd.normal(0, 0.5, n)
    df = spark.createDataFrame([(i, *map(float, X[i]), float(yv[i])) for i in range(n)], "id long, a double, b double, c double, y double")
    tr, _ = MD._prepare(df, df, ["a", "b", "c"], "y")
    Xs = (X - X.mean(0)) / X.std(0)
    ols = MD.linear_regression().fit(tr)
    ref = np.linalg.lstsq(np.column_stack([Xs, np.ones(n)]), yv, rcond=None)[0]
    assert np.allclose(ols.coefficients.toArray(), ref[:3], atol=1e-6)
    alpha = 10.0
    ridge = MD.ridge_factory(alpha)(n, yv.std()).fit(tr)
    Xc, yc = Xs - Xs.mean(0), yv - yv.mean()
    ref_r = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert np.allclose(ridge.coefficients.toArray(), ref_r, atol=1e-4)


def test_folds_and_split(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    f = MD.assign_folds(df, ["k"], 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in f) == [200] * 5
    tr, te = MD.hash_split(df, ["k"], 0.2)
    a = {r.k for r in te.collect()}
    tr2, te2 = MD.hash_split(df.repartition(7), ["k"], 0.2)
    assert a == {r.k for r in te2.collect()} and 120 < len(a) < 280


def test_classification_metrics(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 0.0), (2.0, 2.0)]
    df = spark.createDataFrame(rows, "target double, prediction double")
    ours = MD.classification_metrics(df).collect()[0]
    ref = MD.evaluator_metrics(df)
    assert (ours.accuracy, ours.f1) == (ref["accuracy"], ref["f1"])


def _knn_reference(X, k):
    """Straight scikit-learn KNNImputer(weights='distance') semantics in numpy."""
    out = X.copy()
    d = X.shape[1]
    for i in range(X.shape[0]):
        for j in np.where(np.isnan(X[i]))[0]:
            cands = []
            for m in range(X.shape[0]):
                if np.isnan(X[m, j]):
                    continue
                common = ~np.isnan(X[i]) & ~np.isnan(X[m])
                if not common.any():
                    continue
                dist = np.sqrt(((X[i, common] - X[m, common]) ** 2).sum() * d / common.sum())
                cands.append((dist, X[m, j]))
            if not cands:  # no donor shares a coordinate: the column mean
                out[i, j] = np.nanmean(X[:, j])
                continue
            cands.sort(key=lambda t: t[0])
            top = cands[:k]
            if any(t[0] == 0 for t in top):
                out[i, j] = np.mean([t[1] for t in top if t[0] == 0])
            else:
                wts = np.array([1 / t[0] for t in top])
                out[i, j] = (wts * np.array([t[1] for t in top])).sum() / wts.sum()
    return out


def test_knn_imputer_exact(spark):
    rnd = np.random.default_rng(5)
    X = rnd.normal(size=(120, 3))
    X[rnd.random(X.shape) < 0.15] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(len(X))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = PR.KNNImputer(inputCols=["a", "b", "c"], idCol="id", k=5, blockRows=17).fit(df)
    got = model.transform(df).orderBy("id").toPandas()[["a", "b", "c"]].to_numpy()
    assert np.allclose(got, _knn_reference(X, 5), atol=1e-9)


def test_fold_engine_matches_direct_fits(spark):
    rnd = np.random.default_rng(4)
    n = 200
    X = rnd.normal(size=(n, 2))
    yv = X @ np.array([2.0, -1.0]) + rnd.normal(0, 1, n)
    df = spark.createDataFrame([(i, float(X[i, 0]), float(X[i, 1]), float(yv[i])) for i in range(n)],
                               "id long, a double, b double, y double")
    folds = MD.cross_validate(df, ["a", "b"], "y", ["id"], k=4).orderBy("fold").collect()
    fa = MD.assign_folds(df, ["id"], 4).select("id", "fold").toPandas().set_index("id")["fold"]
    for r in folds:
        tr = fa.index[fa != r.fold].to_numpy()
        te = fa.index[fa == r.fold].to_numpy()
        A = np.column_stack([X[tr], np.ones(len(tr))])
        w = np.linalg.lstsq(A, yv[tr], rcond=None)[0]

        def r2(idx):
            p = np.column_stack([X[idx], np.ones(len(idx))]) @ w
            return 1 - ((yv[idx] - p) ** 2).sum() / ((yv[idx] - yv[idx].mean()) ** 2).sum()
        assert abs(r.r2_train - r2(tr)) < 1e-9 and abs(r.r2_test - r2(te)) < 1e-9


def _cd_elastic_net(X, y, alpha, l1_ratio, iters=5000):
    """scikit-learn ElasticNet objective by coordinate descent:
    1/(2n)||y - Xw - b||^2 + alpha*r*||w||_1 + alpha*(1-r)/2*||w||^2."""
    n, d = X.shape
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(d)
    for _ in range(iters):
        for j in range(d):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = Xc[:, j] @ Xc[:, j] / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1_ratio, 0) / (z + alpha * (1 - l1_ratio))
    return w


def test_lasso_and_elastic_net_mapping(spark):
    rnd = np.random.default_rng(9)
    n = 400
    X = rnd.normal(size=(n, 3))
    yv = X @ np.array([3.0, -2.0, 0.05]) + 1 + rnd.normal(0, 1.0, n)
    df = spark.createDataFrame([(i, *map(float, X[i]), float(yv[i])) for i in range(n)],
                               "id long, a double, b double, c double, y double")
    tr, _ = MD._prepare(df, df, ["a", "b", "c"], "y")
    Xs = (X - X.mean(0)) / X.std(0)
    for alpha, r in ((0.1, 1.0), (0.5, 1.0), (0.3, 0.5), (1.0, 0.2)):
        factory = MD.lasso_factory(alpha) if r == 1.0 else MD.elastic_net_factory(alpha, r)
        model = factory(n, yv.std()).fit(tr)
        ref = _cd_elastic_net(Xs, yv, alpha, r)
        assert np.allclose(model.coefficients.toArray(), ref, atol=2e-4), (alpha, r, model.coefficients, ref)


def test_yeo_johnson_lambda_far_outside_the_first_grid(spark):
    import numpy as np

    from tessera.ml.prep import fit_yeo_johnson
    x = np.random.default_rng(4).gamma(2, 0.002, 4000)
    lam = fit_yeo_johnson(spark.createDataFrame([(float(v),) for v in x], "x double"), ["x"])["x"]

    def likelihood(k):
        return -len(x) / 2 * np.log(np.var(((x + 1) ** k - 1) / k)) + (k - 1) * np.log1p(x).sum()

    grid = np.linspace(-400, -50, 3501)
    best = max(grid, key=likelihood)
    assert abs(lam - best) < 0.2 and likelihood(lam) >= likelihood(best) - 1e-3
    assert fit_yeo_johnson(spark.createDataFrame([(3.0,)] * 5, "x double"), ["x"]) == {"x": 1.0}


def test_statistics_of_large_values_and_null_features(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tessera.ml import models as MD
    y = 1e9 + np.random.default_rng(6).random(2000)
    df = spark.createDataFrame([(i, float(i % 300) if i % 4 else None, float(v)) for i, v in enumerate(y)], "id long, x double, label double")
    m = MD.CellMoments(df.withColumn("cell", F.lit(0)), ["x"], "label", "cell").cells[0]
    known = [i for i in range(2000) if i % 4]
    assert abs(np.sqrt(m.c[1, 1] / m.n) - y[known].std()) < 1e-4
    assert abs(m.mean[0] - np.mean([i % 300 for i in known])) < 1e-9
    pred = df.withColumn("prediction", F.col("label") + F.when(F.col("id") % 2 == 0, 0.1).otherwise(-0.1))
    r2 = pred.agg(MD.r2_score(pred).alias("r")).first()["r"]
    assert abs(r2 - (1 - 0.01 / y.var())) < 1e-3
    assert pred.limit(1).agg(MD.r2_score(pred).alias("r")).first()["r"] is None


def test_full_vocabulary_is_an_error(spark):
    import pytest

    from tessera.ml import models as MD
    df = spark.createDataFrame([("aa bb cc dd", 0.0), ("aa ee ff", 1.0)], "t string, target double")
    pipe = MD.text_pipeline("t", vocabulary_limit=3).fit(df)
    with pytest.raises(ValueError):
        MD.whole_vocabulary(pipe, 3)
    assert MD.whole_vocabulary(MD.text_pipeline("t").fit(df)) == 6


def test_identical_knn_donors_are_dealt_evenly(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "donors")
    spark.createDataFrame([(1.0, 2.0)] * 5000, "a double, b double").write.parquet(path)
    sizes = spark.read.parquet(path).groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(50)).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 200


def test_yeo_johnson_lambda_equals_the_best_of_numpy(spark):
    """Small, large, negative and mixed values; columns with gaps, one value and none."""
    from tessera.ml.prep import fit_yeo_johnson
    rng = np.random.default_rng(8)
    x = {"mixed": rng.normal(0, 3, 1500), "skewed": rng.exponential(2, 1500), "large": rng.lognormal(12, 1, 1500),
         "small": rng.gamma(2, 1e-4, 1500), "left": -rng.exponential(5, 1500), "near0": np.expm1(rng.normal(4, .5, 1500))}
    rows = [(*(float(v[i]) for v in x.values()), 3.0 if i % 2 else None, None, float("nan") if i % 2 else float(i)) for i in range(1500)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*x, "flat", "none", "holes"]))
    lam = fit_yeo_johnson(df, df.columns)
    assert lam["flat"] == 1.0 and "none" not in lam and np.isfinite(lam["holes"])

    def likelihood(v, k):
        with np.errstate(all="ignore"):
            pos = np.log1p(np.maximum(v, 0)) if abs(k) < 1e-12 else np.expm1(k * np.log1p(np.maximum(v, 0))) / k
            neg = -np.log1p(np.maximum(-v, 0)) if abs(k - 2) < 1e-12 else -np.expm1((2 - k) * np.log1p(np.maximum(-v, 0))) / (2 - k)
            found = -len(v) / 2 * np.log(np.var(np.where(v >= 0, pos, neg))) + (k - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()
            return found if np.isfinite(found) else -np.inf

    for c, v in x.items():
        step = max(1.0, abs(lam[c])) * 1e-2
        assert likelihood(v, lam[c]) >= max(likelihood(v, lam[c] - step), likelihood(v, lam[c] + step)), (c, lam[c], [likelihood(v, lam[c] + d) for d in (-step, 0, step)])
        assert likelihood(v, lam[c]) >= max(likelihood(v, k) for k in np.linspace(-5, 5, 400)) - 1e-4, (c, lam[c])
