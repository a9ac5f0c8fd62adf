"""Steps 8 and 9: feature preparation on lineitem numbers with planted gaps,
text classification of documents by language, regression of the extended
price on the other lineitem numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.stopwords import ENGLISH
from tessera.ml import models as MD
from tessera.ml import prep as PR
from tessera.ml.compose import Branch, Columns, ColumnTransformer, FunctionStep
from tessera.operators import stats as S
from tessera.plans.preparation import preparation_pipeline
from tessera.plans.registry import query, sround, table

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUMS = ["q", "price", "disc", "tax"]


def data(spark, d):
    li = table(spark, d, "lineitem")
    k = F.col("l_orderkey")
    rf = F.col("l_returnflag")
    grade = F.when(rf == "A", "A").when(rf == "N", "B").otherwise("C")
    return li.select(*KEYS,
                     F.when(k % 11 == 0, None).otherwise(F.col("l_quantity")).alias("q"),
                     F.when(k % 13 == 0, None).otherwise(F.col("l_extendedprice")).alias("price"),
                     F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
                     F.when(k % 17 == 0, None).otherwise(grade).alias("grade"),
                     (F.col("l_linestatus") == "O").cast("int").alias("target"))


DATA_SQL = """data AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS q,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS price,
    l_discount AS disc, l_tax AS tax,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' ELSE 'C' END END AS grade,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS target FROM lineitem)"""
K = ", ".join(KEYS)


def r6(c):
    return F.round(c, 6).alias(c)


@query("m1_impute_mean", f"""WITH {DATA_SQL} SELECT {K},
    {sround('coalesce(q, (SELECT avg(q) FROM data))', 6)} AS q,
    {sround('coalesce(price, (SELECT avg(price) FROM data))', 6)} AS price FROM data""")
def m1_impute_mean(spark, d):
    df = data(spark, d)
    out = PR.Imputer(inputCols=["q", "price"], strategy="mean").fit(df).transform(df)
    return out.select(*KEYS, r6("q"), r6("price"))


@query("m1_impute_median", f"""WITH {DATA_SQL} SELECT {K},
    {sround('coalesce(q, (SELECT quantile_cont(q, 0.5) FROM data))', 6)} AS q,
    {sround('coalesce(price, (SELECT quantile_cont(price, 0.5) FROM data))', 6)} AS price FROM data""")
def m1_impute_median(spark, d):
    df = data(spark, d)
    out = PR.Imputer(inputCols=["q", "price"], strategy="median").fit(df).transform(df)
    return out.select(*KEYS, r6("q"), r6("price"))


MODE_SQL = "(SELECT grade FROM data WHERE grade IS NOT NULL GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1)"


@query("m2_impute_most_frequent", f"WITH {DATA_SQL} SELECT {K}, coalesce(grade, {MODE_SQL}) AS grade FROM data")
def m2_impute_most_frequent(spark, d):
    df = data(spark, d)
    out = PR.Imputer(inputCols=["grade"], strategy="most_frequent").fit(df).transform(df)
    return out.select(*KEYS, "grade")


@query("m4_standardize", f"WITH {DATA_SQL} SELECT {K}, " + ", ".join(
    sround(f"({c} - (SELECT avg({c}) FROM data)) / (SELECT stddev_pop({c}) FROM data)", 6) + f" AS {c}" for c in NUMS)
    + " FROM data")
def m4_standardize(spark, d):
    df = data(spark, d)
    out = PR.Standardizer(inputCols=NUMS).fit(df).transform(df)
    return out.select(*KEYS, *[r6(c) for c in NUMS])


@query("m6_min_max_scale", f"WITH {DATA_SQL} SELECT {K}, " + ", ".join(
    sround(f"({c} - (SELECT min({c}) FROM data)) / ((SELECT max({c}) FROM data) - (SELECT min({c}) FROM data))", 6)
    + f" AS {c}" for c in NUMS) + " FROM data")
def m6_min_max_scale(spark, d):
    df = data(spark, d)
    out = PR.MinMaxScaler(inputCols=NUMS).fit(df).transform(df)
    return out.select(*KEYS, *[r6(c) for c in NUMS])


@query("m9_one_hot_drop_first", f"""WITH {DATA_SQL}, g AS (SELECT {K}, coalesce(grade, {MODE_SQL}) AS grade FROM data)
SELECT {K}, CAST(grade = 'B' AS DOUBLE) AS grade_B, CAST(grade = 'A' AS DOUBLE) AS grade_A FROM g""")
def m9_one_hot_drop_first(spark, d):
    df = data(spark, d)
    df = PR.Imputer(inputCols=["grade"], strategy="most_frequent").fit(df).transform(df)
    out = PR.OneHotEncoder(inputCol="grade", categories=["C", "B", "A"], dropFirst=True).transform(df)
    return out.select(*KEYS, "grade_B", "grade_A")


@query("m10_ordinal_encode", f"""WITH {DATA_SQL}, g AS (SELECT {K}, coalesce(grade, {MODE_SQL}) AS grade FROM data)
SELECT {K}, CAST(CASE grade WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 END AS DOUBLE) AS grade FROM g""")
def m10_ordinal_encode(spark, d):
    df = data(spark, d)
    df = PR.Imputer(inputCols=["grade"], strategy="most_frequent").fit(df).transform(df)
    return PR.OrdinalEncoder(inputCols=["grade"], categories=["A", "B", "C"]).transform(df).select(*KEYS, "grade")


def _bins_sql(c):
    lo, hi = f"(SELECT min({c}) FROM data)", f"(SELECT max({c}) FROM data)"
    terms = " + ".join(f"CASE WHEN {c} >= {i} * (({hi} - {lo}) / 20) + {lo} THEN 1 ELSE 0 END" for i in range(1, 20))
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE CAST({terms} AS DOUBLE) END"


@query("m11_uniform_bins", f"WITH {DATA_SQL} SELECT {K}, " + ", ".join(f"{_bins_sql(c)} AS {c}" for c in NUMS)
       + " FROM data")
def m11_uniform_bins(spark, d):
    df = data(spark, d)
    out = PR.UniformBinner(inputCols=NUMS, numBins=20).fit(df).transform(df)
    return out.select(*KEYS, *NUMS)


@query("m12_chi2_select", f"""WITH {DATA_SQL}, b AS (SELECT target, """ + ", ".join(f"{_bins_sql(c)} AS {c}" for c in NUMS)
       + """ FROM data),
pc AS (SELECT target, count(*) AS n_c, """ + ", ".join(f"sum({c}) AS {c}" for c in NUMS) + """ FROM b GROUP BY target),
s AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", sum(power({c} - n_c / (SELECT sum(n_c) FROM pc) * (SELECT sum({c}) FROM pc), 2) / "
    f"(n_c / (SELECT sum(n_c) FROM pc) * (SELECT sum({c}) FROM pc))) AS chi2 FROM pc" for c in NUMS) + f""")
SELECT "column", {sround('chi2', 6)} AS chi2, row_number() OVER (ORDER BY chi2 DESC) <= 2 AS selected FROM s""")
def m12_chi2_select(spark, d):
    df = data(spark, d)
    binned = PR.UniformBinner(inputCols=NUMS, numBins=20).fit(df).transform(df)
    scores = PR.chi2_scores(binned, NUMS, "target")
    selector = PR.ChiSquareSelector(inputCols=NUMS, k=2, labelCol="target").fit(binned)
    dropped = selector.getOrDefault(selector.drop)
    return scores.select("column", F.round("chi2", 6).alias("chi2"), (~F.col("column").isin(*dropped)).alias("selected"))


@query("m7_yeo_johnson")
def m7_yeo_johnson(spark, d):
    df = PR.Imputer(inputCols=NUMS, strategy="median").fit(data(spark, d)).transform(data(spark, d))
    out = PR.PowerTransformer(inputCols=["q", "price"]).fit(df).transform(df)
    return out.select(*KEYS, F.round("q", 4).alias("q"), F.round("price", 4).alias("price"))


@query("m8_conditional_symmetrizer")
def m8_conditional_symmetrizer(spark, d):
    df = data(spark, d)
    df = PR.Imputer(inputCols=NUMS, strategy="median").fit(df).transform(df)
    out = PR.ConditionalSymmetrizer(inputCols=NUMS, threshold=0.05).fit(df).transform(df)
    return out.select(*KEYS, *[F.round(c, 4).alias(c) for c in NUMS])


@query("m13_pca_variance_share")
def m13_pca_variance_share(spark, d):
    df = data(spark, d)
    df = PR.Imputer(inputCols=NUMS, strategy="mean").fit(df).transform(df)
    df = PR.Standardizer(inputCols=NUMS).fit(df).transform(df)
    out = PR.VariancePCA(inputCols=NUMS, share=0.8).fit(df).transform(df)
    return out.select(*KEYS, *[F.round(c, 4).alias(c) for c in out.columns if c.startswith("pc_")])


IMPUTED_SQL = DATA_SQL.replace("data AS", "raw AS", 1) + f""", data AS (SELECT {K}, target, disc, tax,
    coalesce(q, (SELECT quantile_cont(q, 0.5) FROM raw)) AS q, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM raw)) AS price,
    coalesce(grade, {MODE_SQL.replace("FROM data", "FROM raw")}) AS grade, q AS q0, price AS price0 FROM raw)"""
BINNED = ["binned__q", "binned__price", "disc", "tax", "grade"]


def _branches_sql():
    scaled = ", ".join(sround(f"({c}0 - (SELECT min({c}0) FROM data)) / ((SELECT max({c}0) FROM data) - (SELECT min({c}0) FROM data))", 6)
                       + f" AS scaled__{c}" for c in ("q", "price"))
    total, n = "(SELECT sum({c}) FROM pc)", "(SELECT sum(n_c) FROM pc)"
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS name, sum(power({c} - n_c / {n} * {total.format(c=c)}, 2) / (n_c / {n} * {total.format(c=c)})) AS chi2 FROM pc" for c in BINNED)
    return f"""WITH {IMPUTED_SQL}, b AS (SELECT {K}, target, {_bins_sql("q")} AS binned__q, {_bins_sql("price")} AS binned__price,
    {_bins_sql("disc")} AS disc, {_bins_sql("tax")} AS tax, CAST(CASE grade WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END AS DOUBLE) AS grade, {scaled} FROM data),
pc AS (SELECT target, count(*) AS n_c, {", ".join(f"sum({c}) AS {c}" for c in BINNED)} FROM b GROUP BY target),
s AS ({parts}),
top AS (SELECT string_agg(name, ',' ORDER BY name) AS selected FROM (SELECT name FROM s ORDER BY chi2 DESC LIMIT 3))
SELECT {K}, target, {", ".join(BINNED)}, scaled__q, scaled__price, selected FROM b, top"""


@query("m14_column_branches", _branches_sql())
def m14_column_branches(spark, d):
    """Numeric and categorical branches picked by type, and a third branch that
    reads two of the numeric columns again from the original input."""
    df = data(spark, d)
    kept = [*KEYS, "target"]
    branches = ColumnTransformer([
        Branch("binned", Columns(kind="numeric"), [lambda c: PR.Imputer(inputCols=c, strategy="median"), lambda c: PR.UniformBinner(inputCols=c, numBins=20)]),
        Branch("ordinal", Columns(kind="categorical"), [lambda c: PR.Imputer(inputCols=c, strategy="most_frequent"),
                                                        lambda c: PR.OrdinalEncoder(inputCols=c, categories=["A", "B", "C"])]),
        Branch("scaled", Columns(names=["q", "price"]), [lambda c: PR.MinMaxScaler(inputCols=c)])], keep=kept)
    out = branches.fit(df).transform(df)
    best = PR.ChiSquareSelector(inputCols=BINNED, k=3, labelCol="target").fit(out)
    selected = sorted(set(BINNED) - set(best.getOrDefault(best.drop)))
    return out.select(*kept, *BINNED, r6("scaled__q"), r6("scaled__price"), F.lit(",".join(selected)).alias("selected"))


@query("m15_preparation_pipeline")
def m15_preparation_pipeline(spark, d):
    """Pipes 1 to 3 in one pipeline, saved and loaded again."""
    import uuid

    from pyspark.ml import PipelineModel

    from tessera.operators.windows import global_index
    from tessera.session import scratch_path
    df = global_index(data(spark, d), KEYS + NUMS + ["grade", "target"], out="rid")
    model = preparation_pipeline([*KEYS, "target"], "target", "rid", skew_threshold=0.05, categories=["C", "B", "A"]).fit(df)
    path = scratch_path(spark, f"preparation-{uuid.uuid4().hex[:12]}")
    model.write().save(path)
    out = PipelineModel.load(path).transform(df)
    return out.select(*KEYS, "target", *[F.round(c, 4).alias(c) for c in out.columns if c.startswith("pc_")])


# ------------------------------------------------------------------ text classification
def articles(spark, d):
    """Whole texts and, as their summary, the longest sentence of each (the first of equals)."""
    doc = table(spark, d, "documents")
    sentences = F.transform(F.split("text", r"[.!?]\s+"), lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("at"), s.alias("s")))
    return doc.select("doc_id", F.array_max(sentences)["s"].alias("summary"),
                      F.col("text").alias("documents"), F.col("lang").alias("categoria"))


@query("m17_string_index_labels", """SELECT lang AS categoria,
    CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS target FROM documents GROUP BY lang""")
def m17_string_index_labels(spark, d):
    _, idx = MD.index_labels(articles(spark, d), "categoria")
    return idx.select("categoria", "target").distinct()


@query("m23_classification_metrics", """WITH c AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
per AS (SELECT k.c, coalesce(s.support, 0) AS support, coalesce(pr.predicted, 0) AS predicted, coalesce(t.tp, 0) AS tp
    FROM (SELECT y AS c FROM c UNION SELECT p FROM c) k
    LEFT JOIN (SELECT y AS c, sum(n) AS support FROM c GROUP BY 1) s ON s.c = k.c
    LEFT JOIN (SELECT p AS c, sum(n) AS predicted FROM c GROUP BY 1) pr ON pr.c = k.c
    LEFT JOIN (SELECT y AS c, n AS tp FROM c WHERE y = p) t ON t.c = k.c)
SELECT """ + sround("sum(tp) / sum(support)", 4) + """ AS accuracy,
    """ + sround("sum(support * CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0 END) / sum(support)", 4)
       + """ AS f1 FROM per""")
def m23_classification_metrics(spark, d):
    lab = table(spark, d, "labels")
    return MD.classification_metrics(lab, label="quality", prediction="toxic")


@query("m22_m24_text_classification")
def m22_m24_text_classification(spark, d):
    _, idx = MD.index_labels(articles(spark, d), "categoria")
    train, test = MD.hash_split(idx, ["doc_id"], 0.2, seed=0)
    return MD.compare_text_fields(train, test, ["summary", "documents"])


def _hash_sql(keys, seed=0):
    return "substr(md5(concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + f", '{seed}')), 1, 8)"


@query("m21_hash_split_sizes", f"""SELECT CASE WHEN CAST('0x' || {_hash_sql(["l_orderkey", "l_linenumber", "l_partkey"])} AS BIGINT) / 4294967296.0 >= 0.2
    THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM lineitem GROUP BY 1""")
def m21_hash_split_sizes(spark, d):
    train, test = MD.hash_split(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 0.2, 0)
    return (train.select(F.lit("train").alias("split"), "l_orderkey")
            .unionByName(test.select(F.lit("test").alias("split"), "l_orderkey"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ regression
RFEAT = ["l_quantity", "l_discount", "l_tax"]
RLABEL = "l_extendedprice"
RKEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def reg_data(spark, d):
    return table(spark, d, "lineitem").select(*RKEYS, "l_discount", "l_tax")


@query("m26_r2_of_regression_line", """WITH l AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b,
    regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
p AS (SELECT l_extendedprice AS y, a + b * l_quantity AS yhat FROM lineitem, l)
SELECT """ + sround("1 - sum((y - yhat) * (y - yhat)) / (sum(y * y) - sum(y) * sum(y) / count(y))", 6) + " AS r2 FROM p")
def m26_r2_of_regression_line(spark, d):
    li = table(spark, d, "lineitem")
    line = S.regression_lines(li, ["l_quantity"], RLABEL).collect()[0]
    p = li.select(F.col(RLABEL).alias("label"),
                  (F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col("l_quantity")).alias("prediction"))
    return p.agg(F.round(MD.r2_score(p), 6).alias("r2"))


@query("m25_ols_coefficients")
def m25_ols_coefficients(spark, d):
    df = reg_data(spark, d)
    tr, te = MD._prepare(df, df, RFEAT, RLABEL)
    model = MD.linear_regression().setLabelCol("label").fit(tr)
    return MD.coefficient_table(spark, model, RFEAT).select("feature", F.round("coefficient", 4).alias("coefficient"))


@query("m27_holdout_evaluation")
def m27_holdout_evaluation(spark, d):
    return MD.holdout_evaluation(reg_data(spark, d), RFEAT, RLABEL, RKEYS, (0.2, 0.3))


@query("m28_cross_validation")
def m28_cross_validation(spark, d):
    return MD.cross_validate(reg_data(spark, d), RFEAT, RLABEL, RKEYS, k=5)


@query("m29_polynomial_cv")
def m29_polynomial_cv(spark, d):
    return MD.cv_summary(MD.cross_validate(reg_data(spark, d), RFEAT, RLABEL, RKEYS, k=5, degree=2))


@query("m29_polynomial_features", """SELECT l_quantity AS poly_0, l_quantity * l_quantity AS poly_1, l_discount AS poly_2,
    l_quantity * l_discount AS poly_3, l_discount * l_discount AS poly_4, CAST(1.0 AS DOUBLE) AS poly_bias FROM lineitem""")
def m29_polynomial_features(spark, d):
    return MD.polynomial_features(table(spark, d, "lineitem"), ["l_quantity", "l_discount"], 2, include_bias=True)


# one feature: the closed forms of the regression line give every score in SQL
ONE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
RANKED_SQL = f"""ranked AS (SELECT l_quantity AS x, l_extendedprice AS y, CAST('0x' || {_hash_sql(ONE)} AS BIGINT) / 4294967296.0 AS u,
    row_number() OVER (ORDER BY {_hash_sql(ONE)}, {", ".join(ONE)}, l_quantity, l_extendedprice) - 1 AS rank FROM lineitem)"""


def _line_sql(parts):
    """(tag, r2_train, r2_test) of a line through each training part, with
    ``parts`` as (tag, training rows, test rows, ridge alpha)."""
    out = []
    for tag, train, test, alpha in parts:
        out.append(f"""SELECT {tag} AS tag, 1 - sum((y - a - b * x) ^ 2) FILTER (WHERE {train}) / (var_pop(y) FILTER (WHERE {train}) * count(*) FILTER (WHERE {train})) AS r2_train,
    1 - sum((y - a - b * x) ^ 2) FILTER (WHERE {test}) / (var_pop(y) FILTER (WHERE {test}) * count(*) FILTER (WHERE {test})) AS r2_test
FROM ranked, (SELECT b, my - b * mx AS a FROM (SELECT covar_pop(y, x) * count(*) / (var_pop(x) * (count(*) + {alpha})) AS b, avg(x) AS mx, avg(y) AS my
    FROM ranked WHERE {train}))""")
    return f"WITH {RANKED_SQL}, " + "scored AS (" + " UNION ALL ".join(out) + ")"


def _fold_parts(tag="{i}", alpha=0.0):
    return [(tag.format(i=i), f"rank % 5 <> {i}", f"rank % 5 = {i}", alpha) for i in range(5)]


@query("m27_holdout_one_feature", _line_sql([("0.2", "u >= 0.2", "u < 0.2", 0.0), ("0.3", "u >= 0.3", "u < 0.3", 0.0)])
       + f" SELECT CAST(tag AS DOUBLE) AS test_size, {sround('r2_train', 6)} AS r2_train, {sround('r2_test', 6)} AS r2_test FROM scored")
def m27_holdout_one_feature(spark, d):
    out = MD.holdout_evaluation(table(spark, d, "lineitem"), ["l_quantity"], RLABEL, ONE, (0.2, 0.3))
    return out.select("test_size", r6("r2_train"), r6("r2_test"))


@query("m28_cross_validation_one_feature", _line_sql(_fold_parts())
       + f" SELECT CAST(tag AS INTEGER) AS fold, {sround('r2_train', 6)} AS r2_train, {sround('r2_test', 6)} AS r2_test FROM scored")
def m28_cross_validation_one_feature(spark, d):
    out = MD.cross_validate(table(spark, d, "lineitem"), ["l_quantity"], RLABEL, ONE, k=5)
    return out.select("fold", r6("r2_train"), r6("r2_test"))


@query("m30_ridge_sweep_one_feature", _line_sql(_fold_parts("'ridge alpha=10'", 10.0) + _fold_parts("'ridge alpha=20000'", 20000.0))
       + f" SELECT tag AS candidate, {sround('avg(r2_train)', 6)} AS mean_train, {sround('avg(r2_test)', 6)} AS mean_test,"
       " tag = 'ridge alpha=20000' AS chosen FROM scored GROUP BY tag")
def m30_ridge_sweep_one_feature(spark, d):
    out = MD.regularization_sweep(table(spark, d, "lineitem"), ["l_quantity"], RLABEL, ONE, MD.ridge_lasso_candidates("ridge", [10.0, 20000.0]))
    return out.select("candidate", r6("mean_train"), r6("mean_test"), "chosen")


def _prefix_parts(share):
    n = "(SELECT count(*) FROM lineitem)"
    return [(f"{share}", f"rank % 5 <> {i} AND rank - (rank - {i} + 4) // 5 < greatest(floor({share}::DOUBLE * ({n} - ({n} - {i} + 4) // 5)), 2)",
             f"rank % 5 = {i}", 0.0) for i in range(5)]


@query("m34_learning_curve_one_feature", _line_sql([p for share in (0.1, 0.55, 1.0) for p in _prefix_parts(share)])
       + f" SELECT CAST(tag AS DOUBLE) AS train_share, {sround('avg(r2_train)', 6)} AS mean_train, {sround('avg(r2_test)', 6)} AS mean_test FROM scored GROUP BY tag")
def m34_learning_curve_one_feature(spark, d):
    out = MD.learning_curve(table(spark, d, "lineitem"), ["l_quantity"], RLABEL, ONE, (0.1, 0.55, 1.0))
    return out.select("train_share", r6("mean_train"), r6("mean_test"))


@query("m30_ridge_lasso_sweep")
def m30_ridge_lasso_sweep(spark, d):
    df = reg_data(spark, d)
    base = MD.cv_summary(MD.cross_validate(df, RFEAT, RLABEL, RKEYS, k=5)).collect()[0]
    cands = MD.ridge_lasso_candidates("ridge", [0.1, 10.0]) + MD.ridge_lasso_candidates("lasso", [0.1, 10.0])
    return MD.regularization_sweep(df, RFEAT, RLABEL, RKEYS, cands, 5, 0, base["mean_train"], base["mean_test"], 0.005)


@query("m31_elastic_net_sweep")
def m31_elastic_net_sweep(spark, d):
    df = reg_data(spark, d)
    cands = MD.elastic_net_candidates([0.1, 1.0], [0.2, 0.8])
    return MD.regularization_sweep(df, RFEAT, RLABEL, RKEYS, cands, 5, 0, None, None, 1.0)


@query("m32_feature_ablation")
def m32_feature_ablation(spark, d):
    return MD.feature_ablation(reg_data(spark, d), RFEAT, RLABEL, RKEYS, [["l_tax"], ["l_discount", "l_tax"]], k=5)


@query("m34_learning_curve")
def m34_learning_curve(spark, d):
    return MD.learning_curve(reg_data(spark, d), RFEAT, RLABEL, RKEYS, k=5)


@query("m36_model_comparison")
def m36_model_comparison(spark, d):
    df = reg_data(spark, d)
    s1 = MD.cv_summary(MD.cross_validate(df, RFEAT, RLABEL, RKEYS, k=5)).collect()[0]
    s2 = MD.cv_summary(MD.cross_validate(df, RFEAT, RLABEL, RKEYS, k=5, degree=2)).collect()[0]
    rows = []
    for name, s in (("linear", s1), ("polynomial degree 2", s2)):
        rows += [(name, "Train", s["mean_train"]), (name, "Test", s["mean_test"]), (name, "Gap", s["gap"])]
    return MD.comparison_table(spark.createDataFrame(rows, "model string, metric string, value double"))


@query("m3_knn_impute")
def m3_knn_impute(spark, d):
    from tessera.operators.windows import global_index
    df = data(spark, d)
    df = global_index(df, KEYS + NUMS + ["grade", "target"], out="rid")  # a unique key; no row dropped
    out = PR.KNNImputer(inputCols=NUMS, idCol="rid", k=5).fit(df).transform(df)
    return out.select(*KEYS, *[F.round(c, 4).alias(c) for c in NUMS])


@query("u3_function_step_in_pipeline", f"""SELECT p_partkey, {sround('(p_retailprice / p_size - (SELECT avg(p_retailprice / p_size) FROM part)) / (SELECT stddev_pop(p_retailprice / p_size) FROM part)', 6)} AS unit_price FROM part""")
def u3_function_step_in_pipeline(spark, d):
    """A pipeline with a function step, saved and loaded again."""
    import uuid

    from pyspark.ml import Pipeline, PipelineModel

    from tessera.session import scratch_path
    pipe = Pipeline(stages=[FunctionStep(ratio_of, key="p_partkey", top="p_retailprice", bottom="p_size", out="unit_price"),
                            PR.Standardizer(inputCols=["unit_price"])])
    p = table(spark, d, "part")
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    pipe.fit(p).write().save(path)
    return PipelineModel.load(path).transform(p).select("p_partkey", F.round("unit_price", 6).alias("unit_price"))


def ratio_of(df, key, top, bottom, out):
    """(key, out): the quotient of two columns; NULL where the divisor is 0."""
    return df.select(key, F.try_divide(F.col(top), F.col(bottom)).alias(out))


_STOP_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH) + ")"
_TERMS_SQL = f"""words AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM words WHERE term <> '' AND term NOT IN {_STOP_SQL} GROUP BY 1, 2),
v AS (SELECT term, row_number() OVER (ORDER BY sum(n) DESC, term) - 1 AS term_id, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_total,
    sqrt((t.all_rows * CAST(sum(n * n) AS DOUBLE) - CAST(sum(n) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) / (t.all_rows * (t.all_rows - 1))) AS sd
    FROM c, (SELECT CAST(count(*) AS DOUBLE) AS all_rows FROM documents) t GROUP BY term, t.all_rows)"""


def _vocabulary(spark, d):
    from tessera.ml import vocabulary as V
    doc = table(spark, d, "documents")
    counts = V.term_counts(doc, "doc_id", "text")
    return V, counts, V.vocabulary(counts, doc.count())


@query("m20_vocabulary_table", f"""WITH {_TERMS_SQL} SELECT term, term_id, n_docs, n_total, {sround("sd", 6)} AS sd FROM v""")
def m20_vocabulary_table(spark, d):
    _, _, terms = _vocabulary(spark, d)
    return terms.select("term", "term_id", "n_docs", "n_total", r6("sd"))


@query("m20_sparse_counts", f"""WITH {_TERMS_SQL} SELECT doc_id, string_agg(CAST(term_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ' ' ORDER BY term_id) AS counts
FROM c JOIN v USING (term) GROUP BY doc_id""")
def m20_sparse_counts(spark, d):
    V, counts, terms = _vocabulary(spark, d)
    rows = V.sparse_rows(V.scaled_counts(counts, terms), "n")
    joined = F.zip_with("term_ids", "counts", lambda t, n: F.concat_ws(":", t.cast("string"), n.cast("string")))
    return rows.select(F.col("id").alias("doc_id"), F.concat_ws(" ", joined).alias("counts"))


@query("m20_scaled_counts", f"""WITH {_TERMS_SQL} SELECT term_id, count(*) AS n_docs, {sround("sum(n) / max(sd)", 4)} AS scaled
FROM c JOIN v USING (term) WHERE sd > 0 GROUP BY term_id""")
def m20_scaled_counts(spark, d):
    V, counts, terms = _vocabulary(spark, d)
    scaled = V.scaled_counts(counts, terms).groupBy("term_id").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("scaled").alias("scaled"))
    return scaled.where("scaled > 0").select("term_id", "n_docs", F.round("scaled", 4).alias("scaled"))


@query("m18_m20_tokens_and_counts", f"""WITH {_TERMS_SQL}, t AS (SELECT doc_id, regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]') AS w FROM documents),
k AS (SELECT doc_id, w, list_filter(w, lambda x: x NOT IN {_STOP_SQL}) AS kept FROM t)
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens, CAST(len(kept) AS INTEGER) AS n_kept, CAST(len(list_distinct(kept)) AS INTEGER) AS n_distinct_terms,
    CAST((SELECT count(*) FROM v) AS INTEGER) AS vocabulary_size FROM k""")
def m18_m20_tokens_and_counts(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StopWordsRemover, Tokenizer

    from tessera.ml import vocabulary as V
    doc = articles(spark, d)
    pipe = Pipeline(stages=[Tokenizer(inputCol="documents", outputCol="tokens"),
                            StopWordsRemover(inputCol="tokens", outputCol="filtered", stopWords=list(ENGLISH))])
    out = pipe.fit(doc).transform(doc)
    terms = V.vocabulary(V.token_counts(out, "doc_id", F.col("filtered")), doc.count())
    return out.select("doc_id", F.size("tokens").alias("n_tokens"), F.size("filtered").alias("n_kept"),
                      F.size(F.array_distinct("filtered")).alias("n_distinct_terms"),
                      F.lit(terms.count()).cast("int").alias("vocabulary_size"))


@query("m16_pipeline_save_and_load", f"""WITH {DATA_SQL}, i AS (SELECT {K}, coalesce(q, (SELECT avg(q) FROM data)) AS q,
    coalesce(price, (SELECT avg(price) FROM data)) AS price FROM data)
SELECT {K}, """ + ", ".join(sround(f"({c} - (SELECT avg({c}) FROM i)) / (SELECT stddev_pop({c}) FROM i)", 6) + f" AS {c}"
                           for c in ("q", "price")) + " FROM i")
def m16_pipeline_save_and_load(spark, d):
    import uuid

    from pyspark.ml import Pipeline, PipelineModel

    from tessera.session import scratch_path
    df = data(spark, d)
    model = Pipeline(stages=[PR.Imputer(inputCols=["q", "price"], strategy="mean"),
                             PR.Standardizer(inputCols=["q", "price"])]).fit(df)
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex[:12]}")
    model.write().overwrite().save(path)
    out = PipelineModel.load(path).transform(df)
    return out.select(*KEYS, r6("q"), r6("price"))
