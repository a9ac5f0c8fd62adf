"""Step 6: descriptive statistics on lineitem numbers, word statistics and
term frequencies on documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.stopwords import ENGLISH
from tessera.operators import aggregate as agg
from tessera.operators import stats as S
from tessera.operators import text_analytics as X
from tessera.plans.registry import query, sround, table

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FEATURES = ["l_quantity", "l_discount", "l_tax"]
TARGET = "l_extendedprice"


def _union(template: str, cols=NUM) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


def r6(c):
    return F.round(c, 6)


@query("a16_describe", "SELECT * FROM (" + _union(
    "SELECT '{c}' AS \"column\", count({c}) AS \"count\", " + sround("avg({c})", 9) + " AS mean, "
    + sround("stddev_samp({c})", 6) + " AS std, min({c}) AS \"min\", max({c}) AS \"max\", "
    + sround("quantile_cont({c}, 0.25)", 6) + " AS q25, " + sround("quantile_cont({c}, 0.5)", 6) + " AS q50, "
    + sround("quantile_cont({c}, 0.75)", 6) + " AS q75 FROM lineitem") + ")")
def a16_describe(spark, d):
    out = S.describe(table(spark, d, "lineitem"), NUM)
    return out.select("column", "count", F.round("mean", 9).alias("mean"), r6("std").alias("std"), "min", "max",
                      r6("q25").alias("q25"), r6("q50").alias("q50"), r6("q75").alias("q75"))


@query("a16_describe_approx_count", "SELECT * FROM (" + _union(
    "SELECT '{c}' AS \"column\", count({c}) AS \"count\", min({c}) AS \"min\", max({c}) AS \"max\" FROM lineitem") + ")")
def a16_describe_approx_count(spark, d):
    # the approximate quantiles are not compared; the moments are exact
    out = S.describe(table(spark, d, "lineitem"), NUM, method="approx")
    return out.select("column", "count", "min", "max")


_CAT = ["l_returnflag", "l_linestatus", "l_shipmode_text"]


@query("a17_describe_categorical", """WITH li AS (SELECT l_returnflag, l_linestatus,
    CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_band FROM lineitem),
f AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM li GROUP BY 2
      UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM li GROUP BY 2
      UNION ALL SELECT 'size_band', size_band, count(*) FROM li GROUP BY 2)
SELECT "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
    arg_min(value, (-n, value)) AS top, max(n) AS freq FROM f GROUP BY 1""")
def a17_describe_categorical(spark, d):
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity")
    li = li.select("l_returnflag", "l_linestatus",
                   F.when(q < 10, "small").when(q < 30, "medium").otherwise("large").alias("size_band"))
    return S.describe_categorical(li, ["l_returnflag", "l_linestatus", "size_band"])


@query("a18_value_counts", "SELECT o_orderpriority, count(*) AS \"count\" FROM orders GROUP BY 1")
def a18_value_counts(spark, d):
    return S.value_counts(table(spark, d, "orders"), "o_orderpriority")


SKEW_SQL = _union("SELECT '{c}' AS \"column\", skewness({c}) AS skew FROM lineitem")


@query("a20_skewness", f"SELECT \"column\", {sround('skew', 6)} AS skew FROM ({SKEW_SQL})")
def a20_skewness(spark, d):
    return S.skewness(table(spark, d, "lineitem"), NUM).withColumn("skew", r6("skew"))


@query("a21_skew_summary", f"""SELECT {sround('avg(skew)', 6)} AS mean_skew, {sround('min(skew)', 6)} AS min_skew,
    {sround('max(skew)', 6)} AS max_skew FROM ({SKEW_SQL})""")
def a21_skew_summary(spark, d):
    s = S.skew_summary(S.skewness(table(spark, d, "lineitem"), NUM))
    return s.select(*[r6(c).alias(c) for c in s.columns])


@query("a22_split_by_skew", f"SELECT \"column\", abs(skew) >= 0.1 AS is_skewed FROM ({SKEW_SQL})")
def a22_split_by_skew(spark, d):
    return S.split_by_skew(S.skewness(table(spark, d, "lineitem"), NUM), 0.1, absolute=True).select(
        "column", "is_skewed")


_FENCES = _union("SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lineitem")


@query("a23_box_stats", f"""WITH f AS (SELECT "column", q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo,
    q3 + 1.5 * (q3 - q1) AS hi FROM ({_FENCES})),
o AS (""" + _union("SELECT '{c}' AS \"column\", count_if({c} < f.lo OR {c} > f.hi) AS n_outliers "
                   "FROM lineitem, f WHERE f.\"column\" = '{c}'") + f""")
SELECT f."column", {sround('q1', 6)} AS q1, {sround('q3', 6)} AS q3, {sround('iqr', 6)} AS iqr,
    {sround('lo', 6)} AS lower, {sround('hi', 6)} AS upper, o.n_outliers FROM f JOIN o ON f."column" = o."column" """)
def a23_box_stats(spark, d):
    b = S.box_stats(table(spark, d, "lineitem"), NUM)
    return b.select("column", *[r6(c).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]], "n_outliers")


@query("m33_remove_outliers", f"""WITH f AS (SELECT "column", q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
    FROM ({_FENCES}))
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE """ + " AND ".join(
    f"{c} BETWEEN (SELECT lo FROM f WHERE \"column\" = '{c}') AND (SELECT hi FROM f WHERE \"column\" = '{c}')"
    for c in NUM))
def m33_remove_outliers(spark, d):
    return S.remove_outliers(table(spark, d, "lineitem"), NUM).select("l_orderkey", "l_linenumber", "l_partkey")


@query("a24_histogram", """WITH r AS (""" + _union(
    "SELECT '{c}' AS \"column\", min({c}) AS lo, max({c}) AS hi FROM lineitem") + """),
v AS (""" + _union("SELECT '{c}' AS \"column\", {c} AS value FROM lineitem") + """),
b AS (SELECT v."column", CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS bin
    FROM v JOIN r ON v."column" = r."column"),
c AS (SELECT "column", bin, count(*) AS n FROM b GROUP BY 1, 2),
g AS (SELECT "column", lo, hi, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM r)
SELECT g."column", g.bin, """ + sround("lo + g.bin * ((hi - lo) / 20)", 6) + """ AS lower,
    """ + sround("lo + (g.bin + 1) * ((hi - lo) / 20)", 6) + """ AS upper, coalesce(c.n, 0) AS "count"
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def a24_histogram(spark, d):
    h = S.histogram(table(spark, d, "lineitem"), NUM, 20)
    return h.select("column", "bin", r6("lower").alias("lower"), r6("upper").alias("upper"), "count")


def _pairs():
    out = []
    for a in NUM:
        for b in NUM:
            out.append((a, b))
    return out


@query("a25_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + (sround(f"corr({a}, {b})", 6) + " AS r FROM lineitem"
                                                  if a != b else "1.0 AS r") for a, b in _pairs()))
def a25_correlation_matrix(spark, d):
    return S.correlation_matrix(table(spark, d, "lineitem"), NUM).withColumn("r", r6("r"))


@query("a26_grade_correlations", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {sround(f'corr({c}, {TARGET})', 6)} AS r, CASE WHEN abs(corr({c}, {TARGET})) < 0.25 "
    f"THEN 'weak' WHEN abs(corr({c}, {TARGET})) < 0.5 THEN 'medium' ELSE 'strong' END AS grade FROM lineitem"
    for c in FEATURES))
def a26_grade_correlations(spark, d):
    return S.grade_correlations(table(spark, d, "lineitem"), FEATURES, TARGET).withColumn("r", r6("r"))


@query("a27_regression_lines", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {sround(f'regr_slope({TARGET}, {c})', 4)} AS slope, "
    f"{sround(f'regr_intercept({TARGET}, {c})', 4)} AS intercept FROM lineitem" for c in FEATURES))
def a27_regression_lines(spark, d):
    r = S.regression_lines(table(spark, d, "lineitem"), FEATURES, TARGET)
    return r.select("column", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


# ------------------------------------------------------------------ documents
@query("a10_count_per_category", "SELECT lang, count(doc_id) AS num_articles FROM documents GROUP BY 1")
def a10_count_per_category(spark, d):
    return agg.count_per_group(table(spark, d, "documents"), "lang", "doc_id", "num_articles")


@query("a14_distinct_values", "SELECT DISTINCT source FROM documents")
def a14_distinct_values(spark, d):
    return agg.distinct_values(table(spark, d, "documents"), "source")


@query("a14_distinct_count", """SELECT count(DISTINCT lang) AS n_distinct_lang,
    count(DISTINCT source) AS n_distinct_source FROM documents""")
def a14_distinct_count(spark, d):
    return agg.distinct_count(table(spark, d, "documents"), ["lang", "source"])


@query("f9_word_count", """SELECT doc_id, len(string_split(text, ' ')) AS num_words,
    len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS num_real_words FROM documents""")
def f9_word_count(spark, d):
    doc = table(spark, d, "documents")
    return doc.select("doc_id", T.word_count("text").alias("num_words"),
                      T.word_count("text", skip_empty=True).alias("num_real_words"))


@query("f10_f11_derived_and_concat", """SELECT doc_id, len(string_split(source, ' ')) + len(string_split(text, ' ')) AS tot_num_words,
    md5(source || ' ' || text) AS sum_doc_md5 FROM documents""")
def f10_f11_derived_and_concat(spark, d):
    doc = table(spark, d, "documents")
    return doc.select("doc_id", (T.word_count("source") + T.word_count("text")).alias("tot_num_words"),
                      F.md5(T.concat_with_space("source", "text")).alias("sum_doc_md5"))


@query("a11_word_stats_per_category", """SELECT lang, count(doc_id) AS num_articles,
    """ + sround("avg(len(string_split(source, ' ')) + len(string_split(text, ' ')))", 2) + """ AS avg_num_words,
    min(len(string_split(source, ' ')) + len(string_split(text, ' '))) AS num_words_shortest_article,
    max(len(string_split(source, ' ')) + len(string_split(text, ' '))) AS num_words_longest_article
    FROM documents GROUP BY 1""")
def a11_word_stats_per_category(spark, d):
    return X.word_stats(table(spark, d, "documents"), "lang", ["source", "text"], "doc_id")


_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
_TF_SQL = f"""WITH t AS (SELECT lang, unnest(regexp_extract_all(lower(text), '{X.TOKEN_PATTERN.replace("'", "''")}')) AS term
    FROM documents),
c AS (SELECT lang, term, count(*) AS n FROM t WHERE term NOT IN ({_STOP}) GROUP BY 1, 2)"""


@query("a28_term_frequencies", _TF_SQL + " SELECT lang, term, n FROM c")
def a28_term_frequencies(spark, d):
    return X.term_frequencies(table(spark, d, "documents"), "lang", "text")


@query("w5_top_terms_per_category", _TF_SQL + """ SELECT lang, term, n FROM (SELECT *,
    row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rn FROM c) WHERE rn <= 25""")
def w5_top_terms_per_category(spark, d):
    return X.term_frequencies(table(spark, d, "documents"), "lang", "text", top_k=25)
