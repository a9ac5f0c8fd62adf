"""Step 2 and projections: period reports, top-k, sorts, filters, renames,
masking and views on the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregate as agg
from tessera.operators import joins
from tessera.operators import ordering as O
from tessera.operators import project as P
from tessera.plans.registry import query, sround, table


@query("a1_monthly_report", """SELECT strftime(o_orderdate, '%Y-%m') AS year_month,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders GROUP BY 1""")
def a1_monthly_report(spark, d):
    o = table(spark, d, "orders").withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    r = agg.monthly_report(o, "o_orderdate", "amount")
    return r.withColumn("total", F.col("total").cast("decimal(28,2)"))


@query("f5_year_month", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""")
def f5_year_month(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))


@query("o1_top_ten", """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o1_top_ten(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return O.top_n(o, "o_totalprice", 10, ["o_orderkey"])


@query("o2_sort_by_parsed_date", """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date_text,
    CAST(o_orderdate AS DATE) AS parsed FROM orders ORDER BY parsed""")
def o2_sort_by_parsed_date(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_text"))
    return O.sort_by_parsed_date(o, "date_text", "dd/MM/yyyy", out="parsed")


# rating planted NULL on parts whose size is a multiple of 10
_RATED = "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_retailprice / 100.0 END"


@query("o3_sort_desc_nulls_first", f"""SELECT p_partkey, p_name, {sround(_RATED, 4)} AS rating FROM part
    ORDER BY rating DESC NULLS FIRST, lower(p_name) DESC""")
def o3_sort_desc_nulls_first(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey", "p_name",
        F.round(F.when(F.col("p_size") % 10 == 0, F.lit(None)).otherwise(F.col("p_retailprice") / 100.0), 4)
        .alias("rating"))
    return O.sort_desc_nulls_first(p, "rating")


@query("o4_order_by_key", "SELECT c_custkey, c_name FROM customer ORDER BY 1")
def o4_order_by_key(spark, d):
    return O.order_by_keys(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("o7_head", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def o7_head(spark, d):
    return O.head(table(spark, d, "customer"), 20, ["c_custkey"])


@query("s17_preview_rows", "SELECT * FROM lineitem ORDER BY " + ", ".join(
    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]) + " LIMIT 10")
def s17_preview_rows(spark, d):
    return O.head(table(spark, d, "lineitem"), 10,
                  ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                   "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])


@query("p1_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def p1_drop_columns(spark, d):
    return P.drop_columns(table(spark, d, "orders"), "o_totalprice", "o_orderdate", "o_orderpriority")


@query("p2_select_rename", """SELECT p_name AS "Movies", p_type AS "Genres", p_size AS "Rating" FROM part""")
def p2_select_rename(spark, d):
    return P.select_rename(table(spark, d, "part"), {"p_name": "Movies", "p_type": "Genres", "p_size": "Rating"})


@query("p3_p4_cast_and_threshold", """SELECT p_partkey, TRY_CAST(p_brand_num AS DOUBLE) AS rating
    FROM (SELECT p_partkey, replace(p_brand, 'Brand#', '') AS p_brand_num FROM part)
    WHERE TRY_CAST(p_brand_num AS DOUBLE) > 3""")
def p3_p4_cast_and_threshold(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.regexp_replace("p_brand", "Brand#", "").alias("rating"))
    p = P.derive_cast(p, "rating", "double")
    return P.threshold_filter(p, "rating", 3, ">")


@query("p5_map_drifting_columns", """SELECT CAST(n_nationkey AS VARCHAR) AS nation,
    CAST(n_name AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS comment FROM nation""")
def p5_map_drifting_columns(spark, d):
    return P.map_columns_by_name(table(spark, d, "nation"),
                                 {"n_nationkey": "nation", "n_name": "name", "n_comment": "comment"})


@query("p6_surrogate_row_index", "SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS RowIndex FROM part")
def p6_surrogate_row_index(spark, d):
    return P.surrogate_index(table(spark, d, "part").select("p_partkey"), ["p_partkey"])


@query("p7_replace_first_row", """SELECT RowIndex,
    CASE WHEN RowIndex = 1 THEN 'Nazione' ELSE n_name END AS n_name,
    CASE WHEN RowIndex = 1 THEN 'Regione' ELSE CAST(n_regionkey AS VARCHAR) END AS n_regionkey
    FROM (SELECT row_number() OVER (ORDER BY n_nationkey) AS RowIndex, n_name, n_regionkey FROM nation)""")
def p7_replace_first_row(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").cast("string"))
    n = P.surrogate_index(n, ["n_nationkey"], out="RowIndex").drop("n_nationkey")
    return P.replace_values_in_row(n, "RowIndex", 1, {"n_name": "Nazione", "n_regionkey": "Regione"})


@query("f18_rename_by_lookup", """SELECT r_regionkey AS region_id, r_name AS region_name FROM region""")
def f18_rename_by_lookup(spark, d):
    lookup = {"r_regionkey": "region_id", "r_name": "region_name"}
    return P.rename_columns(table(spark, d, "region"), lookup)


@query("p10_both_null_filter", """SELECT event_id FROM (SELECT event_id,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS a,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END AS b FROM events) WHERE NOT (a IS NULL AND b IS NULL)""")
def p10_both_null_filter(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("event_type")).alias("a"),
        F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("props")).alias("b"))
    return P.drop_both_null(P.flag_both_null(e, "a", "b"), "a", "b").select("event_id")


@query("p11_fill_nulls", """SELECT event_id,
    coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END, '') AS a,
    coalesce(CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END, '') AS b FROM events""")
def p11_fill_nulls(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("event_type")).alias("a"),
        F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("props")).alias("b"))
    return P.fill_nulls(e, {"a": "", "b": ""})


@query("p13_privacy_view", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def p13_privacy_view(spark, d):
    return P.privacy_view(table(spark, d, "customer"), ["c_custkey", "c_nationkey", "c_mktsegment"])


@query("p14_mask_by_role", """SELECT c_custkey, CASE WHEN lower(c_mktsegment) IN ('building')
    THEN c_name ELSE '***********' END AS c_name FROM customer""")
def p14_mask_by_role(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    # the viewing role varies per row here: the market segment plays the role name
    return P.mask_column(c, "c_name", F.upper(F.col("c_mktsegment")), ["building"]).select("c_custkey", "c_name")


@query("p15_select_by_dtype", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p15_select_by_dtype(spark, d):
    li = table(spark, d, "lineitem")
    return P.select_by_dtype(li, include=["double"])


@query("j3_visit_patient_view", """SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_nationkey
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def j3_visit_patient_view(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.inner_join_project(o, c, "c_custkey", ["o_orderkey", "o_orderdate", "c_name", "c_nationkey"],
                                    right_max_rows=1_000_000)


@query("p9_replace_sentinel", """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN -1.0 ELSE o_totalprice END AS raw,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0.0 ELSE o_totalprice END AS price FROM orders""")
def p9_replace_sentinel(spark, d):
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("raw"))
    return P.replace_sentinel(o.withColumn("price", F.col("raw")), "price", -1, F.lit(0.0))


@query("a13_row_count_snapshot", "SELECT count(*) AS total_rows, true AS has_timestamp FROM orders")
def a13_row_count_snapshot(spark, d):
    snap = agg.row_count_snapshot(table(spark, d, "orders"))
    return snap.select("total_rows", F.col("snapshot_ts").isNotNull().alias("has_timestamp"))


@query("f3_strip_thousands", """SELECT o_orderkey, TRY_CAST(replace(format('{:,.2f}', o_totalprice * 10), ',', '') AS DOUBLE) AS price
    FROM orders""")
def f3_strip_thousands(spark, d):
    from tessera.functions.text import strip_thousands
    o = table(spark, d, "orders").select("o_orderkey", F.format_number(F.col("o_totalprice") * 10, 2).alias("txt"))
    return o.select("o_orderkey", strip_thousands("txt").alias("price"))


@query("p12_coalesce_zero_after_outer_join", """SELECT c.c_custkey, coalesce(o.n, 0) AS n_orders,
    coalesce(o.total, 0) AS total FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM orders
    GROUP BY 1) o ON o.o_custkey = c.c_custkey""")
def p12_coalesce_zero_after_outer_join(spark, d):
    o = table(spark, d, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    j = joins.left_join(table(spark, d, "customer").select("c_custkey"), o, "c_custkey")
    return P.coalesce_zero(j, ["n_orders", "total"])


@query("f4_parse_date_pattern", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d2 FROM orders""")
def f4_parse_date_pattern(spark, d):
    from tessera.functions.text import parse_date
    o = table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("t"),
        F.when(F.col("o_orderkey") % 101 == 0, F.lit("13/45/2020")).otherwise(
            F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t2"))
    return o.select("o_orderkey", parse_date("t", "MM/dd/yyyy").alias("d"), parse_date("t2").alias("d2"))


@query("f7_f8_round_and_cast", f"""SELECT o_orderkey, {sround('o_totalprice / 7.0', 2)} AS r2,
    CAST({sround('o_totalprice / 7.0', 2)} AS DECIMAL(10,2)) AS dec, CAST(o_custkey AS INTEGER) AS cust FROM orders""")
def f7_f8_round_and_cast(spark, d):
    o = table(spark, d, "orders")
    r = F.round(F.col("o_totalprice") / 7.0, 2)
    return o.select("o_orderkey", r.alias("r2"), r.cast("decimal(10,2)").alias("dec"), F.col("o_custkey").cast("int").alias("cust"))
