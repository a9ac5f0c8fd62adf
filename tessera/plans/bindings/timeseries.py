"""Step 3: price series from the events table.

Series = event_type; daily price = round(sum(value), 2) per day; days whose
day-of-month leaves 3 when divided by 7 carry the sentinel -1. The raw frame
mimics the price CSV: text date MM/dd/yyyy, text price with thousands commas,
extra columns that cleaning drops. Weekly index = number of events on each
Sunday, as text date yyyy-MM-dd.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregate as agg
from tessera.operators import windows as W
from tessera.plans import medallion as M
from tessera.plans.registry import query, sround, table

SERIES = "series"


def daily(spark, d):
    ev = table(spark, d, "events")
    return ev.groupBy(F.col("event_type").alias(SERIES), F.to_date("ts").alias("day")).agg(
        F.round(F.sum("value"), 2).alias("p"), F.count(F.lit(1)).alias("volume"))


def raw_prices(spark, d):
    dd = daily(spark, d)
    price_txt = F.when(F.dayofmonth("day") % 7 == 3, F.lit("-1")).otherwise(
        F.format_number("p", 2))
    return dd.select(F.col(SERIES), F.date_format("day", "MM/dd/yyyy").alias("Date"),
                     price_txt.alias("Price"), F.lit("0").alias("Open"), F.lit("0").alias("High"),
                     F.lit("0").alias("Low"), F.col("volume").cast("string").alias("Vol."),
                     F.lit("0%").alias("Change %"))


def trend(spark, d):
    ev = table(spark, d, "events")
    day = F.to_date("ts")
    return (ev.where(F.dayofweek(day) == 1)
              .groupBy(F.col("event_type").alias(SERIES),
                       F.date_format(day, "yyyy-MM-dd").alias("Settimana"))
              .agg(F.count(F.lit(1)).cast("string").alias("interesse")))


def silver(spark, d):
    return M.clean_prices(raw_prices(spark, d), series=SERIES)


SQL_DAILY = """daily AS (SELECT event_type AS series, CAST(ts AS DATE) AS day,
    round(sum(value), 2) AS p, count(*) AS volume FROM events GROUP BY 1, 2),
raw AS (SELECT series, day, volume, CASE WHEN day(day) % 7 = 3 THEN -1.0 ELSE p END AS price
    FROM daily)"""

SQL_SILVER = f"""WITH {SQL_DAILY},
silver AS (SELECT series, day AS "Date", {sround('''CASE WHEN price = -1 THEN
    avg(CASE WHEN price <> -1 THEN price END) OVER (PARTITION BY series ORDER BY day
        ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) ELSE price END''', 2)} AS "Price" FROM raw)"""


@query("w1_sentinel_fill", SQL_SILVER + ' SELECT series, "Date", "Price" FROM silver')
def w1_sentinel_fill(spark, d):
    return silver(spark, d)


@query("w2_moving_average", SQL_SILVER + f""" SELECT series, "Date", "Price",
    {sround('avg("Price") OVER (PARTITION BY series ORDER BY "Date" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)', 6)} AS "Price_MA_10"
    FROM silver""")
def w2_moving_average(spark, d):
    out = W.moving_average(silver(spark, d), "Price", ["Date"], 10, partition_by=SERIES,
                           out="Price_MA_10")
    return out.withColumn("Price_MA_10", F.round("Price_MA_10", 6))


# (l_orderkey, l_linenumber) repeats in the test data: order by every column
LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("w2_moving_average_unpartitioned", """SELECT l_orderkey, l_linenumber, l_partkey,
    """ + sround(f"avg(l_extendedprice) OVER (ORDER BY {', '.join(LI_ORDER)} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)", 4) + """ AS ma_10
    FROM lineitem""")
def w2_moving_average_unpartitioned(spark, d):
    li = table(spark, d, "lineitem")
    out = W.moving_average(li, "l_extendedprice", LI_ORDER, 10, out="ma_10")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("ma_10", 4).alias("ma_10"))


@query("a12_mean_per_date", SQL_SILVER + f""", ma AS (SELECT series, "Date",
    avg("Price") OVER (PARTITION BY series ORDER BY "Date" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m
    FROM silver)
    SELECT series, "Date", {sround('avg(m)', 6)} AS "Weekly_Price_MA" FROM ma GROUP BY 1, 2""")
def a12_mean_per_date(spark, d):
    ma = W.moving_average(silver(spark, d), "Price", ["Date"], 10, partition_by=SERIES,
                          out="Price_MA_10")
    out = M.mean_per_date(ma, "Date", "Price_MA_10", "Weekly_Price_MA", SERIES)
    return out.withColumn("Weekly_Price_MA", F.round("Weekly_Price_MA", 6))


SQL_GOLD = SQL_SILVER + """, ma AS (SELECT series, "Date",
    avg("Price") OVER (PARTITION BY series ORDER BY "Date" ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m
    FROM silver),
per_date AS (SELECT series, "Date", avg(m) AS w FROM ma GROUP BY 1, 2),
trend AS (SELECT event_type AS series, CAST(ts AS DATE) AS data, count(*) AS interesse
    FROM events WHERE dayofweek(CAST(ts AS DATE)) = 0 GROUP BY 1, 2)
SELECT p.series, t.data, CAST(""" + sround("p.w", 2) + """ AS DECIMAL(10,2)) AS prezzo,
    CAST(t.interesse AS INTEGER) AS indice_google_trend
FROM per_date p JOIN trend t ON p.series = t.series AND p."Date" = t.data"""


@query("j4_gold_join_weekly_index", SQL_GOLD)
def j4_gold_join_weekly_index(spark, d):
    return M.enrich_with_trend(silver(spark, d), trend(spark, d), "interesse", series=SERIES)


@query("p8_apply_mapping_load", """WITH g AS (""" + SQL_GOLD + """)
SELECT series AS asset, data AS "date", CAST(prezzo AS DOUBLE) AS price,
    CAST(indice_google_trend AS BIGINT) AS trend_index FROM g""")
def p8_apply_mapping_load(spark, d):
    gold = M.enrich_with_trend(silver(spark, d), trend(spark, d), "interesse", series=SERIES)
    return M.apply_mapping(gold, [("series", "asset", "string"), ("data", "date", "date"),
                                  ("prezzo", "price", "double"),
                                  ("indice_google_trend", "trend_index", "bigint")])


@query("w6_monthly_returns", SQL_SILVER + f""", per AS (SELECT series, strftime("Date", '%Y-%m') AS period,
    arg_max("Price", "Date") AS last_price FROM silver GROUP BY 1, 2)
SELECT series, period, last_price,
    {sround('last_price / lag(last_price) OVER (PARTITION BY series ORDER BY period) - 1.0', 6)} AS period_return
FROM per""")
def w6_monthly_returns(spark, d):
    out = W.period_returns(silver(spark, d), "Date", "Price", "month", SERIES)
    return out.withColumn("period_return", F.round("period_return", 6))


@query("w6_yearly_returns", """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d,
    avg(o_totalprice) AS price FROM orders GROUP BY 1),
per AS (SELECT strftime(d, '%Y') AS period, arg_max(price, d) AS lp FROM o GROUP BY 1)
SELECT period, """ + sround("lp", 4) + """ AS last_price,
    """ + sround("lp / lag(lp) OVER (ORDER BY period) - 1.0", 6) + """ AS period_return FROM per""")
def w6_yearly_returns(spark, d):
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.avg("o_totalprice").alias("price"))
    out = W.period_returns(o, "d", "price", "year")
    return out.select("period", F.round("last_price", 4).alias("last_price"),
                      F.round("period_return", 6).alias("period_return"))


@query("w7_extreme_moves", SQL_SILVER + f""", r AS (SELECT series, "Date", "Price",
    "Price" / lag("Price") OVER (PARTITION BY series ORDER BY "Date") - 1.0 AS ret FROM silver),
s AS (SELECT series, avg(ret) AS mu, stddev_samp(ret) AS sd FROM r WHERE ret IS NOT NULL GROUP BY 1)
SELECT r.series, r."Date", {sround('r.ret', 6)} AS daily_return, {sround('(r.ret - s.mu) / s.sd', 6)} AS z
FROM r JOIN s ON r.series = s.series WHERE abs((r.ret - s.mu) / s.sd) > 1.5""")
def w7_extreme_moves(spark, d):
    out = W.extreme_moves(silver(spark, d), "Date", "Price", k=1.5, series=SERIES)
    return out.select(SERIES, "Date", F.round("daily_return", 6).alias("daily_return"),
                      F.round("z", 6).alias("z"))


@query("a29_mean_volume", f"""WITH {SQL_DAILY}
SELECT series, strftime(day, '%Y-%m') AS period, {sround('avg(volume)', 6)} AS mean_volume
FROM raw GROUP BY 1, 2""")
def a29_mean_volume(spark, d):
    raw = raw_prices(spark, d).select(
        SERIES, F.date_format(F.try_to_date("Date", "MM/dd/yyyy"), "yyyy-MM").alias("period"),
        F.col("`Vol.`").try_cast("bigint").alias("volume"))
    out = agg.mean_per_key(raw, [SERIES, "period"], "volume", "mean_volume")
    return out.withColumn("mean_volume", F.round("mean_volume", 6))


@query("a30_mean_return_per_weekday", SQL_SILVER + f""", r AS (SELECT series, "Date",
    "Price" / lag("Price") OVER (PARTITION BY series ORDER BY "Date") - 1.0 AS ret FROM silver)
SELECT series, CAST(isodow("Date") AS INTEGER) AS weekday, {sround('avg(ret)', 6)} AS mean_return
FROM r GROUP BY 1, 2""")
def a30_mean_return_per_weekday(spark, d):
    s = silver(spark, d)
    r = W.rolling(s, ["Date"], {"prev": lambda w: F.first("Price").over(w)}, -1, -1, SERIES)
    r = r.withColumn("ret", F.try_divide("Price", "prev") - F.lit(1.0))  # no return after a price of 0
    out = agg.mean_per_weekday(r, "Date", "ret", key=[SERIES], out="mean_return")
    return out.withColumn("mean_return", F.round("mean_return", 6))


@query("w4_global_row_index", """SELECT l_orderkey, l_linenumber,
    row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS row_index FROM lineitem""")
def w4_global_row_index(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return W.global_index(li, ["l_orderkey", "l_linenumber"], out="row_index")
