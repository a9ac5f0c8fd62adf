"""Medallion price pipeline: raw -> silver -> gold -> warehouse (reference jobs
T1, T2 and L of the price project; inventory S4-S7, P1, P8, P9, W1, W2, A12,
J4, F3, F4, F7, F8).

The reference runs each step on an unpartitioned window ordered by date;
here every window goes through :func:`tessera.operators.windows.rolling`,
per series when a series column is given, skew-proof either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.windows import fill_sentinel_with_previous_mean, moving_average

# Raw price file columns the cleaning job drops.
RAW_DROP = ("Open", "High", "Low", "Vol.", "Change %")


def _series(series) -> list[str]:
    return [] if series is None else ([series] if isinstance(series, str) else list(series))


def clean_prices(raw: DataFrame, date_col: str = "Date", price_col: str = "Price",
                 date_fmt: str = "MM/dd/yyyy", drop: Sequence[str] = RAW_DROP,
                 sentinel: float = -1, k: int = 5, series=None, **kw) -> DataFrame:
    """Raw -> silver: drop columns, parse date and price text, fill the
    sentinel with the mean of the ``k`` previous valid rows, round to 2."""
    df = raw.drop(*drop)                                                   # P1
    df = df.withColumn(date_col, F.try_to_date(F.col(date_col), date_fmt))  # F4
    df = df.withColumn(price_col, F.regexp_replace(F.col(price_col), ",", "")
                       .try_cast("double"))                                # F3
    return fill_sentinel_with_previous_mean(df, price_col, [date_col], sentinel, k,
                                            partition_by=series or None, digits=2, **kw)


def mean_per_date(df: DataFrame, date_col: str, value_col: str, out: str,
                  series=None) -> DataFrame:
    """Mean of ``value_col`` per date (A12). Named "weekly" in the reference,
    but it groups by day; the inner join with the weekly index thins it."""
    return df.groupBy(*_series(series), date_col).agg(F.avg(value_col).alias(out))


def enrich_with_trend(silver: DataFrame, trend: DataFrame, trend_value_col: str,
                      date_col: str = "Date", price_col: str = "Price",
                      trend_date_col: str = "Settimana", n: int = 10, series=None,
                      **kw) -> DataFrame:
    """Silver + weekly index text -> gold ``(data, prezzo, indice_google_trend)``.

    The weekly index has one row per week (and series); Spark broadcasts it if
    its measured size allows. Building the plan runs no job.
    """
    keys = _series(series)
    ma = moving_average(silver, price_col, [date_col], n, partition_by=keys or None,
                        out="Price_MA_10", **kw)                           # W2
    per_date = mean_per_date(ma, date_col, "Price_MA_10", "Weekly_Price_MA", keys)
    t = trend.select(*keys, F.try_to_date(F.col(trend_date_col), "yyyy-MM-dd").alias("data"),
                     F.col(trend_value_col).alias("__trend"))
    cond = [per_date[k] == t[k] for k in keys] + [per_date[date_col] == t["data"]]
    j = per_date.join(t, cond, "inner")                                    # J4
    return j.select(*[per_date[k] for k in keys], t["data"],
                    F.round(F.col("Weekly_Price_MA"), 2).cast("decimal(10,2)").alias("prezzo"),  # F7, F8
                    F.col("__trend").try_cast("int").alias("indice_google_trend"))


def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Typed projection from ``(source, target, type)`` triples (P8, U1):
    the reference's Python row map is replaced by JVM-side casts."""
    return df.select(*[F.col(src).try_cast(typ).alias(dst) for src, dst, typ in mappings])


def load_to_table(df: DataFrame, table: str, mode: str = "append", jdbc_url: str | None = None,
                  jdbc_props: dict | None = None) -> None:
    """Gold -> warehouse table (S7). A JDBC URL writes through JDBC instead."""
    if jdbc_url:
        df.write.mode(mode).jdbc(jdbc_url, table, properties=jdbc_props or {})
    else:
        df.write.mode(mode).saveAsTable(table)
