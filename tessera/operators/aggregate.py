"""Grouped and conditional aggregation (inventory A1-A14, A29-A31).

All functions return lazy DataFrames; Catalyst plans partial (map-side)
aggregation before the shuffle, so a hot group key costs one partial row
per task, not one task holding the whole group.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- A2, A3, A5-A7
def count_when(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def sum_when(value, cond: Column, scale: int | None = 2) -> Column:
    """``round(sum(case when cond then value else 0 end), scale)``.

    Money should arrive as DECIMAL so the sum is exact and independent of
    row order; ``else 0`` keeps an all-unmatched group at 0 rather than NULL.
    """
    v = _c(value)
    s = F.sum(F.when(cond, v).otherwise(F.lit(0)))
    return F.round(s, scale) if scale is not None else s


def counts_by_code(code_col, codes: Sequence, names: Sequence[str]) -> list[Column]:
    """One conditional count per code, aliased (A5, A6): a fixed pivot with
    absent codes kept as 0-columns."""
    c = _c(code_col)
    return [count_when(c == F.lit(k)).alias(n) for k, n in zip(codes, names)]


# ---------------------------------------------------------------- A1
def monthly_report(df: DataFrame, date_col: str, amount_col: str,
                   month_col: str = "year_month", total_col: str = "total") -> DataFrame:
    """Sum of amounts per calendar month ``yyyy-MM``, ascending."""
    return (df.groupBy(F.date_format(_c(date_col), "yyyy-MM").alias(month_col))
              .agg(F.sum(_c(amount_col)).alias(total_col))
              .orderBy(month_col))


# ---------------------------------------------------------------- A9, A14
def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``GROUP BY`` all columns used as DISTINCT."""
    return (df.select(*cols) if cols else df).distinct()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(col).distinct()


def distinct_count(df: DataFrame, cols: Iterable[str], approx: bool = False) -> DataFrame:
    """Number of distinct values per column, one row."""
    f = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[f(F.col(c)).alias(f"n_distinct_{c}") for c in cols])


# ---------------------------------------------------------------- A10, A11, A12
def count_per_group(df: DataFrame, key: str, col: str, out: str = "n") -> DataFrame:
    """Count of non-null ``col`` per ``key`` (A10)."""
    return df.groupBy(key).agg(F.count(F.col(col)).alias(out))


def summary_per_group(df: DataFrame, key: str, col: str, prefix: str = "",
                      digits: int = 2) -> DataFrame:
    """count / rounded mean / min / max of ``col`` per ``key``."""
    c = F.col(col)
    return df.groupBy(key).agg(
        F.count(c).alias(f"{prefix}count"),
        F.round(F.avg(c), digits).alias(f"{prefix}avg"),
        F.min(c).alias(f"{prefix}min"),
        F.max(c).alias(f"{prefix}max"),
    )


def mean_per_key(df: DataFrame, key, col: str, out: str) -> DataFrame:
    """Mean of ``col`` per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.avg(col).alias(out))


# ---------------------------------------------------------------- A13
def row_count_snapshot(df: DataFrame, ts_col: str = "snapshot_ts",
                       count_col: str = "total_rows") -> DataFrame:
    """``SELECT current_timestamp, count(*)``."""
    return df.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.current_timestamp().alias(ts_col), F.col(count_col))


# ---------------------------------------------------------------- A30
def mean_per_weekday(df: DataFrame, date_col: str, value_col: str,
                     key: Sequence[str] = (), out: str = "mean_value") -> DataFrame:
    """Mean of ``value_col`` per ISO weekday (1 = Monday … 7 = Sunday)."""
    wd = (F.weekday(_c(date_col)) + 1).alias("weekday")
    return df.groupBy(*key, wd).agg(F.avg(value_col).alias(out))
