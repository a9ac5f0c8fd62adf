"""Validation, quarantine, missing values and duplicate handling
(inventory P16-P21, S9, with W3 and O5 from windows/ordering).

Validation never drops silently: rows are split into a good frame and a
quarantine frame that carries the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import is_blank, valid_amount, valid_day_month_year

# The valid ratings and stock statuses of the book catalogue.
VALID_RATINGS = ("One", "Two", "Three", "Four", "Five")
VALID_STOCK = ("In stock", "Out of stock")


def _q(name):
    return F.col(f"`{name}`")


def _first_failure(checks: Sequence[tuple[Column, str]]) -> Column:
    """Reason of the first failing check, NULL when all pass."""
    expr = F.lit(None).cast("string")
    for cond, reason in reversed(list(checks)):
        expr = F.when(~F.coalesce(cond, F.lit(False)), F.lit(reason)).otherwise(expr)
    return expr


# P16
def validate_ledger(df: DataFrame, date_col: str = "Date", desc_col: str = "Description",
                    amount_col: str = "Amount") -> DataFrame:
    """Add ``is_valid`` and ``reason`` to ledger rows: the date must be an
    existing ``dd/mm/yyyy`` day, the description not blank, the amount a finite
    number (decimal comma allowed)."""
    reason = _first_failure([
        (valid_day_month_year(_q(date_col)), "bad_date"),
        (~is_blank(_q(desc_col)), "empty_description"),
        (valid_amount(_q(amount_col)), "bad_amount"),
    ])
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def split_valid(df: DataFrame, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) frames from a validated frame."""
    return df.where(F.col(flag)), df.where(~F.col(flag))


# P17
def file_verdict(df: DataFrame, flag: str = "is_valid", file_col: str = "file") -> DataFrame:
    """One row per file: ``file_ok`` is true only when every row is valid."""
    return df.groupBy(file_col).agg(F.bool_and(F.col(flag)).alias("file_ok"),
                                    F.count(F.lit(1)).alias("n_rows"))


def rows_of_valid_files(df: DataFrame, flag: str = "is_valid", file_col: str = "file") -> DataFrame:
    """Rows of files with no bad row (any bad row rejects its whole file).
    The verdict has one row per file, so the semi-join side is small."""
    good = file_verdict(df, flag, file_col).where("file_ok").select(file_col)
    return df.join(good, file_col, "left_semi")


# P18
def validate_books(df: DataFrame, title: str = "Title", rating: str = "Rating",
                   price: str = "Price", stock: str = "Stock") -> DataFrame:
    """Domain rules of the book catalogue; a missing price passes (as NaN
    does in the reference) and is handled by the missing-value step."""
    reason = _first_failure([
        (~is_blank(_q(title)), "empty_title"),
        (_q(rating).isin(*VALID_RATINGS), "bad_rating"),
        (~F.coalesce(_q(price) < 0, F.lit(False)), "negative_price"),
        (_q(stock).isin(*VALID_STOCK), "bad_stock"),
    ])
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def _missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    m = _q(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        m = m | F.isnan(_q(c))
    return m


# P19
def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (or NaN in floating columns)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


# P20
def rows_with_missing(df: DataFrame) -> DataFrame:
    cond = F.lit(False)
    for c in df.columns:
        cond = cond | _missing(df, c)
    return df.where(cond)


# A15, P21
def missing_counts(df: DataFrame) -> DataFrame:
    """Long form ``(column, n_missing, n_rows)`` from a single scan."""
    aggs = [F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"))
                               for i, c in enumerate(df.columns)]))
    return one.select(F.col("n_rows"), stack.alias("s")).select("s.column", "s.n_missing", "n_rows")


def columns_without_missing(df: DataFrame) -> DataFrame:
    """Columns with no missing value."""
    return missing_counts(df).where(F.col("n_missing") == 0).select("column")


# A19
def duplicate_tally(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``duplicated().value_counts()``: rows that repeat an earlier row vs the
    rest. One partial aggregation per distinct row, then a global sum."""
    keys = list(subset) if subset else df.columns
    g = df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum(F.col("n") - 1).cast("bigint").alias("n_duplicated"),
                 F.count(F.lit(1)).alias("n_first"))


# S9
def issues_report(duplicates: DataFrame, missing: DataFrame) -> DataFrame:
    """One frame with an ``issue`` column (``duplicate`` / ``missing``), to be
    written with ``partitionBy("issue")`` or shown."""
    return (duplicates.withColumn("issue", F.lit("duplicate"))
            .unionByName(missing.withColumn("issue", F.lit("missing"))))
