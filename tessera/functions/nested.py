"""JSON paths, array/struct updates, pairs from arrays and multi-valued
field aggregates (inventory F17, F19, F20, A31). All built-in higher-order
functions: they run inside codegen, per row, with no grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F17
def json_path(c, path: str, to: str | None = None) -> Column:
    """Value at a JSONPath (``$.a[0].b``) of a JSON text column."""
    v = F.get_json_object(_c(c), path)
    return v.try_cast(to) if to else v


def json_struct(c, schema: str) -> Column:
    """Parse a JSON text column with a DDL schema (no inference)."""
    return F.from_json(_c(c), schema)


# F19
def keep_elements(arr, pred) -> Column:
    """Array elements satisfying ``pred(x)``."""
    return F.filter(_c(arr), pred)


def update_elements(arr, fn) -> Column:
    """Array with ``fn(x)`` applied to each element (for struct elements use
    ``x.withField(...)``)."""
    return F.transform(_c(arr), fn)


def any_element(arr, pred) -> Column:
    return F.exists(_c(arr), pred)


def contains(arr, value) -> Column:
    return F.array_contains(_c(arr), value)


# F20
def pairs_from_arrays(df: DataFrame, id_col: str, arr_col: str) -> DataFrame:
    """Unordered pairs ``(a, b)``, ``a < b``, from "a lists b" arrays, with
    ``mutual`` true when each lists the other.

    Each listing becomes one ``(least, greatest, direction)`` row; a partial
    aggregation per pair then merges the two directions. No self-join, no
    pairs inside a group: the output is bounded by the listings."""
    e = df.select(F.col(id_col).alias("a"), F.explode(F.col(arr_col)).alias("b")).where(
        F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                 (F.col("a") < F.col("b")).alias("forward"))
    return e.groupBy("a", "b").agg((F.countDistinct("forward") == 2).alias("mutual"))


# A31
def count_per_value(df: DataFrame, arr_or_col: str, out: str = "n") -> DataFrame:
    """Rows per value of a (possibly multi-valued) field; an empty or NULL
    array counts under NULL (``explode_outer``)."""
    dt = df.schema[arr_or_col].dataType.simpleString()
    v = F.explode_outer(arr_or_col) if dt.startswith("array") else F.col(arr_or_col)
    return df.select(v.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias(out))


def values_per_row(df: DataFrame, id_col: str, arr_col: str, out: str = "n_values") -> DataFrame:
    """Number of values per row of a multi-valued field (NULL array -> 0)."""
    return df.select(id_col, F.coalesce(F.size(arr_col), F.lit(0)).alias(out))
