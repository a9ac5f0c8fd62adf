"""Joins (inventory J1-J4) and a size-checked broadcast.

Broadcasting is decided either by AQE at run time (from the measured size of
the finished shuffle stage, ``spark.sql.adaptive.autoBroadcastJoinThreshold``)
or by :func:`bounded_broadcast`, which counts the rows of
the candidate side and falls back to a shuffle join above the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_width(schema: T.StructType) -> int:
    """Upper estimate of the bytes of one row in a broadcast hash relation:
    8 per fixed-width field, 64 per string or binary, 256 per nested field."""
    width = 16
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, (T.StringType, T.BinaryType)):
            width += 64
        elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            width += 256
        else:
            width += 8
    return width


def bounded_broadcast(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint ``broadcast`` only when ``df`` provably fits: at most ``max_rows``
    rows and at most ``max_bytes`` by the schema's row-width estimate.

    The check is a count, one partial sum per task (a Parquet dimension table
    answers it from its footers); a larger side keeps a shuffle join (or AQE's
    own run-time choice).
    """
    limit = max(1, min(max_rows, max_bytes // row_width(df.schema)))
    return F.broadcast(df) if df.count() <= limit else df


def left_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Left outer equi-join."""
    return left.join(right, on=on, how=how)


def left_join_chain(base: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of left joins on one key.

    All joins share ``key``, so Spark keeps one hash partitioning of ``key``
    across the chain: each side is shuffled once, and none twice.
    """
    out = base
    for o in others:
        out = out.join(o, on=key, how="left")
    return out


def inner_join_project(left: DataFrame, right: DataFrame, on, cols: Sequence,
                       right_max_rows: int | None = None) -> DataFrame:
    """Inner equi-join followed by a projection (J3). ``right_max_rows`` asks
    for a size-checked broadcast of the right side."""
    r = bounded_broadcast(right, right_max_rows) if right_max_rows else right
    return left.join(r, on=on, how="inner").select(*cols)


def join_on_date_string(left: DataFrame, right: DataFrame, left_date: str, right_text: str,
                        fmt: str = "yyyy-MM-dd", how: str = "inner",
                        right_max_rows: int | None = None) -> DataFrame:
    """Join a DATE column to a column holding the date as text.

    The text side is parsed once with ``try_to_date`` (bad text becomes NULL
    and never matches), so the join stays a plain equi-join that Catalyst can
    plan as a hash or broadcast join instead of a cast inside a theta join.
    """
    key = "__join_date"
    r = right.withColumn(key, F.try_to_date(F.col(right_text), fmt))
    if right_max_rows:
        r = bounded_broadcast(r, right_max_rows)
    out = left.join(r, F.col(left_date).cast("date") == r[key], how)
    return out.drop(key)
