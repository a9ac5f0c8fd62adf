"""Sorting, limits, top-k, keep-first dedup and bag union (inventory O1-O7, S17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name):
    return F.col(f"`{name}`") if isinstance(name, str) else name


# O1
def top_n(df: DataFrame, by: str, n: int = 10, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties broken by ``tie_breakers``
    ascending. ``orderBy(...).limit(n)`` is planned as TakeOrderedAndProject:
    each task keeps its own top ``n``, only those are merged."""
    return df.orderBy(_q(by).desc(), *[_q(t).asc() for t in tie_breakers]).limit(n)


# O2
def sort_by_parsed_date(df: DataFrame, col: str, fmt: str = "dd/MM/yyyy",
                        out: str | None = None) -> DataFrame:
    """Parse a text date and sort ascending by it (bad text sorts last)."""
    parsed = F.try_to_date(_q(col), fmt)
    name = out or "__parsed"
    res = df.withColumn(name, parsed).orderBy(F.col(name).asc_nulls_last())
    return res if out else res.drop(name)


# O3
def sort_desc_nulls_first(df: DataFrame, col: str, case_insensitive: bool = True) -> DataFrame:
    c = _q(col)
    if case_insensitive and isinstance(df.schema[col].dataType.simpleString(), str) \
            and df.schema[col].dataType.simpleString() == "string":
        c = F.lower(c)
    return df.orderBy(c.desc_nulls_first())


# O4
def order_by_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(*[_q(k) for k in keys])


# O5
def keep_first_per_key(df: DataFrame, key, arrival: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in ``arrival`` order (pandas
    ``drop_duplicates(keep='first')``).

    Computed as ``min_by(row, arrival)`` per key: a partial aggregation, so a
    hot key is reduced in every map task rather than sorted in one task
    (``dropDuplicates`` would keep an arbitrary row).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[_q(c) for c in rest])
    order = F.struct(*[_q(c) for c in arrival])
    first = df.groupBy(*[_q(k) for k in keys]).agg(F.min_by(row, order).alias("__first"))
    return first.select(*[_q(k) for k in keys], "__first.*").select(*[_q(c) for c in df.columns])


# O6
def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union by column name (pages concatenated)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


# O7, S17
def head(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; in ``order_by`` when given (deterministic), else in
    scan order."""
    return (df.orderBy(*[_q(c) for c in order_by]) if order_by else df).limit(n)
