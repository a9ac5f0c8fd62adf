"""Projection, renaming, casting, masking and simple predicates (inventory P1-P15).

All of these are narrow transformations: no shuffle, fused into one
whole-stage-codegen span with the scan, and column pruning / filter pushdown
reach the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The mask text of the clinical masking policy (eleven asterisks).
MASK = "***********"


def _q(name: str) -> Column:
    """Column by exact name, even with dots or spaces in it."""
    return F.col(f"`{name}`")


# P1
def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by exact name (names like ``Vol.`` or ``Change %`` work)."""
    return df.drop(*names)


# P2
def select_rename(df: DataFrame, mapping) -> DataFrame:
    """Select and rename by a mapping ``{source: target}`` or list of pairs;
    a bare name keeps its own name."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    cols = []
    for p in pairs:
        src, dst = (p, p) if isinstance(p, str) else p
        cols.append(_q(src).alias(dst))
    return df.select(*cols)


# P3, F8
def derive_cast(df: DataFrame, col: str, to: str, out: str | None = None) -> DataFrame:
    """Derive a column with a safe cast: text that does not parse becomes NULL."""
    return df.withColumn(out or col, _q(col).try_cast(to))


# P4
def threshold_filter(df: DataFrame, col: str, threshold, op: str = ">") -> DataFrame:
    """Keep rows where ``col op threshold``; NULLs drop out (SQL semantics)."""
    c = _q(col)
    cond = {">": c > threshold, ">=": c >= threshold, "<": c < threshold,
            "<=": c <= threshold, "==": c == threshold, "!=": c != threshold}[op]
    return df.where(cond)


# P5
def map_columns_by_name(df: DataFrame, mapping: Mapping[str, str],
                        to: str = "string") -> DataFrame:
    """Map drifting columns by name to a required list; a name missing from the
    input yields a NULL column of the requested type instead of an error."""
    present = set(df.columns)
    return df.select(*[(_q(src).try_cast(to) if src in present else F.lit(None).cast(to)).alias(dst)
                       for src, dst in mapping.items()])


# P6
def surrogate_index(df: DataFrame, order_by=None, out: str = "RowIndex", start: int = 1) -> DataFrame:
    """Row index from ``start`` step 1. With ``order_by`` it follows that total
    order (global_index); without, it follows the current partition order in
    two passes (per-partition counts, then offsets), with no extra shuffle."""
    from tessera.operators.windows import global_index, index_in_partition_order
    if order_by:
        return global_index(df, order_by, out=out, start=start)
    return index_in_partition_order(df, out=out, start=start)


# P7
def replace_values_in_row(df: DataFrame, index_col: str, row: int,
                          values: Mapping[str, object]) -> DataFrame:
    """Overwrite columns on the row whose ``index_col == row`` (the ADF header
    translation); every other row is untouched."""
    hit = F.col(index_col) == F.lit(row)
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(_q(c)) for c, v in values.items()})


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns through a lookup (P7 preferred form, F18)."""
    return df.withColumnsRenamed(dict(mapping))


# P9
def replace_sentinel(df: DataFrame, col: str, sentinel, replacement: Column) -> DataFrame:
    return df.withColumn(col, F.when(_q(col) == F.lit(sentinel), replacement).otherwise(_q(col)))


# P10
def flag_both_null(df: DataFrame, a: str, b: str, out: str = "both_null") -> DataFrame:
    return df.withColumn(out, _q(a).isNull() & _q(b).isNull())


def drop_both_null(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(~(_q(a).isNull() & _q(b).isNull()))


# P11
def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


# P12
def coalesce_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(_q(c), F.lit(0).cast(df.schema[c].dataType))
                           for c in cols})


# P13
def privacy_view(df: DataFrame, cols: Sequence[str], view_name: str | None = None) -> DataFrame:
    """Column-subset view; registered as a temporary view when named."""
    out = df.select(*[_q(c) for c in cols])
    if view_name:
        out.createOrReplaceTempView(view_name)
    return out


# P14
def mask_column(df: DataFrame, col: str, role, allowed_roles: Sequence[str],
                mask: str = MASK) -> DataFrame:
    """Show ``col`` only to the allowed roles, compared case-insensitively;
    everyone else sees ``mask``. ``role`` is a role name or a Column (for
    per-row roles, e.g. an access log joined to the data)."""
    r = role if isinstance(role, Column) else F.lit(role)
    allowed = [a.lower() for a in allowed_roles]
    return df.withColumn(col, F.when(F.lower(r).isin(*allowed), _q(col)).otherwise(F.lit(mask)))


# P15
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def columns_by_dtype(df: DataFrame, include: Sequence[str] = ("numeric",),
                     exclude: Sequence[str] = ()) -> list[str]:
    """Column names by type family: ``numeric``, ``string``, ``date``,
    ``timestamp``, ``boolean`` or a Spark simple type name."""
    def fam(dt):
        out = {dt.simpleString()}
        if isinstance(dt, _NUMERIC):
            out.add("numeric")
        if isinstance(dt, T.StringType):
            out |= {"string", "object"}
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            out.add("timestamp")
        if isinstance(dt, T.DateType):
            out.add("date")
        if isinstance(dt, T.BooleanType):
            out.add("boolean")
        return out
    inc, exc = set(include), set(exclude)
    return [f.name for f in df.schema.fields
            if (not inc or fam(f.dataType) & inc) and not fam(f.dataType) & exc]


def select_by_dtype(df: DataFrame, include: Sequence[str] = ("numeric",),
                    exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*[_q(c) for c in columns_by_dtype(df, include, exclude)])
