"""File sources and sinks (inventory S1-S16).

Per-file checks (header, field count, row validity) are computed as one
DataFrame keyed by ``_metadata.file_path``: no file is opened on the driver
and no per-file job is launched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.quality import validate_ledger
from tessera.sources.schemas import CLINICAL, LEDGER_HEADER, LEDGER_TEXT

CORRUPT = "_corrupt_record"


def _paths(p):
    return [p] if isinstance(p, str) else list(p)


# S4, S13
def read_csv_text(spark: SparkSession, path, header: bool = True, columns: Sequence[str] | None = None,
                  **options) -> DataFrame:
    """Headered CSV with every field as text (no inference); ``columns``
    selects by name and yields NULL for a missing name (schema drift)."""
    df = spark.read.options(header=header, inferSchema=False, **options).csv(_paths(path))
    if columns:
        present = set(df.columns)
        df = df.select(*[(F.col(f"`{c}`") if c in present else F.lit(None).cast("string")).alias(c)
                         for c in columns])
    return df


# S1, S2
def read_csv_checked(spark: SparkSession, path, schema: T.StructType = LEDGER_TEXT) -> DataFrame:
    """CSV against a declared schema: header names must equal the schema
    (``enforceSchema=False``), rows with the wrong field count keep their raw
    line in ``_corrupt_record``, and each row carries its source file."""
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(s).options(header=True, enforceSchema=False, mode="PERMISSIVE",
                                       columnNameOfCorruptRecord=CORRUPT).csv(_paths(path)))
    return df.withColumn("file", F.col("_metadata.file_path"))


def _positional_rows(spark: SparkSession, path, schema: T.StructType = LEDGER_TEXT, header: bool = True) -> DataFrame:
    """Rows by position (a ``header`` line is skipped, not checked here); a row
    with the wrong field count keeps its raw line in ``_corrupt_record``."""
    s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(s).options(header=header, enforceSchema=True, mode="PERMISSIVE",
                                         columnNameOfCorruptRecord=CORRUPT)
            .csv(_paths(path)).withColumn("file", F.col("_metadata.file_path")))


def check_csv_files(spark: SparkSession, path, schema: T.StructType, validate=None,
                    header: Sequence[str] | None = None) -> DataFrame:
    """Per-file verdict of a CSV contract (S2, P17):
    ``(file, header_ok, n_rows, n_bad_rows, ok)``. A file passes when its
    first line holds exactly the expected names (the schema's unless ``header``
    is given; they may be quoted), no row has the wrong field count, and
    ``validate(rows) -> rows with is_valid`` (optional) accepts every row. A
    file without any line gives no row.

    One scan: the header is parsed as a row like the others and told by its
    place, the first row of the block at offset 0."""
    names = list(header) if header else [f.name for f in schema.fields]
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(CORRUPT, T.StringType())])
    rows = _positional_rows(spark, path, schema, header=False)
    rows = rows.withColumns({"__block": F.col("_metadata.file_block_start"), "__pos": F.monotonically_increasing_id()})
    # every data column is read: Spark tells a wrong field count only then
    fields = F.array(*[F.col(f"`{f.name}`").cast("string") for f in schema.fields])
    v = validate(rows) if validate else rows.withColumn("is_valid", F.size(fields) >= 0)
    # a header that does not fit the columns' types is in the corrupt record, as it stands in the file
    line = F.from_csv(F.col(CORRUPT), text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    wanted = F.array(*[F.lit(n) for n in names])
    named = F.when(F.col(CORRUPT).isNull(), fields == wanted).otherwise(
        line[CORRUPT].isNull() & (F.array(*[line[f"c{i}"] for i in range(len(names))]) == wanted))
    bad = F.coalesce(~F.col("is_valid"), F.lit(True)) | F.col(CORRUPT).isNotNull()
    v = v.select("file", "__block", "__pos", F.coalesce(named, F.lit(False)).alias("named"), bad.alias("bad"))
    first = F.min_by(F.struct("named", "bad"), F.when(F.col("__block") == 0, F.col("__pos")))
    out = v.groupBy("file").agg(first.alias("h"), (F.count(F.lit(1)) - 1).alias("n_rows"), F.count_if("bad").alias("n"))
    out = out.select("file", F.col("h.named").alias("header_ok"), "n_rows", (F.col("n") - F.col("h.bad").cast("long")).alias("n_bad_rows"))
    return out.withColumn("ok", F.col("header_ok") & (F.col("n_bad_rows") == 0))


def check_ledger_files(spark: SparkSession, path, header: Sequence[str] = LEDGER_HEADER) -> DataFrame:
    """The ledger contract: header ``Date,Description,Amount`` and every row
    a valid record (P16)."""
    return check_csv_files(spark, path, LEDGER_TEXT, lambda rows: validate_ledger(rows, *header), header)


def read_ledger(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Typed ledger rows of the files that pass :func:`check_ledger_files`,
    and the rows of the rejected files (S1), with the raw line in
    ``_corrupt_record`` where the field count was wrong. Amount text with a
    decimal comma is normalised."""
    verdict = check_ledger_files(spark, path)
    rows = _positional_rows(spark, path)
    good_files = verdict.where("ok").select("file")
    good = rows.join(good_files, "file", "left_semi")
    typed = good.select(F.try_to_date("Date", "d/M/yyyy").alias("date"), F.col("Description").alias("description"),
                        F.replace(F.col("Amount"), F.lit(","), F.lit(".")).try_cast("decimal(18,2)").alias("amount"))
    rejected = rows.join(good_files, "file", "left_anti")
    return typed, rejected


# S3
def append_records(df: DataFrame, path: str, header: bool = True) -> None:
    """Append rows as new CSV part files of the ledger folder."""
    df.write.mode("append").option("header", header).csv(path)


# S5, S6
def read_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(*_paths(path))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# S8
def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Cleaned rows as CSV with header, or as JSON lines."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        raise ValueError(fmt)


# S9
def write_issues(report: DataFrame, path: str) -> None:
    """Issues report (duplicates / missing) as CSV, one folder per issue."""
    report.write.mode("overwrite").partitionBy("issue").option("header", True).csv(path)


# S10, S11
def copy_into(spark: SparkSession, table: str, path, schemas: Mapping[str, T.StructType] = CLINICAL,
              fail_fast: bool = True) -> DataFrame:
    """Typed CSV load of a declared table: header skipped, fields optionally
    quoted with ``"``, positional columns; a malformed row fails the load
    (FAILFAST, as COPY does) unless ``fail_fast=False``."""
    return (spark.read.schema(schemas[table])
            .options(header=True, quote='"', escape='"', mode="FAILFAST" if fail_fast else "PERMISSIVE",
                     timestampNTZFormat="yyyy-MM-dd HH:mm:ss", dateFormat="yyyy-MM-dd")
            .csv(_paths(path)))


def create_tables(spark: SparkSession, database: str | None = None,
                  schemas: Mapping[str, T.StructType] = CLINICAL) -> list[str]:
    """Create (or replace) empty managed tables for the declared schemas."""
    names = []
    for name, schema in schemas.items():
        full = f"{database}.{name}" if database else name
        spark.createDataFrame([], schema).write.mode("overwrite").saveAsTable(full)
        names.append(full)
    return names


# S12
def list_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of the files under ``path``;
    the file content is never read (pruned column)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(_paths(path)).select("path", "length", "modificationTime")


# S14
def write_csv_quoted(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV sink with every text field quoted; one output file only when asked
    (it funnels all rows through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


# S15
def dataset_metadata(df: DataFrame) -> DataFrame:
    """Per input file: name, size, last modification and row count, plus the
    column count of the dataset (``GetMetadata``). ``df`` must be a file scan."""
    m = df.select(F.col("_metadata.file_name").alias("file_name"),
                  F.col("_metadata.file_size").alias("file_size"),
                  F.col("_metadata.file_modification_time").alias("last_modified"))
    return m.groupBy("file_name", "file_size", "last_modified").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "column_count", F.lit(len(df.columns)))


# S16
#: Fixed names of the nine entries of a manifest.
MANIFEST_KEYS = ("OriginalFileColumnNumber", "OriginalFileSize", "OriginalFileLastModified", "OriginalFileName",
                 "OriginalFileCustomMetadata_Author", "OriginalFileCustomMetadata_Format",
                 "OutputFileColumnNumber", "OutputFileSize", "OutputFileLastModified")


def _file_totals(spark: SparkSession, path, glob: str | None = None):
    """Number, summed size and last modification of the files of a dataset,
    and the name of its first."""
    return list_files(spark, path, glob).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("size"), F.max("modificationTime").alias("modified"),
        F.min(F.element_at(F.split("path", "/"), -1)).alias("name")).first()


def write_with_manifest(df: DataFrame, path: str, source: str, author: str | None = None, form: str | None = None,
                        table: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Write ``df`` and, after the commit, a manifest of what was read and what
    was written; returns the manifest, ``(key, value)`` in nine rows.

    The entries on the original come from the files of ``source`` (a dataset
    of ``fmt``; the size is that of all its files, the name that of its file or
    of the dataset's last path part if it has several) and from ``author`` and
    ``form``; those on the output from the files that were written, so a
    failed write leaves no manifest. It is saved as JSON lines in
    ``<path>_manifest`` and, with ``table``, as properties of an external table
    over ``path``. A value that is not known is NULL (and no table property).
    """
    spark = df.sparkSession
    columns = len(spark.read.format(fmt).options(**options).load(source).columns)
    before = _file_totals(spark, source)
    df.write.mode("overwrite").parquet(path)
    after = _file_totals(spark, path, "*.parquet")
    name = before["name"] if before["files"] == 1 else source.rstrip("/").rsplit("/", 1)[-1]
    stamp = [t["modified"].isoformat() if t["modified"] else None for t in (before, after)]
    values = [str(columns), str(before["size"] or 0), stamp[0], name, author, form,
              str(len(spark.read.parquet(path).columns)), str(after["size"] or 0), stamp[1]]
    manifest = spark.createDataFrame(list(zip(MANIFEST_KEYS, values)), "key string, value string")
    target = path.rstrip("/") + "_manifest"
    manifest.coalesce(1).write.mode("overwrite").json(target)
    if table:
        def quoted(text: str) -> str:
            return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
        properties = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in zip(MANIFEST_KEYS, values) if v is not None)
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {quoted(path)} TBLPROPERTIES ({properties})")
    return spark.read.schema("key string, value string").json(target)

