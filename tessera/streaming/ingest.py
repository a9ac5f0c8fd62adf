"""Hourly incremental loads as Structured Streaming (inventory R1, R2).

The reference schedules ``COPY INTO`` every hour. Here a file stream with a
checkpoint replaces the schedule's bookkeeping: each run (``availableNow``
trigger, from any scheduler) loads exactly the files it has not seen, and a
restart after a failure resumes from the checkpoint. Spark tracks files by
path; :func:`load_tables` also keeps a fingerprint of every loaded file's
content, by which it finds files that were rewritten under their old name.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "csv",
                **options) -> DataFrame:
    opts = {"header": True, "quote": '"', "escape": '"'} if fmt == "csv" else {}
    opts.update(options)
    return spark.readStream.format(fmt).schema(schema).options(**opts).load(source_dir)


def incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                     checkpoint: str, fmt: str = "csv", after_batch=None, **options) -> dict:
    """Load every new file of ``source_dir`` into the Parquet folder
    ``target_path`` and stop (R1). ``after_batch(batch_df, batch_id)`` runs
    after each batch is written (R2). Returns counts of this run.

    Each micro-batch overwrites its own ``batch_id=N`` sub-folder, so a batch
    replayed after a failure (written, but not yet committed to the
    checkpoint) replaces its earlier output instead of duplicating it. Read
    the target with :func:`read_target`."""
    stream = file_stream(spark, source_dir, schema, fmt, **options)

    written = []  # ids of this run's batches; progress reports keep only the last hundred

    def write_batch(batch: DataFrame, batch_id: int):
        written.append(batch_id)
        batch.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/batch_id={batch_id}")
        if after_batch is not None:
            after_batch(batch, batch_id)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not written:
        return {"batches": 0, "rows": 0}
    counts = (spark.read.schema(schema).parquet(*[f"{target_path.rstrip('/')}/batch_id={b}" for b in sorted(set(written))])
              .groupBy(F.col("_metadata.file_path").alias("f")).count()
              .groupBy(F.regexp_extract("f", r"batch_id=(\d+)", 1).alias("b")).agg(F.sum("count").alias("n"))
              .agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first())
    return counts.asDict()


def _fingerprints(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Content of each file as one number: a sum over its lines, so a large
    file is read by many tasks."""
    if not paths:
        return {}
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.xxhash64("value").cast("decimal(38,0)").alias("h"))
    rows = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).collect()  # one row per new or touched file
    return {r["path"]: f"{r['n']}:{r['h']}" for r in rows}


def load_tables(spark: SparkSession, source_root: str, schemas: dict[str, T.StructType], target_root: str, state_root: str,
                after_batch=None, **options) -> dict[str, int]:
    """One run of the hourly load for every table of ``schemas`` (R1): new files
    of ``<source_root>/<table>`` are appended to ``<target_root>/<table>``; the
    result is the number of rows added per table.

    The tables are streams of their own that run side by side. A row that does
    not fit the table's schema fails its batch (FAILFAST, as COPY does): a batch
    is published as one folder when it is written whole, so the target stays as
    it was, and the run ends with the error after the other tables are done. A
    file whose size or time changed since it was loaded is read again if its
    content differs (COPY loads a changed file again, next to its old rows);
    a touched file with the same content is not.
    """
    options = {"mode": "FAILFAST", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd", **options}

    def load(name: str) -> int:
        source, target, state = (f"{r.rstrip('/')}/{name}" for r in (source_root, target_root, state_root))
        ledger = f"{state}/ledger"
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "[!_.]*").load(source)
        found = {r["path"]: (r["length"], r["modificationTime"]) for r in listed.select("path", "length", "modificationTime").collect()}
        try:
            latest = spark.read.parquet(ledger).groupBy("path").agg(F.max_by(F.struct("length", "modified", "content"), "run").alias("x"), F.max("run").alias("run"))
            known = {r["path"]: r for r in latest.select("path", "x.*", "run").collect()}
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            known = {}
        touched = [p for p, stat in found.items() if p not in known or (known[p]["length"], known[p]["modified"]) != stat]
        content = _fingerprints(spark, touched)
        run = 1 + max((r["run"] for r in known.values()), default=-1)
        changed = [p for p in touched if p in known and content.get(p, "") != known[p]["content"]]
        rows = 0
        if changed:
            # the folder is named by the run: a run that failed before its ledger entry writes it again
            again = spark.read.format("csv").schema(schemas[name]).options(header=True, quote='"', escape='"', **options).load(changed)
            folder = f"{target}/batch_id={-1 - run}"
            again.write.mode("overwrite").parquet(folder)
            rows += spark.read.parquet(folder).count()
        rows += incremental_load(spark, source, schemas[name], target, f"{state}/checkpoint", after_batch=after_batch, **options)["rows"]
        if touched:
            entries = [(p, *found[p], content.get(p, ""), run) for p in touched]
            spark.createDataFrame(entries, "path string, length long, modified timestamp, content string, run long").coalesce(1).write.mode("append").parquet(ledger)
        return rows

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(schemas)))) as pool:
        runs = {name: pool.submit(load, name) for name in schemas}
    errors = [run.exception() for run in runs.values() if run.exception()]
    if errors:
        raise errors[0]
    return {name: run.result() for name, run in runs.items()}


def read_target(spark: SparkSession, target_path: str) -> DataFrame:
    """The loaded rows, without the ``batch_id`` folder column."""
    return spark.read.parquet(target_path).drop("batch_id")


def count_report(spark: SparkSession, target_path: str, report_path: str,
                 ts_col: str = "Timestamp_Rilevazione", count_col: str = "Totale_Ricoveri"):
    """``after_batch`` hook appending ``(current timestamp, row count of the
    target)`` to a report table (R2). Idempotent per batch: a batch id that is
    already in the report is not appended twice (replays after a failure)."""

    def hook(_batch: DataFrame, batch_id: int):
        try:
            report = spark.read.parquet(report_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            report = None
        done = report is not None and not report.where(F.col("batch_id") == batch_id).isEmpty()
        if done:
            return
        total = spark.read.parquet(target_path).agg(F.count(F.lit(1)).cast("int").alias(count_col))
        row = total.select(F.current_timestamp().alias(ts_col), F.col(count_col),
                           F.lit(batch_id).cast("long").alias("batch_id"))
        row.write.mode("append").parquet(report_path)

    return hook
