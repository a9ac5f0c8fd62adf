"""Session construction and lineage cutting.

Library code never creates a session on its own; these helpers exist for
scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Setting that removes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Setting that limits the bytes of one batch of rows on its way to Python, and the limit for rows that hold texts.
BATCH_BYTES, TEXT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator of the cluster and
    is used as is. Only when nothing is configured (tests, local runs) a
    scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; on a cluster it must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint), and bounds the plan
    of iterative jobs.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def limit_batches(spark: SparkSession, most: int = TEXT_BATCH) -> None:
    """Sends rows to Python in batches of at most ``most`` bytes from now on,
    unless the session has a limit of its own: for rows that the caller runs,
    where ``write_table`` can't set the limit for the time of a write."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(most))


def write_table(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and return
    a DataFrame reading it back: a lineage cut that survives executor loss
    and is read as columnar files (cheaper than an RDD checkpoint). The
    shuffle files of the write go when it ends: the table replaces them.

    ``batch_bytes``: bytes of a batch of rows for the Python functions in
    ``df`` (a larger row is a batch of its own). A task holds several copies of
    a batch, in the JVM outside its heap and in Python."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    settings = {SHUFFLE_CLEANUP: "true"} | ({BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.parquet(path)
