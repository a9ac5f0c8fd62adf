"""Step 4 and 10: sources, sinks and incremental loads as round trips of the
test tables through files in the shared scratch folder (a fresh sub-folder
per call, under the session's ``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import quality as Q
from tessera.plans.bindings.quality import LEDGER_SQL, VALIDATED_SQL, ledger
from tessera.plans.registry import query, table
from tessera.session import scratch_path, write_table
from tessera.sources import io
from tessera.streaming import ingest


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _ledger_folder(spark, d):
    """Valid ledger rows appended in one batch, faulty rows in another (S3)."""
    path = _scratch(spark, "ledger")
    v = Q.validate_ledger(ledger(spark, d))
    cols = ["Date", "Description", "Amount"]
    io.append_records(v.where("is_valid").select(*cols), path)
    io.append_records(v.where(~F.col("is_valid")).select(*cols), path)
    return path


@query("s1_s3_ledger_csv_roundtrip", VALIDATED_SQL + """ SELECT CAST(strptime("Date", '%d/%m/%Y') AS DATE) AS "date",
    "Description" AS description, CAST(replace("Amount", ',', '.') AS DECIMAL(18,2)) AS amount FROM v WHERE reason IS NULL""")
def s1_s3_ledger_csv_roundtrip(spark, d):
    typed, _ = io.read_ledger(spark, _ledger_folder(spark, d))
    return typed


@query("s2_ledger_file_verdicts", VALIDATED_SQL + """ SELECT reason IS NULL AS ok, CAST(count(*) AS BIGINT) AS n_rows,
    CAST(count_if(reason IS NOT NULL) AS BIGINT) AS n_bad_rows FROM v GROUP BY 1""")
def s2_ledger_file_verdicts(spark, d):
    v = io.check_ledger_files(spark, _ledger_folder(spark, d))
    return v.groupBy("ok").agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                               F.sum("n_bad_rows").cast("bigint").alias("n_bad_rows"))


@query("s4_csv_as_text", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
    CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def s4_csv_as_text(spark, d):
    path = _scratch(spark, "customer-csv")
    io.export(table(spark, d, "customer"), path, "csv")
    return io.read_csv_text(spark, path)


@query("s5_s6_parquet_roundtrip", "SELECT * FROM orders")
def s5_s6_parquet_roundtrip(spark, d):
    path = _scratch(spark, "orders-parquet")
    io.write_parquet(table(spark, d, "orders"), path, partition_by=["o_orderstatus"])
    return io.read_parquet(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                               "o_orderdate", "o_orderpriority")


@query("s8_json_lines_export", "SELECT * FROM part")
def s8_json_lines_export(spark, d):
    p = table(spark, d, "part")
    path = _scratch(spark, "part-json")
    io.export(p, path, "json")
    return spark.read.schema(p.schema).json(path)


@query("s10_typed_csv_load", "SELECT * FROM nation")
def s10_typed_csv_load(spark, d):
    n = table(spark, d, "nation")
    path = _scratch(spark, "nation-csv")
    io.write_csv_quoted(n, path)
    return io.copy_into(spark, "nation", path, {"nation": n.schema})


@query("s14_quoted_single_file", "SELECT * FROM region")
def s14_quoted_single_file(spark, d):
    r = table(spark, d, "region")
    path = _scratch(spark, "region-csv")
    io.write_csv_quoted(r, path, single_file=True)
    return io.copy_into(spark, "region", path, {"region": r.schema})


@query("s12_list_staged_files")
def s12_list_staged_files(spark, d):
    path = _scratch(spark, "staged")
    io.export(table(spark, d, "supplier"), path, "csv")
    return io.list_files(spark, path, "*.csv")


@query("s15_dataset_metadata", "SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows, 11 AS column_count FROM lineitem")
def s15_dataset_metadata(spark, d):
    m = io.dataset_metadata(table(spark, d, "lineitem"))
    return m.groupBy("file_name", "column_count").agg(F.sum("n_rows").alias("n_rows"))


@query("s16_write_with_metadata", "SELECT * FROM supplier")
def s16_write_with_metadata(spark, d):
    path = _scratch(spark, "supplier-out")
    io.write_with_manifest(table(spark, d, "supplier"), path, f"{d.rstrip('/')}/supplier.parquet")
    return spark.read.parquet(path)


@query("s16_output_manifest", """WITH c AS (SELECT CAST(count(*) AS VARCHAR) AS n FROM (DESCRIBE supplier))
SELECT * FROM (VALUES ('OriginalFileSize', 'size of the files'), ('OriginalFileLastModified', 'last modification of the files'),
    ('OriginalFileName', 'supplier.parquet'), ('OriginalFileCustomMetadata_Author', 'o''neil'), ('OriginalFileCustomMetadata_Format', 'Parquet'),
    ('OutputFileColumnNumber', '2'), ('OutputFileSize', 'size of the files'), ('OutputFileLastModified', 'last modification of the files')) AS t(key, value)
UNION ALL SELECT 'OriginalFileColumnNumber', n FROM c""")
def s16_output_manifest(spark, d):
    """The nine entries, read back from the table's properties; sizes and times
    are replaced by words where they equal a listing of the files."""
    source, path, name = f"{d.rstrip('/')}/supplier.parquet", _scratch(spark, "supplier-manifest"), f"tessera_manifest_{uuid.uuid4().hex[:12]}"
    s = table(spark, d, "supplier")
    saved = io.write_with_manifest(s.select(*s.columns[:2]), path, source, "o'neil", "Parquet", name)
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key").isin(*io.MANIFEST_KEYS))
    rows = {r["key"]: r["value"] for r in properties.collect()}
    spark.sql(f"DROP TABLE {name}")
    assert rows == {r["key"]: r["value"] for r in saved.collect()}
    for side, files in (("Original", io.list_files(spark, source)), ("Output", io.list_files(spark, path, "*.parquet"))):
        size, last = files.agg(F.sum("length"), F.max("modificationTime")).first()
        if rows[f"{side}FileSize"] == str(size):
            rows[f"{side}FileSize"] = "size of the files"
        if rows[f"{side}FileLastModified"] == last.isoformat():
            rows[f"{side}FileLastModified"] = "last modification of the files"
    return spark.createDataFrame(list(rows.items()), "key string, value string")


EVENT_CSV = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                          T.StructField("value", T.DoubleType())])


@query("r1_incremental_load", "SELECT event_id, event_type, value FROM events")
def r1_incremental_load(spark, d):
    base = _scratch(spark, "ingest")
    src, tgt, ck, rep = (f"{base}/{x}" for x in ("src", "tgt", "ck", "rep"))
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    hook = ingest.count_report(spark, tgt, rep)
    # two drops of new files, one load after each; a re-run loads nothing
    ev.where(F.col("event_type") < "m").write.mode("append").option("header", True).csv(src)
    ingest.incremental_load(spark, src, EVENT_CSV, tgt, ck, after_batch=hook)
    ev.where(F.col("event_type") >= "m").write.mode("append").option("header", True).csv(src)
    ingest.incremental_load(spark, src, EVENT_CSV, tgt, ck, after_batch=hook)
    ingest.incremental_load(spark, src, EVENT_CSV, tgt, ck, after_batch=hook)
    return ingest.read_target(spark, tgt)


# seven clinical tables made of orders, customers and events; both sides use these expressions
_CLINIC = {
    "pazienti": ("customer", ["CAST(c_custkey AS INT)", "c_name", "c_mktsegment", "DATE '1980-01-31'", "'F'", "c_name", "'Via, \"1\"'"]),
    "ricoveri": ("orders", ["CAST(o_orderkey AS INT)", "CAST(o_custkey AS INT)", "CAST(o_orderdate AS DATE)", "CAST(NULL AS DATE)", "o_orderpriority", "o_orderstatus"]),
    "visite": ("orders", ["CAST(o_orderkey AS INT)", "CAST(o_custkey AS INT)", "CAST(o_orderdate AS DATE)", "o_orderstatus", "o_orderpriority", "'a, b'"]),
    "terapie": ("orders", ["CAST(o_orderkey AS INT)", "CAST(o_custkey AS INT)", "CAST(o_orderdate AS DATE)", "CAST(o_orderdate AS DATE)", "o_orderpriority", "o_orderstatus", "'x'"]),
    "sensori_iot": ("events", ["CAST(event_id AS INT)", "CAST(event_id AS INT)", "TIMESTAMP '2024-01-02 03:04:05'", "event_type", "'120/80'", "'mmHg'"]),
    "utenti": ("customer", ["CAST(c_custkey AS INT)", "c_name", "c_mktsegment", "c_name", "c_mktsegment", "'it'"]),
    "accessi_log": ("events", ["CAST(event_id AS INT)", "CAST(event_id AS INT)", "CAST(event_id AS INT)", "TIMESTAMP '2024-01-02 03:04:05'", "event_type"]),
}


@query("r1_seven_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n, CAST(sum({cols[0]}) AS BIGINT) AS ids, count({cols[3]}) AS fourth, min(CAST({cols[4]} AS VARCHAR)) AS least FROM {src}"
    for t, (src, cols) in _CLINIC.items()))
def r1_seven_tables(spark, d):
    """Seven tables in two drops and a third run that finds nothing; then one
    table's file is written again with the same rows, which is no change."""
    from tessera.sources.schemas import CLINICAL
    base = _scratch(spark, "clinic")
    schemas = {t: CLINICAL[t] for t in _CLINIC}
    for half in (0, 1):
        for t, (src, cols) in _CLINIC.items():
            rows = table(spark, d, src)
            key = F.crc32(F.col(rows.columns[0]).cast("string").cast("binary")) % 2
            out = rows.where(key == half).selectExpr(*[f"{c} AS {n}" for c, n in zip(cols, schemas[t].names)])
            out.write.mode("append").options(header=True, escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss").csv(f"{base}/in/{t}")
        ingest.load_tables(spark, f"{base}/in", schemas, f"{base}/out", f"{base}/state")
    assert not any(ingest.load_tables(spark, f"{base}/in", schemas, f"{base}/out", f"{base}/state").values())
    parts = []
    for t in _CLINIC:
        x, names = ingest.read_target(spark, f"{base}/out/{t}"), schemas[t].names
        parts.append(x.agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(names[0]).alias("ids"), F.count(names[3]).alias("fourth"),
                           F.min(F.col(names[4]).cast("string")).alias("least")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("r2_load_report", """SELECT CAST(count(*) AS INTEGER) AS "Totale_Ricoveri", CAST(0 AS BIGINT) AS batch_id
    FROM events""")
def r2_load_report(spark, d):
    base = _scratch(spark, "ingest-report")
    src, tgt, ck, rep = (f"{base}/{x}" for x in ("src", "tgt", "ck", "rep"))
    ev = table(spark, d, "events").select("event_id", "event_type", "value")
    ev.write.mode("append").option("header", True).csv(src)
    ingest.incremental_load(spark, src, EVENT_CSV, tgt, ck, after_batch=ingest.count_report(spark, tgt, rep))
    return spark.read.parquet(rep).select("Totale_Ricoveri", "batch_id")


@query("s7_load_to_warehouse_table", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS data,
    CAST(o_totalprice AS DOUBLE) AS prezzo, CAST(length(o_orderpriority) AS INTEGER) AS indice_google_trend FROM orders""")
def s7_load_to_warehouse_table(spark, d):
    from tessera.plans.medallion import apply_mapping, load_to_table
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"),
                                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
                                         F.col("o_totalprice").cast("string").alias("p"),
                                         F.length("o_orderpriority").cast("string").alias("t"))
    typed = apply_mapping(o, [("k", "id", "bigint"), ("d", "data", "date"), ("p", "prezzo", "double"),
                              ("t", "indice_google_trend", "int")])
    name = f"tessera_fact_{uuid.uuid4().hex[:12]}"
    path = _scratch(spark, name)
    typed.limit(0).write.option("path", path).saveAsTable(name)   # declare (S11-style), then append (S7)
    load_to_table(typed, name, mode="append")
    loaded = spark.read.schema(spark.table(name).schema).parquet(path)
    spark.sql(f"DROP TABLE {name}")   # external: its files stay in the scratch folder
    return loaded


@query("s11_declared_clinical_table", """SELECT CAST(o_orderkey AS INTEGER) AS "ID_Ricovero", CAST(o_custkey AS INTEGER) AS "ID_Paziente",
    CAST(o_orderdate AS DATE) AS "Data_Inizio", CAST(CAST(o_orderdate AS DATE) + INTERVAL 3 DAY AS DATE) AS "Data_Fine",
    o_orderpriority AS "Reparto", o_orderstatus AS "Motivo_Ricovero" FROM orders""")
def s11_declared_clinical_table(spark, d):
    from tessera.sources.schemas import CLINICAL
    db = f"tessera_clinic_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{_scratch(spark, db)}'")
    io.create_tables(spark, db, {"ricoveri": CLINICAL["ricoveri"]})
    o = table(spark, d, "orders")
    rows = o.select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.to_date("o_orderdate"),
                    F.date_add(F.to_date("o_orderdate"), 3), F.col("o_orderpriority"), F.col("o_orderstatus"))
    rows.write.insertInto(f"{db}.ricoveri")
    loaded = write_table(spark.table(f"{db}.ricoveri"), "ricoveri")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return loaded


@query("s13_drifting_csv_source", """SELECT CAST(p_partkey AS VARCHAR) AS movies, p_type AS "genresgenregenre",
    CAST(NULL AS VARCHAR) AS "Rating:" FROM part""")
def s13_drifting_csv_source(spark, d):
    path = _scratch(spark, "movies-csv")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("movies"), F.col("p_type").alias("genresgenregenre"),
                                       F.col("p_size").alias("YEAR"))
    io.export(p, path, "csv")
    return io.read_csv_text(spark, path, columns=["movies", "genresgenregenre", "Rating:"])
