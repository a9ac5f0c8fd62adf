"""Loads of several tables, bad rows, changed files; manifests; tables that queries leave behind."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import io
from tessera.sources.schemas import CLINICAL
from tessera.streaming import ingest

from conftest import SF


def _drop(folder, table, name, lines):
    os.makedirs(f"{folder}/{table}", exist_ok=True)
    with open(f"{folder}/{table}/{name}", "w") as f:
        f.write("\n".join([",".join(CLINICAL[table].names), *lines]) + "\n")


def test_bad_rows_leave_the_target_and_other_tables_load(spark, tmp_dir):
    src, out, state = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/state"
    schemas = {t: CLINICAL[t] for t in ("visite", "accessi_log")}
    _drop(src, "visite", "a.csv", ['1,7,2024-01-02,x,"Rossi, Anna",n', "2,7,2024-01-03,x,y,"])
    _drop(src, "accessi_log", "a.csv", ["1,2,3,2024-01-02 10:00:00,read"])
    assert ingest.load_tables(spark, src, schemas, out, state) == {"visite": 2, "accessi_log": 1}
    assert ingest.read_target(spark, f"{out}/visite").where("Medico = 'Rossi, Anna'").count() == 1
    _drop(src, "visite", "b.csv", ["3,8,2024-01-04,x,y,z", "four,8,2024-01-04,x,y,z"])
    _drop(src, "accessi_log", "b.csv", ["2,2,3,2024-01-02 11:00:00,write"])
    with pytest.raises(Exception):
        ingest.load_tables(spark, src, schemas, out, state)
    assert ingest.read_target(spark, f"{out}/visite").count() == 2
    assert ingest.read_target(spark, f"{out}/accessi_log").count() == 2
    _drop(src, "visite", "b.csv", ["3,8,2024-01-04,x,y,z"])  # mended
    assert ingest.load_tables(spark, src, schemas, out, state) == {"visite": 1, "accessi_log": 0}


def test_changed_files_are_told_by_content(spark, tmp_dir):
    src, out, state = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/state"
    schemas = {"accessi_log": CLINICAL["accessi_log"]}
    line = "1,2,3,2024-01-02 10:00:00,read"
    _drop(src, "accessi_log", "a.csv", [line])
    assert ingest.load_tables(spark, src, schemas, out, state) == {"accessi_log": 1}
    os.utime(f"{src}/accessi_log/a.csv", (1, 1))  # touched, the same content
    assert ingest.load_tables(spark, src, schemas, out, state) == {"accessi_log": 0}
    _drop(src, "accessi_log", "a.csv", [line, "9,2,3,2024-01-02 10:00:00,read"])
    assert ingest.load_tables(spark, src, schemas, out, state) == {"accessi_log": 2}
    assert ingest.load_tables(spark, src, schemas, out, state) == {"accessi_log": 0}
    assert sorted(r[0] for r in ingest.read_target(spark, f"{out}/accessi_log").select("ID_Accesso").collect()) == [1, 1, 9]


def test_manifest_of_an_output(spark, tmp_dir):
    df = spark.range(10).select("id", F.lit("x").alias("x"))
    df.repartition(3).write.csv(f"{tmp_dir}/source", header=True)
    got = {r["key"]: r["value"] for r in io.write_with_manifest(df, f"{tmp_dir}/out", f"{tmp_dir}/source", author="A", fmt="csv", header=True).collect()}
    assert sorted(got) == sorted(io.MANIFEST_KEYS)
    files = [f"{tmp_dir}/out/{f}" for f in os.listdir(f"{tmp_dir}/out") if f.endswith(".parquet")]
    assert got["OutputFileSize"] == str(sum(map(os.path.getsize, files))) and got["OutputFileColumnNumber"] == got["OriginalFileColumnNumber"] == "2"
    assert got["OriginalFileName"] == "source" and got["OriginalFileCustomMetadata_Author"] == "A" and got["OriginalFileCustomMetadata_Format"] is None


def test_queries_leave_no_table_behind(spark):
    import __spark_entry__ as E
    before = (len(spark.catalog.listTables()), len(spark.catalog.listDatabases()))
    for name in ("s7_load_to_warehouse_table", "s11_declared_clinical_table", "s16_output_manifest"):
        assert E.queries()[name](spark, SF).count()
    assert (len(spark.catalog.listTables()), len(spark.catalog.listDatabases())) == before
