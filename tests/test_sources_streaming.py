"""Sources, sinks and incremental loads in scratch folders."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.sources import io
from tessera.sources.schemas import CLINICAL
from tessera.streaming import ingest


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_ledger_file_contract(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "good.csv"), "Date,Description,Amount\n01/02/2024,Bread,2,50\n")
    _write(os.path.join(tmp_dir, "good2.csv"), "Date,Description,Amount\n1/2/2024,Milk,\"1,20\"\n03/02/2024,Eggs,3\n")
    _write(os.path.join(tmp_dir, "badrow.csv"), "Date,Description,Amount\n31/02/2024,Bread,2\n")
    _write(os.path.join(tmp_dir, "badhead.csv"), "Data,Descr,Amount\n01/02/2024,Bread,2\n")
    v = {os.path.basename(r.file): (r.header_ok, r.n_rows, r.n_bad_rows, r.ok)
         for r in io.check_ledger_files(spark, tmp_dir).collect()}
    assert v["good2.csv"] == (True, 2, 0, True)
    assert v["badrow.csv"][3] is False and v["badhead.csv"][0] is False
    # "2,50" unquoted is a 4-field row: the file fails
    assert v["good.csv"][3] is False
    typed, rejected = io.read_ledger(spark, tmp_dir)
    assert sorted(r.description for r in typed.collect()) == ["Eggs", "Milk"]
    assert "01/02/2024,Bread,2,50" in [r._corrupt_record for r in rejected.collect()]


def test_header_as_a_row_of_the_one_scan(spark, tmp_dir):
    heads = {"quoted": '"Date","Description","Amount"', "more": "Date,Description,Amount,Note", "fewer": "Date,Description", "none": "01/02/2024,Bread,2",
             "spaced": "Date, Description,Amount", "twice": "Date,Description,Amount\nDate,Description,Amount"}
    for name, head in heads.items():
        _write(os.path.join(tmp_dir, f"{name}.csv"), f"{head}\n01/02/2024,Bread,2\n02/02/2024,Milk,1\n")
    _write(os.path.join(tmp_dir, "only.csv"), "Date,Description,Amount\n")
    _write(os.path.join(tmp_dir, "empty.csv"), "")
    v = {os.path.basename(r.file)[:-4]: (r.header_ok, r.n_rows, r.n_bad_rows, r.ok) for r in io.check_ledger_files(spark, tmp_dir).collect()}
    assert v == {"quoted": (True, 2, 0, True), "more": (False, 2, 0, False), "fewer": (False, 2, 0, False), "none": (False, 2, 0, False),
                 "spaced": (False, 2, 0, False), "twice": (True, 3, 1, False), "only": (True, 0, 0, True)}


def test_header_over_many_blocks(spark, tmp_dir):
    """The file is cut into many blocks; its header is the first row of the first."""
    _write(os.path.join(tmp_dir, "long.csv"), "Date,Description,Amount\n" + "01/02/2024,Bread,2\n" * 5000 + "x,Bread,2\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        r = io.check_ledger_files(spark, tmp_dir).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (r.header_ok, r.n_rows, r.n_bad_rows) == (True, 5001, 1)


def test_copy_into_failfast(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pazienti.csv")
    _write(p, 'ID_Paziente,Nome,Cognome,Data_Nascita,Sesso,Codice_Fiscale,Indirizzo\n'
              '1,Anna,Neri,1980-01-02,F,XX,"Via Roma 1, Milano"\n')
    df = io.copy_into(spark, "pazienti", p)
    r = df.collect()[0]
    assert r.Indirizzo == "Via Roma 1, Milano" and str(r.Data_Nascita) == "1980-01-02"
    bad = os.path.join(tmp_dir, "bad.csv")
    _write(bad, "ID_Paziente,Nome,Cognome,Data_Nascita,Sesso,Codice_Fiscale,Indirizzo\nx,A,B,notadate,F,X,Y\n")
    with pytest.raises(Exception):
        io.copy_into(spark, "pazienti", bad).collect()


def test_sinks_and_listing(spark, tmp_dir):
    df = spark.range(5).select(F.col("id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    io.write_csv_quoted(df, os.path.join(tmp_dir, "q"), single_file=True)
    files = io.list_files(spark, os.path.join(tmp_dir, "q"), "*.csv").collect()
    assert len(files) == 1 and files[0].length > 0
    text = open(files[0].path.replace("file:", ""), encoding="utf-8").read()
    assert '"n0"' in text
    io.export(df, os.path.join(tmp_dir, "j"), "json")
    assert spark.read.json(os.path.join(tmp_dir, "j")).count() == 5
    io.write_parquet(df, os.path.join(tmp_dir, "p"))
    back = io.read_parquet(spark, os.path.join(tmp_dir, "p"))
    meta = io.dataset_metadata(back).collect()
    assert sum(m.n_rows for m in meta) == 5 and meta[0].column_count == 2
    rep = Q.issues_report(df.limit(1), df.limit(2))
    io.write_issues(rep, os.path.join(tmp_dir, "issues"))
    parts = {d for d in os.listdir(os.path.join(tmp_dir, "issues")) if d.startswith("issue=")}
    assert parts == {"issue=duplicate", "issue=missing"}


def test_read_csv_text_with_drift(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "m.csv"), "movies,Title,YEAR\nA,B,1999\n")
    df = io.read_csv_text(spark, tmp_dir, columns=["movies", "Rating:"])
    assert df.collect()[0].asDict() == {"movies": "A", "Rating:": None}


def test_incremental_load(spark, tmp_dir):
    src, tgt, ck, rep = (os.path.join(tmp_dir, x) for x in ("src", "tgt", "ck", "rep"))
    os.makedirs(src)
    schema = CLINICAL["ricoveri"]
    line = "ID_Ricovero,ID_Paziente,Data_Inizio,Data_Fine,Reparto,Motivo_Ricovero\n{},1,2024-01-01,2024-01-05,Cardio,Test\n"
    hook = ingest.count_report(spark, tgt, rep, )
    _write(os.path.join(src, "a.csv"), line.format(1))
    ingest.incremental_load(spark, src, schema, tgt, ck, after_batch=hook)
    assert ingest.read_target(spark, tgt).count() == 1
    ingest.incremental_load(spark, src, schema, tgt, ck, after_batch=hook)
    assert ingest.read_target(spark, tgt).count() == 1
    _write(os.path.join(src, "b.csv"), line.format(2))
    ingest.incremental_load(spark, src, schema, tgt, ck, after_batch=hook)
    assert ingest.read_target(spark, tgt).count() == 2
    time.sleep(1.1)
    _write(os.path.join(src, "a.csv"), line.format(3))
    ingest.incremental_load(spark, src, schema, tgt, ck, after_batch=hook)
    assert ingest.read_target(spark, tgt).count() == 2
    totals = sorted(r.Totale_Ricoveri for r in spark.read.parquet(rep).collect())
    assert totals == [1, 2]


def test_tables_and_warehouse_load(spark, tmp_dir):
    from tessera.plans.medallion import apply_mapping, load_to_table
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tessera_test LOCATION '{tmp_dir}/db'")
    names = io.create_tables(spark, "tessera_test")
    assert "tessera_test.pazienti" in names
    assert spark.table("tessera_test.sensori_iot").schema == CLINICAL["sensori_iot"]
    gold = spark.createDataFrame([("2024-01-07", "12.5", "40")], "d string, p string, t string")
    typed = apply_mapping(gold, [("d", "data", "date"), ("p", "prezzo", "double"), ("t", "indice_google_trend", "int")])
    load_to_table(typed, "tessera_test.price_fact")
    load_to_table(typed, "tessera_test.price_fact")
    assert spark.table("tessera_test.price_fact").count() == 2


def test_generic_csv_contract(spark, tmp_dir):
    head = "ID_Utente,Nome,Cognome,Email,Ruolo,Reparto\n"
    _write(os.path.join(tmp_dir, "ok.csv"), head + "1,Anna,Neri,a@x.it,medico,Cardio\n")
    _write(os.path.join(tmp_dir, "short.csv"), head + "2,Luca,Bianchi\n")
    _write(os.path.join(tmp_dir, "head.csv"), "id,nome\n3,Sara\n")
    v = {os.path.basename(r.file): r.ok for r in io.check_csv_files(spark, tmp_dir, CLINICAL["utenti"]).collect()}
    assert v == {"ok.csv": True, "short.csv": False, "head.csv": False}


def test_incremental_load_counts_its_rows(spark, tmp_path):
    from pyspark.sql import types as T

    from tessera.streaming import ingest
    src = tmp_path / "in"
    src.mkdir()
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    for k in range(3):
        (src / f"f{k}.csv").write_text("a\n1\n2\n")
    args = (spark, str(src), schema, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert ingest.incremental_load(*args, maxFilesPerTrigger=1) == {"batches": 3, "rows": 6}
    assert ingest.incremental_load(*args, maxFilesPerTrigger=1) == {"batches": 0, "rows": 0}
    (src / "f9.csv").write_text("a\n")
    assert ingest.incremental_load(*args, maxFilesPerTrigger=1)["rows"] == 0
