"""Edge cases and invariances: empty input, all-NULL columns, input order
and partitioning do not change results."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.operators import aggregate as A
from tessera.operators import ordering as O
from tessera.operators import quality as Q
from tessera.operators import stats as S
from tessera.operators import windows as W
from tessera.plans.customer_features import customer_features, output_columns


def test_customer_features_without_activity(spark):
    cust = spark.createDataFrame([(1, dt.date(1990, 5, 1)), (2, None)], "id_cliente long, data_nascita date")
    acc = spark.createDataFrame([], "id_cliente long, id_conto long, id_tipo_conto int")
    txn = spark.createDataFrame([], "id_conto long, id_tipo_trans int, importo decimal(18,2)")
    out = customer_features(cust, acc, txn, "2024-06-30")
    assert out.columns == output_columns()
    rows = {r.id_cliente: r for r in out.collect()}
    assert rows[1].eta == 34 and rows[2].eta is None
    assert all(rows[1][c] == 0 for c in out.columns[2:])


def test_customer_features_account_without_transactions(spark):
    cust = spark.createDataFrame([(1, dt.date(2000, 1, 1))], "id_cliente long, data_nascita date")
    acc = spark.createDataFrame([(1, 10, 0), (1, 11, 3)], "id_cliente long, id_conto long, id_tipo_conto int")
    txn = spark.createDataFrame([(10, 0, Decimal("5.50")), (10, 7, Decimal("2.25"))],
                                "id_conto long, id_tipo_trans int, importo decimal(18,2)")
    r = customer_features(cust, acc, txn, "2024-01-01").collect()[0]
    assert (r.numero_di_conti, r.tipo_conto_base, r.tipo_conto_famiglie) == (2, 1, 1)
    assert (r.numero_transazioni_in_entrata, r.numero_transazioni_in_uscita) == (1, 1)
    assert (r.importo_entrata_ContoBase, r.importo_uscita_ContoBase) == (Decimal("5.50"), Decimal("2.25"))
    assert r.trans_uscita_Supermercato == 1 and r.importo_entrata_ContoFamiglie == 0


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k int, t int, v double")
    assert W.moving_average(empty, "v", ["t"], 3, partition_by="k").count() == 0
    assert W.moving_average(empty, "v", ["t"], 3, strategy="halo").count() == 0
    assert W.global_index(empty, ["t"]).count() == 0
    assert S.quantiles(empty, ["v"]).count() == 0
    assert O.keep_first_per_key(empty, "k", ["t"]).count() == 0


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, v double")
    m = {r.column: r.n_missing for r in Q.missing_counts(df).collect()}
    assert m == {"k": 0, "v": 2}
    d = S.describe(df, ["v"]).collect()[0]
    assert d["count"] == 0 and d["q50"] is None


def test_invariant_to_partitioning_and_order(spark):
    rows = [(dt.date(2024, m, d), Decimal(f"{m}.{d:02d}")) for m in range(1, 7) for d in range(1, 28, 3)]
    df = spark.createDataFrame(rows, "d date, a decimal(18,2)")
    base = sorted(map(tuple, A.monthly_report(df, "d", "a").collect()))
    for variant in (df.repartition(7), df.orderBy(F.rand(3)), df.coalesce(1)):
        assert sorted(map(tuple, A.monthly_report(variant, "d", "a").collect())) == base
    k = spark.createDataFrame([(i % 4, i) for i in range(40)], "g int, n int")
    a = sorted(map(tuple, O.keep_first_per_key(k.repartition(5), "g", ["n"]).collect()))
    b = sorted(map(tuple, O.keep_first_per_key(k.coalesce(1), "g", ["n"]).collect()))
    assert a == b == [(0, 0), (1, 1), (2, 2), (3, 3)]
    idx_a = sorted(map(tuple, W.global_index(k.repartition(3), ["g", "n"]).collect()))
    idx_b = sorted(map(tuple, W.global_index(k.orderBy(F.rand(1)), ["g", "n"]).collect()))
    assert idx_a == idx_b


def test_null_keys_are_duplicates_and_nan_is_missing(spark):
    import math
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, n int")
    assert sorted(r.n for r in W.duplicate_key_rows(df, "k").collect()) == [1, 2, 4, 5]
    flags = {r.n: r.dup for r in W.duplicate_key_rows(df, "k", flag="dup").collect()}
    assert flags == {1: True, 2: True, 3: False, 4: True, 5: True}
    x = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,)], "x double")
    m = S.moments(x, ["x"]).collect()[0]
    assert m["count"] == 3 and abs(m["mean"] - 7 / 3) < 1e-12 and not math.isnan(m["std"])


def test_blank_is_python_strip(spark):
    from tessera.functions.text import is_blank
    df = spark.createDataFrame([("",), (" \t\n",), (" ",), ("a",)], "t string")
    assert [r.b for r in df.select(is_blank("t").alias("b")).collect()] == [True, True, True, False]


def test_unordered_surrogate_index_and_quarantine(spark):
    from tessera.operators.project import surrogate_index
    df = spark.range(0, 50, 1, 4).withColumnRenamed("id", "k")
    idx = surrogate_index(df, out="RowIndex")
    got = sorted(r.RowIndex for r in idx.collect())
    assert got == list(range(1, 51))
    again = {r.k: r.RowIndex for r in idx.collect()}
    assert again == {r.k: r.RowIndex for r in idx.collect()}   # stable on recomputation
    led = spark.createDataFrame([("01/02/2024", "x", "1,5", "f1"), ("31/02/2024", "y", "2", "f1"),
                                 ("03/02/2024", "z", "3", "f2")], "Date string, Description string, Amount string, file string")
    good, bad = Q.split_valid(Q.validate_ledger(led))
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["bad_date"]
    assert [r.file for r in Q.rows_of_valid_files(Q.validate_ledger(led)).collect()] == ["f2"]
