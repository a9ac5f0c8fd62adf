"""The halo rolling engine and the global index equal plain Spark windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import windows as W


def _data(spark, n=300, series=3):
    rnd = random.Random(7)
    rows = [(s, i, rnd.choice([-1.0, rnd.uniform(0, 100)])) for s in range(series) for i in range(n)]
    return spark.createDataFrame(rows, "s int, t int, v double")


def test_rolling_matches_window(spark):
    df = _data(spark)
    for lo, hi in ((-9, 0), (-5, -1), (-2, 3)):
        got = W.rolling(df, ["t"], {"m": lambda w: F.avg("v").over(w)}, lo, hi, "s", ranges=17)
        w = Window.partitionBy("s").orderBy("t").rowsBetween(lo, hi)
        exp = df.withColumn("m", F.avg("v").over(w))
        a = sorted((r.s, r.t, round(r.m, 9) if r.m is not None else None) for r in got.collect())
        b = sorted((r.s, r.t, round(r.m, 9) if r.m is not None else None) for r in exp.collect())
        assert a == b


def test_rolling_unpartitioned(spark):
    df = _data(spark, 200, 1).drop("s")
    got = W.moving_average(df, "v", ["t"], 10, out="m", ranges=13)
    exp = df.withColumn("m", F.avg("v").over(Window.orderBy("t").rowsBetween(-9, 0)))
    assert sorted((r.t, round(r.m, 9)) for r in got.collect()) == sorted((r.t, round(r.m, 9)) for r in exp.collect())


def test_global_index_invariant_to_layout(spark):
    df = _data(spark, 100, 2)
    a = W.global_index(df.repartition(7), ["s", "t"]).select("s", "t", "row_index")
    b = W.global_index(df.coalesce(1), ["s", "t"], num_partitions=3).select("s", "t", "row_index")
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb
    assert sorted(r[2] for r in ra) == list(range(1, 201))


def test_top_k_and_duplicates(spark):
    df = spark.createDataFrame([("a", 3), ("a", 5), ("a", 1), ("b", 2), ("c", 9), ("c", 9)], "g string, n int")
    top = W.top_k_per_group(df, "g", [F.col("n").desc()], 2)
    assert sorted(map(tuple, top.collect())) == [("a", 3), ("a", 5), ("b", 2), ("c", 9), ("c", 9)]
    dup = W.duplicate_key_rows(df, "g")
    assert dup.count() == 5


def test_period_returns(spark):
    import datetime as dt
    rows = [(dt.date(2024, 1, 5), 10.0), (dt.date(2024, 1, 31), 20.0), (dt.date(2024, 2, 10), 25.0),
            (dt.date(2024, 2, 29), 30.0)]
    df = spark.createDataFrame(rows, "d date, p double")
    r = {x.period: x.period_return for x in W.period_returns(df, "d", "p", "month").collect()}
    assert r["2024-01"] is None and abs(r["2024-02"] - 0.5) < 1e-12


def test_global_index_materialized(spark):
    df = _data(spark, 50, 2)
    a = W.global_index(df, ["s", "t"]).select("s", "t", "row_index")
    b = W.global_index(df, ["s", "t"]).select("s", "t", "row_index")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_bounded_broadcast(spark):
    from tessera.operators.joins import bounded_broadcast
    small = spark.range(10)
    assert "ResolvedHint" in small.transform(lambda d: bounded_broadcast(d, 100))._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in bounded_broadcast(small, 100)._jdf.queryExecution().logical().toString().lower()
    big = spark.range(1000)
    assert bounded_broadcast(big, 100) is big


def test_rolling_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None)
    @given(lo=st.integers(-6, 0), width=st.integers(0, 6), bucket=st.integers(7, 40),
           n=st.integers(1, 120), series=st.integers(1, 3), seed=st.integers(0, 1000))
    def check(lo, width, bucket, n, series, seed):
        rnd = random.Random(seed)
        hi = min(lo + width, 6)
        rows = [(s, i, rnd.uniform(-5, 5)) for s in range(series) for i in range(n)]
        df = spark.createDataFrame(rows, "s int, t int, v double")
        got = W.rolling(df, ["t"], {"m": lambda w: F.sum("v").over(w)}, lo, hi, "s",
                        ranges=bucket, strategy="halo")
        exp = df.withColumn("m", F.sum("v").over(Window.partitionBy("s").orderBy("t").rowsBetween(lo, hi)))
        key = lambda r: (r.s, r.t, None if r.m is None else round(r.m, 9))
        assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, exp.collect()), key=repr)

    check()


def test_global_index_keeps_payload_dense(spark):
    """Rows, several input partitions, a payload column in the result: every
    index once, in key order."""
    n = 1_000_000
    df = spark.range(0, n, numPartitions=7).select(
        F.xxhash64("id").alias("k"), F.col("id").alias("payload"), F.concat(F.lit("p"), F.col("id")).alias("text"))
    out = W.global_index(df, ["k"])
    row = out.agg(F.countDistinct("row_index").alias("d"), F.min("row_index").alias("lo"), F.max("row_index").alias("hi"),
                  F.countDistinct("payload").alias("p"), F.max(F.length("text")).alias("t")).first()
    assert (row["d"], row["lo"], row["hi"], row["p"]) == (n, 1, n, n)
    got = out.where("row_index IN (1, 500000, 1000000)").orderBy("row_index").select("k").collect()
    keys = sorted(r["k"] for r in df.select("k").collect())
    assert [r["k"] for r in got] == [keys[0], keys[499_999], keys[-1]]


def test_division_by_zero_is_defined(spark):
    flat = spark.createDataFrame([(f"2024-01-{d:02d}", 5.0) for d in range(1, 9)], "d string, p double").withColumn("d", F.to_date("d"))
    assert W.extreme_moves(flat, "d", "p").count() == 0
    zero = spark.createDataFrame([("2024-01-01", 0.0), ("2024-02-01", 3.0)], "d string, p double").withColumn("d", F.to_date("d"))
    assert [r["period_return"] for r in W.period_returns(zero, "d", "p").orderBy("period").collect()] == [None, None]


def test_rolling_is_one_shuffle_and_no_job_to_build(spark, capsys):
    import re

    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("t"), (F.col("id") % 1000).cast("double").alias("v"), F.lit("payload").alias("p"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    got = W.rolling(W.rolling(df, ["t"], {"m": lambda w: F.avg("v").over(w)}, -5, -1), ["t"], {"q": lambda w: F.sum("v").over(w)}, -3, 2)
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("run", "run")
    one = W.rolling(df, ["t"], {"m": lambda w: F.avg("v").over(w)}, -5, -1)
    one.explain("formatted")
    plan = capsys.readouterr().out.split("Subqueries")[0]
    moves = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: (\w+)", plan)
    # rows of the table move once; the edges move as at most k rows a range and task, then as one list a range
    assert sum("hashpartitioning" in how for _, how in moves) == 2 and "RoundRobin" not in plan
    w = Window.orderBy("t")
    want = df.withColumn("m", F.avg("v").over(w.rowsBetween(-5, -1))).withColumn("q", F.sum("v").over(w.rowsBetween(-3, 2)))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rolling_over_few_rows_and_many_ranges(spark):
    for n in (0, 1, 3, 40):
        df = spark.range(n).select((F.col("id") * 3).alias("t"), F.col("id").cast("double").alias("v"))
        for lo, hi in ((-7, 0), (-2, 5), (1, 4)):
            got = W.rolling(df, ["t"], {"s": lambda w: F.sum("v").over(w)}, lo, hi, ranges=33)
            want = df.withColumn("s", F.sum("v").over(Window.orderBy("t").rowsBetween(lo, hi)))
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rolling_with_null_keys(spark):
    rows = [(None if i % 3 == 0 else "b" if i % 3 == 1 else "a", i, float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = W.rolling(df, ["t"], {"m": lambda w: F.sum("v").over(w)}, -4, 1, "s", ranges=9)
    want = df.withColumn("m", F.sum("v").over(Window.partitionBy("s").orderBy("t").rowsBetween(-4, 1)))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
