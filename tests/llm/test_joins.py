"""Joins of tables that grow with the input are never broadcast: the rows that
exploded keys, probes and small files stand for are more than Spark's size of them tells."""

from pyspark.sql import functions as F

from tessera.llm import graph, simhash, stages


def plans_of(monkeypatch, *modules):
    """The plans of the tables that the modules write, as they are written."""
    plans = []
    for module in modules:
        def write(df, *rest, given=module.write_table, **named):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return given(df, *rest, **named)
        monkeypatch.setattr(module, "write_table", write)
    return plans


def test_near_duplicates_broadcast_no_table(spark, monkeypatch):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.expr(
        "concat_ws(' ', transform(sequence(1, 900), i -> md5(concat(id div 3, ':', i))))").alias("text"))
    plans = plans_of(monkeypatch, simhash, graph)
    out = simhash.near_duplicates(docs)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {i: i // 3 * 3 for i in range(60)}
    joins = [line.strip() for p in plans for line in p.splitlines() if "Join" in line]
    assert len(joins) >= 8 and not [line for line in joins if "Broadcast" in line or "Cartesian" in line]


def test_components_broadcast_no_table(spark, monkeypatch):
    plans = plans_of(monkeypatch, graph)
    found = graph.connected_components(spark.range(1, 40).select("id", (F.col("id") - F.col("id") % 10).alias("to")), "id", "to")
    assert {r["node"]: r["component"] for r in found.collect()} == {i: i // 10 * 10 for i in range(40)}
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)


def test_the_stage_broadcasts_no_ids(spark, monkeypatch):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.expr("repeat(concat('w', id div 2, ' '), 9)").alias("text"))
    plans = plans_of(monkeypatch, simhash, graph)
    out = stages.without_near_duplicates(spark, docs, "")
    kept = {r["doc_id"] for r in out.collect()}
    assert kept <= set(range(0, 30, 2)) and 0 in kept
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in plans[-1] and not any("BroadcastHashJoin" in p for p in plans)
