"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import write_table


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with ``least``: the smallest node among u and its v.

    The smallest nodes are written first: the join then reads two tables, and
    only between plain shuffles can the links of one node be split over tasks.
    Never a broadcast: small files can hold very many links."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return edges.hint("merge").join(write_table(least, "least"), "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that can be reached over ``links``,
    for every node on a link between different nodes.

    Alternates large-star and small-star steps until the links no longer
    change. A node's smallest neighbour is a partial aggregate, and the join
    back to its links reads written tables, so that a skewed join splits the
    links of one node and a node with very many links is no single task.
    """
    edges = (links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = write_table(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = write_table(_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "links")
        small = _least(large)
        small = (small.select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .union(small.select("u", F.col("least").alias("v"))).where("u <> v").distinct())
        edges = write_table(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select("v", "v")).distinct())
