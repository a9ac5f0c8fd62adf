"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt into shards of bounded size. Each shard holds a forest: per
tree a sorted array of long hash strings (signs of random projections, the
first the most significant bit). A query descends every tree to its longest
matching prefix and then ascends all trees in step, one letter at a time,
until the ranges of rows that share the prefix hold enough candidates beside
the query itself, the wanted number of different ones at least; these are
scored exactly. Every query visits every shard, and the best of the shards
are merged, so all rows are indexed and no tree is ever one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import required, struct

FOUND = struct(query_id="long", vec_id="long", score="double")


class Forest:
    """Sorted hash strings of the rows of ``vectors``, per tree."""

    def __init__(self, vectors: np.ndarray, trees: int = 16, bits: int = 32, seed: int = 7):
        self.bits = bits
        self.planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], bits))
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings (trees x rows) as integers."""
        weights = np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return np.stack([((vectors @ p) > 0) @ weights for p in self.planes])

    def candidates(self, queries: np.ndarray, share: float, own: np.ndarray, enough):
        """For each query the rows of the longest common prefix length at
        which the ranges of all trees together hold ``share`` times the other
        rows and ``enough(query, rows)`` is true (all rows, if there is no such
        length). ``own``: rows of each query itself, which do not count."""
        codes = self.codes(queries)
        low = np.empty((self.bits + 1, *codes.shape), np.int64)
        high = np.empty_like(low)
        for level in range(self.bits + 1):
            rest = np.int64(self.bits - level)
            first = (codes >> rest) << rest
            for t in range(len(codes)):
                low[level, t] = np.searchsorted(self.sorted[t], first[t])
                high[level, t] = np.searchsorted(self.sorted[t], first[t] + (np.int64(1) << rest))
        held = (high - low).sum(axis=1) - len(codes) * own
        reached = held >= share * (self.order.shape[1] - own)
        level = np.where(reached.any(axis=0), self.bits - np.argmax(reached[::-1], axis=0), 0)
        for q in range(codes.shape[1]):
            for at in range(level[q], -1, -1):
                seen = np.zeros(self.order.shape[1], bool)
                for t in range(len(codes)):
                    seen[self.order[t, low[at, t, q]:high[at, t, q]]] = True
                rows = np.flatnonzero(seen)
                if not at or enough(q, rows):
                    break
            yield rows


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def search_shard(index: pd.DataFrame, queries: pd.DataFrame, k: int, share: float, trees: int, bits: int) -> pd.DataFrame:
    """The ``k`` best rows of a shard for each query."""
    index = index.assign(key=[v.tobytes() for v in index["embedding"]]).sort_values(["vec_id", "key"])
    queries = queries.assign(key=[v.tobytes() for v in queries["embedding"]]).sort_values(["vec_id", "key"]).drop_duplicates("vec_id")
    rows, asked = unit(np.stack(index["embedding"].to_list())), unit(np.stack(queries["embedding"].to_list()))
    ids, query_ids = index["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    size, asked_size = np.sqrt((rows * rows).sum(axis=1)), np.sqrt((asked * asked).sum(axis=1))
    forest = Forest(rows, trees, bits)
    known, number, times = np.unique(ids, return_inverse=True, return_counts=True)
    place = np.minimum(np.searchsorted(known, query_ids), len(known) - 1)
    own = np.where(known[place] == query_ids, times[place], 0)
    out = []
    for a in range(0, len(asked), 256):
        def enough(q: int, near: np.ndarray, a: int = a) -> bool:
            others = near[ids[near] != query_ids[a + q]]
            return len(others) >= k and (len(known) == len(ids) or len(np.unique(number[others])) >= k)

        for q, near in enumerate(forest.candidates(asked[a:a + 256], share, own[a:a + 256], enough), a):
            near = near[ids[near] != query_ids[q]]
            rough = (rows[near] @ asked[q]) / size[near]
            if len(near) > k:
                keep = rough >= np.partition(rough, -k)[-k] - 1e-9 * asked_size[q]
                near = near[keep]
            # summed alike for every row, so equal vectors tie exactly
            score = (rows[near] * asked[q]).sum(axis=1) / (size[near] * asked_size[q])
            best = np.lexsort((ids[near], -score))
            _, once = np.unique(ids[near][best], return_index=True)
            best = best[np.sort(once)][:k]
            out.append(pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[near][best], "score": np.clip(score[best], -1, 1)}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in FOUND.names})


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, share: float = 1.5, trees: int = 24, bits: int = 32,
            shard_rows: int = 8192, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the
    largest cosine found for each row of ``queries`` (both with vec_id and
    embedding), ties to the smaller vec_id.

    A query's own id is no candidate. Null and zero vectors, those with null
    or non-finite components and rows without an id take no part; vectors are
    compared with those of their own length. Of rows with the same id, a query
    is the first by its bytes, and a candidate counts once, with its best
    score. ``share`` is the number of rows of a shard that the ranges of all
    trees must hold before the ascent ends, as a share of the shard without the
    query (a row counts for every tree that holds it): 1.5 keeps recall well above 0.9 even
    where vectors have no clusters at all; clustered ones do with far less. Of
    at most ``k`` other rows all are found. An empty table gives no rows; extra
    columns of any name are left out.
    """
    def valid(df: DataFrame) -> DataFrame:
        df = required(df, {"vec_id": "long", "embedding": "array<double>"})
        fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (df.where(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
                .withColumn("dim", F.size("embedding")))

    vectors, queries = valid(vectors), valid(queries)
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({c: [] for c in FOUND.names})
        return search_shard(rows, asked, k, share, trees, bits)

    key = ["dim", "shard", "block"]
    found = (dealt(vectors, "shard", shards, "block", blocks).groupBy(*key)
             .cogroup(dealt(queries, "block", blocks, "shard", shards).groupBy(*key)).applyInPandas(search, FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
