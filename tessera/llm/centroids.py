"""Centroid clustering by dimension-sharded Lloyd rounds on integer vectors.

The vectors are cut into chunks of rows and each chunk into column blocks, one
record per (chunk, block). A round has three steps:

* a task on a block computes the exact partial squared distances of the rows
  of its chunks to its slice of the centroids,
* the partial distances of a chunk are added over its blocks, and each row
  takes the nearest centroid,
* each block sums its own columns by the rows' centroids, and its slice of the
  centroids becomes the floored mean.

Everything is integer arithmetic, so no order of addition changes a result.
Only the centroids (their number times the dimensions) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import required, struct
from tessera.session import write_table

RECORDS = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("block", T.IntegerType()),
                        T.StructField("data", T.BinaryType()), T.StructField("ids", T.ArrayType(T.LongType()))])


def quantised(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Components as integers, floor(scale * x). An integer so large that the
    squared distance of two vectors may not fit 64 bits is an error."""
    whole = np.floor(scale * vectors.astype(np.float64))
    limit = 2.0 ** 30 / np.sqrt(max(1, vectors.shape[-1]))
    if len(whole) and np.abs(whole).max() > limit:
        raise OverflowError(f"a component times {scale} is beyond {limit:.0f}: squared distances would not fit 64 bits")
    return whole.astype(np.int64)


def _chunks(vectors: DataFrame, dims: int, scale: int, blocks: int, rows: int) -> DataFrame:
    """(chunk, block, data, ids): the integers of each column block of each
    chunk of at most ``rows`` rows, row by row; block -1 holds the ids."""
    edges = [dims * b // blocks for b in range(blocks + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                whole = quantised(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims), scale)
                data = [np.ascontiguousarray(whole[:, a:b], np.int32).tobytes() for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * (blocks + 1), pa.int64()), pa.array([*range(blocks), -1], pa.int32()), pa.array([*data, None], pa.binary()),
                     pa.array([None] * blocks + [part.column(0).to_pylist()], pa.list_(pa.int64()))], names=RECORDS.names)
                chunk += 1

    return write_table(vectors.mapInArrow(cut, RECORDS), "vector-blocks")


def _assign(records: DataFrame, centroids: np.ndarray, blocks: int) -> DataFrame:
    """(chunk, labels, distances): each row's nearest centroid, ties to the
    smaller number, and its squared distance."""
    dims, k = centroids.shape[1], len(centroids)
    edges = [dims * b // blocks for b in range(blocks + 1)]
    sent = records.sparkSession.sparkContext.broadcast(centroids)
    partial, final = struct(chunk="long", parts="binary"), struct(chunk="long", labels="binary", distances="binary")

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, block, data in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = edges[block], edges[block + 1]
                x, own = np.frombuffer(data, np.int32).reshape(-1, b - a), sent.value[:, a:b]
                widest = max(1, int(np.abs(x).max(initial=0)), int(np.abs(own).max(initial=0)))
                # products and sums below 2^53 are exact as doubles, and there is a fast product of matrices for these
                kind = np.float64 if 4 * (b - a) * widest ** 2 < 2 ** 53 else np.int64
                x, own = x.astype(kind), own.astype(kind)
                found = (x * x).sum(axis=1)[:, None] - 2 * (x @ own.T) + (own * own).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([found.astype(np.int64).tobytes()], pa.binary())],
                                                 names=partial.names)

    def add_blocks(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.int64) for p in rows["parts"]).reshape(-1, k)
        labels = total.argmin(axis=1)
        return pd.DataFrame({"chunk": [key[0]], "labels": [labels.astype(np.int32).tobytes()],
                             "distances": [np.take_along_axis(total, labels[:, None], axis=1).tobytes()]})

    slices = records.where("block >= 0").select("chunk", "block", "data")
    return slices.mapInArrow(distances, partial).groupBy("chunk").applyInPandas(add_blocks, final)


def _updated(records: DataFrame, assigned: DataFrame, centroids: np.ndarray, blocks: int) -> np.ndarray:
    """The centroids after each block has replaced its slice by the floored
    means of its columns; a centroid without rows stays."""
    k, dims = centroids.shape
    edges = [dims * b // blocks for b in range(blocks + 1)]
    schema = struct(block="int", cluster="int", column="int", total="long", n="long")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, data, labels in zip(*(c.to_pylist() for c in batch.columns)):
                width = edges[block + 1] - edges[block]
                total, n = held.setdefault(block, (np.zeros((k, width), np.int64), np.zeros(k, np.int64)))
                labels = np.frombuffer(labels, np.int32)
                own = np.bincount(labels, minlength=k)
                used = np.flatnonzero(own)
                ordered = np.frombuffer(data, np.int32).reshape(-1, width)[np.argsort(labels, kind="stable")]
                total[used] += np.add.reduceat(ordered, (np.cumsum(own) - own)[used], dtype=np.int64)
                n += own
        for block, (total, n) in held.items():
            used, width = np.flatnonzero(n), total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used) * width, block, np.int32)), pa.array(np.repeat(used, width).astype(np.int32)),
                 pa.array(np.tile(np.arange(edges[block], edges[block + 1], dtype=np.int32), len(used))), pa.array(total[used].ravel()),
                 pa.array(np.repeat(n[used], width))], names=schema.names)

    slices = records.where("block >= 0").select("chunk", "block", "data")
    summed = (slices.join(assigned.select("chunk", "labels"), "chunk").select("block", "data", "labels").mapInArrow(sums, schema)
              .groupBy("block", "cluster", "column").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    mean = F.expr("(total - pmod(total, n)) div n")  # exact floor, also below zero
    new = centroids.copy()
    for r in summed.select("cluster", "column", mean.alias("mean")).collect():  # centroids times dimensions numbers
        new[r["cluster"], r["column"]] = r["mean"]
    return new


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
            blocks: int = 4, chunk_rows: int = 2048) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) per kept
    vector (columns vec_id and embedding): its nearest centroid after
    ``rounds`` rounds (ties: the smaller number), the squared distance, that
    distance summed over its cluster and over all, and the centroid.

    Kept are vectors of exactly ``dims`` components, none null or non-finite;
    a component x counts as the integer floor(``scale`` * x). The first
    centroids are the ``k`` kept vectors with the smallest hex SHA-256 of
    ``seed:vec_id`` in that order (all, if there are fewer; equal ids by their
    components; vectors without an id come after all others). Repeated rows are
    vectors of their own and may be centroids that stay empty. An empty table
    gives none. A component too large for 64-bit squared distances is an error.
    """
    vectors = required(vectors, {"vec_id": "long", "embedding": "array<double>"})
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where((F.size("embedding") == dims) & fine)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "embedding").limit(k).collect()
    blocks = min(blocks, dims)
    schema = struct(vec_id="long", cluster="int", distance="long")
    if not first:
        return kept.sparkSession.createDataFrame([], T.StructType(schema.fields + struct(cluster_inertia="long", inertia="long", centroid="[long]").fields))
    centroids = quantised(np.array([r["embedding"] for r in first]), scale)
    records = _chunks(kept, dims, scale, blocks, chunk_rows)
    for _ in range(rounds):
        centroids = _updated(records, write_table(_assign(records, centroids, blocks), "labels"), centroids, blocks)
    assigned = _assign(records, centroids, blocks)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, distances in zip(*(batch.column(i) for i in range(3))):
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(np.frombuffer(labels.as_py(), np.int32)),
                                                  pa.array(np.frombuffer(distances.as_py(), np.int64))], names=schema.names)

    ids = records.where("block = -1").select("chunk", "ids")
    found = write_table(ids.join(assigned, "chunk").select("ids", "labels", "distances").mapInArrow(rows, schema), "clusters")
    own = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}  # one number a centroid
    final = kept.sparkSession.createDataFrame([(c, n, sum(own.values()), centroids[c].tolist()) for c, n in own.items()],
                                              struct(cluster="int", cluster_inertia="long", inertia="long", centroid="[long]"))
    return found.join(F.broadcast(final), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def centroid_sha256(centroid: Column) -> Column:
    """Hex SHA-256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda x: x.cast("string")), ","), 256)
