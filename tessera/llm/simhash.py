"""Near duplicates by SimHash under the generalised pigeonhole principle.

Fingerprints are linked when they differ in at most ``distance`` bits. The 64
bits are grouped into partitions, correlated bits together; a query
fingerprint gets a threshold T_i >= -1 per partition with
sum(T_i + 1) = distance + 1, so any fingerprint within the distance is within
T_i of it in at least one partition. The thresholds of each query are chosen
by dynamic programming on the estimated number of candidates, so a partition
value that very many fingerprints share is skipped in favour of others. All
values within T_i are probed by an equality join and the full distance is
verified in that join.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import required, struct
from tessera.llm.graph import connected_components
from tessera.session import TEXT_BATCH, write_table

BITS = 64


def text_fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash (unsigned 64 bits) of a text's word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size) - 1
    begin, end = (end - size + 1)[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for a in range(0, len(begin), 1 << 16):
        block = b"".join([digest(joined[i:j], seed) for i, j in zip(begin[a:a + (1 << 16)], end[a:a + (1 << 16)])])
        bits = np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(begin)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, with_text: bool = False) -> DataFrame:
    """(doc_id, fp) and, if asked for, text: the fingerprint as a signed long,
    one row per row.

    Words are runs without ASCII white space, A-Z lower-cased. Null and empty
    texts have fingerprint 0.
    """
    schema = struct(doc_id="long", fp="long", **({"text": "string"} if with_text else {}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([text_fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), batch.column(1)][:len(schema)], names=schema.names)

    return required(docs, {"doc_id": "long", "text": "string"}).mapInArrow(scan, schema)


def bit_groups(distinct: DataFrame, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of about equal size, correlated bits
    together. Correlations come from all fingerprints: each task sends one
    64 x 64 table of sums."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            fps = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False).astype(">i8"))
            for a in range(0, len(fps), 1 << 16):
                bits = np.unpackbits(fps[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)[:, ::-1]
                rows = np.hstack([bits, np.ones((len(bits), 1))]).astype(np.float64)
                total += rows.T @ rows
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "value"])

    got = (distinct.select("fp").mapInArrow(sums, struct(cell="long", value="double"))
           .groupBy("cell").agg(F.sum("value").alias("value")).collect())
    total = np.zeros((BITS + 1) ** 2)
    for r in got:
        total[r["cell"]] = r["value"]
    total = total.reshape(BITS + 1, BITS + 1)
    n = max(total[-1, -1], 1.0)
    mean = total[-1, :BITS] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    like = np.abs(total[:BITS, :BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(free, key=lambda b: (like[b][[x for x in free if x != b]].max(initial=0), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (like[b][group].mean(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def parts_for(n: int, distance: int) -> int:
    """Number of partitions with the least probes plus candidates for ``n``
    evenly spread fingerprints."""
    def cost(m: int) -> float:
        base, more = divmod(distance + 1, m)
        probes = sum(ball(BITS // m, base - 1 + (i < more)) for i in range(m))
        return probes * (1 + n / 2.0 ** (BITS // m))
    return min(range(2, max(3, min(distance + 1, 8) + 1)), key=cost)


def ball(width: int, radius: int) -> int:
    """Number of values of ``width`` bits within ``radius`` of one."""
    total, term = 0, 1
    for e in range(radius + 1):
        total += term
        term = term * (width - e) // (e + 1)
    return total


def part_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for j, bit in enumerate(group):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(j)
    return out


def allocate(cost: np.ndarray) -> np.ndarray:
    """Thresholds (queries x parts, -1 or more) of least cost, where
    ``cost[q, i, t]`` is the cost of threshold ``t - 1`` in part i and the t
    of a query add up to ``cost.shape[2] - 1``."""
    queries, parts, steps = cost.shape
    best, choice = cost[:, 0, :].copy(), []
    for i in range(1, parts):
        new, pick = np.full((queries, steps), np.inf), np.zeros((queries, steps), np.int64)
        for s in range(steps):
            for t in range(s + 1):
                c = best[:, s - t] + cost[:, i, t]
                better = c < new[:, s]
                new[better, s], pick[better, s] = c[better], t
        best = new
        choice.append(pick)
    left, out = np.full(queries, steps - 1), np.empty((queries, parts), np.int64)
    for i in range(parts - 1, 0, -1):
        out[:, i] = choice[i - 1][np.arange(queries), left]
        left = left - out[:, i]
    out[:, 0] = left
    return out - 1


def _keys(groups: list[list[int]], column: str = "fp") -> list:
    """One expression per part: the part's number above its bits."""
    return [F.lit(i << 56).bitwiseOR(sum((F.shiftright(F.col(column), b).bitwiseAND(F.lit(1)) * F.lit(1 << j)
                                          for j, b in enumerate(g)), F.lit(0).cast("long")))
            for i, g in enumerate(groups)]


def links(distinct: DataFrame, distance: int = 4, heavy_share: int = 1024, rounds: int = 2) -> DataFrame:
    """(fp, component): fingerprints reachable over links share a component.

    ``distinct`` holds each fingerprint once in column ``fp``. First, members
    of a partition bucket join the bucket's smallest label if they are within
    the distance of its fingerprint (``rounds`` times): dense groups shrink
    to a label in linear work. The probe join then looks for links between
    different labels only. Partition values held by more than 1 of
    ``heavy_share`` fingerprints (so fewer than that per partition) are sent
    to the tasks for the cost estimates.

    All joins are merge joins: keys and probes are several rows for each row of
    a table, which Spark's size of it does not show, and the driver would
    broadcast them.
    """
    n = distinct.count()
    groups = bit_groups(distinct, parts_for(n, distance))
    labels = write_table(distinct.select("fp", F.col("fp").alias("label"), F.array(*_keys(groups)).alias("keys")), "labels")
    for _ in range(rounds):
        at = labels.select("fp", "label", "keys", F.explode("keys").alias("key"))
        centre = at.groupBy("key").agg(F.min(F.struct("label", "fp")).alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1")
        near = F.bit_count(F.col("fp").bitwiseXOR(F.col("c.fp"))) <= distance
        labels = write_table(
            at.hint("merge").join(centre, "key").where(near).groupBy("fp").agg(F.min("c.label").alias("lower"))
            .join(labels.hint("merge"), "fp", "right")
            .select("fp", F.least("label", F.coalesce("lower", "label")).alias("label"), "keys"), "labels")
    index = labels.select("fp", "label", F.explode("keys").alias("key"))
    heavy: dict[int, list] = {}
    for r in index.groupBy("key").count().where(F.col("count") > max(n // heavy_share, 16)).collect() if n else []:
        heavy.setdefault(r["key"] >> 56, []).append((r["key"] & ((1 << 56) - 1), r["count"]))
    schema = struct(key="long", fp="long", label="long")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [[np.array([sum(1 << b for b in c) for e in range(t + 1) for c in combinations(range(len(g)), e)], np.uint64)
                  for t in range(distance + 1) if ball(len(g), t) <= 50_000] for g in groups]
        for batch in batches:
            fps, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for a in range(0, len(fps), 1 << 12):
                q = fps[a:a + (1 << 12)].view(np.uint64)
                cost = np.full((len(q), len(groups), distance + 2), 1e30)
                cost[:, :, 0] = 0
                values = [part_values(q, g) for g in groups]
                for i, g in enumerate(groups):
                    for t, m in enumerate(masks[i]):
                        cost[:, i, t + 1] = len(m) * (1 + n / 2.0 ** len(g))
                    for value, count in heavy.get(i, []):
                        off = np.bitwise_count(values[i] ^ np.uint64(value))
                        for t in range(len(masks[i])):
                            cost[:, i, t + 1] += np.where(off <= t, count, 0)
                chosen = allocate(cost)
                for i in range(len(groups)):
                    for t, m in enumerate(masks[i]):
                        rows = np.flatnonzero(chosen[:, i] == t)
                        for b in range(0, len(rows), max(1, 200_000 // len(m))):
                            sub = rows[b:b + max(1, 200_000 // len(m))]
                            keys = (values[i][sub][:, None] ^ m[None, :]).ravel().view(np.int64) | np.int64(i << 56)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys), pa.array(np.repeat(fps[a + sub], len(m))),
                                 pa.array(np.repeat(label[a + sub], len(m)))], names=schema.names)

    probes = labels.select("fp", "label").mapInArrow(probe, schema).select("key", F.col("fp").alias("a"), F.col("label").alias("la"))
    found = index.select("key", F.col("fp").alias("b"), F.col("label").alias("lb"))
    pairs = probes.hint("merge").join(found, (probes["key"] == found["key"]) & (F.col("la") < F.col("lb"))
                        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    parts = connected_components(pairs.select("la", "lb"), "la", "lb")
    return (labels.hint("merge").join(parts, labels["label"] == parts["node"], "left")
            .select("fp", F.coalesce("component", "label").alias("component")))


def groups(docs: DataFrame, shingle: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component, component_id) per document row: the fingerprint,
    a fingerprint that names its group, and the smallest doc_id of the group
    (null where no row of it has an id)."""
    prints = write_table(fingerprints(docs, shingle, seed), "fingerprints", TEXT_BATCH)
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    first = write_table(first, "distinct")
    component = write_table(links(first.select("fp"), distance).hint("merge").join(first, "fp"), "components")
    smallest = component.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = component.hint("merge").join(smallest, "component").select("fp", "component", "component_id")
    return prints.hint("merge").join(named, "fp").select("doc_id", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) per document row.

    ``fingerprint``: 16 hex digits; ``component_id``: smallest doc_id that can
    be reached over links of at most ``distance`` differing bits, its own
    included (rows without an id never name a component; null where no row of
    it has an id). Null, empty and wordless texts have fingerprint zero and
    are linked like any other. Repeated rows stay. An empty table gives none.
    """
    return groups(docs, shingle, distance, seed).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
