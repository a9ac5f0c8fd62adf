"""Exact k-nearest-neighbour imputation as a Spark job that skips far blocks (M3).

Distance is scikit-learn's ``nan_euclidean``: over the coordinates present in
both rows, scaled by (all coordinates / common coordinates). Weights are
1/distance; donors at distance 0 take all the weight. Of donors at the same
distance those with the smaller value come first.

Donors are dealt to the leaves of a tree of medians, fitted on a bounded sample
of them; the box of every leaf (smallest and largest value of each column) is
taken over all its donors. A receiver (row with a gap) first meets the donors
of its own leaf, which gives a bound on its k-th distance for each missing
column, then only the leaves whose box comes as near as that bound. Leaves are
cut into blocks and receivers into chunks, so that no task holds more than one
of each; every task keeps the ``k`` best donors of a receiver and column, and
the k best of these are found with a partial top-k before the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import write_table

#: Donors that the tree is fitted on, and its largest number of leaves (the bound of the boxes each task gets).
SAMPLE_ROWS, MAX_LEAVES = 20_000, 4096
#: Searches by missing columns, and sets of columns that donors may have for them.
SPACES, MAX_PATTERNS = 24, 256
#: Pairs of receivers and donors that one search for all of them is quicker for than several.
FEW_PAIRS = 2_000_000_000
#: Receivers whose distances to a block are held at a time.
SLICE = 200


def _nearest(cols: list[str], k: int, d: int):
    """Of one block of donors the ``k`` best of each receiver and missing column;
    ``d`` is the number of all coordinates."""

    def run(recv: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"rid": pd.Series(dtype="int64"), "column": pd.Series(dtype="str"),
                             "dist": pd.Series(dtype="float64"), "value": pd.Series(dtype="float64")})]
        every, D = recv[cols].to_numpy(dtype="float64"), donors[cols].to_numpy(dtype="float64")
        rids, dp = recv["rid"].to_numpy(), ~np.isnan(D)
        for begin in range(0, len(every) if len(D) else 0, SLICE):
            R = every[begin:begin + SLICE]
            rp = ~np.isnan(R)
            total, common = np.zeros((len(R), len(D))), np.zeros((len(R), len(D)))
            for c in range(len(cols)):  # differences, not products: equal rows are at distance 0 exactly
                both = np.outer(rp[:, c], dp[:, c])
                total += np.where(both, (R[:, c, None] - D[None, :, c]) ** 2, 0.0)
                common += both
            with np.errstate(divide="ignore", invalid="ignore"):
                dist = np.sqrt(total * d / common)
            dist[~np.isfinite(dist)] = np.inf
            for j, c in enumerate(cols):
                need, has = np.flatnonzero(~rp[:, j]), np.flatnonzero(dp[:, j])
                if not len(need) or not len(has):
                    continue
                sub = dist[np.ix_(need, has)]
                last = min(k, len(has)) - 1
                kth = np.partition(sub, last, axis=1)[:, last]
                row, col = np.nonzero((sub <= kth[:, None]) & np.isfinite(sub))
                found = pd.DataFrame({"rid": rids[begin + need[row]], "column": c, "dist": sub[row, col], "value": D[has[col], j]})
                found = found.iloc[np.lexsort((found["value"], found["dist"], row))]
                out.append(found[(found.groupby("rid").cumcount() < k).to_numpy()])
        return pd.concat(out[1:], ignore_index=True) if len(out) > 1 else out[0]
    return run


def median_tree(sample: np.ndarray, depth: int, by: list[int] | None = None) -> tuple[list[int], list[float], list[float]]:
    """(column, bound) of every inner node of a complete tree in level order,
    and the values that stand for missing ones. Each node is cut at the median
    of its widest column (of those in ``by``, if given)."""
    by = by or list(range(sample.shape[1]))
    with np.errstate(all="ignore"):
        fill = [float(np.mean(v)) if len(v := x[np.isfinite(x)]) else 0.0 for x in sample.T]
    full = np.where(np.isfinite(sample), sample, fill)
    column, bound, nodes = [], [], [full]
    for _ in range(depth):
        below = []
        for rows in nodes:
            at = by[int((rows[:, by].max(axis=0) - rows[:, by].min(axis=0)).argmax())] if len(rows) else by[0]
            cut = float(np.median(rows[:, at])) if len(rows) else 0.0
            column.append(at)
            bound.append(cut)
            below += [rows[rows[:, at] <= cut], rows[rows[:, at] > cut]]
        nodes = below
    return column, bound, fill


def with_leaf(df: DataFrame, cols: list[str], tree: tuple[list[int], list[float], list[float]]) -> DataFrame:
    """``df`` with the number of the leaf each row lies in, as ``leaf``."""
    column, bound, fill = tree
    filled = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit(x)) for c, x in zip(cols, fill)])
    df = df.withColumn("leaf", F.lit(0))
    for _ in range(int(math.log2(len(column) + 1))):
        right = F.get(filled, F.get(F.lit(column), F.col("leaf"))) > F.get(F.lit(bound), F.col("leaf"))
        df = df.withColumn("leaf", 2 * F.col("leaf") + 1 + right.cast("int"))
    return df.withColumn("leaf", F.col("leaf") - len(column))


def nearest_in_box(rows: np.ndarray, low: np.ndarray, high: np.ndarray, some: np.ndarray, all_: np.ndarray,
                   width: int | None = None) -> np.ndarray:
    """Rows x leaves: no donor of a leaf is nearer than this. ``some`` and
    ``all_`` (leaves x columns) tell whether any and whether all donors of a leaf
    have a value. Which coordinates are common differs from donor to donor: of
    those that only some donors have, the ones that make the mean smallest count."""
    with np.errstate(invalid="ignore"):
        gap = np.maximum(np.maximum(low[None] - rows[:, None], rows[:, None] - high[None]), 0.0)
    gap = np.nan_to_num(gap, nan=0.0, posinf=np.inf) ** 2
    present = ~np.isnan(rows)[:, None]
    sure, maybe = present & all_[None], present & (some & ~all_)[None]
    total, n = np.where(sure, gap, 0.0).sum(axis=2), sure.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        best = np.where(n > 0, total / n, np.inf)
        for more in np.moveaxis(np.sort(np.where(maybe, gap, np.inf), axis=2), 2, 0):
            total, n = total + more, n + 1
            best = np.minimum(best, total / n)
    return np.sqrt(best * (width or rows.shape[1]))


def nearest_donors(recv: DataFrame, donors: DataFrame, cols: list[str], k: int, block_rows: int = 5000,
                   chunk_rows: int = 2000, width: int | None = None, by: list[str] | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``(rid, column, dist, value)`` with the ``k`` best donors of every
    receiver and missing column, the leaves every receiver met beside its own
    as ``(rid, leaf)``, and the number of leaves. ``recv``: rid and ``cols``,
    NULL where missing. Without donors there are no rows. ``width`` is the number
    of all coordinates, where ``cols`` are some of them; the tree cuts the columns
    ``by`` only."""
    width = width or len(cols)
    donors = donors.select(*[F.col(f"`{c}`").alias(c) for c in cols])  # columns of their own, if both come from one frame
    n_d = donors.count()
    depth = max(0, min(int(math.log2(MAX_LEAVES)), math.ceil(math.log2(max(1, n_d / block_rows)))))
    order = F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.monotonically_increasing_id())
    sample = donors.select("*", order.alias("__at")).orderBy("__at").limit(SAMPLE_ROWS).drop("__at").toPandas()
    tree = median_tree(sample[cols].to_numpy(dtype="float64"), depth, [cols.index(c) for c in by] if by else None)
    donors, recv, n_leaves = with_leaf(donors, cols, tree), with_leaf(recv, cols, tree), 1 << depth
    boxes = donors.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.min(f"`{c}`") for c in cols]).alias("low"),
        F.array(*[F.max(f"`{c}`") for c in cols]).alias("high"), F.array(*[F.count(f"`{c}`") for c in cols]).alias("held")).collect()
    low, high = np.full((n_leaves, len(cols)), np.nan), np.full((n_leaves, len(cols)), np.nan)
    held, size = np.zeros((n_leaves, len(cols)), np.int64), np.zeros(n_leaves, np.int64)
    for b in boxes:
        low[b["leaf"]], high[b["leaf"]] = np.array(b["low"], float), np.array(b["high"], float)
        held[b["leaf"]], size[b["leaf"]] = b["held"], b["n"]
    blocks = F.lit([max(1, -(-int(n) // block_rows)) for n in size])

    def met(rows: DataFrame) -> DataFrame:
        """Receivers with a ``leaf`` against all donors of that leaf."""
        n = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}  # a row a leaf
        chunks = F.lit([-(-n.get(i, 0) // chunk_rows) for i in range(n_leaves)])
        few, many = F.get(blocks, F.col("leaf")), F.get(chunks, F.col("leaf"))
        r = (rows.withColumn("chunk", F.pmod(F.xxhash64("rid"), many))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (few - 1).cast("long")))))
        d = (donors.withColumn("block", F.pmod(F.monotonically_increasing_id(), few).cast("long")).where(many > 0)
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), (many - 1).cast("long")))))
        keys = ["leaf", "block", "chunk"]
        found = (r.withColumn("chunk", F.col("chunk").cast("long")).groupBy(*keys).cogroup(d.groupBy(*keys))
                 .applyInPandas(_nearest(cols, k, width), "rid long, column string, dist double, value double"))
        return write_table(_top(found, k), "knn-donors-met")

    own = met(recv)
    reach = own.groupBy("rid", "column").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("dist")).where(F.col("n") >= k)
    reach = reach.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("column", "dist"))).alias("reach"))
    asked = recv.join(reach, "rid", "left").select("rid", "leaf", *[F.col(f"`{c}`") for c in cols],
                                                   F.array(*[F.coalesce(F.element_at("reach", F.lit(c)), F.lit(math.inf)) for c in cols]).alias("reach"))
    some, all_ = held > 0, (held == size[:, None]) & (held > 0)
    step = max(1, 2_000_000 // (n_leaves * len(cols)))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), step):
                part = batch.iloc[begin:begin + step]
                rows = part[cols].to_numpy(dtype="float64")
                bound = nearest_in_box(rows, low, high, some, all_, width)
                limit = np.stack(part["reach"].to_numpy()) * (1 + 1e-9)
                wanted = np.zeros(bound.shape, bool)
                for j in range(len(cols)):
                    wanted |= np.isnan(rows[:, j])[:, None] & some[None, :, j] & (bound <= limit[:, j, None]) & np.isfinite(bound)
                wanted[np.arange(len(part)), part["leaf"].to_numpy()] = False
                row, leaf = np.nonzero(wanted)
                yield pd.DataFrame({"rid": part["rid"].to_numpy()[row], "leaf": leaf.astype("int32")})

    visits = write_table(asked.mapInPandas(near, "rid long, leaf int"), "knn-visits")
    rest = met(recv.drop("leaf").join(visits, "rid"))
    return _top(own.union(rest), k), visits, n_leaves


def _top(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("rid", "column").orderBy("dist", "value"))
    return found.withColumn("place", place).where(F.col("place") <= k).drop("place")


def nearest_by_pattern(recv: DataFrame, donors: DataFrame, cols: list[str], k: int, block_rows: int = 5000,
                       chunk_rows: int = 2000) -> tuple[DataFrame, DataFrame]:
    """``(rid, column, dist, value)`` as of :func:`nearest_donors`, for one of the
    receivers that have the same values, and ``(rid, of)``: for every receiver the
    one that was asked for.

    Receivers that miss the same columns, and donors with which they have the same
    columns in common, are searched by themselves: their tree cuts the columns they
    have in common, and of donors at one place only the ``k`` smallest values can be
    among the best. Receivers beyond ``SPACES`` such searches meet all donors together,
    as do all of them where there are few."""
    bits = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in cols])
    held = [frozenset(c for c, b in zip(cols, r["bits"]) if b == "1") for r in
            donors.select(bits.alias("bits")).distinct().limit(MAX_PATTERNS + 1).collect()]
    asked = recv.groupBy(bits.alias("bits")).count().orderBy(F.desc("count"), "bits").limit(SPACES).collect()
    spaces, alone = [], []
    several = len(held) <= MAX_PATTERNS and recv.count() * donors.count() > FEW_PAIRS
    for r in asked if several else ():
        mine = {c for c, b in zip(cols, r["bits"]) if b == "1"}
        more = sorted({(tuple(c for c in cols if c in mine & d), t) for d in held if mine & d for t in d - mine})
        if len(spaces) + len(more) <= SPACES:
            spaces += [(r["bits"], mine, common, t) for common, t in more]
            alone.append(r["bits"])
    reps = write_table(recv.groupBy(*[f"`{c}`" for c in cols]).agg(F.min("rid").alias("rid")), "knn-receivers")
    found = reps.sparkSession.createDataFrame([], "rid long, column string, dist double, value double")
    for pattern, mine, common, t in spaces:
        some = donors.where(F.col(f"`{t}`").isNotNull())
        for c in mine:
            some = some.where(F.col(f"`{c}`").isNotNull() if c in common else F.col(f"`{c}`").isNull())
        names = [f"`{c}`" for c in common]
        place = F.row_number().over(Window.partitionBy(*names).orderBy(f"`{t}`"))
        some = write_table(some.select(*names, f"`{t}`", place.alias("__place")).where(F.col("__place") <= k).drop("__place"), "knn-donors")
        few = reps.where(bits == pattern).select("rid", *names, F.lit(None).cast("double").alias(t))
        found = found.union(nearest_donors(few, some, [*common, t], k, block_rows, chunk_rows, len(cols), list(common))[0])
    rest = reps.where(~bits.isin(alone)) if alone else reps
    if not rest.isEmpty():
        found = found.union(nearest_donors(rest, donors, cols, k, block_rows, chunk_rows)[0])
    a, b = recv.alias("a"), reps.alias("b")
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in cols]
    return _top(found, k), a.join(b, same).select("a.rid", F.col("b.rid").alias("of"))


def knn_impute(df: DataFrame, donors_path: str, cols, id_col: str, k: int, means: dict,
               block_rows: int = 5000, chunk_rows: int = 2000) -> DataFrame:
    spark = df.sparkSession
    from tessera.shipping import ensure_importable
    ensure_importable(spark)
    cols = list(cols)
    miss = F.lit(False)
    for c in cols:
        miss = miss | F.col(c).isNull() | F.isnan(F.col(c))
    recv = df.where(miss).select(F.col(id_col).alias("rid"), *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c)
                                                                for c in cols])
    if recv.isEmpty():
        return df
    found, members = nearest_by_pattern(recv, spark.read.parquet(donors_path).select(*cols), cols, k, block_rows, chunk_rows)
    best = found.groupBy("rid", "column").agg(F.array_sort(F.collect_list(F.struct("dist", "value"))).alias("nn"))  # k at most
    zero = F.exists("nn", lambda x: x["dist"] == 0)
    w = lambda x: F.when(zero, F.when(x["dist"] == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1.0 / x["dist"])
    num = F.aggregate("nn", F.lit(0.0), lambda acc, x: acc + w(x) * x["value"])
    den = F.aggregate("nn", F.lit(0.0), lambda acc, x: acc + w(x))
    fills = best.select("rid", "column", (num / den).alias("fill"))
    wide = fills.withColumnRenamed("rid", "of").groupBy("of").pivot("column", cols).agg(F.first("fill")).join(members, "of")
    wide = wide.select(F.col("rid").alias(id_col), *[F.col(c).alias(f"__fill_{c}") for c in cols])
    out = df.join(wide, id_col, "left")
    return out.withColumns({
        c: F.when(F.col(c).isNull() | F.isnan(F.col(c)),
                  F.coalesce(F.col(f"__fill_{c}"), F.lit(means.get(c)))).otherwise(F.col(c))
        for c in cols}).drop(*[f"__fill_{c}" for c in cols])
