"""Window operators (inventory W1-W7) and the global row index.

A plain ``Window.orderBy(x)`` without ``partitionBy`` moves every row into a
single task, and ``partitionBy(series)`` puts a whole hot series into one
task. :func:`rolling` avoids both: it cuts the whole order into ranges, copies
the few rows a frame needs from the ranges beside it ("halo"), evaluates the
window per range and drops the copies. The result equals the single global
window; a task holds one range and its halo rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_PID, _LOCAL, _N, _OFF = "__pid", "__local", "__n", "__off"


def _cols(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _offsets(tagged: DataFrame) -> DataFrame:
    """Rows before each partition of a tagged table, one row per partition."""
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    return counts.select(
        _PID,
        F.coalesce(F.sum(_N).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))


def _dense(ordered: DataFrame, out: str, start: int) -> DataFrame:
    """Index in partition order. The rows with their place are written once
    and both the rows and the counts are read from that table: evaluated
    twice, a range shuffle may cut its ranges differently."""
    from tessera.session import write_table
    tagged = (ordered.withColumn(_PID, F.spark_partition_id().cast("long"))
                     .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID), 33)))
    tagged = write_table(tagged, "row-index")
    res = tagged.join(F.broadcast(_offsets(tagged)), _PID, "inner")
    return res.withColumn(out, (F.col(_OFF) + F.col(_LOCAL) + F.lit(start)).cast("long")).drop(_PID, _LOCAL, _OFF)


# ---------------------------------------------------------------- W4
def global_index(df: DataFrame, order_by, out: str = "row_index", start: int = 1,
                 num_partitions: int | None = None) -> DataFrame:
    """Consecutive index ``start, start+1, …`` in the order of ``order_by``.

    ``order_by`` must be a total order (add a unique tie-breaker), which makes
    the index deterministic and so safe to recompute after an executor loss.

    Plan: one range shuffle on the order key (Spark samples the key to cut
    balanced ranges, so a hot value of the first key is split by the later
    keys), a sort inside each range, the position of each row inside its
    range from ``monotonically_increasing_id``, written to the shared folder,
    then the row count of each range turned into an offset. The offsets table has one row per range
    partition - bounded by ``num_partitions`` - and is broadcast.
    """
    keys = _cols(order_by)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _dense(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys), out, start)


# ---------------------------------------------------------------- rolling engine
_BUCKET, _HALO, _BOUNDS, _KEY = "__bucket", "__halo", "__bounds", "__key"
#: Sampled rows per range.
_SAMPLE = 32


def _ranges(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """``df`` with the number of the range of ``order`` (one of ``n``) that
    each row lies in.

    The bounds are quantiles of the rows whose keys have the smallest hashes:
    the same rows whenever and wherever they are asked for, so every use of
    the ranges cuts alike. They are a scalar subquery of the plan, not a job
    of their own; a row finds its range by halving.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    sample = df.select(key.alias("k")).orderBy(F.xxhash64("k"), "k").limit(_SAMPLE * n)
    held = sample.agg(F.array_sort(F.collect_list("k")).alias("s"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(1, n - 1))), lambda i: F.get("s", F.floor(i * F.size("s") / n).cast("int")))
    found = df.select("*", held.select(cuts.alias(_BOUNDS)).scalar().alias(_BOUNDS), key.alias(_KEY), F.lit(0).alias(_BUCKET))
    for i in range(max(1, n - 1).bit_length() - 1, -1, -1):  # each step a projection of its own: compiled, nothing computed twice
        passed = F.get(_BOUNDS, F.col(_BUCKET) + ((1 << i) - 1)) < F.col(_KEY)
        found = found.withColumn(_BUCKET, F.when(passed, F.col(_BUCKET) + (1 << i)).otherwise(F.col(_BUCKET)))
    return found.drop(_BOUNDS, _KEY)


def _edge_rows(ranged: DataFrame, order: list[Column], k: int, before: bool) -> DataFrame:
    """Copies of the ``k`` rows before (or after) each range, with that range's
    number. Every task forwards at most ``k`` rows per range; a range with
    fewer rows passes its neighbour's on."""
    toward = [c.desc_nulls_last() if before else c.asc_nulls_first() for c in order]
    names = [c for c in ranged.columns if c != _BUCKET]
    edge = (ranged.withColumn("__rn", F.row_number().over(Window.partitionBy(_BUCKET).orderBy(*toward))).where(F.col("__rn") <= k)
            .groupBy(_BUCKET).agg(F.collect_list(F.struct("__rn", F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))).alias("rows")))
    sign = -1 if before else 1
    edge = edge.select(_BUCKET, F.array_sort("rows", lambda a, b: (a["__rn"] - b["__rn"]) * sign).alias("rows"))
    # one row per range from here: places of the edge rows in the whole order
    end = F.sum(F.size("rows")).over(Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("__end", end).withColumn("__begin", F.col("__end") - F.size("rows"))
    near = Window.orderBy(_BUCKET).rowsBetween(*((1, k) if before else (-k, -1)))
    edge = edge.withColumn("__near", F.collect_list(F.struct(F.col(_BUCKET).alias("bucket"), F.col("__begin").alias("begin"), F.col("__end").alias("end"))).over(near))
    edge = edge.select("__near", "__begin", F.posexplode("rows").alias("__pos", "__x"))
    place = F.col("__begin") + F.col("__pos")
    serves = F.filter("__near", lambda r: r["begin"] - place <= k if before else place - r["end"] < k)
    return edge.select("__x.row", F.explode(F.transform(serves, lambda r: r["bucket"])).alias(_BUCKET)).select("row.*", _BUCKET)


def rolling(df: DataFrame, order_by, columns: dict[str, Callable[[WindowSpec], Column]],
            lo: int, hi: int, partition_by=None, ranges: int | None = None,
            strategy: str = "halo") -> DataFrame:
    """Add window columns with a ROWS frame ``[lo, hi]`` per ``partition_by``.

    ``columns`` maps an output name to ``fn(window_spec) -> Column``, e.g.
    ``{"ma": lambda w: F.avg("price").over(w)}``; the spec already carries the
    partitioning, the order and the frame. ``order_by`` (ascending) must be a
    total order within a partition.

    ``strategy``: ``"halo"`` (default) cuts the whole order into ``ranges``
    ranges and gives each the few rows before and after it; rows are shuffled
    once, and no job runs while the plan is built. ``"window"`` is one plain
    Spark window, for callers who know that the largest partition fits a task.
    """
    parts = _cols(partition_by)
    keys = _cols(order_by)
    if strategy == "window":
        w = (Window.partitionBy(*parts) if parts else Window).orderBy(*keys).rowsBetween(lo, hi)
        return df.withColumns({k: fn(w) for k, fn in columns.items()})
    order = [F.col(c) if isinstance(c, str) else c for c in parts + keys]
    n = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = _ranges(df, order, n)
    every = ranged.withColumn(_HALO, F.lit(False))
    for k, before in ((max(0, -lo), True), (max(0, hi), False)):
        if k:
            every = every.unionByName(_edge_rows(ranged, order, k, before).withColumn(_HALO, F.lit(True)))
    w = Window.partitionBy(_BUCKET, *parts).orderBy(*keys).rowsBetween(lo, hi)
    out = every.withColumns({k: fn(w) for k, fn in columns.items()})
    return out.where(~F.col(_HALO)).drop(_BUCKET, _HALO)


# ---------------------------------------------------------------- W1, P9
def fill_sentinel_with_previous_mean(df: DataFrame, value: str, order_by, sentinel=-1,
                                     k: int = 5, partition_by=None, digits: int | None = 2,
                                     **kw) -> DataFrame:
    """Replace ``sentinel`` by the mean of the ``k`` previous rows (W1 + P9 + F7).

    Sentinel rows of the window are skipped (not counted), filled values are
    not fed back into later windows, and a row with no valid predecessor gets
    NULL. Values are rounded to ``digits`` afterwards, as in the reference.
    """
    v = F.col(value)
    tmp = "__prev_mean"
    out = rolling(df, order_by, {tmp: lambda w: F.avg(F.when(v != F.lit(sentinel), v)).over(w)},
                  -k, -1, partition_by, **kw)
    filled = F.when(v == F.lit(sentinel), F.col(tmp)).otherwise(v)
    if digits is not None:
        filled = F.round(filled, digits)
    return out.withColumn(value, filled).drop(tmp)


# ---------------------------------------------------------------- W2
def moving_average(df: DataFrame, value: str, order_by, n: int = 10, partition_by=None,
                   out: str | None = None, **kw) -> DataFrame:
    """Trailing mean of the current and ``n-1`` previous rows."""
    name = out or f"{value}_MA_{n}"
    return rolling(df, order_by, {name: lambda w: F.avg(value).over(w)}, -(n - 1), 0,
                   partition_by, **kw)


# ---------------------------------------------------------------- W3
def duplicate_key_rows(df: DataFrame, key, flag: str | None = None) -> DataFrame:
    """All members of groups whose key occurs more than once.

    Counted with a partial aggregation and joined back, not with a window:
    a window puts a hot key's whole group in one task, the aggregation does
    not, and AQE can split the hot side of the join.
    """
    keys = _cols(key)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    dup = dup.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__cnt")
    # NULL keys form one group, as in pandas: compare null-safely
    cond = [df[k].eqNullSafe(dup[f"__k{i}"]) for i, k in enumerate(keys)]
    if flag:
        j = df.join(dup, cond, "left")
        return j.withColumn(flag, F.coalesce(F.col("__cnt") > 1, F.lit(False))).drop(
            "__cnt", *[f"__k{i}" for i in range(len(keys))])
    return df.join(dup.where(F.col("__cnt") > 1), cond, "left_semi")


# ---------------------------------------------------------------- W5
def top_k_per_group(df: DataFrame, group, order: Sequence[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group in ``order``.

    ``row_number() <= k`` is planned by Spark with a partial group limit before
    the shuffle, so each map task forwards at most ``k`` rows per group.
    ``order`` must break ties for a deterministic result.
    """
    rn = rank_col or "__rn"
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


# ---------------------------------------------------------------- W6
def period_returns(df: DataFrame, date_col: str, price_col: str, period: str = "month",
                   series=None, out: str = "period_return") -> DataFrame:
    """Return of each period over the previous period's last price.

    ``period`` is ``"month"`` or ``"year"``. Last price = price at the latest
    date of the period (``max_by``); after a price of 0 the return is NULL; the per-period table is small (series x
    periods), the lag runs on it.
    """
    fmt = {"month": "yyyy-MM", "year": "yyyy"}[period]
    keys = _cols(series)
    per = df.groupBy(*keys, F.date_format(F.col(date_col), fmt).alias("period")).agg(
        F.max_by(F.col(price_col), F.col(date_col)).alias("last_price"))
    w = Window.partitionBy(*keys).orderBy("period")
    prev = F.lag("last_price").over(w)
    return per.withColumn(out, F.try_divide(F.col("last_price"), prev) - F.lit(1.0))


# ---------------------------------------------------------------- W7
def extreme_moves(df: DataFrame, date_col: str, price_col: str, k: float = 2.0,
                  series=None, **kw) -> DataFrame:
    """Days whose return deviates from the series mean by more than ``k``
    sample standard deviations (W7; the reference names the analysis, this is
    our definition). Returns every such day with its return and z-score."""
    keys = _cols(series)
    prev = "__prev_price"
    r = rolling(df.select(*keys, date_col, price_col), [date_col],
                {prev: lambda w: F.first(price_col).over(w)}, -1, -1, keys or None, **kw)
    r = r.withColumn("daily_return", F.try_divide(F.col(price_col), F.col(prev)) - F.lit(1.0)).drop(prev)
    r = r.where(F.col("daily_return").isNotNull())
    stats = r.groupBy(*keys).agg(F.avg("daily_return").alias("mean_return"),
                                 F.stddev_samp("daily_return").alias("sd_return"))
    if not keys:  # one statistics row: join it on a constant key
        keys = ["__all"]
        r, stats = r.withColumn("__all", F.lit(0)), stats.withColumn("__all", F.lit(0))
        j = r.join(F.broadcast(stats), keys, "inner").drop("__all")
    else:
        j = r.join(stats, keys, "inner")
    j = j.withColumn("z", F.try_divide(F.col("daily_return") - F.col("mean_return"), F.col("sd_return")))
    return j.where(F.abs(F.col("z")) > F.lit(k))


def index_in_partition_order(df: DataFrame, out: str = "row_index", start: int = 1) -> DataFrame:
    """Consecutive index in the current partition order, without a shuffle of
    the data (P6 when no order is given). Deterministic when the input order
    is (e.g. a file scan); use :func:`global_index` for a defined order."""
    return _dense(df, out, start)
