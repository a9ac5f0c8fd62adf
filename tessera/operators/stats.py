"""Descriptive statistics on wide numeric tables (inventory A16-A27, M33).

Every statistic is computed for all requested columns in a fixed number of
passes, never one job per column:

* moments (count, mean, sd, min, max, skewness, correlations, regression
  lines) - one ``agg`` over the wide table, partial aggregation per task;
* exact quantiles - rounds of two aggregations that narrow down the wanted
  ranks; no value is shuffled or sorted beyond the last few.
  ``method="approx"`` uses ``percentile_approx`` instead.

Results are small long-form frames: one row per column (or column pair).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.comoments import correlations


def _q(name):
    return F.col(f"`{name}`")


def _num(name):
    """The column as DOUBLE with NaN read as missing (pandas skips both)."""
    x = _q(name).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def _values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value)`` of all present values, made row by row (no shuffle)."""
    wide = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _num(c).alias("value")) for c in cols])).alias("x")
    return df.select(wide).select("x.*").where(F.col("value").isNotNull())


def _long(df: DataFrame, cols: Sequence[str], fields: dict[str, Callable[[int], Column]]) -> DataFrame:
    """One row per column from a single wide row: ``fields`` maps an output
    name to a function of the column's place."""
    rows = [F.struct(F.lit(c).alias("column"), *[make(i).alias(name) for name, make in fields.items()]) for i, c in enumerate(cols)]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, count, mean, std, min, max)`` in one pass (sample sd as pandas)."""
    aggs = []
    for i, c in enumerate(cols):
        x = _num(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                                        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                               for i, c in enumerate(cols)]))
    return one.select(rows.alias("r")).select("r.*")


#: Values between two bounds that are few enough to be sorted in one row.
FEW = 10_000


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75),
              method: str = "exact", accuracy: int = 1000, few: int = FEW) -> DataFrame:
    """``(column, q, value)``: linear-interpolated quantiles (pandas / DuckDB
    ``quantile_cont``), NULL and NaN ignored.

    ``exact`` finds the values at the wanted ranks in rounds: a round takes
    approximate quantiles a little below and above each rank, counts the values
    on either side of these bounds, and goes on between them - a few parts in
    ``accuracy`` of the values are left - until one bound is the value or at
    most ``few`` values remain, which are sorted. A round is two aggregations
    of the wide table for all columns and ranks; no value is shuffled.
    ``approx`` is ``percentile_approx``.
    """
    cols = list(cols)
    if method == "approx":
        one = df.agg(*[F.percentile_approx(_num(c), list(qs), accuracy * 10).alias(f"p{i}") for i, c in enumerate(cols)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(float(q)).alias("q"), F.col(f"p{i}")[j].alias("value"))
            for i, c in enumerate(cols) for j, q in enumerate(qs)]))
        return one.select(rows.alias("r")).select("r.*")
    if method != "exact":
        raise ValueError(method)
    clean = df.select(*[_num(c).alias(f"v{i}") for i, c in enumerate(cols)])
    counts = clean.agg(*[F.count(c).alias(c) for c in clean.columns]).first() if cols else []
    ranks = {(i, r) for i, n in enumerate(counts) if n for q in qs for r in _ranks(n, q)[:2]}
    found = _values_at_ranks(clean, ranks, list(counts), accuracy, few)
    out = []
    for i, n in enumerate(counts):
        for q in qs if n else ():
            low, high, part = _ranks(n, q)
            a, b = found[i, low], found[i, high]
            out.append((cols[i], float(q), a + part * (b - a) if a != b else a))
    return df.sparkSession.createDataFrame(out, "column string, q double, value double")


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    """Ranks (from 0) below and above a quantile of ``n`` values, and its place between them."""
    h = (n - 1) * q
    return math.floor(h), math.ceil(h), h - math.floor(h)


def _values_at_ranks(clean: DataFrame, ranks: set[tuple[int, int]], counts: list[int], accuracy: int, few: int) -> dict:
    """Value at each (column place, rank). ``clean`` has columns v0, v1, ... of
    doubles without NaN, ``counts`` their numbers of values."""
    found: dict[tuple[int, int], float] = {}
    # the rank lies between two values (exclusive; None: open end), with so many values up to the first and so many between
    state = {t: (None, None, 0, counts[t[0]]) for t in ranks}

    def within(i: int, low: float | None, high: float | None) -> Column:
        v = F.col(f"v{i}")
        inside = F.lit(True) if low is None else v > F.lit(low)
        return F.when(inside if high is None else inside & (v < F.lit(high)), v)

    while state:
        spans: dict[tuple, list] = {}
        for (i, r), (low, high, before, inside) in state.items():
            spans.setdefault((i, low, high, before, inside), []).append(r)
        aggs, wide = [], []
        for k, ((i, low, high, before, inside), rs) in enumerate(spans.items()):
            v = within(i, low, high)
            if inside <= few:
                ordered = F.array_sort(F.collect_list(v))
                aggs.append(F.array(*[F.get(ordered, F.lit(r - before)) for r in rs]).alias(f"s{k}"))
            else:
                near = [min(1.0, max(0.0, (r - before + 0.5) / inside + d)) for r in rs for d in (-2 / accuracy, 2 / accuracy)]
                aggs.append(F.percentile_approx(v, near, accuracy).alias(f"s{k}"))
        row = clean.agg(*aggs).first()
        for k, ((i, low, high, before, inside), rs) in enumerate(spans.items()):
            for j, r in enumerate(rs):
                if inside <= few:
                    found[i, r] = row[f"s{k}"][j]
                    del state[i, r]
                else:
                    wide.append((i, r, *row[f"s{k}"][2 * j:2 * j + 2]))
        bounds = sorted({(i, x) for i, _, a, b in wide for x in (a, b)})
        if not bounds:
            continue
        sums = clean.agg(*[F.count_if(F.col(f"v{i}") < F.lit(x)).alias(f"l{k}") for k, (i, x) in enumerate(bounds)],
                         *[F.count_if(F.col(f"v{i}") <= F.lit(x)).alias(f"u{k}") for k, (i, x) in enumerate(bounds)]).first()
        under = {b: (sums[f"l{k}"], sums[f"u{k}"]) for k, b in enumerate(bounds)}
        for i, r, a, b in wide:
            low, high, before, inside = state.pop((i, r))
            (less_a, upto_a), (less_b, upto_b) = under[i, a], under[i, b]
            if r < less_a:
                state[i, r] = (low, a, before, less_a - before)
            elif r < upto_a:
                found[i, r] = a
            elif r < less_b:
                state[i, r] = (a, b, upto_a, less_b - upto_a)
            elif r < upto_b:
                found[i, r] = b
            else:
                state[i, r] = (b, high, upto_b, before + inside - upto_b)
    return found


def describe(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """pandas ``describe()`` per column: count, mean, std, min, 25%, 50%, 75%, max."""
    qs = quantiles(df, cols, (0.25, 0.5, 0.75), method)
    wide = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                      for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return moments(df, cols).join(wide, "column", "left")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas ``describe(include='object')``: count, unique, top, freq.
    ``top`` is the most frequent value, ties to the smallest value."""
    long = df.select(*[_q(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    freq = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return freq.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """``value_counts()``, most frequent first."""
    return df.groupBy(_q(col)).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), _q(col))


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, skew)``: adjusted Fisher-Pearson skewness as pandas ``skew``
    (A20): Spark's population skewness times sqrt(n(n-1))/(n-2)."""
    aggs = []
    for i, c in enumerate(cols):
        x = _num(c)
        aggs += [F.skewness(x).alias(f"g{i}"), F.count(x).alias(f"n{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        n = F.col(f"n{i}").cast("double")
        adj = F.when(n > 2, F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        rows.append(F.struct(F.lit(c).alias("column"), adj.alias("skew")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def skew_summary(skews: DataFrame) -> DataFrame:
    """mean / min / max of the per-column skewness."""
    return skews.agg(F.avg("skew").alias("mean_skew"), F.min("skew").alias("min_skew"),
                     F.max("skew").alias("max_skew"))


def split_by_skew(skews: DataFrame, threshold: float = 0.5, absolute: bool = False) -> DataFrame:
    """Flag skewed columns: ``skew > t`` (EDA form) or ``|skew| >= t``."""
    cond = (F.abs("skew") >= threshold) if absolute else (F.col("skew") > threshold)
    return skews.withColumn("is_skewed", cond)


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact") -> DataFrame:
    """``(column, q1, q3, iqr, lower, upper)`` (A23); NULL numbers for a
    column without a value."""
    qs = quantiles(df, cols, (0.25, 0.75), method)
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    w = qs.groupBy("column").agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
                                 F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return names.join(w, "column", "left").select("column", "q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower"),
                    (F.col("q3") + k * iqr).alias("upper"))


def box_stats(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact") -> DataFrame:
    """Fences plus the number of values outside them, per column (A23). The
    fences are a few numbers per column; the values outside are counted for all
    columns in one pass."""
    rows = {r["column"]: r for r in iqr_fences(df, cols, k, method).collect()}
    outside = [F.count_if((_num(c) < F.lit(rows[c]["lower"])) | (_num(c) > F.lit(rows[c]["upper"]))) for c in cols]
    one = df.agg(*[x.alias(f"o{i}") for i, x in enumerate(outside)])
    fields = {name: (lambda i, name=name: F.lit(rows[cols[i]][name]).cast("double")) for name in ("q1", "q3", "iqr", "lower", "upper")}
    return _long(one, cols, {**fields, "n_outliers": lambda i: F.col(f"o{i}")})


def remove_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, method: str = "exact") -> DataFrame:
    """Rows inside every column's IQR fences, fences from the full data.
    Rows with a NULL or NaN in one of the columns go.

    The fences are a few numbers per column; they are read to the driver (a
    bounded result) and become one conjunctive filter, applied in one scan."""
    fences = {r["column"]: (r["lower"], r["upper"]) for r in iqr_fences(df, cols, k, method).collect()}
    cond = F.lit(True)
    for c in cols:
        lo, hi = fences.get(c, (None, None))  # no fences: no value, no row inside
        cond = cond & F.coalesce((_q(c) >= F.lit(lo)) & (_q(c) <= F.lit(hi)), F.lit(False))
    return df.where(cond)


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """``(column, bin, lower, upper, count)`` with ``bins`` equal-width bins
    between each column's min and max, the last bin closed (numpy) (A24).
    Empty bins are listed with count 0."""
    ends = df.agg(*[F.min(_num(c)).alias(f"lo{i}") for i, c in enumerate(cols)], *[F.max(_num(c)).alias(f"hi{i}") for i, c in enumerate(cols)])
    rng = _long(ends, cols, {"lo": lambda i: F.col(f"lo{i}"), "hi": lambda i: F.col(f"hi{i}")}).where("lo IS NOT NULL")
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    # one row per column is broadcast; the bins are counted in the tasks
    counts = _values(df, cols).join(F.broadcast(rng), "column").groupBy("column", b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair, pairwise-complete (A25), from
    one mergeable matrix whatever the number of columns. NULL for a pair with
    fewer than two common rows or without variation in them."""
    return correlations(df, cols)


def grade_correlations(df: DataFrame, cols: Sequence[str], target: str,
                       weak: float = 0.25, medium: float = 0.5) -> DataFrame:
    """``(column, r, grade)``: |r| < 0.25 weak, < 0.5 medium, else strong."""
    one = df.agg(*[F.corr(_num(c), _num(target)).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("r")) for i, c in enumerate(cols)]
    out = one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    a = F.abs("r")
    return out.withColumn("grade", F.when(a < weak, "weak").when(a < medium, "medium").otherwise("strong"))


def regression_lines(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """``(column, slope, intercept)`` of the simple least-squares line of the
    target on each feature (A27)."""
    y = _num(target)
    one = df.agg(*[F.regr_slope(y, _num(c)).alias(f"s{i}") for i, c in enumerate(cols)],
                 *[F.regr_intercept(y, _num(c)).alias(f"b{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("slope"), F.col(f"b{i}").alias("intercept"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
