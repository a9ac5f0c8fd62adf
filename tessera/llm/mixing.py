"""Mixing sources to target weights by entropy balancing, in built-in
functions only.

Each document gets a rate, the expected number of its copies in the mix. Of all
rates of at most ``max_copies`` that give every source its target of words, the
ones closest in relative entropy to one copy of everything are exponentially
tilted: min(max_copies, exp(tilt of the source * size of the document)). The
tilts solve the convex dual problem, by Newton steps for all sources at once:
a step is one aggregation over the table of (source, size, number of
documents), whose rows are bounded by the different sizes of a source.

Rates become whole copies by floor(rate + u), where u is a hash of the
document, shifted by one offset per source so that the source's words come
near to its target; one document per source mends what whole documents left.
The offset is found by rounds of one small histogram per source, so a source
with a third of all rows is neither sorted nor gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import required
from tessera.operators.windows import global_index
from tessera.session import write_table

#: Bits of one round's histogram of thresholds, and of a threshold.
STEP, BITS = 11, 33


def words(text: Column) -> Column:
    """Number of runs of other characters than space and bytes 9 to 13."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(sid, source, source_size, target) for a table of (source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` of all words; a target stops at ``most`` times the source's size
    and the excess is shared by weight among the others, until none is above.
    """
    numbered = global_index(sizes, [F.asc_nulls_last("source")], "sid", 0)
    weight = F.get(F.lit([float(w) for w in weights]), (F.col("sid") % len(weights)).cast("int"))
    numbered = write_table(numbered.select("sid", "source", "source_size", weight.alias("weight"),
                                           (F.col("source_size") * float(most)).alias("cap")), "sources")
    full, level = F.lit(False), 0.0
    while True:
        row = numbered.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("cap"))).alias("held"),
                           F.sum(F.when(~full, F.col("weight"))).alias("open"), F.count_if(full).alias("n")).first()
        if not row["all"] or not row["open"]:
            break
        level = (row["all"] * share - (row["held"] or 0.0)) / row["open"]
        above = full | (F.col("weight") * level > F.col("cap"))
        if numbered.where(above).count() == row["n"]:
            break
        full = above
    return numbered.select("sid", "source", "source_size", F.when(full, F.col("cap")).otherwise(F.col("weight") * level).alias("target"))


def rate(size: Column, unit: Column, tilt: Column, most: float) -> tuple[Column, Column]:
    """(rate, the same without the limit) of documents of ``size`` words."""
    free = F.exp(F.least(tilt * size / unit, F.lit(700.0)))
    return F.least(free, F.lit(float(most))), free


def tilts(sizes: DataFrame, goals: DataFrame, most: float = 2.0, tolerance: float = 1e-7, max_rounds: int = 200) -> DataFrame:
    """(sid, unit, tilt): the tilt of each source, with sizes measured in
    ``unit``, the source's mean size. ``sizes``: (sid, size, n) of the
    documents that have words; ``goals``: (sid, target).

    A Newton step that leaves the bracket of the root is replaced by a half of
    the bracket, and no step is longer than four or four times the tilt. A
    source that must give all or nothing has an infinite tilt.
    """
    unit = sizes.groupBy("sid").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("unit"), F.sum("n").alias("docs"))
    goal, none = F.col("target") / F.col("unit"), F.lit(None).cast("double")
    start = F.when(goal >= F.col("docs") * float(most) * (1 - tolerance), float("inf")).when(goal <= 0, float("-inf")).otherwise(0.0)
    state = write_table(unit.join(goals, "sid").select("sid", "unit", goal.alias("goal"), start.alias("tilt"), none.alias("low"), none.alias("high"),
                                                       (F.abs(start) == float("inf")).alias("done")), "tilts")
    tilt, low, high = F.col("tilt"), F.col("low"), F.col("high")
    for _ in range(max_rounds):
        if state.where(~F.col("done")).isEmpty():
            break
        z = F.col("size") / F.col("unit")
        limited, free = rate(F.col("size"), F.col("unit"), tilt, most)
        step = (sizes.join(state.where(~F.col("done")), "sid").groupBy("sid")
                .agg(*[F.first(c).alias(c) for c in ("unit", "goal", "tilt", "low", "high")], F.sum(F.col("n") * z * limited).alias("given"),
                     F.sum(F.when(free < most, F.col("n") * z * z * free).otherwise(0.0)).alias("slope")))
        miss = F.col("goal") - F.col("given")
        step = step.select("sid", "unit", "goal", "tilt", F.when(miss > 0, tilt).otherwise(low).alias("low"), F.when(miss > 0, high).otherwise(tilt).alias("high"),
                           (F.abs(miss) <= tolerance * F.col("goal")).alias("done"), (tilt + F.try_divide(miss, F.col("slope"))).alias("newton"))
        far, back = F.greatest(tilt * 4, tilt + 4), F.least(tilt * 4, tilt - 4)
        inside = F.coalesce((F.col("newton") > F.coalesce(low, back)) & (F.col("newton") < F.coalesce(high, far)), F.lit(False))
        step = step.select("sid", "unit", "goal", "low", "high", "done", F.when(F.col("done"), tilt).when(inside, F.col("newton"))
                           .otherwise(F.when(low.isNull(), back).when(high.isNull(), far).otherwise((low + high) / 2)).alias("tilt"))
        state = write_table(step.unionByName(state.where("done")), "tilts")
    return state.select("sid", "unit", "tilt")


def thresholds(docs: DataFrame, goals: DataFrame) -> DataFrame:
    """(sid, threshold) such that the copies with keys below it give each
    source the words nearest to its target. ``docs``: (sid, size, keys), a key
    of ``BITS`` bits for each copy a document can have; ``goals``: (sid, target).

    A round sums the words of a source's copies by the next ``STEP`` bits of
    their keys and goes on with those keys at which the target is passed. A
    source that never passes its target has no row: it takes all copies.
    """
    copies = docs.where("size > 0").select("sid", "size", F.explode("keys").alias("key"))
    state = goals.select("sid", "target", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for shift in range(BITS - STEP, -1, -STEP):
        held = (copies.join(state, "sid").where(F.shiftright("key", shift + STEP) == F.col("prefix"))
                .groupBy("sid", "target", "before", F.shiftright("key", shift).alias("slot")).agg(F.sum("size").alias("words")))
        # at most 2^STEP rows a source
        held = held.withColumn("given", F.col("before") + F.sum("words").over(Window.partitionBy("sid").orderBy("slot")))
        passed = F.col("given") > F.col("target")
        found = held.groupBy("sid", "target", "before").agg(F.max(F.when(~passed, F.col("given"))).alias("under"),
                                                            F.min(F.when(passed, F.struct("given", "slot"))).alias("over"))
        state = write_table(found.where("over IS NOT NULL").select("sid", "target", F.col("over.slot").alias("prefix"),
                                                                   F.coalesce("under", "before").alias("before"), F.col("over.given").alias("over")), "thresholds")
    nearer = F.abs(F.col("over") - F.col("target")) < F.abs(F.col("before") - F.col("target"))
    return state.select("sid", (F.col("prefix") + nearer.cast("long")).alias("threshold"))


def repaired(docs: DataFrame, most: int) -> DataFrame:
    """``docs`` (a written table with sid, size, target, draw and copies), where
    in each source the document whose size is nearest to what the source lacks
    or has too much is taken once more or less, if that brings the source
    nearer to its target."""
    off = write_table(docs.groupBy("sid").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off")), "missed")
    able = F.when(F.col("off") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0)
    miss = F.abs(F.abs("off") - F.col("size"))
    fit = docs.select("sid", "size", "draw", "copies").join(off, "sid").where(able & (miss < F.abs("off")))
    best = write_table(fit.groupBy("sid").agg(F.min(F.struct(miss.alias("miss"), "size", "draw", "copies")).alias("best"), F.first("off").alias("off")), "nearest")
    best = best.select("sid", "off", "best.size", "best.draw", "best.copies")
    keys = ["sid", "size", "draw", "copies"]
    alike = docs.select(*keys).join(best, keys).groupBy("off", *keys).agg(F.count(F.lit(1)).alias("n"))  # equal rows change together
    change = alike.where(F.abs(F.abs("off") - F.col("n") * F.col("size")) < F.abs("off")).select(*keys, F.signum("off").cast("int").alias("change"))
    return docs.join(write_table(change, "changes"), keys, "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0))).drop("change")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) per document
    row: ``copies`` (0 to ``most``) of a document of ``size`` words are taken.

    Null texts have no words; a document without words has rate 1 and no
    copies. A null source is a source of its own. Rows that are equal in id and
    text are taken alike, rows without an id by their text. Repeated rows are
    rows of their own; an empty table gives none. The draws are hashes of id
    and text, so reruns agree.
    """
    docs = required(docs, {"doc_id": "long", "text": "string", "source": "string"})
    read = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"))
    docs = write_table(read, "sizes")
    goals = write_table(targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    named = goals.select("sid", F.col("source").alias("own"), "source_size", "target")
    docs = docs.join(named, F.col("source").eqNullSafe(F.col("own"))).drop("own")
    counted = write_table(docs.where("size > 0").groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "size-counts")
    found = tilts(counted, goals.select("sid", "target"), most)
    given = F.when(F.col("size") > 0, rate(F.col("size"), F.col("unit"), F.col("tilt"), most)[0]).otherwise(1.0)
    docs = docs.join(found, "sid", "left").withColumn("rate", given)
    u = F.pmod("draw", F.lit(1 << BITS - 1)) / float(1 << BITS - 1)
    # copy j is taken above the offset j - rate - u; large documents are moved away from 0, where the chosen offset will lie,
    # so that small ones bring a source to its target
    away = F.pow(1.0 + F.coalesce(F.col("size") / F.col("unit"), F.lit(0.0)), F.lit(2.0))
    keys = F.array(*[F.floor((F.greatest(F.least((j - F.col("rate") - u) * away, F.lit(1.0)), F.lit(-1.0)) + 1.0) * float(1 << BITS - 1)) for j in range(1, most + 1)])
    keys = F.transform(keys, lambda k: F.least(k, F.lit((1 << BITS) - 1)))
    docs = docs.withColumn("keys", keys).drop("unit", "tilt")
    docs = write_table(docs, "rates")
    chosen = docs.join(thresholds(docs, goals.select("sid", "target")), "sid", "left")
    below = F.size(F.filter("keys", lambda k: k < F.coalesce("threshold", F.lit(1 << BITS))))  # no threshold: all copies
    chosen = write_table(chosen.withColumn("copies", F.when(F.col("size") > 0, below).otherwise(0)).drop("keys", "threshold"), "copies")
    return repaired(chosen, most).select("doc_id", "source", "size", "source_size", "target", "rate", "copies")
