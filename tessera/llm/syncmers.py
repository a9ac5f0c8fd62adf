"""Document fingerprints of closed syncmers, in built-in functions only.

A k-mer is a run of ``k`` words. It is an anchor if the smallest hash of its
inner runs of ``s`` words stands at its first or last place: whether a k-mer
is chosen depends on nothing but itself, so the same passage gives the same
anchors in any context. A fingerprint is the list of a text's anchors, each
with the distance in words from the anchor before, so that texts are matched
by what stands where and an insertion spoils a single entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import required


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fingerprint(text: Column, k: int = 6, s: int = 2) -> Column:
    """Anchors of a text as ``distance:hash`` entries, joined by commas. A text
    without an anchor (of fewer than ``k`` words, or with no closed ``k``-mer) is
    one anchor, the hash of the text itself."""
    inner = k - s + 1

    def anchors(words: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(words) - s),
                           lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(s)]))
        return let(runs, lambda h: let(closed(h), lambda at: F.array_join(F.transform(at, entry(h, at)), ",")))

    def closed(h: Column) -> Column:
        def chosen(i: Column) -> Column:
            return let(F.array_min(F.slice(h, i + 1, inner)), lambda least: (F.get(h, i) == least) | (F.get(h, i + inner - 1) == least))
        return F.filter(F.sequence(F.lit(0), F.size(h) - inner), chosen)

    def entry(h: Column, at: Column) -> Callable[[Column, Column], Column]:
        def one(i: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(at, j - 1)).otherwise(F.lit(0))
            return F.concat((i - before).cast("string"), F.lit(":"), F.substring(F.hex(F.xxhash64(F.slice(h, i + 1, inner))), -8, 8))
        return one

    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    whole = F.concat(F.lit("0:"), F.hex(F.xxhash64(text)))
    return let(words, lambda w: F.when(F.size(w) >= k, let(anchors(w), lambda a: F.when(a == "", whole).otherwise(a))).otherwise(whole))


def likeness(a: Column, b: Column) -> Column:
    """Share of the entries of two fingerprints that both have (Dice), 0 to 1."""
    both = F.struct(F.array_distinct(F.split(a, ",")).alias("a"), F.array_distinct(F.split(b, ",")).alias("b"))
    return let(both, lambda x: 2.0 * F.size(F.array_intersect(x["a"], x["b"])) / (F.size(x["a"]) + F.size(x["b"])))


def with_next(docs: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Each row with ``next_<column>`` of the document that follows by
    descending doc_id (ties by text, rows without an id last; after the last:
    the first).

    Ids are cut into ranges at approximate quantiles; the first document of a
    range is copied to the range before it, so each range is a window of its
    own and there is one shuffle of the rows.
    """
    cuts = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] if buckets > 1 else None
    cuts = sorted(set(cuts or []))
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(F.lit(cuts), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0))
    top = {r["bucket"]: r["top"] for r in docs.select(bucket.alias("bucket"), "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("top")).collect()}
    order = sorted(top, reverse=True)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    docs = docs.withColumn("bucket", bucket)
    heads = [F.when((F.col("bucket") == b) & F.col("doc_id").eqNullSafe(F.lit(top[b]).cast("long")),
                    F.struct(F.lit(before[b]).alias("bucket"), F.lit(True).alias("copy"))) for b in order]
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("copy"))
    dealt = docs.withColumn("place", F.explode(F.array_compact(F.array(own, F.coalesce(*heads)))) if heads else own)
    window = Window.partitionBy("place.bucket").orderBy("place.copy", F.desc_nulls_last("doc_id"), "text")
    return (dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
            .where(~F.col("place.copy")).drop("place", "bucket"))


def fingerprints(docs: DataFrame, k: int = 6, s: int = 2) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) per document row.

    The edited text is the text with its last floor(n/2) of n characters
    replaced by the first as many (or all) of the next document. Null texts
    are empty; a lone document is its own next. Repeated rows stay; an empty
    table gives none.
    """
    docs = required(docs, {"doc_id": "long", "text": "string"})
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("fingerprint", fingerprint(F.col("text"), k, s))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = with_next(docs, ["text", "fingerprint"], buckets).select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       fingerprint(F.col("edited"), k, s).alias("edited_fingerprint"), "next_fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
