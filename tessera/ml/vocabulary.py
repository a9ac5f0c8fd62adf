"""Term counts against a vocabulary that is a table.

A fitted ``CountVectorizer`` holds its vocabulary on the driver. Here the terms
and their dense ids are a written table: counting, numbering, scaling and
looking up are aggregations and joins, so the vocabulary may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.stopwords import ENGLISH
from tessera.operators.windows import global_index


#: The most frequent terms, and the longest of them, that are looked up without a shuffle of the counts.
FREQUENT_TERMS, FREQUENT_LENGTH = 200_000, 64


#: Tokens that are counted at a time.
SLICE = 1 << 20


def _counted(leave_out: Sequence[str], at_once: int = SLICE):
    """Of batches (id, tokens) the rows (id, term, n); every row is a text of its own."""
    names = ["id", "term", "n"]
    left = pa.array(list(leave_out), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.searchsorted(ends, np.arange(at_once, ends[-1], at_once), side="right") if len(ends) else []
            for begin, end in zip([0, *cuts], [*cuts, len(ends)]):
                part = batch.slice(begin, end - begin)
                rows = pc.list_parent_indices(part.column(1)).to_numpy()
                terms = pc.list_flatten(part.column(1)).dictionary_encode()
                held = terms.dictionary
                key, n = np.unique(rows * len(held) + terms.indices.to_numpy(), return_counts=True)
                row, code = np.divmod(key, max(1, len(held)))
                if len(left):
                    live = ~pc.is_in(held, left).to_numpy(zero_copy_only=False)[code]
                    row, code, n = row[live], code[live], n[live]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), held.take(pa.array(code)), pa.array(n.astype(np.int64))], names=names)
    return run


def token_counts(df: DataFrame, id_col: str, tokens: Column, leave_out: Sequence[str] = ()) -> DataFrame:
    """``(id, term, n)``: how often each token stands in a row's array of tokens.
    Rows that share an id are one text. Where every row has an id of its own (one
    count of the ids tells), a row's tokens are counted in place and nothing is
    shuffled; else the rows are dealt by id before their tokens are taken apart, so
    that texts are shuffled and not their counts."""
    key = F.col(f"`{id_col}`")
    if df.groupBy(key).count().where("count > 1").isEmpty():
        rows = df.select(key.alias("id"), tokens.alias("tokens"))
        return rows.mapInArrow(_counted(leave_out), T.StructType([rows.schema["id"], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]))
    rows = df.repartition(key).select(key.alias("id"), F.explode(tokens).alias("term"))
    return rows.where(~F.col("term").isin(*leave_out)).groupBy("id", "term").agg(F.count(F.lit(1)).alias("n"))


def term_counts(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] = ENGLISH) -> DataFrame:
    """``(id, term, n)``: how often each term stands in a row's text. Terms are
    the lower-case runs between white space that are no stop words. A NULL or
    empty text has no term; rows that share an id are one text."""
    rows = df.select(*dict.fromkeys([f"`{id_col}`", f"`{text_col}`"]))
    return token_counts(rows, id_col, F.split(F.lower(F.col(f"`{text_col}`")), r"\s"), ["", *stop_words])


def vocabulary(counts: DataFrame, n_rows: int) -> DataFrame:
    """``(term, term_id, n_docs, n_total, sd)`` of :func:`term_counts`: ids from
    0, the most frequent term first, ties in the order of the terms. ``sd`` is the
    sample deviation of a term's counts over all ``n_rows`` rows, also those
    without it; NULL for a single row."""
    n = F.lit(n_rows).cast("double")
    spread = n * F.sum(F.col("n") * F.col("n")) - F.sum("n") * F.sum("n")  # exact while below 2^53
    held = counts.groupBy("term").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_total"),
                                      F.sqrt(F.try_divide(spread, n * (n - 1))).alias("sd"))
    return global_index(held, [F.col("n_total").desc(), F.col("term")], out="term_id", start=0)  # reads a written table


def scaled_counts(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(id, term_id, n, scaled)``: counts by the ids of a vocabulary, and
    divided by the terms' deviations (0 where a term does not vary, as Spark's
    scaler has it). Terms that the vocabulary lacks give no row. The most frequent
    terms, a bounded number, are broadcast, so that only counts of the others are
    shuffled; a long term that many rows hold is a skewed key of their join, which
    adaptive execution splits."""
    often = (F.col("term_id") < FREQUENT_TERMS) & (F.length("term") <= FREQUENT_LENGTH)
    terms = terms.select("term", "term_id", "sd")
    few = F.broadcast(terms.where(often))
    rest = counts.join(few, "term", "left_anti").hint("merge").join(terms.where(~often), "term")
    unit = F.when(F.col("sd") > 0, F.col("n") / F.col("sd")).otherwise(F.lit(0.0))
    return counts.join(few, "term").union(rest.select("term", "id", "n", "term_id", "sd")).select("id", "term_id", "n", unit.alias("scaled"))


def sparse_rows(scaled: DataFrame, value: str = "scaled") -> DataFrame:
    """``(id, term_ids, counts)``: one row per text with the ids of its terms in
    ascending order and their values. Texts without a term have no row."""
    pairs = F.array_sort(F.arrays_zip(F.collect_list("term_id").alias("term_id"), F.collect_list(value).alias("v")))
    return scaled.groupBy("id").agg(pairs.alias("p")).select("id", F.col("p.term_id").alias("term_ids"), F.col("p.v").alias("counts"))
