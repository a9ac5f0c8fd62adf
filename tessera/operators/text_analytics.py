"""Word statistics and term frequencies over text tables (inventory A10, A11,
A28, F9-F11, W5).

Whole texts are tokenised inside the JVM (``regexp_extract_all``), exploded
and counted with a partial aggregation per (group, term): a hot category or a
very long document adds rows, never a single-task bottleneck. This replaces
the reference's collect-every-text-per-category loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.stopwords import ENGLISH
from tessera.functions.text import word_count
from tessera.operators.windows import top_k_per_group

# A token is a letter/digit/underscore followed by any number of
# letters, digits, underscores or apostrophes.
TOKEN_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"


def tokens(text_col: str):
    return F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)


def word_stats(df: DataFrame, group: str, text_cols: Sequence[str], id_col: str,
               digits: int = 2) -> DataFrame:
    """Per group: number of items, rounded mean, min and max of the total
    word count over ``text_cols`` (A11, with F9 and F10)."""
    total = None
    for c in text_cols:
        wc = word_count(c)
        total = wc if total is None else total + wc
    w = df.select(group, id_col, total.alias("tot_num_words"))
    return w.groupBy(group).agg(
        F.count(F.col(id_col)).alias("num_articles"),
        F.round(F.avg("tot_num_words"), digits).alias("avg_num_words"),
        F.min("tot_num_words").alias("num_words_shortest_article"),
        F.max("tot_num_words").alias("num_words_longest_article"))


def term_frequencies(df: DataFrame, group: str, text_col: str,
                     stop_words: Sequence[str] = ENGLISH, top_k: int | None = None) -> DataFrame:
    """``(group, term, n)``: how often each non-stop-word term occurs per
    group, optionally only the ``top_k`` most frequent (ties by term) (A28).

    The stop-word list is a bounded constant; the anti-filter is an
    ``isin`` set lookup inside the scan stage."""
    exploded = df.select(F.col(group), F.explode(tokens(text_col)).alias("term"))
    kept = exploded.where(~F.col("term").isin(*stop_words))
    counts = kept.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"))
    if top_k:
        counts = top_k_per_group(counts, group, [F.col("n").desc(), F.col("term").asc()], top_k)
    return counts
