"""The operators of this subpackage bound to the test tables, with the digest
columns their contracts ask for. ``QUERIES`` and ``ORACLE_SQL`` are read by
the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, centroids, forest, infill, langid, licenses, mixing, packing, passages, simhash, syncmers, warc, wrapper

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op10_warc_dictionary"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
     g AS (SELECT hex, min(page_id) AS lowest FROM p GROUP BY hex)
SELECT p.page_id, p.payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(p.hex, 1 + 5 * (i // 4), 5) AS BIGINT)
                                >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN p.page_id = g.lowest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = g.lowest THEN NULL ELSE g.lowest END AS refers_to
FROM p JOIN g USING (hex)
"""


@query
def op4_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    phrases = ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(f"('{t}', '{label}')" for t, label in licenses.TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
phrase AS (SELECT string_split(p, ' ') AS p, label FROM (VALUES {phrases}) AS t(p, label)),
base AS (SELECT k, label, pos FROM (SELECT k, label, p, words, unnest(range(0, len(words) - len(p) + 1)) AS pos FROM d, phrase)
         WHERE words[pos + 1 : pos + len(p)] = p),
tokens AS (SELECT list_distinct(string_split(t, ' ')) AS t, label FROM (VALUES {templates}) AS t(t, label)),
block AS (SELECT k, list_distinct(words[s + 1 : s + 48]) AS b
          FROM (SELECT k, words, unnest(range(0, greatest(len(words) - 25, 0) + 1, 24)) AS s FROM d)
          WHERE len(list_intersect(words[s + 1 : s + 48], (SELECT flatten(list(t)) FROM tokens))) >= 2),
share AS (SELECT k, label, len(list_intersect(b, t)) / len(t) AS share FROM block, tokens),
hit AS (SELECT k, label, share FROM share WHERE share >= 0.8 - 1e-9),
own AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY k),
every AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT k, label FROM base UNION ALL SELECT k, label FROM hit) GROUP BY k),
top AS (SELECT k, max(share) AS share FROM hit GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(own.n, 0) AS n_base, own.lo AS first_word, own.hi AS last_word,
       coalesce(own.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN own.n > 0 THEN 1.0::DOUBLE ELSE coalesce(top.share, 0)::DOUBLE END AS score
FROM d LEFT JOIN own USING (k) LEFT JOIN every USING (k) LEFT JOIN top USING (k)
"""


ORACLE_SQL["op4_license_templates"] = _license_sql()


@query
def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf_dir, "pages"))


@query
def op9_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op7_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", F.size("spans").cast("long").alias("n_spans"),
                        F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"]).cast("long").alias("repeated_words"),
                        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string"))), ",")
                        .alias("spans"))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN)


@query
def op11_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate")


@query
def op12_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.centroid_sha256(F.col("centroid")).alias("centroid_sha256"))


def _lloyd_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds as one chain of plain queries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (SELECT row, min_by(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT row, c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, m{r} AS m) GROUP BY row)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n
  FROM (SELECT c, unnest(v.x) AS x, unnest(range(64)) AS i FROM v JOIN a{r} USING (row)) GROUP BY c, i),
m{r + 1} AS (SELECT m.c, coalesce(g.x, m.x) AS x FROM m{r} AS m
  LEFT JOIN (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY c) AS g ON g.c = m.c)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c, x
  FROM (SELECT x, sha256('2:' || vec_id) AS h FROM v ORDER BY h NULLS LAST, x LIMIT {k})),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)}
SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (row) JOIN m{rounds} AS m ON m.c = a.c
"""


ORACLE_SQL["op12_sharded_lloyd"] = _lloyd_sql()


@query
def op13_swar_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    back = infill.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(back, 256).alias("restored_sha256"))


ORACLE_SQL["op13_swar_infill"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s,
                  regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS tokens FROM documents),
h AS (SELECT *, len(tokens) AS n, CAST('0x' || substr(s, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(s, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(s, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(s, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(tokens[1 : a], '') AS prefix, array_to_string(tokens[a + 1 : b], '') AS middle,
             array_to_string(tokens[b + 1 : n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
