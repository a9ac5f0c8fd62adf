"""Step 7: HTML records from pages, JSON paths on events, array and struct
work on conversation texts, pairs from arrays and multi-valued fields built
by rule from customer keys, clinical reading parse on event values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.functions import nested as N
from tessera.functions import text as T
from tessera.plans.registry import query, table


def _unescape(e: str) -> str:
    return (f"replace(replace(replace(replace(replace({e}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
            f"'&#39;', ''''), '&amp;', '&')")


_LI = '<li><a href="([^"]*)">([^<]*)</a></li>'


@query("f14_extract_nav_links", f"""WITH m AS (SELECT page_id, regexp_extract_all(html, '{_LI}', 1) AS hrefs,
    regexp_extract_all(html, '{_LI}', 2) AS labels FROM pages),
u AS (SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS position, unnest(hrefs) AS href,
    unnest(labels) AS label FROM m)
SELECT page_id, position, trim({_unescape('href')}) AS href, trim({_unescape('label')}) AS label FROM u""")
def f14_extract_nav_links(spark, d):
    pg = table(spark, d, "pages")
    return H.extract_records(pg, "html", "page_id", ("li", None),
                             {"href": ("a", None, "href"), "label": ("a", None, None)})


@query("f14_extract_titles", f"""SELECT page_id, CAST(0 AS INTEGER) AS position,
    trim({_unescape("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
    trim({_unescape("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) AS heading FROM pages""")
def f14_extract_titles(spark, d):
    pg = table(spark, d, "pages")
    return H.extract_records(pg, "html", "page_id", ("html", None),
                             {"title": ("title", None), "heading": ("h1", None)})


@query("f17_json_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def f17_json_path(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", N.json_path("props", "$.k", "int").alias("k"))


@query("f17_json_struct", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS k2 FROM events")
def f17_json_struct(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", (N.json_struct("props", "k BIGINT")["k"] * 2).alias("k2"))


@query("f19_array_and_struct_updates", """WITH w AS (SELECT conv_id, turn, role, string_split(text, ' ') AS words FROM conversations)
SELECT conv_id, turn, len(list_filter(words, lambda x: length(x) > 6)) AS n_long_words,
    len(list_filter(words, lambda x: x LIKE '%?')) > 0 AS has_question,
    list_contains(list_transform(words, lambda x: lower(x)), 'the') AS mentions_the,
    upper(role) AS role_upper, len(words) AS n_words FROM w""")
def f19_array_and_struct_updates(spark, d):
    cv = table(spark, d, "conversations")
    words = F.split("text", " ")
    s = cv.select("conv_id", "turn", F.struct("role", words.alias("words")).alias("msg"))
    s = s.withColumn("msg", F.col("msg").withField("role", F.upper("msg.role")))  # struct update
    w = F.col("msg.words")
    return s.select(
        "conv_id", "turn",
        F.size(N.keep_elements(w, lambda x: F.length(x) > 6)).alias("n_long_words"),
        N.any_element(w, lambda x: x.endswith("?")).alias("has_question"),
        N.contains(N.update_elements(w, lambda x: F.lower(x)), "the").alias("mentions_the"),
        F.col("msg.role").alias("role_upper"), F.size(w).alias("n_words"))


def friends(spark, d):
    c = table(spark, d, "customer")
    k, n = F.col("c_custkey"), F.lit(c.count())
    return c.select("c_custkey", F.array((k * 7 + 3) % n, (k * 13 + 5) % n, (k + 1) % n).alias("friends"))


@query("f20_friend_pairs", """WITH e AS (SELECT c_custkey AS a,
    unnest([(c_custkey * 7 + 3) % n, (c_custkey * 13 + 5) % n, (c_custkey + 1) % n]) AS b
    FROM customer, (SELECT count(*) AS n FROM customer)),
f AS (SELECT least(a, b) AS a2, greatest(a, b) AS b2, a < b AS fwd FROM e WHERE a <> b)
SELECT a2 AS a, b2 AS b, count(DISTINCT fwd) = 2 AS mutual FROM f GROUP BY 1, 2""")
def f20_friend_pairs(spark, d):
    return N.pairs_from_arrays(friends(spark, d), "c_custkey", "friends")


def contacts(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    phones = F.slice(F.array(F.concat(F.lit("+39-"), k.cast("string")),
                             F.concat(F.lit("+39-"), (k + 100000).cast("string"))), 1, (k % 3).cast("int"))
    return c.select(k.alias("contact_id"), F.col("c_mktsegment").alias("company"), phones.alias("phones"))


_CONTACTS_SQL = """WITH c AS (SELECT c_custkey AS contact_id, c_mktsegment AS company,
    (['+39-' || CAST(c_custkey AS VARCHAR), '+39-' || CAST(c_custkey + 100000 AS VARCHAR)])[1:(c_custkey % 3)] AS phones
    FROM customer)"""


@query("a31_contacts_per_company", _CONTACTS_SQL + " SELECT company AS value, count(*) AS n FROM c GROUP BY 1")
def a31_contacts_per_company(spark, d):
    return N.count_per_value(contacts(spark, d), "company")


@query("a31_phones_per_contact", _CONTACTS_SQL + " SELECT contact_id, len(phones) AS n_values FROM c")
def a31_phones_per_contact(spark, d):
    return N.values_per_row(contacts(spark, d), "contact_id", "phones")


@query("a31_phone_prefix_counts", _CONTACTS_SQL + """, u AS (SELECT CASE WHEN len(phones) = 0 THEN NULL
    ELSE unnest(CASE WHEN len(phones) = 0 THEN [NULL] ELSE phones END) END AS p FROM c)
SELECT substr(p, 1, 5) AS value, count(*) AS n FROM u GROUP BY 1""")
def a31_phone_prefix_counts(spark, d):
    c = contacts(spark, d).withColumn("phones", F.transform("phones", lambda p: F.substring(p, 1, 5)))
    return N.count_per_value(c, "phones")


@query("f16_parse_clinical_reading", """SELECT event_id,
    CASE event_type WHEN 'click' THEN CAST(floor(value * 10) AS DOUBLE) WHEN 'error' THEN NULL ELSE value END AS value,
    CASE event_type WHEN 'click' THEN CAST(floor(value * 5) AS DOUBLE) END AS value2,
    CASE WHEN value IS NULL THEN NULL WHEN event_type = 'click' THEN 'mmHg' WHEN event_type = 'purchase' THEN 'mg/dL' END AS unit FROM events""")
def f16_parse_clinical_reading(spark, d):
    """Readings as text, written by kind of event: a pair with a unit, a number with or without one, no number."""
    ev = table(spark, d, "events")
    t = F.col("event_type")
    whole = [F.floor(F.col("value") * n).cast("bigint").cast("string") for n in (10, 5)]
    number = F.col("value").cast("string")
    reading = (F.when(t == "click", F.concat(whole[0], F.lit("/"), whole[1], F.lit(" mmHg")))
               .when(t == "error", F.lit("n/a")).when(t == "purchase", F.concat(number, F.lit(" mg/dL"))).otherwise(number))
    return ev.select("event_id", T.parse_measure(reading).alias("m")).select("event_id", "m.value", "m.value2", "m.unit")
