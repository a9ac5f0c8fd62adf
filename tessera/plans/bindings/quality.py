"""Step 5: validation, quarantine, parsing, duplicates and missing values.

Faults are planted by fixed rules on the keys, the same rule on both the
Spark and the SQL side: ledger lines from orders (a non-existent day, a blank
description, text and NaN amounts, decimal commas on even keys, one "file"
per customer group), a book catalogue from parts (blank titles, bad ratings,
bad and negative prices, odd stock text), NULL and NaN cells in parts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import ordering as O
from tessera.operators import quality as Q
from tessera.operators import windows as W
from tessera.plans.registry import query, table


def ledger(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    amt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return o.select(
        "o_orderkey",
        F.concat(F.lit("ledger_"), (F.col("o_custkey") % 300).cast("string"), F.lit(".csv")).alias("file"),
        F.when(k % 97 == 0, F.lit("31/02/2024")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Date"),
        F.when(k % 89 == 0, F.lit("   ")).otherwise(F.col("o_orderpriority")).alias("Description"),
        F.when(k % 83 == 0, F.lit("abc")).when(k % 79 == 0, F.lit("nan"))
         .when(k % 2 == 0, F.replace(amt, F.lit("."), F.lit(","))).otherwise(amt).alias("Amount"))


LEDGER_SQL = """ledger AS (SELECT o_orderkey, 'ledger_' || CAST(o_custkey % 300 AS VARCHAR) || '.csv' AS file,
    CASE WHEN o_orderkey % 97 = 0 THEN '31/02/2024' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS "Date",
    CASE WHEN o_orderkey % 89 = 0 THEN '   ' ELSE o_orderpriority END AS "Description",
    CASE WHEN o_orderkey % 83 = 0 THEN 'abc' WHEN o_orderkey % 79 = 0 THEN 'nan'
         WHEN o_orderkey % 2 = 0 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
         ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "Amount" FROM orders)"""

_AMT_OK = """(TRY_CAST(replace({a}, ',', '.') AS DOUBLE) IS NOT NULL
    AND NOT isnan(TRY_CAST(replace({a}, ',', '.') AS DOUBLE)) AND NOT isinf(TRY_CAST(replace({a}, ',', '.') AS DOUBLE)))"""

VALIDATED_SQL = "WITH " + LEDGER_SQL + """, v AS (SELECT *, CASE
    WHEN NOT (regexp_matches("Date", '^\\d{1,2}/\\d{1,2}/\\d{4}$') AND try_strptime("Date", '%d/%m/%Y') IS NOT NULL) THEN 'bad_date'
    WHEN NOT (trim("Description") <> '') THEN 'empty_description'
    WHEN NOT """ + _AMT_OK.format(a='"Amount"') + """ THEN 'bad_amount' END AS reason FROM ledger)"""


@query("p16_validate_ledger", VALIDATED_SQL + " SELECT o_orderkey, reason, reason IS NULL AS is_valid FROM v")
def p16_validate_ledger(spark, d):
    return Q.validate_ledger(ledger(spark, d)).select("o_orderkey", "reason", "is_valid")


@query("p16_quarantine", VALIDATED_SQL + """ SELECT o_orderkey, file, "Date", "Description", "Amount", reason
    FROM v WHERE reason IS NOT NULL""")
def p16_quarantine(spark, d):
    good, bad = Q.split_valid(Q.validate_ledger(ledger(spark, d)))
    return bad.drop("is_valid")


@query("p17_rows_of_valid_files", VALIDATED_SQL + """ SELECT o_orderkey, file FROM v
    WHERE file IN (SELECT file FROM v GROUP BY file HAVING bool_and(reason IS NULL))""")
def p17_rows_of_valid_files(spark, d):
    return Q.rows_of_valid_files(Q.validate_ledger(ledger(spark, d)), file_col="file").select("o_orderkey", "file")


@query("p17_file_verdict", VALIDATED_SQL + """ SELECT file, bool_and(reason IS NULL) AS file_ok,
    count(*) AS n_rows FROM v GROUP BY file""")
def p17_file_verdict(spark, d):
    return Q.file_verdict(Q.validate_ledger(ledger(spark, d)), file_col="file")


_PAT = T.RECORD_PATTERN


@query("f1_parse_free_text_record", "WITH " + LEDGER_SQL + f""", l AS (SELECT o_orderkey,
    "Date" || ' ' || "Description" || ' ' || "Amount" AS line FROM ledger),
x AS (SELECT o_orderkey, regexp_matches(line, '{_PAT}') AS m,
    regexp_extract(line, '{_PAT}', 1) AS d, regexp_extract(line, '{_PAT}', 2) AS des,
    regexp_extract(line, '{_PAT}', 3) AS a FROM l),
y AS (SELECT *, (m AND try_strptime(d, '%d/%m/%Y') IS NOT NULL AND trim(des) <> ''
    AND {_AMT_OK.format(a='a')}) AS ok FROM x)
SELECT o_orderkey, ok, CASE WHEN ok THEN CAST(try_strptime(d, '%d/%m/%Y') AS DATE) END AS "date",
    CASE WHEN ok THEN des END AS description,
    CASE WHEN ok THEN TRY_CAST(replace(a, ',', '.') AS DECIMAL(18,2)) END AS amount FROM y""")
def f1_parse_free_text_record(spark, d):
    lg = ledger(spark, d)
    line = F.concat_ws(" ", "Date", "Description", "Amount")
    return lg.select("o_orderkey", T.parse_record(line).alias("r")).select("o_orderkey", "r.*")


@query("f2_decimal_comma_amount", "WITH " + LEDGER_SQL + """ SELECT o_orderkey,
    TRY_CAST(replace("Amount", ',', '.') AS DECIMAL(18,2)) AS amount FROM ledger""")
def f2_decimal_comma_amount(spark, d):
    return ledger(spark, d).select("o_orderkey", T.decimal_comma_number("Amount", "decimal(18,2)").alias("amount"))


def books(spark, d):
    p = table(spark, d, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    words = ["one", "TWO", "three", "Four", "FIVE", "six"]
    rating = F.lit(None).cast("string")
    for i, w in reversed(list(enumerate(words))):
        rating = F.when(s % 6 == i, F.lit(w)).otherwise(rating)
    price = F.col("p_retailprice").cast("string")
    return p.select(
        "p_partkey",
        F.when(k % 50 == 0, F.lit("  ")).otherwise(F.col("p_name")).alias("Title"),
        rating.alias("rating_raw"),
        F.when(k % 40 == 0, F.lit("N/A")).when(k % 45 == 0, F.concat(F.lit("£-"), price))
         .when(k % 2 == 0, F.concat(F.lit("Â£"), price)).otherwise(F.concat(F.lit("£"), price)).alias("price_raw"),
        F.when(s % 7 == 0, F.lit(" Out of stock ")).when(s % 11 == 0, F.lit("Unknown"))
         .otherwise(F.lit("In stock  ")).alias("stock_raw"))


BOOKS_SQL = """books AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN '  ' ELSE p_name END AS "Title",
    CASE p_size % 6 WHEN 0 THEN 'one' WHEN 1 THEN 'TWO' WHEN 2 THEN 'three' WHEN 3 THEN 'Four'
        WHEN 4 THEN 'FIVE' WHEN 5 THEN 'six' END AS rating_raw,
    CASE WHEN p_partkey % 40 = 0 THEN 'N/A' WHEN p_partkey % 45 = 0 THEN '£-' || CAST(p_retailprice AS VARCHAR)
         WHEN p_partkey % 2 = 0 THEN 'Â£' || CAST(p_retailprice AS VARCHAR) ELSE '£' || CAST(p_retailprice AS VARCHAR) END AS price_raw,
    CASE WHEN p_size % 7 = 0 THEN ' Out of stock ' WHEN p_size % 11 = 0 THEN 'Unknown' ELSE 'In stock  ' END AS stock_raw
    FROM part),
clean AS (SELECT p_partkey, "Title", upper(substr(rating_raw, 1, 1)) || lower(substr(rating_raw, 2)) AS "Rating",
    TRY_CAST(replace(replace(price_raw, 'Â£', ''), '£', '') AS DOUBLE) AS "Price", trim(stock_raw) AS "Stock" FROM books)"""


def clean_books(spark, d):
    b = books(spark, d)
    return b.select("p_partkey", "Title", T.capitalize("rating_raw").alias("Rating"),
                    T.currency_to_double("price_raw").alias("Price"), T.strip("stock_raw").alias("Stock"))


@query("f12_currency_to_double", "WITH " + BOOKS_SQL + ' SELECT p_partkey, "Price" FROM clean')
def f12_currency_to_double(spark, d):
    return clean_books(spark, d).select("p_partkey", "Price")


@query("f13_capitalize_and_strip", "WITH " + BOOKS_SQL + ' SELECT p_partkey, "Rating", "Stock" FROM clean')
def f13_capitalize_and_strip(spark, d):
    return clean_books(spark, d).select("p_partkey", "Rating", "Stock")


@query("p18_validate_books", "WITH " + BOOKS_SQL + """ SELECT p_partkey, CASE
    WHEN NOT (trim("Title") <> '') THEN 'empty_title'
    WHEN NOT ("Rating" IN ('One','Two','Three','Four','Five')) THEN 'bad_rating'
    WHEN NOT (NOT coalesce("Price" < 0, false)) THEN 'negative_price'
    WHEN NOT ("Stock" IN ('In stock','Out of stock')) THEN 'bad_stock' END AS reason FROM clean""")
def p18_validate_books(spark, d):
    return Q.validate_books(clean_books(spark, d)).select("p_partkey", "reason")


def holes(spark, d):
    """Parts with planted NULL names and NULL / NaN prices."""
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select("p_partkey", F.when(k % 13 == 0, None).otherwise(F.col("p_name")).alias("name"),
                    "p_size",
                    F.when(k % 17 == 0, F.lit(float("nan"))).when(k % 19 == 0, F.lit(None))
                     .otherwise(F.col("p_retailprice")).alias("price"))


HOLES_SQL = """holes AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS name, p_size,
    CASE WHEN p_partkey % 17 = 0 THEN 'nan'::DOUBLE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_retailprice END AS price
    FROM part)"""


@query("p19_drop_missing", "WITH " + HOLES_SQL + """ SELECT p_partkey FROM holes
    WHERE name IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)""")
def p19_drop_missing(spark, d):
    return Q.drop_missing(holes(spark, d)).select("p_partkey")


@query("p20_rows_with_missing", "WITH " + HOLES_SQL + """ SELECT p_partkey FROM holes
    WHERE name IS NULL OR price IS NULL OR isnan(price)""")
def p20_rows_with_missing(spark, d):
    return Q.rows_with_missing(holes(spark, d)).select("p_partkey")


_MISSING_SQL = "WITH " + HOLES_SQL + """, m AS (
    SELECT 'p_partkey' AS "column", CAST(count_if(p_partkey IS NULL) AS BIGINT) AS n_missing, count(*) AS n_rows FROM holes
    UNION ALL SELECT 'name', CAST(count_if(name IS NULL) AS BIGINT), count(*) FROM holes
    UNION ALL SELECT 'p_size', CAST(count_if(p_size IS NULL) AS BIGINT), count(*) FROM holes
    UNION ALL SELECT 'price', CAST(count_if(price IS NULL OR isnan(price)) AS BIGINT), count(*) FROM holes)"""


@query("a15_missing_counts", _MISSING_SQL + " SELECT * FROM m")
def a15_missing_counts(spark, d):
    return Q.missing_counts(holes(spark, d))


@query("p21_columns_without_missing", _MISSING_SQL + ' SELECT "column" FROM m WHERE n_missing = 0')
def p21_columns_without_missing(spark, d):
    return Q.columns_without_missing(holes(spark, d))


@query("w3_duplicate_key_rows", """SELECT p_partkey, p_name FROM part
    WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)""")
def w3_duplicate_key_rows(spark, d):
    return W.duplicate_key_rows(table(spark, d, "part").select("p_partkey", "p_name"), "p_name")


@query("o5_keep_first_per_key", """SELECT p_name, p_partkey, p_brand FROM (SELECT p_name, p_partkey, p_brand,
    row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""")
def o5_keep_first_per_key(spark, d):
    p = table(spark, d, "part").select("p_name", "p_partkey", "p_brand")
    return O.keep_first_per_key(p, "p_name", ["p_partkey"])


@query("a19_duplicate_tally", """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicated, count(*) AS n_first
    FROM (SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2)""")
def a19_duplicate_tally(spark, d):
    return Q.duplicate_tally(table(spark, d, "part"), ["p_name", "p_brand"])


@query("o6_union_pages", "SELECT * FROM part WHERE p_size < 25 UNION ALL SELECT * FROM part WHERE p_size >= 25")
def o6_union_pages(spark, d):
    p = table(spark, d, "part")
    return O.union_all([p.where(F.col("p_size") < 25), p.where(F.col("p_size") >= 25)])


@query("s9_issues_report", "WITH " + HOLES_SQL + """ SELECT p_partkey, 'duplicate' AS issue FROM holes
    WHERE name IN (SELECT name FROM holes GROUP BY name HAVING count(*) > 1)
       OR (name IS NULL AND (SELECT count(*) FROM holes WHERE name IS NULL) > 1)
    UNION ALL SELECT p_partkey, 'missing' FROM holes WHERE name IS NULL OR price IS NULL OR isnan(price)""")
def s9_issues_report(spark, d):
    h = holes(spark, d)
    dups = W.duplicate_key_rows(h, "name")
    return Q.issues_report(dups, Q.rows_with_missing(h)).select("p_partkey", "issue")


@query("f15_page_total", """SELECT page_id, coalesce(TRY_CAST(list_last(string_split_regex(trim(
    'Page 1 of ' || regexp_extract(url, 'page=(\\d+)', 1)), '\\s+')) AS INTEGER), 1) AS total_pages FROM pages""")
def f15_page_total(spark, d):
    pg = table(spark, d, "pages")
    pager = F.concat(F.lit("Page 1 of "), F.regexp_extract("url", r"page=(\d+)", 1))
    return pg.select("page_id", T.page_total(pager).alias("total_pages"))
