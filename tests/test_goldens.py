"""Small hand-worked cases for the reference's rules (our own rows)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import aggregate as A
from tessera.operators import ordering as O
from tessera.operators import project as P
from tessera.operators import windows as W
from tessera.plans.customer_features import whole_years

LEDGER = [("05/01/2023", "Bread", "2.50"), ("17/01/2023", "Train", "12,40"),
          ("02/02/2023", "Books", "30"), ("28/02/2023", "Gift", "30"),
          ("01/03/2022", "Rent", "500.00"), ("09/03/2022", "Cinema", "9.99"),
          ("15/12/2021", "Phone", "199.9"), ("16/12/2021", "Cable", "5")]


def ledger(spark):
    df = spark.createDataFrame(LEDGER, "Date string, Description string, Amount string")
    return df.select(F.try_to_date("Date", "dd/MM/yyyy").alias("date"), "Description",
                     T.decimal_comma_number("Amount", "decimal(18,2)").alias("amount"))


def test_monthly_report(spark):
    r = [tuple(x) for x in A.monthly_report(ledger(spark), "date", "amount").collect()]
    assert r == [("2021-12", Decimal("204.90")), ("2022-03", Decimal("509.99")),
                 ("2023-01", Decimal("14.90")), ("2023-02", Decimal("60.00"))]


def test_top_n_with_tie_breaker(spark):
    df = ledger(spark)
    r = [(x.Description, x.amount) for x in O.top_n(df, "amount", 4, ["Description"]).collect()]
    assert r == [("Rent", Decimal("500.00")), ("Phone", Decimal("199.90")),
                 ("Books", Decimal("30.00")), ("Gift", Decimal("30.00"))]


def test_sentinel_fill(spark):
    prices = [1, 2, -1, 4, 5, -1, 7]
    df = spark.createDataFrame([(i, float(p)) for i, p in enumerate(prices)], "d int, price double")
    for strategy in ("halo", "window"):
        kw = {"ranges": 6} if strategy == "halo" else {"strategy": "window"}
        out = W.fill_sentinel_with_previous_mean(df.withColumn("s", F.lit(1)), "price", ["d"], -1, 5,
                                                 partition_by="s", **kw)
        assert [r.price for r in out.orderBy("d").collect()] == [1, 2, 1.5, 4, 5, 3, 7]
    lead = spark.createDataFrame([(0, -1.0), (1, 2.0)], "d int, price double")
    out = W.fill_sentinel_with_previous_mean(lead, "price", ["d"])
    assert [r.price for r in out.orderBy("d").collect()] == [None, 2.0]


def test_free_text_record(spark):
    df = spark.createDataFrame([("18/05/2024 Dinner at restaurant 45,88",), ("31/02/2024 x 5",),
                                ("18/05/2024 45",)], "line string")
    r = df.select(T.parse_record("line").alias("r")).select("r.*").collect()
    assert tuple(r[0]) == (True, dt.date(2024, 5, 18), "Dinner at restaurant", Decimal("45.88"))
    assert not r[1].ok and r[1].date is None
    assert not r[2].ok


def test_whole_year_age(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2023, 2, 28)),
                                (dt.date(2000, 2, 29), dt.date(2024, 2, 29))], "b date, e date")
    assert [r.a for r in df.select(whole_years(F.col("b"), F.col("e")).alias("a")).collect()] == [22, 24]


def test_word_count(spark):
    df = spark.createDataFrame([("",), ("a  b",), ("a b ",)], "t string")
    assert [r.n for r in df.select(T.word_count("t").alias("n")).collect()] == [1, 3, 3]
    assert [r.n for r in df.select(T.word_count("t", skip_empty=True).alias("n")).collect()] == [0, 2, 2]


def test_masking(spark):
    df = spark.createDataFrame([("MEDICO", "secret"), ("Medico", "x"), ("infermiere", "y")], "role string, v string")
    out = P.mask_column(df, "v", F.col("role"), ["medico"])
    assert [r.v for r in out.collect()] == ["secret", "x", "*" * 11]


def test_capitalize_and_currency(spark):
    df = spark.createDataFrame([("tHREE", "Â£51.77"), ("one", "£x")], "r string, p string")
    r = df.select(T.capitalize("r").alias("r"), T.currency_to_double("p").alias("p")).collect()
    assert (r[0].r, r[0].p) == ("Three", 51.77)
    assert (r[1].r, r[1].p) == ("One", None)


def test_page_total(spark):
    df = spark.createDataFrame([("Page 1 of 50",), ("  Page 1 of 7 ",), (None,), ("Page x",)], "t string")
    assert [r.n for r in df.select(T.page_total("t").alias("n")).collect()] == [50, 7, 1, 1]
