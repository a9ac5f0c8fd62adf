"""Scalar text and number parsing (inventory F1-F13, F15, F16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Pattern of a free-text ledger record "DD/MM/YYYY description amount".
RECORD_PATTERN = r"(\d{2}/\d{2}/\d{4})\s+(.+?)\s+(\d+(?:[.,]\d{1,})?)$"
# Currency marks removed from prices (the mis-decoded pound sign first).
CURRENCY_MARKS = ("Â£", "£")


def is_blank(c) -> Column:
    """Empty after Python's ``str.strip()`` (any Unicode whitespace)."""
    return _c(c).rlike(r"(?U)^\s*$")


# F2
def decimal_comma_number(c, to: str = "double") -> Column:
    """``'45,88'`` -> 45.88: decimal comma to point, then a safe cast."""
    return F.replace(_c(c), F.lit(","), F.lit(".")).try_cast(to)


def valid_amount(c) -> Column:
    """Amount text parses as a finite number (decimal comma allowed); NaN and
    infinity are rejected."""
    v = decimal_comma_number(c)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))


# F3
def strip_thousands(c, to: str = "double") -> Column:
    """``'12,345.6'`` -> 12345.6."""
    return F.regexp_replace(_c(c), ",", "").try_cast(to)


# F4
def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to DATE with a pattern; text that is not a real date -> NULL."""
    return F.try_to_date(_c(c), fmt)


def valid_day_month_year(c) -> Column:
    """``d/m/yyyy`` text that names an existing day (1 or 2 digit day and
    month, four-digit year), as Python's ``strptime('%d/%m/%Y')`` accepts."""
    t = _c(c)
    return t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$") & F.try_to_date(t, "d/M/yyyy").isNotNull()


# F5
def year_month(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


# F1
def parse_record(c) -> Column:
    """Parse ``DD/MM/YYYY description amount`` into a struct
    ``(ok, date, description, amount)``. A line that does not match, names a
    day that does not exist, has a blank description or a bad amount gives
    ``ok = false`` and NULL fields."""
    t = _c(c)
    d = F.regexp_extract(t, RECORD_PATTERN, 1)
    desc = F.regexp_extract(t, RECORD_PATTERN, 2)
    amt = F.regexp_extract(t, RECORD_PATTERN, 3)
    matched = t.rlike(RECORD_PATTERN)
    date = F.try_to_date(d, "dd/MM/yyyy")
    ok = matched & date.isNotNull() & ~is_blank(desc) & valid_amount(amt)
    return F.struct(
        ok.alias("ok"),
        F.when(ok, date).alias("date"),
        F.when(ok, desc).alias("description"),
        F.when(ok, F.replace(amt, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")).alias("amount"),
    )


# F9
def word_count(c, skip_empty: bool = False) -> Column:
    """Words split on single spaces. Like the reference, ``''`` counts 1 and
    each extra space adds an empty word; ``skip_empty`` counts real words."""
    parts = F.split(_c(c), " ")
    if skip_empty:
        parts = F.filter(parts, lambda w: w != "")
    return F.size(parts)


# F11
def concat_with_space(a, b) -> Column:
    """``a || ' ' || b`` (NULL if either is NULL: fill first, as the reference does)."""
    return F.concat(_c(a), F.lit(" "), _c(b))


# F12
def currency_to_double(c) -> Column:
    """Price text with pound marks -> DOUBLE; unparseable text -> NULL
    (the missing value; pandas would use NaN)."""
    t = _c(c)
    for mark in CURRENCY_MARKS:
        t = F.replace(t, F.lit(mark), F.lit(""))
    return t.try_cast("double")


# F13
def capitalize(c) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    t = _c(c)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substr(t, F.lit(2))))


def strip(c) -> Column:
    """Python ``str.strip``: all white space at both ends."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


# F15
def page_total(c, default: int = 1) -> Column:
    """Last whitespace-separated token of the pager text ("Page 1 of 50")
    as an integer; missing or unparseable -> ``default``."""
    t = strip(c)
    last = F.element_at(F.split(t, r"(?U)\s+"), -1)
    return F.coalesce(last.try_cast("int"), F.lit(default))


# F16
def parse_measure(c) -> Column:
    """Clinical reading text -> struct(value, value2, unit): ``'120/80 mmHg'`` ->
    (120, 80, mmHg), ``'36.8'`` -> (36.8, NULL, NULL), ``'95 mg/dL'`` ->
    (95, NULL, mg/dL), text -> NULLs. The unit is all that follows the numbers."""
    number = r"([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    pattern = rf"^\s*{number}(?:\s*/\s*{number})?(?:\s*([^0-9\s./+-].*?))?\s*$"
    part = [F.regexp_extract(_c(c), pattern, i) for i in (1, 2, 3)]
    return F.struct(part[0].try_cast("double").alias("value"), part[1].try_cast("double").alias("value2"),
                    F.nullif(part[2], F.lit("")).alias("unit"))
