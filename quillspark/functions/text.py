"""Normal forms of text and codes, and tests on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Answers that stand for "could not be read", and the pattern of an Indian tax number.
PLACEHOLDERS = [
    "n/a", "na", "none", "null", "unknown", "not visible", "not legible", "illegible", "xxx", "xxxx", "-",
    "--", "?", "??", "tbd", "abc", "test", "string", "example", "sample", "0000", "123456",
]
TAX_NUMBER = "^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][0-9A-Z]{3}$"
#: The first date that recent paperwork can bear, and how many days it may be ahead.
FIRST_DATE, DAYS_AHEAD = "2015-01-01", 2


def norm_text(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits, parted by single spaces; empty for null."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def norm_code(text: Column) -> Column:
    """Lower-case ASCII letters and digits alone; empty for null."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def texts_match(a: Column, b: Column) -> Column:
    """Whether two texts have one normal form, or one contains the other and has five characters at least."""
    x, y = norm_text(a), norm_text(b)
    inside = (F.contains(x, y) | F.contains(y, x)) & (F.least(F.length(x), F.length(y)) >= 5)
    return (x != "") & (y != "") & ((x == y) | inside)


def is_placeholder(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(PLACEHOLDERS), F.lit(False))


def is_recent_date(text: Column, as_of: Column) -> Column:
    """Whether text is YYYY-MM-DD, a day of the calendar, from 2015 on and at most two days after as_of."""
    day = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))
    return F.coalesce(day.between(F.lit(FIRST_DATE).cast("date"), F.date_add(as_of, DAYS_AHEAD)), F.lit(False))


def is_tax_number(text: Column) -> Column:
    return F.coalesce(F.upper(F.trim(text)).rlike(TAX_NUMBER), F.lit(False))
