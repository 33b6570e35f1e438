"""Phones, registration numbers, flags and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import CIN_PATTERN
from ledgerloom.functions.text import BLANK, collapse, is_blank, or_null, strip

def phone(x: Column) -> Column:
    """+91 and ten digits that begin with 6 to 9, or null. Of longer numbers the last ten digits count."""
    digits = F.regexp_replace(F.regexp_replace(x, r"\D", ""), r"^0+(?=\d{10})", "")
    digits = F.when((F.length(digits) > 10) & digits.startswith("91"), F.substring(digits, 3, 2**31 - 1)).otherwise(digits)
    last = F.substring(digits, -10, 10)
    return F.when(~is_blank(x) & (F.length(digits) >= 10) & last.rlike("^[6-9]"), F.concat(F.lit("+91"), last))


def cin(x: Column) -> Column:
    """A registration number in upper case without blanks, or null where it isn't well formed."""
    clean = F.upper(F.regexp_replace(x, f"{BLANK}+", ""))
    return F.when(~is_blank(x) & clean.rlike(CIN_PATTERN), clean)


def flag(x: Column) -> Column:
    """Whether a text says yes; null is no."""
    return F.coalesce(F.lower(strip(x)).isin("true", "1", "yes", "y", "t"), F.lit(False))


def source_id(x: Column) -> Column:
    """Stripped, or null where nothing is left. No-value words stay: they are ids."""
    return or_null(strip(x))


def label(x: Column) -> Column:
    """Industry, sector, stage, role, status: blanks collapsed, no-value words to null."""
    return F.when(~is_blank(x), or_null(collapse(x)))


def registration_date(x: Column, epoch_ms: Column) -> Column:
    """An ISO date from a text in one of four forms (day before month where both may be), else from epoch milliseconds."""
    text = F.when(~is_blank(x), strip(x))
    parsed = [F.try_to_date(F.when(text.rlike(form), text), pattern) for form, pattern in ((r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"))]
    ms = F.when(~is_blank(epoch_ms), strip(epoch_ms)).try_cast("double")
    in_range = F.when(F.abs(ms) < 2.5e14, ms)
    return F.date_format(F.coalesce(*parsed, F.to_date(F.timestamp_millis(in_range.cast("bigint")))), "yyyy-MM-dd")
