"""Strings: strip and blank tests that treat Unicode blanks as Python does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import NULL_TOKENS

#: Unicode blanks; Spark's trim knows only the space.
BLANK = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{BLANK}+|{BLANK}+$", "")


def collapse(x: Column) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(x, f"{BLANK}+", " "))


def is_blank(x: Column) -> Column:
    """Null, or one of the no-value words."""
    return x.isNull() | F.lower(strip(x)).isin(*NULL_TOKENS)


def or_null(x: Column) -> Column:
    """The empty string becomes null."""
    return F.when(x != "", x)
