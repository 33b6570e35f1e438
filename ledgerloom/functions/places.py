"""States and cities in one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import CITY_ALIASES, SMALL_WORDS, STATE_ALIASES
from ledgerloom.functions.text import collapse, is_blank, or_null


def _alias(x: Column, names: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(w) for pair in names.items() for w in pair)), x), x)


def title_place(x: Column) -> Column:
    """Words capitalized, but for small ones that aren't first."""

    def one(w: Column, i: Column) -> Column:
        return F.when((i > 0) & w.isin(*SMALL_WORDS), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**31 - 1))))

    return F.array_join(F.transform(F.split(x, " "), one), " ")


def state(x: Column) -> Column:
    key = F.regexp_replace(collapse(F.regexp_replace(F.lower(x), r"\.", "")), " & ", " and ")
    return F.when(~is_blank(x), title_place(_alias(key, STATE_ALIASES)))


def city(x: Column) -> Column:
    key = or_null(collapse(F.regexp_replace(collapse(F.lower(x)), "[^a-z ]", " ")))
    return F.when(~is_blank(x), title_place(_alias(key, CITY_ALIASES)))
