"""Company names: display form and matching key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import GENERIC_NAME_KEYS, KEY_SUFFIX_REWRITES, SUFFIX_DISPLAY
from ledgerloom.functions.text import collapse, is_blank, or_null


def _title(x: Column) -> Column:
    """Title case that restarts after every character that is no letter."""
    runs = F.regexp_extract_all(x, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**31 - 1)))), "")


def display_name(x: Column) -> Column:
    """Blanks collapsed, names all in capitals in title case, legal suffixes in one form."""
    plain = F.when(~is_blank(x), or_null(collapse(x)))
    # the plain name is looked at several times and made once, in the outer function's array
    name = F.transform(F.array(plain), lambda n: F.when((F.upper(n) == n) & (F.lower(n) != n), _title(n)).otherwise(n))[0]
    # a dot after pvt or ltd belongs to it only if a word follows at once
    name = F.regexp_replace(name, r"(?iU)\b(pvt|ltd)\.(?=\w)", "$1\u0001")
    for words, shown in SUFFIX_DISPLAY.items():
        name = F.regexp_replace(name, rf"(?iU)\b{words}\b", shown)
    return F.regexp_replace(name, "\u0001", "")


def name_key(x: Column) -> Column:
    """The key names are matched on: lower case, no punctuation, legal suffixes spelled out."""
    key = F.regexp_replace(F.lower(x), "&", " and ")
    key = collapse(F.regexp_replace(F.regexp_replace(key, r"[.\-_/,]", " "), "[^a-z0-9 ]", " "))
    for pattern, word in KEY_SUFFIX_REWRITES:
        key = F.regexp_replace(key, pattern, word)
    key = F.regexp_replace(key, r"\bpvt\b", "private")
    return F.when(~is_blank(x), or_null(collapse(key)))


def is_generic_key(key: Column) -> Column:
    return key.isNull() | (F.length(key) < 4) | key.isin(*GENERIC_NAME_KEYS)
