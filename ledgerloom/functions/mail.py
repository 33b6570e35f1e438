"""E-mail addresses and the answers of mail servers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import DISPOSABLE_DOMAINS, EMAIL_PATTERN


def valid_syntax(x: Column) -> Column:
    """Whether an address is well formed and not too long; null is not."""
    return F.coalesce(x.rlike(f"^{EMAIL_PATTERN}$") & (F.length(x) <= 254), F.lit(False))


def host(x: Column) -> Column:
    """The part behind the first @, in lower case."""
    return F.lower(F.get(F.split(x, "@", 2), F.lit(1)))


def is_disposable(x: Column) -> Column:
    return F.coalesce(F.lower(x).isin(*DISPOSABLE_DOMAINS), F.lit(False))


def tokens(x: Column) -> Column:
    """The words of an address' local part, without digits at its end."""
    return F.split(F.regexp_replace(F.lower(F.substring_index(x, "@", 1)), "[0-9]+$", ""), r"[._\-]+")


def accepted(code: Column) -> Column:
    """Whether a server's answer takes the recipient; no answer, and any other, does not."""
    return F.coalesce(code.isin(250, 251), F.lit(False))
