"""Websites and hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.dictionaries import GENERIC_DOMAINS, HOST_PATTERN
from ledgerloom.functions.text import BLANK, is_blank, or_null

SCHEME = r"^(?i)[a-z][a-z0-9+.\-]*://"


def is_host(x: Column) -> Column:
    return x.rlike(HOST_PATTERN)


def _bare_host(x: Column) -> Column:
    """Before the first colon, after the last @, without www."""
    x = F.lower(F.substring_index(x, "@", -1))
    return F.regexp_replace(F.substring_index(x, ":", 1), r"^www\.", "")


def website(x: Column) -> Column:
    """https://host/path without slashes at the end, or null where there is no valid host."""
    rest = F.regexp_replace(x, f"{BLANK}+", "")
    rest = F.regexp_replace(F.regexp_replace(rest, SCHEME, ""), r"^/+|/+$", "")
    host = F.regexp_replace(_bare_host(F.substring_index(rest, "/", 1)), r"^\.+|\.+$", "")
    path = F.when(F.instr(rest, "/") > 0, F.regexp_replace(F.regexp_replace(rest, "^[^/]*", ""), "/+$", "")).otherwise("")
    return F.when(~is_blank(x) & is_host(host), F.concat(F.lit("https://"), host, path))


def domain(x: Column) -> Column:
    """The bare host of a website; unlike ``website`` it keeps dots and slashes before the host."""
    rest = F.regexp_replace(F.regexp_replace(x, f"{BLANK}+", ""), SCHEME, "")
    host = F.regexp_replace(_bare_host(F.substring_index(rest, "/", 1)), r"\.+$", "")
    return F.when(~is_blank(x) & is_host(host), host)


def is_generic_domain(x: Column) -> Column:
    """Whether a host, or one it is a sub-domain of, is shared by many companies."""
    labels = F.split(x, r"\.")
    n = F.size(labels)
    # membership in a set, so a host costs as many look-ups as it has labels
    return F.coalesce(F.exists(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".").isin(*GENERIC_DOMAINS)), F.lit(False))


def join(base: Column, href: Column) -> Column:
    """A link's address, relative to its page's; dot segments stay."""
    origin = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*", 0)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(bare == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(bare, "[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.substring_index(origin, "//", 1), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, href))
    )


def is_same_site(host: Column, root: Column) -> Column:
    return (host == root) | host.endswith(F.concat(F.lit("."), root))


def shard(x: Column) -> Column:
    """The folder of a host's stored pages."""
    return F.substring(F.sha1(x), 1, 2)


def safe_name(x: Column) -> Column:
    return or_null(F.regexp_replace(F.lower(x), r"[^a-z0-9.\-]", "_"))
