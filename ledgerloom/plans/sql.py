"""Normalization in the SQL dialect the queries are checked with; written apart from the column functions."""

from __future__ import annotations

from ledgerloom.dictionaries import CITY_ALIASES, GENERIC_DOMAINS, GENERIC_NAME_KEYS, KEY_SUFFIX_REWRITES, NULL_TOKENS, SMALL_WORDS, STATE_ALIASES, SUFFIX_DISPLAY


def words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR lower({strip(x)}) IN ({words(NULL_TOKENS)}))"


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def given(x: str, value: str) -> str:
    """The value, or null where x is blank or the value empty."""
    return f"CASE WHEN NOT {blank(x)} THEN nullif({value}, '') END"


HOST = r"([a-z0-9]([a-z0-9\-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}"


def _host(rest: str) -> str:
    return rf"regexp_replace(split_part(regexp_replace(lower(split_part({rest}, '/', 1)), '^.*@', ''), ':', 1), '^www\.', '')"


def _no_scheme(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\s+', '', 'g'), '^[A-Za-z][A-Za-z0-9+.\-]*://', '')"


def _valid(host: str, value: str, x: str) -> str:
    return f"CASE WHEN NOT {blank(x)} AND length({host}) BETWEEN 1 AND 253 AND regexp_full_match({host}, '{HOST}') THEN {value} END"


def website(x: str) -> str:
    rest = f"trim({_no_scheme(x)}, '/')"
    host = f"trim({_host(rest)}, '.')"
    path = f"rtrim(regexp_replace({rest}, '^[^/]*', ''), '/')"
    return _valid(host, f"'https://' || {host} || {path}", x)


def domain(x: str) -> str:
    host = f"rtrim({_host(_no_scheme(x))}, '.')"
    return _valid(host, host, x)


def generic(d: str) -> str:
    return f"({d} IS NOT NULL AND ({d} IN ({words(GENERIC_DOMAINS)}) OR list_bool_or(list_transform([{words(GENERIC_DOMAINS)}], lambda g: ends_with({d}, '.' || g)))))"


def phone(x: str) -> str:
    digits = rf"regexp_replace({x}, '[^0-9]', '', 'g')"
    bare = f"CASE WHEN length(ltrim({digits}, '0')) >= 10 THEN ltrim({digits}, '0') WHEN length({digits}) > 10 THEN right({digits}, 10) ELSE {digits} END"
    cut = f"CASE WHEN length({bare}) > 10 AND starts_with({bare}, '91') THEN substr({bare}, 3) ELSE {bare} END"
    return f"CASE WHEN NOT {blank(x)} AND length({cut}) >= 10 AND left(right({cut}, 10), 1) IN ('6', '7', '8', '9') THEN '+91' || right({cut}, 10) END"


def cin(x: str) -> str:
    clean = rf"upper(regexp_replace({x}, '\s+', '', 'g'))"
    return rf"CASE WHEN NOT {blank(x)} AND regexp_full_match({clean}, '[LU]\d{{5}}[A-Z]{{2}}\d{{4}}[A-Z]{{3}}\d{{6}}') THEN {clean} END"


def label(x: str) -> str:
    return given(x, collapse(x))


def _alias(x: str, names: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items())
    return f"CASE {x} {cases} ELSE {x} END"


def title_place(x: str) -> str:
    parts = f"string_split({x}, ' ')"
    one = f"CASE WHEN i > 1 AND w IN ({words(SMALL_WORDS)}) THEN w ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END"
    return f"array_to_string(list_transform({parts}, lambda w, i: {one}), ' ')"


def state(x: str) -> str:
    key = f"replace({collapse(f'replace(lower({x}), {chr(39)}.{chr(39)}, {chr(39)}{chr(39)})')}, ' & ', ' and ')"
    return f"CASE WHEN NOT {blank(x)} THEN {title_place(_alias(key, STATE_ALIASES))} END"


def city(x: str) -> str:
    inner = f"regexp_replace({collapse(f'lower({x})')}, '[^a-z ]', ' ', 'g')"
    key = f"nullif({collapse(inner)}, '')"
    return f"CASE WHEN NOT {blank(x)} THEN {title_place(_alias(key, CITY_ALIASES))} END"


def name_key(x: str) -> str:
    key = f"replace(lower({x}), '&', ' and ')"
    key = collapse(rf"regexp_replace(regexp_replace({key}, '[.\-_/,]', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g')")
    for pattern, word in KEY_SUFFIX_REWRITES:
        key = f"regexp_replace({key}, '{pattern}', '{word}', 'g')"
    key = rf"regexp_replace({key}, '\bpvt\b', 'private', 'g')"
    return given(x, collapse(key))


def generic_key(k: str) -> str:
    return f"({k} IS NULL OR length({k}) < 4 OR {k} IN ({words(GENERIC_NAME_KEYS)}))"


def flag(x: str) -> str:
    return f"coalesce(lower({strip(x)}) IN ('true', '1', 'yes', 'y', 't'), false)"


def registration_date(x: str, epoch: str) -> str:
    t = strip(x)
    forms = ((r"\d{1,2}-\d{1,2}-\d{4}", "%d-%m-%Y"), (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"), (r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"))
    tries = ", ".join(f"CASE WHEN NOT {blank(x)} AND regexp_full_match({t}, '{form}') THEN try_strptime({t}, '{pattern}') END" for form, pattern in forms)
    ms = f"CASE WHEN NOT {blank(epoch)} THEN try_cast({strip(epoch)} AS DOUBLE) END"
    return f"strftime(coalesce({tries}, CASE WHEN abs({ms}) < 2.5e14 THEN make_timestamp(CAST(trunc({ms}) AS BIGINT) * 1000) END), '%Y-%m-%d')"


def display_name(x: str) -> str:
    """The display form of a name; title case letter by letter."""
    name = label(x)
    chars = f"string_split({name}, '')"
    titled = rf"array_to_string(list_transform({chars}, lambda c, i: CASE WHEN i > 1 AND regexp_matches(({chars})[i - 1], '\p{{L}}') THEN lower(c) ELSE upper(c) END), '')"
    shown = f"CASE WHEN upper({name}) = {name} AND lower({name}) <> {name} THEN {titled} ELSE {name} END"
    shown = rf"regexp_replace({shown}, '(?i)\b(pvt|ltd)\.(\w)', '\1' || chr(1) || '\2', 'g')"
    for words_, form in SUFFIX_DISPLAY.items():
        shown = rf"regexp_replace({shown}, '(?i)\b{words_}\b', '{form}', 'g')"
    return f"replace({shown}, chr(1), '')"
