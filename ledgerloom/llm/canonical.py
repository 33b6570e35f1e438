"""Freely typed values to the entries of a reference list.

Entries and their aliases are paths of a trie of letters. A typed value is cut into
parts, and each part is run as a Levenshtein automaton (edits and transpositions of
neighbours) along the trie, which returns all entries within a distance that depends
on the part's length. The region of the row decides between entries.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.dictionaries import CITY_ALIASES, STATE_ALIASES
from ledgerloom.functions.text import is_blank
from ledgerloom.operators.skew import join_by_key
from ledgerloom.session import Kept

#: Entries that one trie holds; a longer list is searched block by block.
BLOCK_ENTRIES = 50_000
#: Public short codes beside those of the list.
OTHER_CODES = {"OR": "Odisha", "UA": "Uttarakhand", "UT": "Uttarakhand", "TG": "Telangana", "CT": "Chhattisgarh", "JK": "Jammu and Kashmir"}
#: Words around a place that name no place.
NOISE = {"city", "dist", "district", "distt", "town", "urban", "rural", "state", "st", "of", "india", "bharat", "in", "tehsil", "taluk", "ut", "the"}


def limit(n: int) -> int:
    """The distance allowed for a part of n letters."""
    return 0 if n < 3 else 1 if n < 5 else 2 if n < 8 else 3


def letters(text: str) -> str:
    folded = unicodedata.normalize("NFKD", text.casefold())
    return "".join(c for c in folded if c.isalpha())


class Trie:
    """Paths of letters to entries. An automaton's state on a path is the row of
    distances of all prefixes of the pattern, clipped above the limit."""

    def __init__(self, words: Iterable[tuple[str, object]]):
        self.root: dict = {}
        self.exact: dict[str, set] = {}
        self.longest = 0
        for word, entry in words:
            if word:
                self.longest = max(self.longest, len(word))
                self.exact.setdefault(word, set()).add(entry)
                node = self.root
                for c in word:
                    node = node.setdefault(c, {})
                node.setdefault("", set()).add(entry)

    def search(self, pattern: str, k: int) -> dict[object, int]:
        """Entries within k edits of the pattern, each with its distance."""
        if pattern in self.exact and k == 0:
            return dict.fromkeys(self.exact[pattern], 0)
        if len(pattern) > self.longest + k:
            return {}
        found: dict[object, int] = {}
        n, far = len(pattern), k + 1
        # a state: the distances of the pattern's beginnings whose length is within k of the path's; all others are above k
        stack = [(self.root, 0, [min(i, far) for i in range(n + 1)], None, "")]
        while stack:
            node, depth, row, before, last = stack.pop()
            depth += 1
            low, high = max(1, depth - k), min(n, depth + k)
            for c, child in node.items():
                if c == "":
                    if row[n] <= k:
                        for entry in child:
                            found[entry] = min(found.get(entry, far), row[n])
                    continue
                now = [far] * (n + 1)
                if depth <= k:
                    now[0] = depth
                least = now[0]
                for i in range(low, high + 1):
                    p = pattern[i - 1]
                    if p == c:
                        d = row[i - 1]
                    else:
                        d = row[i - 1]
                        if row[i] < d:
                            d = row[i]
                        if now[i - 1] < d:
                            d = now[i - 1]
                        d += 1
                    if before is not None and i > 1 and p == last and pattern[i - 2] == c and before[i - 2] + 1 < d:
                        d = before[i - 2] + 1
                    if d < least:
                        least = d
                    now[i] = d if d < far else far
                if least <= k:
                    stack.append((child, depth, now, row, c))
        return found


def short_forms(name: str) -> set[str]:
    """Abbreviations of a name of several words: W Bengal, Uttar P, Uttar Pr, Uttar Prdsh."""
    words = [w for w in name.casefold().split() if w not in ("and", "of", "the")]
    if len(words) < 2:
        return set()
    first, rest = words[0], words[1:]
    ends = {rest[-1][:1], rest[-1][:2], rest[-1][:3], rest[-1][0] + re.sub("[aeiou]", "", rest[-1][1:])}
    return {first[0] + "".join(rest)} | {"".join([first, *rest[:-1], e]) for e in ends} | {"".join(words)}


def parts_of(value: str) -> list[list[str]]:
    """The parts of a typed value as lists of words, without numbers and words that name no place."""
    text = unicodedata.normalize("NFKC", value).casefold().replace("&", " and ")
    parts = []
    for part in re.split(r"[,/()\[\]|;:\n]+|\s[-–—]+\s|(?<=\D)-(?=\d)", text):
        words = [w for w in re.split(r"[\W\d_]+", part) if w]
        parts.append(words)
    return [w for w in parts if w]


def spellings(words: list[str]) -> list[str]:
    """Readings of one part: whole, and without words that name no place."""
    bare = [w for w in words if w not in NOISE]
    return [x for x in dict.fromkeys(("".join(words), "".join(bare))) if x]


class Places:
    """Tries of cities and states, and what a typed value may mean."""

    def __init__(self, cities: list[tuple[int, str, int, list[str]]], states: list[tuple[int, str, str, list[str]]]):
        by_name = {name: i for i, name, _, _ in states}
        self.codes = {code.casefold(): i for i, _, code, _ in states if code}
        for code, name in OTHER_CODES.items():
            if name in by_name:
                self.codes.setdefault(code.casefold(), by_name[name])
        other_state = {}
        for alias, name in STATE_ALIASES.items():
            other_state.setdefault(name, []).append(alias)
        other_city = {}
        for alias, name in CITY_ALIASES.items():
            other_city.setdefault(name, []).append(alias)
        named, short = [], {}
        for i, name, _, alt in states:
            for x in (name, *alt, *other_state.get(name.casefold(), ())):
                words = letters(x)
                named.append((words, i))
                named.append((letters(" ".join(w for w in x.casefold().split() if w not in NOISE)), i))
                named.append((letters(x.casefold().replace(" and ", " ")), i))
                for s in short_forms(x):
                    short.setdefault(letters(s), i)
        self.states, self.short = Trie(named), short
        self.region = {i: r for i, _, r, _ in cities}
        self.cities = Trie((letters(x), i) for i, name, _, alt in cities for x in (name, *alt, *other_city.get(name.casefold(), ())))

    def state_of(self, word: str) -> dict[int, int]:
        if word in self.codes:
            return {self.codes[word]: 0}
        if word in self.states.exact:
            return dict.fromkeys(self.states.exact[word], 0)
        if word in self.short:
            return {self.short[word]: 0}
        return self.states.search(word, limit(len(word)))

    def city_of(self, word: str) -> dict[int, int]:
        if word in self.cities.exact:
            return dict.fromkeys(self.cities.exact[word], 0)
        return self.cities.search(word, limit(len(word)))

    def state(self, value: str) -> int:
        """The state meant, or 0. The closest part counts; a tie between states is 0."""
        best: dict[int, int] = {}
        for words in parts_of(value):
            for word in spellings(words):
                for i, d in self.state_of(word).items():
                    best[i] = min(best.get(i, 99), d)
        least = min(best.values(), default=99)
        nearest = [i for i, d in best.items() if d == least]
        return nearest[0] if len(nearest) == 1 else 0

    def city(self, value: str) -> tuple[list[tuple[int, int, int, int]], int]:
        """(city, region, distance, slack left) of each city that may be meant, and the state named beside it."""
        found: dict[int, tuple[int, int]] = {}
        hint = 0
        for words in parts_of(value):
            readings = spellings(words)
            tail = 0
            for n in (1, 2, 3):
                if len(words) > n and (s := self._tail("".join(words[-n:]))):
                    readings += spellings(words[:-n])
                    tail = tail or s
            cities: dict[int, tuple[int, int]] = {}
            states: dict[int, int] = {}
            for at, word in enumerate(readings):
                for i, d in self.city_of(word).items():
                    if i not in cities or d < cities[i][0]:
                        cities[i] = (d, limit(len(word)) - d)
                if at < 2:
                    for i, d in self.state_of(word).items():
                        states[i] = min(states.get(i, 99), d)
            nearest = min((d for d, _ in cities.values()), default=99)
            if states and min(states.values()) < nearest:
                hint = hint or (min(states, key=states.get) if min(states.values()) == 0 else 0)
                continue
            if cities and tail:
                hint = hint or tail
            for i, x in cities.items():
                if i not in found or x < found[i]:
                    found[i] = x
        return [(i, self.region[i], d, slack) for i, (d, slack) in found.items()], hint

    def _tail(self, word: str) -> int:
        if word in self.codes:
            return self.codes[word]
        return next(iter(self.states.exact.get(word, {0})))


def _spread(values: DataFrame) -> DataFrame:
    """Small rows with much work each, over all cores."""
    return values.repartition(4 * values.sparkSession.sparkContext.defaultParallelism)


def _blocks(cities: DataFrame) -> int:
    return max(1, -(-cities.count() // BLOCK_ENTRIES))


def _match_cities(values: DataFrame, cities: DataFrame, states: list[tuple]) -> DataFrame:
    """(value, meant: array of candidates, hint) of distinct ``value``s; blocks of a long list are searched one after the other."""
    schema = "value string, meant array<struct<entry:bigint,region:bigint,d:int,slack:int>>, hint bigint"
    n, found = _blocks(cities), None
    for k in range(n):
        block = cities if n == 1 else cities.where(F.pmod(F.xxhash64("city_id"), F.lit(n)) == k)
        rows = [(r.city_id, r.city, r.state_id, list(r.alt_names or [])) for r in block.toLocalIterator()]
        places = values.sparkSession.sparkContext.broadcast((rows, states))

        def search(batches: Iterator[pd.DataFrame], places=places) -> Iterator[pd.DataFrame]:
            own = Places(*places.value)
            for b in batches:
                hits = [own.city(v) for v in b.value]
                yield pd.DataFrame({"value": b.value, "meant": [[{"entry": i, "region": r, "d": d, "slack": s} for i, r, d, s in h] for h, _ in hits], "hint": [h for _, h in hits]})

        part = _spread(values).mapInPandas(search, schema)
        found = part if found is None else found.unionByName(part)
    if n > 1:
        found = found.groupBy("value").agg(F.flatten(F.collect_list("meant")).alias("meant"), F.max("hint").alias("hint"))
    return found


def _match_states(values: DataFrame, states: list[tuple]) -> DataFrame:
    places = values.sparkSession.sparkContext.broadcast(states)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Places([], places.value)
        for b in batches:
            yield pd.DataFrame({"value": b.value, "state_id": [own.state(v) for v in b.value]})

    return _spread(values).mapInPandas(search, "value string, state_id bigint")


def _pick(meant: Column, region: Column) -> Column:
    """The candidate with the fewest edits, another region counting as one edit
    more that the allowed distance must cover; 0 where several stay."""
    cost = F.transform(meant, lambda m: F.struct((m.d + F.when((region != 0) & (region != m.region), 1).otherwise(0)).alias("cost"), m.d.alias("d"), m.slack.alias("slack"), m.entry.alias("entry")))
    fit = F.filter(cost, lambda m: (m.d == 0) | (m.cost - m.d <= m.slack))
    best = F.array_min(F.transform(fit, lambda m: F.struct(m.cost.alias("cost"), m.d.alias("d"))))
    left = F.array_distinct(F.transform(F.filter(fit, lambda m: (m.cost == best.cost) & (m.d == best.d)), lambda m: m.entry))
    return F.when(F.size(left) == 1, left[0]).otherwise(F.lit(0).cast("bigint"))


def map_places(companies: DataFrame, ref_cities: DataFrame, ref_states: DataFrame) -> DataFrame:
    """(id, field, ref_id): for each city and state of ``companies`` that is a value and
    not byte for byte an entry, the entry it means, or 0.

    Null, blank and no-value words give no row, nor do null ids. Where cities share a
    name, or a spelling lies near several, the row's state decides, else a state named in
    the city, else the state letters of the cin; a tie that stays is 0. Values are matched
    once each, however many rows have them. The list of states is small by nature and
    checked; the list of cities may be long and is searched in blocks.
    """
    kept = Kept(companies.sparkSession)
    if (n := ref_states.count()) > BLOCK_ENTRIES:
        raise ValueError(f"{n} regions; a list of regions has at most {BLOCK_ENTRIES}")
    states = [(r.state_id, r.state, r.short_code, list(r.alt_names or [])) for r in ref_states.toLocalIterator()]
    rows = companies.select("id", "city", "state", "cin").where("id is not null")
    code = F.upper(F.substring(F.regexp_replace("cin", r"\s+", ""), 7, 2))
    codes = {code.upper(): i for code, i in Places([], states).codes.items()}
    by_code = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair)) if codes else F.create_map(F.lit(""), F.lit(0))
    rows = rows.select("id", F.when(~is_blank(F.col("city")), F.col("city")).alias("city"), F.when(~is_blank(F.col("state")), F.col("state")).alias("state"), F.coalesce(F.element_at(by_code, code), F.lit(0)).cast("bigint").alias("by_cin"))

    def counted(field: str) -> DataFrame:
        return kept.keep(rows.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n_rows")), field)

    values = counted("state")
    by_state = kept.keep(_match_states(values.select("value"), states).join(values, "value"), "by_state")
    found = join_by_key(rows.where("state is not null").select("id", F.col("state").alias("value")), by_state, "value")
    exact = F.broadcast(ref_states.select(F.col("state").alias("value")).where("value is not null").distinct())
    state_rows = found.join(exact, "value", "left_anti").select("id", F.lit("state").alias("field"), F.col("state_id").alias("ref_id"))

    values = counted("city")
    by_city = kept.keep(_match_cities(values.select("value"), ref_cities, states).join(values, "value"), "by_city")
    in_row = rows.where("city is not null").select("id", F.col("city").alias("value"), "state", "by_cin")
    named = ref_cities.select(F.col("city").alias("value")).where("value is not null").distinct()
    in_row = in_row.join(named, "value", "left_anti")
    with_state = join_by_key(in_row.where("state is not null").withColumnRenamed("value", "city").withColumnRenamed("state", "value"), by_state, "value").select("id", F.col("city").alias("value"), "state_id", "by_cin")
    without = in_row.where("state is null").select("id", "value", F.lit(0).cast("bigint").alias("state_id"), "by_cin")
    joined = join_by_key(with_state.unionByName(without), by_city, "value")
    region = F.when(F.col("state_id") != 0, F.col("state_id")).when(F.col("hint") != 0, F.col("hint")).otherwise(F.col("by_cin"))
    city_rows = joined.select("id", F.lit("city").alias("field"), _pick(F.col("meant"), region).alias("ref_id"))
    return city_rows.unionByName(state_rows)
