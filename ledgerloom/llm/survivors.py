"""The surviving value of a field in each group of duplicate rows, by token-level consensus.

The values of a group are token sequences. They are aligned progressively, the weightiest
first, into a profile of columns; tokens vote in their column with their value's weight.
The consensus is the row of winning tokens, and the existing value nearest to it survives.
Groups are cut into chunks whose profiles are aligned with each other in further rounds,
so no task ever holds a large group.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.records import cin, phone
from ledgerloom.functions.text import is_blank
from ledgerloom.functions.urls import website
from ledgerloom.operators.skew import join_by_key
from ledgerloom.session import Kept

#: Values, or profiles, that one task aligns at a time.
CHUNK = 200
#: Columns that count for how complete a row is.
FILLED = ("startup_india_id", "name", "website", "domain", "industry", "sector", "stage", "city", "state", "registration_date", "cin", "status", "phone", "role")
DUMMIES = ("1234567890", "9876543210", "0123456789", "8765432109", "7654321098", "6789012345", "7890123456")


def usable_website(x: Column) -> Column:
    """The comparable form of a website with a real host name, else null."""
    site = website(x)
    host = F.regexp_extract(site, "^https://([^/]+)", 1)
    return F.when(~host.rlike(r"^(?:localhost|example|test|invalid|website|domain|yourdomain|yoursite)(?:\.|$)"), site)


def usable_phone(x: Column) -> Column:
    """The comparable form of a complete mobile number that is no dummy, else null."""
    number = phone(x)
    digits = F.substring(number, 4, 10)
    return F.when(~digits.rlike(r"^(\d)\1{7,}") & ~digits.rlike(r"(\d)\1{8}") & ~digits.isin(*DUMMIES), number)


def tokens(value: str, field: str) -> list[str]:
    """Digits of a phone; labels of a host from the right, then the path."""
    if field == "phone":
        return list(value[-10:])
    host, _, path = value.removeprefix("https://").partition("/")
    return [*reversed(host.split(".")), *([f"/{path}"] if path else [])]


Profile = list[dict[str, float]]


def align(a: Profile, b: Profile) -> Profile:
    """One profile of two, by the alignment with the greatest agreement; a gap votes for no token."""
    wa, wb = (max((sum(c.values()) for c in p), default=0.0) for p in (a, b))
    n, m = len(a), len(b)
    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    norm = max(wa * wb, 1e-12)
    match = [[sum(v * y.get(t, 0.0) for t, v in x.items()) / norm for y in b] for x in a]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            score[i][j] = max(score[i - 1][j - 1] + match[i - 1][j - 1] - 0.01, score[i - 1][j] - 0.1, score[i][j - 1] - 0.1)
    out: Profile = []
    i, j = n, m
    while i or j:
        if i and j and score[i][j] == score[i - 1][j - 1] + match[i - 1][j - 1] - 0.01:
            i, j = i - 1, j - 1
            column = dict(a[i])
            for t, v in b[j].items():
                column[t] = column.get(t, 0.0) + v
        elif i and (not j or score[i][j] == score[i - 1][j] - 0.1 or j == 0):
            i -= 1
            column = dict(a[i]) | {"": a[i].get("", 0.0) + wb}
        else:
            j -= 1
            column = dict(b[j]) | {"": b[j].get("", 0.0) + wa}
        out.append(column)
    return out[::-1]


def merge(profiles: list[Profile]) -> Profile:
    weight = lambda p: max((sum(c.values()) for c in p), default=0.0)
    ordered = sorted(profiles, key=lambda p: (-weight(p), json.dumps(p, sort_keys=True)))
    whole = ordered[0]
    for p in ordered[1:]:
        whole = align(whole, p)
    return whole


def consensus(profile: Profile) -> list[str]:
    return [t for c in profile if c and (t := min(c, key=lambda t: (-c[t], t)))]


def distance(a: list[str], b: list[str]) -> float:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return float(row[-1])


def _profiles(values: DataFrame, kept: Kept) -> DataFrame:
    """(g, field, profile) of the (g, field, value, weight) given."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [json.dumps(merge([[{t: x["weight"]} for t in tokens(x["value"], f)] for x in xs])) for f, xs in zip(b.field, b.parts)]
            yield pd.DataFrame({"g": b.g, "field": b.field, "profile": out})

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"g": b.g, "field": b.field, "profile": [json.dumps(merge([json.loads(p) for p in xs])) for xs in b.parts]})

    sizes = values.groupBy("g", "field").agg(F.count("*").alias("n_values"))
    most = sizes.agg(F.max("n_values")).first()[0] or 0
    part = F.struct("value", "weight")
    if most <= CHUNK:  # each group in one chunk
        return values.groupBy("g", "field").agg(F.collect_list(part).alias("parts")).mapInPandas(first, "g long, field string, profile string")
    big = sizes.where(F.col("n_values") > CHUNK)
    key = F.xxhash64("g", "field")
    marked = values.withColumn("k", key).join(F.broadcast(big.select(key.alias("k"), "n_values")) if big.count() <= 10_000 else big.select(key.alias("k"), "n_values"), "k", "left")
    chunk = F.pmod(F.xxhash64("value"), F.ceil(F.coalesce("n_values", F.lit(1)) / (CHUNK / 2)))
    grouped = marked.withColumn("chunk", chunk).groupBy("g", "field", "chunk").agg(F.collect_list(part).alias("parts"))
    profiles = kept.keep(grouped.mapInPandas(first, "g long, field string, profile string"), "profiles")
    while most > 1:
        most = -(-most // (CHUNK // 2))
        counts = profiles.groupBy("g", "field").agg(F.count("*").alias("n_values"))
        left = counts.agg(F.max("n_values")).first()[0] or 0
        if left <= 1:
            break
        marked = profiles.join(counts, ["g", "field"])
        chunk = F.pmod(F.xxhash64("profile"), F.ceil(F.col("n_values") / (CHUNK / 2)))
        grouped = marked.withColumn("chunk", chunk).groupBy("g", "field", "chunk").agg(F.collect_list("profile").alias("parts"))
        profiles = kept.keep(grouped.mapInPandas(again, "g long, field string, profile string"), "profiles")
    return profiles


def choose_survivors(companies: DataFrame) -> DataFrame:
    """(cin, field, id, value): for each group of two or more rows with one valid cin, the row whose website and whose phone survive.

    Only usable values compete. A row behind no competing row in filled fields, updated_at and duplicate_count outvotes all
    others together; without such a row each row has one vote. The value nearest to the consensus survives; of values equally
    near the one of the lowest id does, and of rows with that value the more complete, the more often confirmed, the later and
    then the lower id. A group without usable value gives no row; null ids and invalid cins take no part; repeated
    rows vote again but change no winner.
    """
    kept = Kept(companies.sparkSession)
    filled = sum((F.when(is_blank(F.col(c).cast("string")), 0).otherwise(1) for c in FILLED), F.lit(0))
    rows = companies.select("id", cin(F.col("cin")).alias("cin"), filled.alias("filled"), F.coalesce(F.col("updated_at").cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("updated"), F.coalesce("duplicate_count", F.lit(0)).alias("copies"), usable_website(F.col("website")).alias("website"), usable_phone(F.col("phone")).alias("phone"))
    rows = kept.keep(rows.where("id is not null and cin is not null").withColumn("g", F.xxhash64("cin")), "rows")
    groups = rows.groupBy("g").agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("ids")).where("ids > 1").drop("ids")
    rows = join_by_key(rows, groups, "g")
    long = rows.select("g", "cin", "id", "filled", "updated", "copies", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("website", "phone")))).alias("f"))
    long = kept.keep(long.select("g", "cin", "id", "filled", "updated", "copies", "f.field", "f.value").where("value is not null").withColumn("k", F.xxhash64("g", "field")), "long")
    tops = long.groupBy("k").agg(F.max("filled").alias("top_filled"), F.max("updated").alias("top_updated"), F.max("copies").alias("top_copies"), F.count("*").alias("n_rows"), F.count("*").alias("votes"))
    voted = join_by_key(long, tops, "k")
    first = (F.col("filled") == F.col("top_filled")) & (F.col("updated") == F.col("top_updated")) & (F.col("copies") == F.col("top_copies"))
    best = F.max(F.struct(first.alias("first"), "filled", "copies", "updated", (-F.col("id")).alias("id")))
    values = voted.groupBy("g", "cin", "field", "value").agg(best.alias("best"), F.min("id").alias("least"), F.count("*").alias("n"), F.max("votes").alias("votes"))
    values = values.select("g", "cin", "field", "value", "best", "least", (F.col("n") + F.when(F.col("best.first"), F.col("votes")).otherwise(0)).cast("double").alias("weight"))
    values = kept.keep(values, "values")
    profiles = _profiles(values, kept)
    counts = values.groupBy("g", "field").agg(F.count("*").alias("n_rows")).withColumn("k", F.xxhash64("g", "field"))
    joined = join_by_key(values.withColumn("k", F.xxhash64("g", "field")), profiles.withColumn("k", F.xxhash64("g", "field")).join(counts.select("k", "n_rows"), "k").select("k", "profile", "n_rows"), "k")

    def far(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            memo: dict[str, list[str]] = {}
            d = []
            for f, v, p in zip(b.field, b.value, b.profile):
                if p not in memo:
                    memo[p] = consensus(json.loads(p))
                d.append(distance(tokens(v, f), memo[p]))
            yield pd.DataFrame({"cin": b.cin, "field": b.field, "value": b.value, "d": d, "least": b.least, "minus": b.minus})

    flat = joined.select("cin", "field", "value", "profile", "least", F.col("best.id").alias("minus"))
    scored = flat.mapInPandas(far, "cin string, field string, value string, d double, least long, minus long")
    won = scored.groupBy("cin", "field").agg(F.min(F.struct("d", "least", "minus", "value")).alias("w"))
    return won.select("cin", "field", (-F.col("w.minus")).alias("id"), F.col("w.value").alias("value"))
