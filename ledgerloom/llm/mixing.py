"""Mixtures of sources with target shares of the tokens.

The size of a mixture is cut into blocks of equal tokens. Blocks go to sources one after the
other to the highest quotient weight / (2 * blocks so far + 1) (Sainte-Lague), a source that
has reached its repeats dropping out; the same rule splits a source's blocks over its shards.
In a shard, documents in seeded order form blocks, which are taken in whole rounds, and the
rest by lot.
"""

from __future__ import annotations

import base64
import heapq
import importlib.util
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCKS = 1000
SHARD_TOKENS = 20_000_000


def count_tokens(documents: DataFrame, key: str, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) of every document under a public byte-pair vocabulary; null texts have none."""
    spec = importlib.util.spec_from_file_location("public_tokenizers", f"{folder}/__init__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with open(f"{folder}/{vocabulary}", "rb") as f:
        sent = documents.sparkSession.sparkContext.broadcast((f.read(), module.PATTERN))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        data, pattern = sent.value
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}
        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            yield pd.DataFrame({"key": b.key, "n_tokens": [len(coder.encode_ordinary(t)) if t else 0 for t in b.text]})

    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInPandas(count, f"key {kind}, n_tokens long").withColumnRenamed("key", key)


def apportion(votes: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 * seats so far + 1), none above its cap; seats that no cap allows stay free. Ties go to the earlier.

    The quotients of the seats given lie above one number, which halving finds, so any number of seats takes a few steps: all but the last few
    are given at once, and those one by one.
    """
    live = [i for i, v in enumerate(votes) if v > 0 and caps[i] > 0]
    got = [0] * len(votes)
    if not live or seats <= 0:
        return got
    seats = min(seats, sum(caps[i] for i in live))
    low, high = 0.0, max(votes[i] for i in live) * 2
    for _ in range(200):
        mid = (low + high) / 2
        # seats whose quotient is above mid
        if sum(min(caps[i], max(0, math.floor((votes[i] / mid + 1) / 2))) for i in live) > seats if mid else True:
            low = mid
        else:
            high = mid
    for i in live:
        got[i] = min(caps[i], max(0, math.floor((votes[i] / high + 1) / 2) - 1))
    heap = [(-votes[i] / (2 * got[i] + 1), i) for i in live if got[i] < caps[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(got)):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def plan_mix(sizes: DataFrame, targets: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """A row for each plan and source: tokens at hand, target and most tokens, blocks, and the share reached.

    ``sizes``: (source, n_tokens). A source without documents has 0 tokens. A null weight counts as 0 and null repeats as 1; repeated
    targets of one plan and source count once, by the highest weight. ``short`` tells that the cap on repeats costs a source quota: at blocks of one
    token, the finest there are, it gets fewer than it would get without caps.
    """
    wanted = targets.where("plan_id is not null and source is not null").groupBy("plan_id", "source").agg(F.coalesce(F.max("target_weight"), F.lit(0.0)).alias("weight"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("repeats"))
    rows = wanted.join(sizes, "source", "left").select("plan_id", "source", "weight", F.col("repeats").cast("long").alias("repeats"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    schema = "plan_id long, source string, weight double, repeats long, n_tokens long, total long, target_tokens double, most_tokens long, short boolean, blocks long, block_tokens double, share double"

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("source").reset_index(drop=True)
        total = int(p.n_tokens.sum())
        size = total / blocks
        most = [int(n) * int(r) for n, r in zip(p.n_tokens, p.repeats)]
        caps = [int(m // size) if size else 0 for m in most]
        got = apportion(list(p.weight), blocks, caps)
        whole = sum(got)
        free, capped = (apportion(list(p.weight), total, c) for c in ([total] * len(most), [min(m, total) for m in most]))
        return p.assign(total=total, target_tokens=p.weight * total, most_tokens=most, short=[c < f for c, f in zip(capped, free)], blocks=got, block_tokens=size, share=[g / whole if whole else 0.0 for g in got])

    return rows.groupBy("plan_id").applyInPandas(one, schema)


def draw_mix(counted: DataFrame, plan: DataFrame, key: str, seed: int = 20_240) -> DataFrame:
    """(plan_id, source, key, n_tokens, times): how often each document stands in each plan's mixture; documents left out have no row.

    ``counted``: (key, source, n_tokens). Shards are as many as a source's tokens need, so that no task sorts a whole source.
    """
    spark = counted.sparkSession
    total = counted.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_TOKENS))
    rows = counted.where("n_tokens > 0").withColumn("h", F.xxhash64(F.lit(seed), key)).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    by_shard = rows.groupBy("source", "shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    split = plan.where("blocks > 0").select("plan_id", "source", "blocks", "block_tokens", "repeats").join(by_shard, "source")

    def quota(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("shard").reset_index(drop=True)
        size = p.block_tokens[0]
        caps = [max(1, int(t * r // size + 1)) for t, r in zip(p.shard_tokens, p.repeats)]
        return p.assign(quota=apportion([float(t) for t in p.shard_tokens], int(p.blocks[0]), caps))[["plan_id", "source", "shard", "quota", "block_tokens", "repeats", "shard_tokens"]]

    quotas = split.groupBy("plan_id", "source").applyInPandas(quota, "plan_id long, source string, shard int, quota long, block_tokens double, repeats long, shard_tokens long")
    met = rows.join(quotas, ["source", "shard"])
    order = Window.partitionBy("plan_id", "source", "shard").orderBy("h", key)
    met = met.withColumn("start", F.sum("n_tokens").over(order) - F.col("n_tokens"))
    # the blocks of the shard are taken round by round; the last round takes the blocks from a seeded one on
    in_shard = F.greatest(F.lit(1), F.ceil(F.col("shard_tokens") / F.col("block_tokens")))
    block = F.floor(F.col("start") / F.col("block_tokens"))
    turn = F.pmod(F.xxhash64(F.lit(seed), "plan_id", "source", "shard"), in_shard)
    rounds = F.floor(F.col("quota") / in_shard)
    rest = F.col("quota") - rounds * in_shard
    times = F.least(F.col("repeats"), rounds + F.when(F.pmod(block - turn, in_shard) < rest, 1).otherwise(0))
    return met.select("plan_id", "source", key, "n_tokens", times.cast("long").alias("times")).where("times > 0")


def mix_sources(documents: DataFrame, targets: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The plan of ``plan_mix`` and the draw of ``draw_mix`` for documents (doc_id, source, text).

    Documents of a source that no plan names, and null sources, belong to no mixture. Repeated doc_ids are documents each.
    """
    from ledgerloom.session import Kept

    kept = Kept(documents.sparkSession)
    rows = documents.where("source is not null").select(F.struct("doc_id", "source").alias("k"), "text")
    counted = count_tokens(rows, "k", "text", folder, vocabulary).select("k.doc_id", "k.source", "n_tokens")
    counted = kept.keep(counted, "counted")
    plan = kept.keep(plan_mix(counted.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")), targets, blocks), "plan")
    return plan, draw_mix(counted, plan, "doc_id")
