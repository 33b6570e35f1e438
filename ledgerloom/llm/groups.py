"""Pairwise matches to groups, by hash-to-min.

Every vertex holds a set of vertices as rows (v, u), at first its neighbours and
itself. In each round a vertex sends its whole set to the smallest member and the
smallest member to all others; what arrives is its next set. At the end a group's
smallest vertex holds the group and every other vertex holds that one vertex.
A set is never one value but rows, so no task or driver has to hold a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import is_blank, strip
from ledgerloom.operators.skew import join_by_key
from ledgerloom.session import Kept

MAX_ROUNDS = 60


def source_key(x: Column) -> Column:
    """A source id without blanks around it and letter case; null where it names nobody."""
    return F.when(~is_blank(x), F.lower(strip(x)))


def star_edges(pairs: DataFrame, vertex: str, key: str) -> DataFrame:
    """(v, u): each vertex and the smallest vertex that shares a key with it.

    One row per distinct pair instead of all pairs under a key; it links the same
    vertices. Rows without vertex or key link nothing.
    """
    pairs = pairs.select(F.col(vertex).alias("v"), F.col(key).alias("_key")).where("v is not null and _key is not null").distinct()
    pairs = Kept(pairs.sparkSession).keep(pairs, "pairs")  # read by the count, the hubs and the join
    hubs = pairs.groupBy("_key").agg(F.min("v").alias("u"), F.count("*").alias("n_rows")).where("n_rows > 1")
    return join_by_key(pairs, hubs, "_key").where("u < v").select("v", "u").distinct()


def hash_to_min(edges: DataFrame) -> DataFrame:
    """(v, group_id) for every vertex of ``edges`` (v, u bigint); group_id is the
    smallest vertex linked to it directly or over others.

    Repeated edges, either direction and self-edges are allowed; a null end makes
    the edge nothing. No edge, no row. Fails after MAX_ROUNDS rounds (a chain of
    2 ** MAX_ROUNDS vertices) rather than return half-joined groups.
    """
    spark = edges.sparkSession
    kept = Kept(spark)
    edges = edges.select("v", "u").where("v is not null and u is not null")
    start = edges.select(F.explode(F.array(*(F.struct(F.col(a).alias("v"), F.col(b).alias("u")) for a, b in ("vu", "uv", "vv", "uu")))).alias("e"))
    sets = kept.keep(start.select("e.v", "e.u").distinct(), "sets")
    before = None
    for _ in range(MAX_ROUNDS):
        now = sets.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.bit_xor(F.xxhash64("u", "v", F.lit(7))), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            # a set is {smallest} unless the vertex is the smallest itself
            return sets.groupBy("v").agg(F.min("u").alias("group_id"))
        least = kept.keep(sets.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n_rows")), "least")
        sent = join_by_key(sets, least, "v", total=now[0])
        # (m, u): the set goes to its smallest member; (u, m): that member goes to all
        sent = sent.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("e"))
        sets, before = kept.keep(sent.select("e.v", "e.u").distinct(), "sets"), now
    raise RuntimeError(f"groups did not settle in {MAX_ROUNDS} rounds")


def linked_groups(pairs: DataFrame, vertex: str = "company_id", key: str = "startup_india_id") -> DataFrame:
    """(vertex, group_id) of every vertex that shares a key with another one,
    directly or over others; group_id is the group's smallest vertex.

    Keys are compared by ``source_key``. Vertices alone give no row; null vertices
    are ignored; other columns of ``pairs`` don't matter.
    """
    keyed = pairs.select(F.col(vertex).alias(vertex), source_key(F.col(key)).alias("_source"))
    return hash_to_min(star_edges(keyed, vertex, "_source")).withColumnRenamed("v", vertex)
