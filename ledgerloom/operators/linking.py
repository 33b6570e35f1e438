"""Records linked on equal keys, and the clusters the links make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.names import is_generic_key
from ledgerloom.functions.urls import is_generic_domain
from ledgerloom.operators.skew import join_by_key
from ledgerloom.session import Kept

#: A domain with so many names or registration numbers is a directory, not a company's own.
SHARED_NAMES, SHARED_CINS = 4, 2
MAX_ROUNDS = 60


def shared_domains(records: DataFrame) -> DataFrame:
    """(domain, n_names, n_cins) of hosts that clearly belong to many companies."""
    own = records.where(F.col("domain").isNotNull() & ~is_generic_domain(F.col("domain")))
    counts = own.groupBy("domain").agg(F.count_distinct("name_key").alias("n_names"), F.count_distinct("cin").alias("n_cins"))
    return counts.where((F.col("n_names") >= SHARED_NAMES) | (F.col("n_cins") >= SHARED_CINS))


def link_keys(records: DataFrame) -> DataFrame:
    """(row_idx, kind, key) for each key a record links on; the state beside a name may be null and then equals null."""
    usable = records.join(shared_domains(records).select("domain", F.lit(True).alias("shared")), "domain", "left")
    usable = usable.withColumn("usable", F.col("domain").isNotNull() & ~is_generic_domain(F.col("domain")) & F.col("shared").isNull())
    keys = F.array(
        F.struct(F.lit("startup_india_id").alias("kind"), F.col("startup_india_id").alias("key")),
        F.struct(F.lit("cin").alias("kind"), F.col("cin").alias("key")),
        F.struct(F.lit("domain").alias("kind"), F.when(F.col("usable"), F.col("domain")).alias("key")),
        F.struct(F.lit("website").alias("kind"), F.when(F.col("usable"), F.col("website")).alias("key")),
        F.struct(F.lit("name+state").alias("kind"), F.when(~is_generic_key(F.col("name_key")), F.concat_ws("\u0001", "name_key", F.coalesce("state", F.lit("\u0002")))).alias("key")),
    )
    return usable.select("row_idx", F.explode(keys).alias("k")).select("row_idx", "k.kind", "k.key").where("key is not null")


def link_counts(records: DataFrame) -> DataFrame:
    """(kind, links): how many records beyond the first share a key, by kind."""
    buckets = link_keys(records).groupBy("kind", "key").agg((F.count("*") - 1).alias("n"))
    return buckets.groupBy("kind").agg(F.sum("n").alias("links"))


def star_links(keys: DataFrame) -> DataFrame:
    """(u, v), v the first record under each key: one link a record instead of all pairs."""
    kept = Kept(keys.sparkSession)
    keys = kept.keep(keys.select("row_idx", F.concat_ws("\u0001", "kind", "key").alias("id")), "keys")
    hubs = keys.groupBy("id").agg(F.min("row_idx").alias("v"), F.count("*").alias("n_rows")).where("n_rows > 1")
    return join_by_key(keys, hubs, "id").where("row_idx <> v").select(F.col("row_idx").alias("u"), "v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(row_idx, cluster) of every record with a link, by large and small stars in turn; the cluster is its smallest record. Each round writes two tables."""
    kept = Kept(links.sparkSession)
    links = kept.keep(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    digest = F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))
    before = links.agg(*digest).first()
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            return links.select(F.col("u").alias("row_idx"), F.col("v").alias("cluster"))
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n_rows"))
        large = join_by_key(both, least, "u", total=2 * before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = kept.keep(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n_rows"))
        joined = join_by_key(large, least, "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        links = kept.keep(small, "links")
        now = links.agg(*digest).first()
        if now == before:
            tops = links.select(F.col("v").alias("row_idx"), F.col("v").alias("cluster"))
            return links.select(F.col("u").alias("row_idx"), F.col("v").alias("cluster")).unionByName(tops).distinct()
        before = now
    raise RuntimeError(f"clusters did not settle in {MAX_ROUNDS} rounds")


def clusters(records: DataFrame) -> DataFrame:
    """(row_idx, cluster) of every record; a record without link is its own cluster."""
    found = components(star_links(link_keys(records)))
    return records.select("row_idx").join(found, "row_idx", "left").select("row_idx", F.coalesce("cluster", "row_idx").alias("cluster"))


def cluster_stats(records: DataFrame, found: DataFrame) -> DataFrame:
    """One row: records, clusters, records removed, largest cluster, shared domains."""
    sizes = found.groupBy("cluster").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("total_records"), F.count("*").alias("unique_companies"), (F.sum("n") - F.count("*")).alias("duplicates_removed"), F.max("n").alias("largest_cluster"))
    return total.crossJoin(shared_domains(records).agg(F.count("*").alias("shared_domains")))
