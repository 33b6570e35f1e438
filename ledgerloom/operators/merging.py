"""One company of each cluster of records, and tables kept by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import Kept

FIELDS = ("startup_india_id", "name", "website", "domain", "industry", "sector", "stage", "city", "state", "registration_date", "cin", "status", "phone", "role")


def merge_clusters(records: DataFrame, found: DataFrame) -> DataFrame:
    """One row a cluster: the fullest record's fields, gaps filled from the others in their order.

    Of equally full records one with a registration number, then one with recognition, then the first counts. The earliest
    date wins over the fullest record's. Every step is an aggregate with partial sums, so a cluster of any size needs no task
    of its own; its ids are rows of ``cluster_sources``.
    """
    full = sum((F.col(c).isNotNull().cast("int") for c in FIELDS), F.lit(0))
    rank = F.struct(full.alias("full"), F.col("cin").isNotNull().cast("int").alias("cin"), F.coalesce("dpiit", F.lit(False)).cast("int").alias("dpiit"), (-F.col("row_idx")).alias("first"))
    rows = records.join(found, "row_idx")
    best = [F.max_by(F.struct(F.col(c)), rank).getField(c).alias(f"best_{c}") for c in FIELDS]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row_idx"))).alias(f"first_{c}") for c in FIELDS]
    merged = rows.groupBy("cluster").agg(*best, *first, F.bool_or(F.coalesce("dpiit", F.lit(False))).alias("dpiit"), F.min("registration_date").alias("first_date"), F.count("startup_india_id").alias("source_count"), F.count("*").alias("duplicate_count"))
    fields = [F.coalesce(f"best_{c}", f"first_{c}").alias(c) for c in FIELDS if c != "registration_date"]
    return merged.select("cluster", *fields, F.col("first_date").alias("registration_date"), F.col("dpiit").alias("dpiit_certified"), "source_count", "duplicate_count")


def cluster_sources(records: DataFrame, found: DataFrame) -> DataFrame:
    """(cluster, startup_india_id) of each id a cluster's records have, once."""
    return records.where("startup_india_id is not null").select("row_idx", "startup_india_id").join(found, "row_idx").select("cluster", "startup_india_id").distinct()


def with_dense_ids(merged: DataFrame, after: int = 0) -> DataFrame:
    """``id`` from after + 1 on in the order of the clusters' first records; ids are dense, so two passes over the same written ranges count and place them."""
    spark = merged.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = Kept(spark).keep(merged.repartitionByRange(n, "cluster").withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    placed = ranged.join(F.broadcast(starts), "part")
    at = F.row_number().over(Window.partitionBy("part").orderBy("cluster"))
    return placed.withColumn("id", (at + F.col("start") + after).cast("long")).drop("part", "start")


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of each key, as an upsert in which the last wins leaves it."""
    columns = [c for c in rows.columns if c not in keys]
    kept = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("row"))
    return kept.select(*keys, *(F.col(f"row.{c}").alias(c) for c in columns))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones of the same key."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """New rows whose key is absent are added, the first of each key."""
    columns = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("row")).select(*keys, *(F.col(f"row.{c}").alias(c) for c in columns)) if columns else new.distinct()
    return old.unionByName(first.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def refresh(old: DataFrame, new: DataFrame, keys: list[str], full: bool = False) -> DataFrame:
    """Values made anew: those of keys that have none yet are added, or in full all are replaced."""
    return upsert(old, new, keys) if full else old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns))


def set_status(rows: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of single rows changed by key; rows without update stay."""
    marked = updates.select(key, *(F.col(c).alias(f"new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = rows.join(marked, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns))


def work_list(eligible: DataFrame, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Eligible rows whose key isn't done, by key; with a limit the first ones."""
    left = eligible.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return left if limit is None else left.orderBy(key).limit(limit)
