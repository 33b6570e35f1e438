"""Joins of rows to one value per key where some keys hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 2_000


def join_by_key(rows: DataFrame, per_key: DataFrame, key: str, n: str = "n_rows", total: int | None = None) -> DataFrame:
    """Inner join of ``rows`` to ``per_key`` (one row a key, ``n`` = the key's
    number of rows in ``rows``; the column is dropped).

    A key with more than total / HOT_KEYS rows is hot. There are fewer than
    HOT_KEYS such keys whatever the data, so their side is broadcast and the
    hot rows are never shuffled; all other keys meet in a shuffled join.
    """
    total = rows.count() if total is None else total
    limit = max(50_000, total // HOT_KEYS)
    if total <= limit:
        return rows.join(per_key.drop(n), key)
    hot = per_key.where(F.col(n) > limit)
    hot_rows = rows.join(F.broadcast(hot.drop(n)), key)
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(per_key.where(F.col(n) <= limit).drop(n), key)
    return hot_rows.unionByName(cold_rows)
