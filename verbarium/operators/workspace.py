"""User workspace: notes, bookmarks, soft deletes and synchronisation; keyed by plain ids, apart from the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows with those of the same key replaced by incoming ones. Keys are unique on either side."""
    return current.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)


def last_write_wins(local: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Per key the row with the larger version; a tie keeps the local row. A null version is older than any.

    It is one aggregate with map-side combining, whatever the number of versions of a key.
    """
    both = local.withColumn("_l", F.lit(1)).unionByName(incoming.withColumn("_l", F.lit(0)))
    rest = [c for c in local.columns if c != key]
    order = F.struct(F.col(version).isNotNull(), F.col(version), F.col("_l"))
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*").select(*local.columns)


def apply_tombstones(rows: DataFrame, tombstones: DataFrame, key: str, revision: str) -> DataFrame:
    """Rows that no tombstone of a later revision deletes; ``tombstones``: key and ``deleted_rev``."""
    t = tombstones.groupBy(key).agg(F.max("deleted_rev").alias("_d"))
    return rows.join(t, key, "left").filter(F.col("_d").isNull() | (F.col("_d") <= F.col(revision))).drop("_d")


def toggles(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Bookmark state after a log of toggles: deleted after an even number, and the number is the sync version."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("sync_version"), *[F.max(o).alias(o) for o in order]).withColumn("is_deleted", F.col("sync_version") % 2 == 0)


def sync_package(rows: DataFrame, since: int, version: str) -> DataFrame:
    """Rows changed after a version, deleted ones included."""
    return rows.filter(F.col(version) > since)


def favourites(rows: DataFrame, created: str, key: str, k: int) -> DataFrame:
    """The ``k`` newest, ties by key."""
    return rows.orderBy(F.desc(created), key).limit(k)
