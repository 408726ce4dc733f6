"""Lookups in a table of unique keys that no hot key can stall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than this part of the looked-up rows: at most so many keys can be hot.
HOT_PARTS = 1000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with ``table``, whose ``keys`` are unique and whose ``count`` says how many rows each meets.

    Keys that more than ``total / HOT_PARTS`` rows share are at most ``HOT_PARTS``, whatever the data, so they
    are broadcast and their rows never shuffled; the others meet by a shuffle without hot keys.
    """
    hot = F.broadcast(table.filter(F.col(count) * HOT_PARTS > total).drop(count))
    cold = table.filter(F.col(count) * HOT_PARTS <= total).drop(count)
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(cold, keys, how))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all cores before costly work per row, where a small table has fewer partitions than there are cores."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
