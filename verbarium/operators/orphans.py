"""References to records that do not exist: missing, deleted, or recorded later than the reference.

Parent and child keys are put in one long form and grouped by (parent table, key). Each group is reduced by
a partial aggregate to a handful of numbers, whatever its size, and the groups whose parents cannot serve all
their children are kept; child rows meet only those, without shuffling the rows of hot keys. Counts by period
are sums over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from verbarium.lineage import cut
from verbarium.operators.lookup import lookup

_PARENT = ["parent_table", "key", "born_us", "alive"]
_CHILD = ["ref_table", "ref_id", "ref_field", "parent_table", "key", "at_us"]


def clean_key(key: Column) -> Column:
    """Keys compare trimmed (any white space) and in lower case."""
    return F.lower(F.regexp_replace(key, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def parent_keys(df: DataFrame, table: Column, key: Column, born_us: Column, deleted: Column | None = None) -> DataFrame:
    """Long-form rows of a parent table. ``born_us``: when recorded, in microseconds; ``deleted``: non-null if deleted."""
    alive = F.lit(True) if deleted is None else deleted.isNull()
    return df.select(table.alias("parent_table"), clean_key(key).alias("key"), born_us.cast("long").alias("born_us"), alive.alias("alive")).filter("key is not null")


def child_refs(df: DataFrame, ref_table: str, ref_id: Column, ref_field: str, parent: Column, key: Column, at_us: Column) -> DataFrame:
    """Long-form rows of one reference column; null keys are no references."""
    return df.select(
        F.lit(ref_table).alias("ref_table"), ref_id.cast("string").alias("ref_id"), F.lit(ref_field).alias("ref_field"),
        parent.alias("parent_table"), clean_key(key).alias("key"), at_us.cast("long").alias("at_us"),
    ).filter("key is not null")


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for df in rest:
        first = first.unionByName(df)
    return first


def orphan_references(parents: Iterable[DataFrame], children: Iterable[DataFrame]) -> DataFrame:
    """Distinct orphan references ``(ref_table, ref_id, ref_field, target_id, at_us, reason)``.

    ``reason`` is the first that holds: ``missing`` (no parent row has the key), ``deleted`` (all its rows are
    deleted), ``late`` (its earliest row was recorded after the reference). A null time is never late; a null
    parent table has no parents, so its references are missing. Repeated rows come out once. Empty children
    give no rows, empty parents make every reference missing.
    """
    # null parent tables match nothing; as a value of their own they still group
    refs = _union(children).withColumn("parent_table", F.coalesce("parent_table", F.lit("\0")))
    owners = _union(parents).filter("parent_table is not null")
    long = owners.select(
        "parent_table", "key", F.lit(1).alias("is_parent"), F.col("alive").cast("int").alias("alive"), "born_us", F.lit(None).cast("long").alias("at_us")
    ).unionByName(refs.select("parent_table", "key", F.lit(0).alias("is_parent"), F.lit(0).alias("alive"), F.lit(None).cast("long").alias("born_us"), "at_us"))
    seen = Observation()
    groups = cut(
        long.groupBy("parent_table", "key")
        .agg(F.max("is_parent").alias("has_parent"), F.max("alive").alias("alive"), F.min("born_us").alias("born_us"), F.min("at_us").alias("first_us"), F.count_if(F.col("is_parent") == 0).alias("n"))
        .observe(seen, F.sum("n").alias("n"))
        .filter("n > 0 and (has_parent = 0 or alive = 0 or born_us > first_us)")
        .select(
            "parent_table", "key", "n",
            F.when(F.col("has_parent") == 0, "missing").when(F.col("alive") == 0, "deleted").otherwise("late").alias("reason"),
            F.when((F.col("has_parent") == 1) & (F.col("alive") == 1), F.col("born_us")).alias("late_after_us"),
        )
    )
    hit = lookup(refs, groups, ["parent_table", "key"], "n", seen.get["n"] or 0).filter("late_after_us is null or at_us < late_after_us")
    return hit.select("ref_table", "ref_id", "ref_field", F.col("key").alias("target_id"), "at_us", "reason").distinct()


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphan references per table, field, month (UTC) of the reference and reason; null times have a null month."""
    month = F.date_format(F.timestamp_micros("at_us"), "yyyy-MM")
    return orphans.groupBy("ref_table", "ref_field", month.alias("month"), "reason").agg(F.count(F.lit(1)).alias("n_orphans"))


def lexical_orphans(edges: DataFrame, pronunciations: DataFrame, relation_claims: DataFrame, entities: DataFrame, claims: DataFrame) -> DataFrame:
    """:func:`orphan_references` for edges and pronunciations against entities, and relation_claims against claims."""
    sec = lambda c: F.col(c) * 1_000_000
    claim_us = F.unix_micros(F.try_to_timestamp("extracted_at"))
    parents = [
        parent_keys(entities, F.col("entity_type"), F.col("resolved_id"), sec("created_at"), F.col("deleted_at")),
        parent_keys(claims, F.lit("claim"), F.col("id"), claim_us),
    ]
    children = [
        child_refs(edges, "edges", F.col("id"), "source_id", F.col("source_type"), F.col("source_id"), sec("created_at")),
        child_refs(edges, "edges", F.col("id"), "target_id", F.col("target_type"), F.col("target_id"), sec("created_at")),
        child_refs(pronunciations, "pronunciations", F.col("id"), "target_id", F.col("target_type"), F.col("target_id"), sec("created_at")),
        child_refs(relation_claims, "relation_claims", F.col("relation_id"), "claim_id", F.lit("claim"), F.col("claim_id"), sec("created_at")),
    ]
    return orphan_references(parents, children)
