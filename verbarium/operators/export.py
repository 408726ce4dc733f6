"""Compiling and exporting: snapshots, slices, manifests, interchange records, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(tables: dict[str, tuple[DataFrame, list[str]]], root: str, checks: DataFrame | None = None) -> str:
    """Writes tables sorted by their keys into a new snapshot folder and points ``root/CURRENT`` at it.

    Nothing is published if ``checks`` (a gate report) has a failed gate: that raises and leaves the pointer
    as it was. Readers of an older snapshot are not disturbed.
    """
    if checks is not None:
        failed = [r.gate for r in checks.filter(~F.col("passed")).select("gate").limit(1000).collect()]
        if failed:
            raise ValueError(f"gates failed: {', '.join(sorted(failed))}")
    snapshot = f"{root}/snapshot-{uuid.uuid4().hex}"
    for name, (df, keys) in tables.items():
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(f"{snapshot}/{name}.parquet")
    spark = next(iter(tables.values()))[0].sparkSession
    jvm = spark.sparkContext._jvm
    paths = jvm.org.apache.hadoop.fs.Path
    beside, path = paths(f"{snapshot}/CURRENT"), paths(f"{root}/CURRENT")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = files.create(beside, True)
    out.write(bytearray(snapshot.encode()))
    out.close()
    # written beside and renamed, so that no reader meets a pointer half written
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri() if path.toUri().getScheme() else files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(path), options)
    return snapshot


def current(spark: SparkSession, root: str) -> str:
    """The folder of the published snapshot."""
    return spark.read.text(f"{root}/CURRENT").first()[0]


def closed_slice(lemmas: DataFrame, lexemes: DataFrame, edges: DataFrame) -> DataFrame:
    """The closed sub-graph of ``lemmas (lemma)``: edges with both ends among their lexemes and these lexemes' forms."""
    roots = lexemes.withColumn("_k", F.lower("lemma")).join(lemmas.select(F.lower("lemma").alias("_k")), "_k", "left_semi").select(F.col("lexeme_id").alias("node_id"))
    has = edges.filter("relation_type = 'HAS_FORM'").join(roots.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").select(F.col("target_id").alias("node_id"))
    ids = roots.unionByName(has).distinct()
    return edges.join(ids.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")


def ontolex(lexemes: DataFrame, forms: DataFrame, part: int = 1000) -> DataFrame:
    """``(lexeme_id, part_no, json)``: JSON-LD entries of lexemes with their canonical and all other forms.

    A lexeme has one entry; one of more than ``part`` forms has ceil(forms / ``part``), each with a hash slice of
    about that many forms, numbered from 1. ``lexemes``: ``lexeme_id, lemma, pos``; ``forms``: ``lexeme_id, form_id, surface``.
    """
    own = forms.select("lexeme_id", "form_id", "surface").distinct()
    many = own.groupBy("lexeme_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > part)
    part_no = F.pmod(F.xxhash64("form_id"), F.coalesce(F.ceil(F.col("_n") / part), F.lit(1))) + 1
    per = own.join(many, "lexeme_id", "left").groupBy("lexeme_id", part_no.alias("part_no")).agg(F.array_sort(F.collect_list(F.struct(F.col("form_id").alias("@id"), F.col("surface").alias("writtenRep")))).alias("lexicalForm"))
    entry = F.struct(
        F.col("lexeme_id").alias("@id"), F.lit("ontolex:LexicalEntry").alias("@type"), F.col("pos").alias("partOfSpeech"),
        F.struct(F.col("lemma").alias("writtenRep")).alias("canonicalForm"), F.coalesce("lexicalForm", F.array()).alias("lexicalForm"),
    )
    return lexemes.join(per, "lexeme_id", "left").select("lexeme_id", F.coalesce("part_no", F.lit(1)).alias("part_no"), F.to_json(entry).alias("json"))


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """``(name, n)``: row counts of all tables in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def content_hash(rows: DataFrame, columns: list[str]) -> Column:
    """An order-independent digest of a table's rows, for manifests (as an aggregate)."""
    return F.bit_xor(F.xxhash64(F.to_json(F.struct(*columns))))


def markdown(report: DataFrame) -> str:
    """A gate report, which has a row per gate, as a table."""
    rows = report.orderBy("gate").collect()
    return "\n".join(["| gate | violations | passed |", "|---|---|---|", *[f"| {r.gate} | {r.violations} | {'yes' if r.passed else 'no'} |" for r in rows]])
