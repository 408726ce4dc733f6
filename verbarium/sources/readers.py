"""Readers of raw lexical sources, each with an explicit schema, and the claims they make."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.functions.ids import uuid5

OEWN = "lexicon struct<id string, label string, language string, entries array<struct<id string, lemma string, pos string, senses array<struct<id string, synset string>>>>, synsets array<struct<id string, pos string, definition string>>>"
OEWN_MAPS = (
    "synsets map<string, struct<partOfSpeech string, definition array<string>, lex_domain string, hypernyms array<string>, members array<string>>>, "
    "entries map<string, array<struct<partOfSpeech string, senses array<struct<id string, synset string, definition string, domain string, derivation array<struct<target_lemma string, target_pos string>>>>>>>"
)
KAIKKI = (
    "word string, pos string, lang string, lang_code string, sounds array<struct<ipa string>>, senses array<struct<glosses array<string>>>, "
    "forms array<struct<form string, tags array<string>>>, derived array<struct<word string>>"
)
UNIMORPH = "lemma string, surface string, features string"
SUBTLEX = "Word string, FREQcount long, CDcount long, SUBTLWF double, Lg10WF double, SUBTLCD double, Lg10CD double"
# Relation keys of the YAML form.
YAML_RELATIONS = ["hypernym", "instance_hypernym", "hyponym", "instance_hyponym", "similar", "also", "meronym", "holonym", "antonym", "entails"]


def read_oewn(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OEWN).json(path, multiLine=True)


def read_oewn_maps(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OEWN_MAPS).json(path, multiLine=True)


def read_kaikki(spark: SparkSession, path: str, strict: bool = False, english_only: bool = False) -> DataFrame:
    """JSON lines; a malformed line fails a strict read and is dropped otherwise. A missing language counts as English."""
    df = spark.read.schema(KAIKKI).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")
    if english_only:
        df = df.filter((F.coalesce("lang_code", F.when(F.col("lang").isNull(), "en")) == "en") | (F.col("lang") == "English"))
    return df.filter("word is not null and pos is not null")


def read_unimorph(spark: SparkSession, path: str, quotes: bool = False) -> DataFrame:
    """Tab-separated; ``#`` lines and rows without all three fields are skipped, fields trimmed."""
    df = spark.read.schema(UNIMORPH).csv(path, sep="\t", comment="#", quote='"' if quotes else "")
    return df.select(*[F.trim(c).alias(c) for c in df.columns]).filter("lemma is not null and surface is not null and features is not null")


def read_subtlex(spark: SparkSession, path: str) -> DataFrame:
    """Headed and tab-separated; columns are found by name, in any order."""
    names = spark.read.option("sep", "\t").option("header", True).csv(path)
    kinds = dict(x.split(" ") for x in SUBTLEX.split(", "))
    return names.select(*[(F.col(c).try_cast(t) if c in names.columns else F.lit(None).cast(t)).alias(c) for c, t in kinds.items()]).filter("Word is not null")


def read_oewn_yaml(spark: SparkSession, path: str) -> DataFrame:
    """``(key, is_synset, body)`` of a directory of YAML files; ``body`` is JSON. Keys like ``00001740-n`` are synsets."""
    files = spark.read.text(path, wholetext=True).select("value")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        import yaml

        for b in batches:
            rows = [(str(k), json.dumps(v, default=str)) for t in b["value"] for k, v in (yaml.safe_load(t) or {}).items()]
            yield pd.DataFrame(rows, columns=["key", "body"])

    return files.mapInPandas(parse, "key string, body string").withColumn("is_synset", F.col("key").rlike(r"^\d{8}-[a-z]$"))


def yaml_relations(parsed: DataFrame) -> DataFrame:
    """``(synset_id, relation_type, target_synset_id)`` of synset rows; targets that are no synset ids are left out."""
    pairs = F.array(*[F.struct(F.lit(r).alias("relation_type"), F.from_json(F.get_json_object("body", f"$.{r}"), "array<string>").alias("t")) for r in YAML_RELATIONS])
    rows = parsed.filter("is_synset").select(F.col("key").alias("synset_id"), F.inline(pairs))
    return rows.select("synset_id", "relation_type", F.explode("t").alias("target_synset_id")).filter(F.col("target_synset_id").rlike(r"^\d{8}-[a-z]$"))


def yaml_members(parsed: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """``(synset_id, relation_type, lemma, pos, definition)``: a MEMBER row per member of a synset and a SYNSET_DEF row per definition.

    ``members (lemma)`` keeps the MEMBER rows of those lemmas only. Synsets without either give no rows.
    """
    field = lambda f: F.get_json_object("body", f"$.{f}")
    syn = parsed.filter("is_synset").select(F.col("key").alias("synset_id"), field("partOfSpeech").alias("pos"), F.from_json(field("members"), "array<string>").alias("m"), F.from_json(field("definition"), "array<string>").alias("d"))
    none = F.lit(None).cast("string")
    own = syn.select("synset_id", F.lit("MEMBER").alias("relation_type"), F.explode("m").alias("lemma"), "pos", none.alias("definition"))
    own = own if members is None else own.join(members.select("lemma").distinct(), "lemma", "left_semi")
    told = syn.select("synset_id", F.lit("SYNSET_DEF").alias("relation_type"), none.alias("lemma"), "pos", F.explode("d").alias("definition"))
    return own.unionByName(told)


def oewn_map_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The map form as flat tables: synsets, senses, hypernym links, derivation links."""
    syn = df.select(F.explode("synsets").alias("synset_id", "s"))
    ent = df.select(F.explode("entries").alias("lemma", "e")).select("lemma", F.explode("e").alias("e")).select("lemma", "e.partOfSpeech", F.posexplode("e.senses").alias("rank", "s"))
    return {
        "synsets": syn.select("synset_id", F.col("s.partOfSpeech").alias("pos"), F.get("s.definition", F.lit(0)).alias("gloss"), F.col("s.lex_domain").alias("domain"), F.col("s.members").alias("members")),
        "hypernyms": syn.select("synset_id", F.explode("s.hypernyms").alias("target_synset_id")),
        "senses": ent.select("lemma", F.col("partOfSpeech").alias("pos"), (F.col("rank") + 1).alias("rank"), "s.id", "s.synset", "s.definition", "s.domain"),
        "derivations": ent.select("lemma", F.col("partOfSpeech").alias("pos"), F.explode("s.derivation").alias("d")).select("lemma", "pos", "d.target_lemma", "d.target_pos"),
    }


def _claim(source: str, key: Column, kind: str, subject: Column, predicate: str, body: Column) -> list[Column]:
    name = F.concat_ws("|", F.lit(source), key, F.lit(kind), subject, F.lit(predicate), body)
    return [uuid5(name).alias("id"), F.lit(source).alias("source"), key.alias("source_key"), F.lit(kind).alias("claim_type"), subject.alias("subject"), F.lit(predicate).alias("predicate"), body.alias("object_json")]


def oewn_claims(df: DataFrame, source: str = "OEWN_2025") -> DataFrame:
    """DEFINED_AS, HAS_POS and MEMBER_OF_SYNSET claims; ids follow from the contents."""
    syn = df.select(F.explode("lexicon.synsets").alias("s")).select("s.*")
    ent = df.select(F.explode("lexicon.entries").alias("e")).select("e.*")
    a = syn.select(*_claim(source, F.col("id"), "SYNSET", F.col("id"), "DEFINED_AS", F.to_json(F.struct("definition", "pos"))))
    b = ent.select(*_claim(source, F.col("id"), "LEXICAL_ENTRY", F.col("lemma"), "HAS_POS", F.to_json(F.struct("pos", F.col("id").alias("entry_id")))))
    c = ent.select("lemma", F.explode("senses").alias("s")).select(*_claim(source, F.col("s.id"), "SENSE_MEMBERSHIP", F.col("lemma"), "MEMBER_OF_SYNSET", F.to_json(F.struct(F.col("s.synset").alias("synset")))))
    return a.unionByName(b).unionByName(c).dropDuplicates(["id"])


def kaikki_claims(df: DataFrame, source: str = "WIKTIONARY_KAIKKI_20260805") -> DataFrame:
    body = F.to_json(F.struct("pos", "lang_code", "sounds", "senses"))
    return df.select(*_claim(source, F.concat_ws(":", "word", "pos"), "LEXICAL_RECORD", F.col("word"), "ATTESTED_AS", body)).dropDuplicates(["id"])


def unimorph_claims(df: DataFrame, source: str = "UNIMORPH_ENG") -> DataFrame:
    return df.select(*_claim(source, F.concat_ws(":", "lemma", "surface", "features"), "INFLECTION_RECORD", F.col("lemma"), "HAS_INFLECTION", F.to_json(F.struct("surface", "features")))).dropDuplicates(["id"])


def subtlex_claims(df: DataFrame, source: str = "SUBTLEX_US_R1") -> DataFrame:
    return df.select(*_claim(source, F.col("Word"), "USAGE_FREQUENCY", F.col("Word"), "HAS_FREQUENCY", F.to_json(F.struct(*df.columns)))).dropDuplicates(["id"])


def kaikki_forms(df: DataFrame) -> DataFrame:
    """``(word, pos, form, tags)``: inflected forms, those with spaces left out."""
    return df.select("word", "pos", F.explode("forms").alias("f")).filter(~F.col("f.form").contains(" ")).select("word", "pos", F.col("f.form").alias("form"), F.array_join("f.tags", ";").alias("tags"))


def kaikki_senses(df: DataFrame) -> DataFrame:
    """``(word, pos, rank, gloss)``: glosses joined per sense, ranked among those that have any."""
    glossed = F.filter(F.transform(F.col("senses"), lambda s: F.array_join(s["glosses"], "; ")), lambda g: g != "")
    return df.select("word", "pos", F.posexplode(glossed).alias("rank", "gloss")).withColumn("rank", F.col("rank") + 1)


def kaikki_derived(df: DataFrame) -> DataFrame:
    """``(derived, base)`` of single words."""
    return df.select(F.explode("derived.word").alias("derived"), F.col("word").alias("base")).filter("derived is not null and not contains(derived, ' ')")


def first_ipa(df: DataFrame) -> DataFrame:
    return df.select("word", "pos", F.get(F.filter("sounds.ipa", lambda x: x.isNotNull()), F.lit(0)).alias("ipa"))


def verify_manifest(spark: SparkSession, manifest: dict[str, tuple[str, str]]) -> DataFrame:
    """``(name, status)`` of ``{name: (path, sha256)}``: OK, MISSING, MISMATCH, or PLACEHOLDER for an ``EXPECTED`` hash.

    Files are hashed by the executors.
    """
    want = spark.createDataFrame([(n, p, s) for n, (p, s) in manifest.items()], "name string, path string, sha256 string")
    have = None
    for name, (path, _) in manifest.items():
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            one = spark.read.format("binaryFile").load(path).select(F.lit(name).alias("name"), F.sha2("content", 256).alias("found"), F.col("length").alias("bytes"))
            have = one if have is None else have.unionByName(one)
    have = have if have is not None else spark.createDataFrame([], "name string, found string, bytes long")
    state = F.when(F.col("found").isNull(), "MISSING").when(F.col("sha256").startswith("EXPECTED"), "PLACEHOLDER").when(F.col("found") == F.lower("sha256"), "OK").otherwise("MISMATCH")
    return want.join(have, "name", "left").select("name", state.alias("status"), "bytes")


def preflight(spark: SparkSession, expected: dict[str, tuple[str, int, int]]) -> DataFrame:
    """``(name, bytes, files, status)`` of ``{name: (path, least bytes, least files)}``: OK, MISSING, SMALL or FEW.

    Files are listed, not read; a folder counts with all below it.
    """
    rows = []
    for name, (path, least_bytes, least_files) in expected.items():
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(target):
            rows.append((name, 0, 0, "MISSING"))
            continue
        found = files.getContentSummary(target)
        size, n = found.getLength(), found.getFileCount()
        rows.append((name, size, n, "SMALL" if size < least_bytes else "FEW" if n < least_files else "OK"))
    return spark.createDataFrame(rows, "name string, bytes long, files long, status string")


def numbers(spark: SparkSession, n: int) -> DataFrame:
    """``(i)``: 0 to n - 1, for fixtures at scale."""
    return spark.range(n).withColumnRenamed("id", "i")


def scale_tree(spark: SparkSession, n: int, fan: int = 3) -> DataFrame:
    """``(child, parent)`` links of a tree of ``n`` nodes whose node i hangs on (i - 1) / fan."""
    i = F.col("i")
    return numbers(spark, n).filter("i > 0").select(F.concat(F.lit("n"), i).alias("child"), F.concat(F.lit("n"), F.floor((i - 1) / fan)).alias("parent"))
