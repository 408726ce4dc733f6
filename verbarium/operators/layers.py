"""Layers beside the core graph: translations, pronunciations, constructions, and the rules that keep them typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbarium.functions.ids import NS_DNS, uuid5


def translation_layer(pairs: DataFrame, lexemes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lexemes of another language and TRANSLATION_OF edges to them.

    ``pairs``: ``lemma, other_lemma, other_pos, epistemic_class``, distinct; every lexeme of that lemma gets an
    edge, so a homograph's pair should be UNCERTAIN. ``lexemes``: ``lexeme_id, lemma``. Pairs with a null end
    give nothing; a lemma without a lexeme gives an other lexeme and no edge.
    """
    p = pairs.select("lemma", "other_lemma", "other_pos", "epistemic_class").filter("lemma is not null and other_lemma is not null").distinct()
    other_id = uuid5(F.concat(F.lit("lex.es."), "other_lemma"), NS_DNS)
    others = p.groupBy(other_id.alias("lexeme_id"), F.col("other_lemma").alias("lemma")).agg(F.min("other_pos").alias("pos"))
    joined = p.join(lexemes.select("lexeme_id", "lemma").distinct(), "lemma").select("lexeme_id", other_id.alias("other_id"), "epistemic_class")
    # of several classes of one pair the least certain holds
    rank = F.when(F.col("epistemic_class") == "UNCERTAIN", 2).when(F.col("epistemic_class") == "ATTESTED", 1).otherwise(0)
    one = joined.groupBy("lexeme_id", "other_id").agg(F.max_by("epistemic_class", F.struct(rank, "epistemic_class")).alias("epistemic_class"))
    edges = one.select(
        uuid5(F.concat(F.lit("edge.trans."), "lexeme_id", F.lit("."), "other_id"), NS_DNS).alias("id"), F.col("lexeme_id").alias("source_id"), F.lit("LEXEME").alias("source_type"),
        F.lit("TRANSLATION_OF").alias("relation_type"), F.col("other_id").alias("target_id"), F.lit("LEXEME").alias("target_type"), "epistemic_class",
    )
    return others, edges


def pronunciation_layer(sounds: DataFrame, lexemes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pronunciations of lexemes and their phonetic index, which is no part of the graph.

    ``sounds``: ``lemma, notation, transcription``; every lexeme of that lemma gets one row per notation and
    transcription, ATTESTED. ``lexemes``: ``lexeme_id, lemma``. Null transcriptions give none.
    """
    s = sounds.select("lemma", "notation", "transcription").filter("lemma is not null and transcription is not null").distinct()
    said = s.join(lexemes.select("lexeme_id", "lemma").distinct(), "lemma")
    name = F.concat(F.lit("pron."), F.lower("notation"), F.lit("."), "lexeme_id", F.lit("."), "transcription")
    rows = said.select(uuid5(name, NS_DNS).alias("id"), F.col("lexeme_id").alias("target_id"), F.lit("LEXEME").alias("target_type"), "notation", "transcription", F.lit("ATTESTED").alias("epistemic_class")).distinct()
    index = said.select(F.soundex("lemma").alias("phonetic_key"), F.col("lexeme_id").alias("target_id"), F.lit("LEXEME").alias("target_type"), F.lit("SOUNDEX").alias("algorithm"), F.lit("GENERATED").alias("epistemic_class")).distinct()
    return rows, index


def construction_layer(constructions: DataFrame, realizations: DataFrame, lexemes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Construction nodes and the EXPLICIT edges that tie lexemes to them.

    ``constructions``: ``construction_id, name``; ``realizations``: ``lemma, relation_type, construction_id`` with
    REALIZES, EVOKES or MEMBER_OF_CLASS; ``lexemes``: ``lexeme_id, lemma``. An edge needs both of its ends.
    """
    nodes = constructions.filter("construction_id is not null").groupBy("construction_id").agg(F.min("name").alias("name"))
    kinds = realizations.filter(F.col("relation_type").isin("REALIZES", "EVOKES", "MEMBER_OF_CLASS"))
    ends = kinds.join(nodes.select("construction_id"), "construction_id", "left_semi").join(lexemes.select("lexeme_id", "lemma").distinct(), "lemma")
    edges = ends.select("lexeme_id", "relation_type", "construction_id").distinct()
    return nodes, edges.select(
        uuid5(F.concat_ws(":", "lexeme_id", "relation_type", "construction_id")).alias("id"), F.col("lexeme_id").alias("source_id"), F.lit("LEXEME").alias("source_type"),
        "relation_type", F.col("construction_id").alias("target_id"), F.lit("CONSTRUCTION").alias("target_type"), F.lit("EXPLICIT").alias("epistemic_class"),
    )


def mistyped_pronunciations(pronunciations: DataFrame, entities: DataFrame) -> DataFrame:
    """Pronunciations whose target is registered, but not as what ``target_type`` says; ``entities``: ``node_id, entity_type``."""
    known = entities.groupBy(F.col("node_id").alias("target_id")).agg(F.collect_set("entity_type").alias("_t"))  # a handful of types
    return pronunciations.join(known, "target_id").filter(~F.array_contains("_t", F.col("target_type"))).drop("_t")


def bad_translations(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """TRANSLATION_OF edges that touch a form, or that are neither ATTESTED, EXPLICIT nor UNCERTAIN."""
    t = edges.filter("relation_type = 'TRANSLATION_OF'")
    forms = entities.filter("entity_type = 'FORM'").select("node_id", F.lit(True).alias("_f")).distinct()
    s, o = (forms.withColumnsRenamed({"node_id": end, "_f": flag}) for end, flag in (("source_id", "_s"), ("target_id", "_o")))
    wrong = ~F.coalesce(F.col("epistemic_class").isin("ATTESTED", "EXPLICIT", "UNCERTAIN"), F.lit(False))
    return t.join(s, "source_id", "left").join(o, "target_id", "left").filter(wrong | F.col("_s").isNotNull() | F.col("_o").isNotNull()).drop("_s", "_o")


def phonetic_edges(relation_type: Column) -> Column:
    """Whether an edge's type belongs into the phonetic index instead."""
    return relation_type.contains("PHONETIC") | relation_type.contains("SOUNDEX")
