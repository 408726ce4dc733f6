"""Rule-based relations: derivations by affix, degree chains, generated inflections, morpheme structures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.functions.ids import morpheme_key, uuid5
from verbarium.functions.morph import SLOT_FEATURES, inflect
from verbarium.functions.text import feature_tags
from verbarium.operators.claims import morphemes

# Rule names and stem patterns. Each rule: name, affix, kind, part of speech of base and of the derived word, pattern of the stem.
AFFIX_RULES = [
    ("PREFIX_RE_VERB", "re-", "PREFIX", "VERB", "VERB", "^re([a-z]+)$"),
    ("PREFIX_UN_ADJ", "un-", "PREFIX", "ADJECTIVE", "ADJECTIVE", "^un([a-z]+)$"),
    ("SUFFIX_ABLE_VERB_TO_ADJ", "-able", "SUFFIX", "VERB", "ADJECTIVE", "^([a-z]+)able$"),
]
# The productive affixes of the morpheme catalogue.
AFFIXES = [("un-", "PREFIX"), ("re-", "PREFIX"), ("-ness", "SUFFIX"), ("-ly", "SUFFIX"), ("-tion", "SUFFIX"), ("-able", "SUFFIX")]
MIN_STEM = 3


def inferred_claim(relation_id: Column) -> Column:
    """The id of the claim that an inferred relation makes for itself."""
    return uuid5(F.concat(F.lit("claim:inferred:"), relation_id))


def infer_derivations(lexemes: DataFrame, existing: DataFrame, rules: list[tuple] = AFFIX_RULES) -> DataFrame:
    """INFERRED derivations whose base is attested: ``subject_id, object_id, rule, affix, id, claim_id, ...``.

    ``lexemes``: ``id, normalized_lemma, pos``; ``existing``: ``subject_id, object_id`` of DERIVED_FROM
    relations, which are never repeated. A suffix rule whose stem is not attested tries the stem with "e".
    Stems have at least three letters; null lemmas match no rule.
    """
    hits = []
    for name, affix, kind, base_pos, pos, pattern in rules:
        stem = F.regexp_extract("normalized_lemma", pattern, 1)
        hits.append(F.when((F.col("pos") == pos) & (F.length(stem) >= MIN_STEM), F.struct(F.lit(name).alias("rule"), F.lit(affix).alias("affix"), F.lit(kind == "SUFFIX").alias("suffix"), F.lit(base_pos).alias("base_pos"), stem.alias("stem"))))
    cand = lexemes.filter("normalized_lemma is not null").select(F.col("id").alias("subject_id"), "normalized_lemma", F.inline(F.filter(F.array(*hits), lambda x: x.isNotNull())))
    base = lexemes.select(F.col("id").alias("object_id"), F.col("normalized_lemma").alias("stem"), F.col("pos").alias("base_pos"))
    # both spellings of the stem in one equi-join; the plain one wins
    tries = cand.select("*", F.explode(F.when(F.col("suffix"), F.array(F.struct(F.lit(0).alias("t"), F.col("stem").alias("s")), F.struct(F.lit(1).alias("t"), F.concat("stem", F.lit("e")).alias("s")))).otherwise(F.array(F.struct(F.lit(0).alias("t"), F.col("stem").alias("s"))))).alias("x"))
    found = tries.select("subject_id", "normalized_lemma", "rule", "affix", "base_pos", "x.t", F.col("x.s").alias("stem")).join(base, ["stem", "base_pos"])
    best = found.groupBy("subject_id", "rule").agg(F.min(F.struct("t", "object_id", "stem", "affix", "normalized_lemma")).alias("b")).select("subject_id", "rule", "b.*")
    new = best.join(existing.select("subject_id", "object_id"), ["subject_id", "object_id"], "left_anti")
    rel = uuid5(F.concat(F.lit("rel:inferred:"), "subject_id", F.lit(":"), "object_id"))
    return new.select(
        rel.alias("id"), "subject_id", F.lit("DERIVED_FROM").alias("relation_type"), "object_id", F.lit("INFERRED").alias("evidence_type"), F.lit(0.75).alias("confidence"), F.lit("RESOLVED").alias("resolution_status"),
        "rule", "affix", F.col("normalized_lemma").alias("target_lemma"), F.col("stem").alias("base_lemma"), inferred_claim(rel).alias("claim_id"),
    )


def degree_chains(forms: DataFrame) -> DataFrame:
    """Comparative-to-superlative links: ``lexeme, comparative, superlative`` where both exist, the last of each by form.

    ``forms``: ``lexeme, degree, form``.
    """
    return (
        forms.filter("form is not null").groupBy("lexeme").pivot("degree", ["comparative", "superlative"]).agg(F.max("form"))
        .filter("comparative is not null and superlative is not null")
    )


def degree_of(features: Column) -> Column:
    """``comparative`` or ``superlative`` by the tags of a feature bundle, else null."""
    tags = feature_tags(features)
    return F.when(F.array_contains(tags, "CMPR"), "comparative").when(F.array_contains(tags, "SPRL"), "superlative")


def degree_relations(forms: DataFrame) -> DataFrame:
    """INFLECTS_TO relations from the comparative to the superlative of ``(lexeme, degree, form)``, GENERATED at 0.85."""
    c = degree_chains(forms).select("comparative", "superlative").distinct()
    return c.select(
        uuid5(F.concat("comparative", F.lit(":INFLECTS_TO:"), "superlative")).alias("id"), F.lit("FORM").alias("subject_type"), F.col("comparative").alias("subject_id"), F.lit("INFLECTS_TO").alias("relation_type"),
        F.lit("FORM").alias("object_type"), F.col("superlative").alias("object_id"), F.lit("GENERATED").alias("evidence_type"), F.lit(0.85).alias("confidence"), F.lit("INFERRED").alias("resolution_status"),
    )


def materialize_inflections(lexemes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forms and relations of generated inflections of ``(id, normalized_lemma, pos)`` lexemes.

    Relations: HAS_FORM from the lexeme, INFLECTS_TO from its base form. Irregular and suppletive ones are
    ATTESTED, regular ones GENERATED.
    """
    slots = inflect(lexemes.select(F.col("normalized_lemma").alias("lemma"), "pos")).join(lexemes.select(F.col("normalized_lemma").alias("lemma"), "pos", F.col("id").alias("lexeme_id")), ["lemma", "pos"])
    features = F.try_element_at(F.create_map(*[x for s, f in SLOT_FEATURES.items() for x in (F.lit(s), F.to_json(F.create_map(*[F.lit(y) for kv in sorted(f.items()) for y in kv])))]), F.col("slot"))
    evidence = F.when(F.col("form_type") == "INFLECTED", "GENERATED").otherwise("ATTESTED")
    rows = slots.select("lexeme_id", "lemma", "slot", "surface", "form_type", features.alias("features_json"), evidence.alias("evidence_type"), uuid5(F.concat(F.lit("form:"), "surface", F.lit(":"), "slot")).alias("form_id"), uuid5(F.concat(F.lit("form:"), "lemma")).alias("base_id"))
    forms = rows.select(F.col("form_id").alias("id"), "surface", "slot", "form_type", "features_json", "evidence_type").distinct()
    has = rows.select(F.col("lexeme_id").alias("subject_id"), F.lit("HAS_FORM").alias("relation_type"), F.col("form_id").alias("object_id"), "evidence_type")
    into = rows.select(F.col("base_id").alias("subject_id"), F.lit("INFLECTS_TO").alias("relation_type"), F.col("form_id").alias("object_id"), "evidence_type")
    return forms, has.unionByName(into).distinct()


def derivation_links(pairs: DataFrame, confidence: float = 1.0) -> DataFrame:
    """EXPLICIT DERIVED_FROM relations of ``(subject_id, object_id)``: the subject is the derived word."""
    name = F.concat_ws(":", "subject_id", F.lit("DERIVED_FROM"), "object_id")
    return pairs.select("subject_id", "object_id").distinct().select(uuid5(name).alias("id"), "subject_id", F.lit("DERIVED_FROM").alias("relation_type"), "object_id", F.lit("EXPLICIT").alias("evidence_type"), F.lit(confidence).alias("confidence"))


def structures(derivations: DataFrame) -> DataFrame:
    """Morphological structures of :func:`infer_derivations` rows: the parts in order, as an array of structs."""
    prefix = F.col("affix").endswith("-")
    affix = F.struct(F.col("affix").alias("shape"), F.when(prefix, "PREFIX").otherwise("SUFFIX").alias("type"))
    stem = F.struct(F.col("base_lemma").alias("shape"), F.lit("ROOT").alias("type"))
    return derivations.select(F.col("subject_id").alias("target_id"), F.when(prefix, F.array(affix, stem)).otherwise(F.array(stem, affix)).alias("components"))


def contains_morphemes(derivations: DataFrame) -> DataFrame:
    """CONTAINS_MORPHEME edges from the derived words of :func:`infer_derivations` rows to their affix and their root, in order."""
    parts = structures(derivations).select("target_id", F.posexplode("components").alias("place", "c"))
    to = uuid5(morpheme_key(F.col("c.shape"), F.col("c.type")))
    return parts.select(uuid5(F.concat_ws(":", "target_id", F.lit("CONTAINS_MORPHEME"), to)).alias("id"), F.col("target_id").alias("source_id"), F.lit("CONTAINS_MORPHEME").alias("relation_type"), to.alias("target_id"), (F.col("place") + 1).alias("place")).distinct()


def affix_morphemes(spark: SparkSession) -> DataFrame:
    """The catalogue of productive affixes as morpheme nodes."""
    return morphemes(spark.createDataFrame(AFFIXES, "shape string, type string")).withColumn("status", F.lit("ATTESTED"))
