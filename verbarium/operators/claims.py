"""The claims ledger: normalising claims and resolving them into lexemes, forms and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbarium.functions.ids import NS_DNS, form_key, lexeme_key, morpheme_key, relation_key, uuid5
from verbarium.functions.morph import form_type
from verbarium.functions.text import bundle_pos, feature_tags, frequency_tier, map_pos, normalize_text, zipf
from verbarium.shipping import ship

#: Sources in the order in which they win where only one row may stay.
PRIORITY = ["OEWN", "WIKTIONARY", "UNIMORPH", "SUBTLEX"]


def source_rank(source: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for i, s in reversed(list(enumerate(PRIORITY))):
        out = F.when(source.startswith(s), i).otherwise(out)
    return out


def keyed_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order`` (insert-or-ignore; give a descending order for insert-or-replace).

    It is an aggregate with map-side combining, so a hot key costs no more than another.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)]))
    return rows.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def normalized_lexemes(claims: DataFrame) -> DataFrame:
    """``(claim_id, source, raw_lemma, normalized_lemma, canonical_pos, raw_payload)`` of entry claims."""
    ship(claims.sparkSession)
    return claims.filter(F.col("claim_type").isin("LEXICAL_ENTRY", "LEXICAL_RECORD")).select(
        F.col("id").alias("claim_id"), "source", F.col("subject").alias("raw_lemma"), normalize_text(F.col("subject")).alias("normalized_lemma"),
        map_pos(F.get_json_object("object_json", "$.pos")).alias("canonical_pos"), F.col("object_json").alias("raw_payload"),
    )


def normalized_forms(claims: DataFrame) -> DataFrame:
    """``(claim_id, source, raw_lemma, normalized_lemma, surface, features, pos)`` of inflection claims."""
    ship(claims.sparkSession)
    bundle = F.get_json_object("object_json", "$.features")
    return claims.filter("claim_type = 'INFLECTION_RECORD'").select(
        F.col("id").alias("claim_id"), "source", F.col("subject").alias("raw_lemma"), normalize_text(F.col("subject")).alias("normalized_lemma"),
        F.get_json_object("object_json", "$.surface").alias("surface"), bundle.alias("features"), bundle_pos(feature_tags(bundle)).alias("pos"),
    )


def resolved_lexemes(norm: DataFrame) -> DataFrame:
    """One row per (lemma, pos): deterministic id, sorted sources, the raw lemma of the first source."""
    grouped = norm.filter("normalized_lemma <> ''").groupBy("normalized_lemma", F.col("canonical_pos").alias("pos")).agg(
        F.array_sort(F.collect_set("source")).alias("source_presence"),
        F.min_by("raw_lemma", F.struct(source_rank(F.col("source")), "source", "raw_lemma")).alias("lemma"), F.count(F.lit(1)).alias("n_claims"),
    )
    key = lexeme_key(F.col("normalized_lemma"), F.col("pos"))
    return grouped.select(uuid5(key).alias("id"), "lemma", "normalized_lemma", F.lit("eng").alias("language"), "pos", key.alias("lexeme_key"), "source_presence", "n_claims", F.lit("ATTESTED").alias("status"))


def resolved_forms(norm: DataFrame) -> DataFrame:
    """One row per (surface, features) with its kind; blank surfaces give none."""
    ship(norm.sparkSession)
    s = normalize_text(F.col("surface"))
    rows = norm.filter(F.trim("surface") != "").select("surface", s.alias("normalized_surface"), F.coalesce("features", F.lit("")).alias("features"), "normalized_lemma")
    kind = F.min(form_type(F.col("normalized_lemma"), F.col("normalized_surface")))
    grouped = rows.groupBy("normalized_surface", "features").agg(F.min("surface").alias("surface"), kind.alias("form_type"))
    key = form_key(F.col("normalized_surface"), F.col("features"))
    return grouped.select(uuid5(key).alias("id"), "surface", "normalized_surface", "features", "form_type", key.alias("form_key"))


def has_form_relations(norm: DataFrame, lexemes: DataFrame) -> DataFrame:
    """HAS_FORM relations from lexemes to forms, only where the parent lexeme exists."""
    ship(norm.sparkSession)
    forms = norm.filter(F.trim("surface") != "").select("normalized_lemma", "pos", normalize_text(F.col("surface")).alias("s"), F.coalesce("features", F.lit("")).alias("features"))
    owned = forms.join(lexemes.select("normalized_lemma", "pos", F.col("id").alias("subject_id")), ["normalized_lemma", "pos"])
    obj = uuid5(form_key(F.col("s"), F.col("features")))
    return (
        owned.select("subject_id", obj.alias("object_id")).distinct()
        .select(uuid5(relation_key(F.col("subject_id"), F.lit("HAS_FORM"), F.col("object_id"))).alias("id"), F.lit("LEXEME").alias("subject_type"), "subject_id",
                F.lit("HAS_FORM").alias("relation_type"), F.lit("FORM").alias("object_type"), "object_id", F.lit("EXPLICIT").alias("evidence_type"), F.lit(1.0).alias("confidence"))
    )


def form_claims(relations: DataFrame, norm: DataFrame, lexemes: DataFrame) -> DataFrame:
    """``(relation_id, claim_id)``: the inflection claims behind HAS_FORM relations, by lexeme and form."""
    ship(norm.sparkSession)
    claims = norm.filter(F.trim("surface") != "").select("claim_id", "normalized_lemma", "pos", uuid5(form_key(normalize_text(F.col("surface")), F.col("features"))).alias("object_id"))
    said = claims.join(lexemes.select("normalized_lemma", "pos", F.col("id").alias("subject_id")), ["normalized_lemma", "pos"])
    return relations.select(F.col("id").alias("relation_id"), "subject_id", "object_id").join(said, ["subject_id", "object_id"]).select("relation_id", "claim_id").distinct()


def lexeme_frequencies(claims: DataFrame, lexemes: DataFrame) -> DataFrame:
    """Lexemes with the frequency of their lemma: count, Zipf value and tier; null where none is attested.

    Of several records of a word the latest wins, then the larger id.
    """
    ship(claims.sparkSession)
    path = lambda p: F.get_json_object("object_json", p)
    freq = claims.filter("claim_type = 'USAGE_FREQUENCY'").select(
        normalize_text(F.coalesce(path("$.Word"), F.col("subject"))).alias("normalized_lemma"), path("$.FREQcount").try_cast("long").alias("raw_count"),
        zipf(path("$.Lg10WF")).alias("zipf_score"), F.try_to_timestamp("extracted_at").alias("_t"), F.col("id").alias("_i"),
    )
    last = freq.groupBy("normalized_lemma").agg(F.max_by(F.struct("raw_count", "zipf_score"), F.struct("_t", "_i")).alias("f")).select("normalized_lemma", "f.*")
    return lexemes.join(last.withColumn("tier", frequency_tier(F.col("zipf_score"))), "normalized_lemma", "left")


def crosswalk(parts: dict[str, DataFrame]) -> DataFrame:
    """``(source_table, source_id, resolved_id, epistemic_status)`` of tables of ``(id, lemma, pos)``.

    The key is the trimmed lower-case lemma and pos; synset rows are EXPLICIT, others ATTESTED.
    """
    out = None
    for name, df in parts.items():
        canon, pos = F.lower(F.trim("lemma")), F.lower(F.trim("pos"))
        rows = df.filter("lemma is not null and pos is not null").select(
            F.lit(name).alias("source_table"), F.col("id").cast("string").alias("source_id"), uuid5(F.concat(F.lit("lexeme:"), canon, F.lit(":"), pos), NS_DNS).alias("resolved_id"),
            F.lit("EXPLICIT" if name == "synsets" else "ATTESTED").alias("epistemic_status"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def morphemes(rows: DataFrame) -> DataFrame:
    """Morpheme nodes of ``(shape, type)`` rows."""
    return rows.select("shape", "type").filter("shape <> ''").distinct().withColumn("id", uuid5(morpheme_key(F.col("shape"), F.col("type"))))


def latest(rows: DataFrame, keys: list[str], n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows per key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
