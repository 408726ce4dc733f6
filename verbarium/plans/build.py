"""The batch build as one composition: claims to entities, relations, evidence, gates, search index and manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbarium.lineage import cut
from verbarium.operators import claims as cl
from verbarium.operators import export, gates, inference

_RELATION = ["id", "subject_type", "subject_id", "relation_type", "object_type", "object_id", "evidence_type", "confidence", "resolution_status"]
#: What each table of a build is sorted by, and found by.
KEYS = {
    "lexemes": ["normalized_lemma", "pos"], "forms": ["normalized_surface"], "morphemes": ["id"], "structures": ["target_id"], "relations": ["subject_id", "relation_type", "object_id"],
    "relation_claims": ["relation_id", "claim_id"], "search_index": ["term"],
}


def search_rows(lexemes: DataFrame, forms: DataFrame) -> DataFrame:
    """``(target_id, target_type, term, extra_text)``: lemmas and surfaces to be found, with what else matches."""
    a = lexemes.select(F.col("id").alias("target_id"), F.lit("LEXEME").alias("target_type"), F.col("lemma").alias("term"), F.concat_ws(" ", "normalized_lemma", "pos").alias("extra_text"))
    b = forms.select(F.col("id").alias("target_id"), F.lit("FORM").alias("target_type"), F.col("surface").alias("term"), F.concat_ws(" ", "normalized_surface", "form_type").alias("extra_text"))
    return a.unionByName(b)


def build(claims: DataFrame) -> dict[str, DataFrame]:
    """All tables of a build from a claims ledger.

    Claims are normalised once and lexemes resolved once; what several tables read is cut in between. Relations
    are HAS_FORM (EXPLICIT), DERIVED_FROM by affix (INFERRED, with a claim of its own) and comparative to
    superlative (GENERATED); one row per id. Lexemes carry their frequency. Empty claims give empty tables.
    """
    said_forms = cut(cl.normalized_forms(claims))
    lexemes = cut(cl.resolved_lexemes(cl.normalized_lexemes(claims)))
    forms = cut(cl.resolved_forms(said_forms))
    has_form = cl.has_form_relations(said_forms, lexemes).withColumn("resolution_status", F.lit("RESOLVED"))
    none = lexemes.select(F.col("id").alias("subject_id"), F.col("id").alias("object_id")).limit(0)  # a build starts from claims only
    derived = cut(inference.infer_derivations(lexemes.select("id", "normalized_lemma", "pos"), none))
    inferred = derived.withColumn("subject_type", F.lit("LEXEME")).withColumn("object_type", F.lit("LEXEME"))
    owned = has_form.select(F.col("subject_id").alias("lexeme"), F.col("object_id").alias("form")).join(lexemes.filter("pos = 'ADJECTIVE'").select(F.col("id").alias("lexeme")), "lexeme", "left_semi")
    degree = inference.degree_relations(owned.join(forms.select(F.col("id").alias("form"), inference.degree_of(F.col("features")).alias("degree")), "form").filter("degree is not null"))
    relations = cut(reduce(DataFrame.unionByName, (x.select(*_RELATION) for x in (has_form, inferred, degree))).dropDuplicates(["id"]))
    bridge = cl.form_claims(has_form, said_forms, lexemes).unionByName(derived.select(F.col("id").alias("relation_id"), "claim_id")).distinct()
    return {
        "lexemes": cl.lexeme_frequencies(claims, lexemes).select(*lexemes.columns, "raw_count", "zipf_score", "tier"), "forms": forms, "morphemes": inference.affix_morphemes(claims.sparkSession),
        "structures": inference.structures(derived), "relations": relations, "relation_claims": cut(bridge), "search_index": search_rows(lexemes, forms),
    }


def build_gates(tables: dict[str, DataFrame], claims: DataFrame) -> dict[str, DataFrame]:
    """What must hold before a build is published: keys unique, ends registered, evidence in its domain, claims behind what is EXPLICIT."""
    rel = tables["relations"]
    nodes = tables["lexemes"].select("id").unionByName(tables["forms"].select("id"))
    known = claims.select("id").unionByName(rel.filter("evidence_type = 'INFERRED'").select(inference.inferred_claim(F.col("id")).alias("id")))
    twice = lambda name, key: tables[name].groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return {
        "lexeme_keys": twice("lexemes", "lexeme_key"), "form_keys": twice("forms", "form_key"),
        "subjects": gates.orphan_keys(rel, "subject_id", nodes, "id"), "objects": gates.orphan_keys(rel, "object_id", nodes, "id"),
        "evidence_domain": gates.out_of_domain(rel, "evidence_type", gates.EPISTEMIC), "explicit_without_claim": gates.unbacked(rel, tables["relation_claims"], F.col("evidence_type") == "EXPLICIT"),
        "bridge_without_claim": gates.orphan_keys(tables["relation_claims"], "claim_id", known, "id"), "parts_of_speech": gates.out_of_domain(tables["lexemes"], "pos", gates.POS),
        "affixes": gates.affix_anomalies(tables["morphemes"]), "form_of_form": rel.filter("relation_type = 'HAS_FORM' and (subject_type <> 'LEXEME' or object_type <> 'FORM')"),
    }


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """``(name, n, content)``: row counts and digests that do not depend on row order, one job for all tables."""
    one = [df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(export.content_hash(df, sorted(df.columns)), F.lit(0)).alias("content")).select(F.lit(k).alias("name"), "n", "content") for k, df in tables.items()]
    return reduce(DataFrame.unionByName, one)


def publish_build(claims: DataFrame, root: str) -> str:
    """Builds, gates and publishes: a snapshot with all tables and their manifest, or an error naming the failed gates."""
    tables = build(claims)
    report = gates.report(build_gates(tables, claims))
    return export.publish({k: (tables[k], KEYS[k]) for k in tables} | {"manifest": (manifest(tables), ["name"])}, root, report)
