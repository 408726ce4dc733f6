"""Queries of the training-data operators and the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.llm import leakage, matching, mixing, restated, splitting
from verbarium.sources.tables import table


def _lexical(spark: SparkSession, sf: str) -> DataFrame:
    return matching.lexical_rows(*(table(spark, sf, t) for t in ("staging_lexical_entries", "staging_semantic_relations", "staging_inflections")))


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return matching.scored_pairs(_lexical(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).select("key_a", "key_b")


def p4_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).withColumn("confidence", F.round("confidence", 6))


def p4_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Which row has which profile: with the pairs of profiles, all matches without a row for each pair of equal rows."""
    return matching.matched_profiles(_lexical(spark, sf))[0].withColumn("pid", F.lower(F.hex("pid")))


def p4_profile_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return matching.matched_profiles(_lexical(spark, sf))[1].select(F.lower(F.hex("pid")).alias("pid"), F.lower(F.hex("pid2")).alias("pid2"), F.round("confidence", 6).alias("confidence"))


def _claims(spark: SparkSession, sf: str, least: int = 1) -> DataFrame:
    return restated.restated(table(spark, sf, "staging_claims"), "id", ["source", "claim_type", "predicate"], ["subject"], ["object_json"], least)


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _claims(spark, sf, 2).filter("id <> keep").select(F.col("keep").alias("keep_id"), F.col("id").alias("copy_id"))


def p6_claims(spark: SparkSession, sf: str) -> DataFrame:
    return _claims(spark, sf).filter("id = keep").select("id", "n_copies")


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaks(table(spark, sf, "documents"), "doc_id", table(spark, sf, "eval_items"), "item_id")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("doc_id", "item_id")


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))


def p7_spans(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_spans(table(spark, sf, "documents"), "doc_id", table(spark, sf, "eval_items"), "item_id")


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mixture(table(spark, sf, "documents"), targets), targets)


def p8_fit(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.fit_report(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_unlabelled_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The mixture in which documents without a source take part by their posteriors."""
    targets = table(spark, sf, "mix_targets")
    return mixing.shares(mixing.mixture(table(spark, sf, "documents"), targets, unlabelled=True), targets)


def p8_membership(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.membership(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What any right mixture satisfies, per target source: its documents and tokens are whole, caps kept, the share due reached."""
    targets, docs = table(spark, sf, "mix_targets"), table(spark, sf, "documents")
    s = mixing.shares(mixing.mixture(docs, targets), targets)
    near = F.abs(F.col("actual_share") - F.col("due_share")) <= 0.01
    return s.select("source", "n_documents", (F.col("most_copies") <= F.col("max_repeats")).alias("cap_kept"), near.alias("share_reached"))


def p9_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What any right split satisfies: limits kept, pieces numbered without gaps, fresh parts the whole text.

    Of the documents that must be split whatever the tokenizer, having more words than the limit: SQL can tell these.
    """
    limits = F.broadcast(table(spark, sf, "split_limits").select("profile", "max_tokens").distinct())  # at most as many rows as split_oversized takes
    words = F.size(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)))
    must = table(spark, sf, "documents").select("doc_id", words.alias("n_words")).join(limits, F.col("n_words") > F.col("max_tokens")).select("doc_id", "profile", "max_tokens")
    fresh = F.expr("substring(piece, fresh - start + 1, length(piece))")
    g = p9_pieces(spark, sf).join(must, ["doc_id", "profile"]).groupBy("doc_id", "profile").agg(
        F.max(F.col("n_tokens") - F.col("max_tokens")).alias("over"), F.count(F.lit(1)).alias("n"), F.max("piece_no").alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", fresh.alias("t")))), lambda x: x["t"]), "").alias("whole"),  # the parts of one text
    )
    return g.select("doc_id", "profile", (F.col("over") <= 0).alias("within"), (F.col("n") == F.col("last")).alias("numbered"), F.md5("whole").alias("text_md5"))


def p9_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_oversized(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "split_limits"))


QUERIES = {f.__name__: f for f in (p4_found, p4_confidence, p4_profiles, p4_profile_pairs, p6_found, p6_claims, p7_found, p7_items, p7_spans, p8_mixture, p8_shares, p8_fit, p8_unlabelled_shares, p8_membership, p8_checks, p9_pieces, p9_checks)}

_LEAKS = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) g FROM dw WHERE len(w) >= 12),
i AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) g FROM iw WHERE len(w) >= 12),
leaks AS (SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (g))
"""
_RESTATED = r"""
WITH c AS (SELECT DISTINCT id, source, claim_type, predicate, lower(regexp_replace(subject, '[^\p{L}\p{N}]', '', 'g')) s, object_json j FROM staging_claims WHERE id IS NOT NULL),
leaf AS (SELECT c.id, t.fullkey || '=' || CASE t.type WHEN 'VARCHAR' THEN 's' || lower(regexp_replace(t.atom->>'$', '[^\p{L}\p{N}]', '', 'g')) WHEN 'OBJECT' THEN '{}' WHEN 'ARRAY' THEN '[]'
    WHEN 'BOOLEAN' THEN 'b' || (t.atom->>'$') WHEN 'NULL' THEN 'null' ELSE 'n' || ((t.atom->>'$')::DOUBLE)::VARCHAR END p
  FROM c, json_tree(c.j) t WHERE t.type NOT IN ('OBJECT', 'ARRAY') OR (t.type = 'OBJECT' AND json_keys(t.json) = []) OR (t.type = 'ARRAY' AND json_array_length(t.json) = 0)),
body AS (SELECT id, list_sort(list(DISTINCT p)) b FROM leaf GROUP BY id),
g AS (SELECT id, min(id) OVER w keep, count(*) OVER w n FROM c JOIN body USING (id) WINDOW w AS (PARTITION BY source, claim_type, predicate, s, b))
"""
ORACLE = {
    "p6_found": _RESTATED + "SELECT DISTINCT keep keep_id, id copy_id FROM g WHERE id <> keep",
    "p6_claims": _RESTATED + "SELECT DISTINCT id, n n_copies FROM g WHERE id = keep",
    "p7_found": _LEAKS + "SELECT doc_id, item_id FROM leaks",
    "p8_checks": """SELECT lower(trim(m.source, ' ')) source, count(doc_id) n_documents, true cap_kept, true share_reached FROM mix_targets m LEFT JOIN documents d
        ON lower(trim(d.source, E' \\t\\n\\r' || chr(160))) = lower(trim(m.source, ' ')) GROUP BY 1""",
    "p9_checks": r"""SELECT doc_id, profile, true AS "within", true AS numbered, md5(text) text_md5 FROM documents, (SELECT DISTINCT profile, max_tokens FROM split_limits) WHERE len(regexp_extract_all(text, '\p{L}+')) > max_tokens""",
    "p7_items": _LEAKS + "SELECT item_id, count(*) n_documents FROM leaks GROUP BY 1",
}
