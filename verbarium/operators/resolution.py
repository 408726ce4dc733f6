"""Resolving competing claims, corroborating relations, and healing edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbarium.functions.ids import NS_DNS, NS_URL, uuid5


def conflicts(claims: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with more than one distinct value: ``keys, n_values, n_claims``."""
    return claims.groupBy(*keys).agg(F.countDistinct(value).alias("n_values"), F.count(F.lit(1)).alias("n_claims")).filter("n_values > 1")


def conflict_relations(claims: DataFrame, keys: list[str], value: str, claim_id: str) -> DataFrame:
    """One CONFLICTING relation per competing claim, bridged to it: ``relation_id, claim_id, keys, value, ...``.

    Conflicting keys meet their claims by key; a key with very many claims is split by adaptive execution.
    """
    rows = claims.join(conflicts(claims, keys, value).select(*keys), keys, "left_semi")
    name = F.concat_ws(":", F.lit("conflict"), *keys, value)
    return rows.select(
        uuid5(name).alias("relation_id"), F.col(claim_id).alias("claim_id"), *keys, value,
        F.lit("UNCERTAIN").alias("evidence_type"), F.lit(0.5).alias("confidence"), F.lit("CONFLICTING").alias("resolution_status"),
    ).distinct()


def corroborated(relations: DataFrame, keys: list[str], source: str, confidence: str) -> DataFrame:
    """``relations`` with confidence 1.0 where more than one source states the same keys."""
    n = relations.groupBy(*keys).agg(F.countDistinct(source).alias("n_sources"))
    return relations.join(n, keys).withColumn(confidence, F.when(F.col("n_sources") > 1, 1.0).otherwise(F.col(confidence)))


def resolve_claims(claims: DataFrame, keys: list[str], value: str, claim_id: str, order: list[Column], evidence: str | None = None) -> DataFrame:
    """One row per key: the first value, and what its claims amount to.

    All equal: RESOLVED at 1.0, ATTESTED if several claims agree, else the claim's own evidence. Otherwise
    CONFLICTING, UNCERTAIN, 0.5. Null values count as a value of their own only if all are null.
    """
    one = F.min(F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.col(value).alias("v"), (F.col(evidence) if evidence else F.lit("EXPLICIT")).alias("e")))
    g = claims.groupBy(*keys).agg(F.countDistinct(value).alias("n_values"), F.count(F.lit(1)).alias("n_claims"), one.alias("_f"), F.array_sort(F.collect_set(claim_id)).alias("claim_ids"))
    agree = F.col("n_values") <= 1
    return g.select(
        *keys, F.col("_f.v").alias(value), "n_claims", F.when(agree, "RESOLVED").otherwise("CONFLICTING").alias("status"),
        F.when(~agree, "UNCERTAIN").when(F.col("n_claims") > 1, "ATTESTED").otherwise(F.col("_f.e")).alias("evidence_type"),
        F.when(agree, 1.0).otherwise(0.5).alias("confidence"), "claim_ids",
    )


def provenance_list(rows: DataFrame, keys: list[str], column: str, alias: str) -> DataFrame:
    """The distinct values of a column per key, sorted and joined by commas."""
    return rows.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(column)), ",").alias(alias))


def heal_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose ends both exist; ``nodes`` has ``node_id``."""
    ids = nodes.select("node_id").distinct()
    return edges.join(ids.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")


def missing_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """End points that no node has, with the number of edges that need them."""
    ends = edges.select(F.col("source_id").alias("node_id")).unionByName(edges.select(F.col("target_id").alias("node_id"))).filter("node_id is not null")
    return ends.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_edges")).join(nodes.select("node_id"), "node_id", "left_anti")


def process_errata(queue: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pending errata worked off: the queue with its new statuses, and the edges with touched ones UNCERTAIN.

    ``queue``: ``id, target_entity_id, conflict_type, status``. A missing etymology ends as
    RESOLVED_UNATTESTED, another conflict as RESOLVED_CONFLICT_PRESERVED.
    """
    pending = F.col("status") == "PENDING"
    done = queue.withColumn("status", F.when(pending & (F.col("conflict_type") == "MISSING_ETYMOLOGY"), "RESOLVED_UNATTESTED").when(pending, "RESOLVED_CONFLICT_PRESERVED").otherwise(F.col("status")))
    hit = queue.filter(pending & F.col("target_entity_id").isNotNull()).select(F.col("target_entity_id").alias("_e")).distinct().withColumn("_hit", F.lit(True))
    touched = edges.join(hit.withColumnsRenamed({"_e": "source_id", "_hit": "_s"}), "source_id", "left").join(hit.withColumnsRenamed({"_e": "target_id", "_hit": "_t"}), "target_id", "left")
    marked = touched.withColumn("epistemic_class", F.when(F.coalesce("_s", "_t").isNotNull(), "UNCERTAIN").otherwise(F.col("epistemic_class"))).select(*edges.columns)
    return done, marked


def errata_records(queue: DataFrame) -> DataFrame:
    """The queue worked off, with what became of each pending row kept in ``metadata``.

    ``queue``: ``id, conflict_type, source_a_claim, source_b_claim, metadata`` (JSON of one level, or null)``, status``. A row that is
    not pending stays as it is. Fields already in the metadata stay, an older conflict record is replaced.
    """
    pending = F.col("status") == "PENDING"
    lost = F.col("conflict_type") == "MISSING_ETYMOLOGY"
    record = F.to_json(F.struct(F.col("source_a_claim").alias("source_a"), F.col("source_b_claim").alias("source_b"), F.when(lost, "UNATTESTED").otherwise("CONFLICT_PRESERVED").alias("resolved_as")), {"ignoreNullFields": "false"})
    kept = F.map_filter(F.coalesce(F.from_json("metadata", "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, v: k != "conflict_record")
    merged = F.to_json(F.map_concat(kept, F.create_map(F.lit("conflict_record"), record)))
    status = F.when(pending & lost, "RESOLVED_UNATTESTED").when(pending, "RESOLVED_CONFLICT_PRESERVED").otherwise(F.col("status"))
    return queue.select("id", "conflict_type", status.alias("status"), F.when(pending, merged).otherwise(F.col("metadata")).alias("metadata"), F.when(pending, F.lit("UNCERTAIN")).alias("epistemic_class"))


def etymology_claims(relations: DataFrame, claims: DataFrame) -> DataFrame:
    """``(relation_id, claim_id)``: ETYMOLOGICALLY_FROM relations and the claims that say so of their subject.

    ``relations``: ``id, relation_type, subject_lemma``; compared trimmed in lower case.
    """
    key = lambda c: F.lower(F.trim(c))
    r = relations.filter("relation_type = 'ETYMOLOGICALLY_FROM'").select(F.col("id").alias("relation_id"), key("subject_lemma").alias("_k"))
    c = claims.filter("predicate = 'ETYMOLOGICALLY_FROM'").select(F.col("id").alias("claim_id"), key("subject").alias("_k"))
    return r.join(c, "_k").select("relation_id", "claim_id").distinct()


def mapped_edges(claims: DataFrame, lexemes: DataFrame, forms: DataFrame) -> DataFrame:
    """HAS_FORM edges of inflection claims over the first id of each lemma and surface; what has none gets one of its own.

    ``claims``: ``lemma, form, tags, source``; ``lexemes``: ``lemma, lexeme_id``; ``forms``: ``surface, form_id``, unique by name (see
    :func:`first_ids`). Returns ``id, source_id, target_id, features, provenance, new_lexeme, new_form``; the sources of an edge are sorted and joined.
    """
    said = claims.filter("lemma is not null and form is not null").groupBy("lemma", "form", "tags").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("provenance"))
    j = said.join(lexemes, "lemma", "left").join(forms.withColumnRenamed("surface", "form"), "form", "left")
    lid = F.coalesce("lexeme_id", uuid5(F.concat(F.lower("lemma"), F.lit(":noun")), NS_DNS))
    fid = F.coalesce("form_id", uuid5(F.lower("form"), NS_URL))
    ends = j.select(lid.alias("source_id"), fid.alias("target_id"), F.col("tags").alias("features"), "provenance", F.col("lexeme_id").isNull().alias("new_lexeme"), F.col("form_id").isNull().alias("new_form"))
    return ends.withColumn("id", uuid5(F.concat_ws(":", F.lit("has_form"), "source_id", "target_id", F.coalesce("features", F.lit("None"))))).distinct()


def missing_lexemes(rows: DataFrame, lexemes: DataFrame) -> DataFrame:
    """``(lexeme_id, lemma, pos)`` for lemmas of ``rows (lemma)`` that no lexeme has: nouns, until something else is known."""
    return rows.filter("lemma is not null").select("lemma").distinct().join(lexemes.select("lemma"), "lemma", "left_anti").select(uuid5(F.concat(F.lower("lemma"), F.lit(":noun")), NS_DNS).alias("lexeme_id"), "lemma", F.lit("noun").alias("pos"))


def first_ids(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key, the first by ``order``: the dimension that links names to ids."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, F.struct(order, value)).alias(value))


def canonical_forms(lexemes: DataFrame, forms: DataFrame, edges: DataFrame) -> DataFrame:
    """HAS_FORM edges from lexemes to the form that is spelled like them, where there is none yet.

    ``lexeme_id, form_id, edge_id, is_new_form``. An existing form of that spelling is taken (the smallest id),
    else its id follows from the spelling. ``lexemes``: ``lexeme_id, lemma``; ``forms``: ``form_id, surface``.
    """
    spell = F.lower(F.trim("lemma"))
    lex = lexemes.filter("trim(lemma) <> ''").select("lexeme_id", spell.alias("s")).distinct()
    own = forms.select("form_id", F.lower(F.trim("surface")).alias("s")).distinct()
    has = edges.filter("relation_type = 'HAS_FORM'").select(F.col("source_id").alias("lexeme_id"), F.col("target_id").alias("form_id")).join(own, "form_id").select("lexeme_id", "s")
    lacking = lex.join(has, ["lexeme_id", "s"], "left_anti")
    known = own.groupBy("s").agg(F.min("form_id").alias("form_id"))
    form = F.coalesce("form_id", uuid5(F.concat(F.lit("form:"), "s")))
    out = lacking.join(known, "s", "left").select("lexeme_id", form.alias("f"), F.col("form_id").isNull().alias("is_new_form"))
    return out.select("lexeme_id", F.col("f").alias("form_id"), uuid5(F.concat("lexeme_id", F.lit(":HAS_FORM:"), "f", F.lit(":CANONICAL"))).alias("edge_id"), "is_new_form")
