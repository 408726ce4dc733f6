"""Queries of the reference's own operators over the lexical tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.functions import text as tx
from verbarium.functions.ids import NS_DNS
from verbarium.functions.morph import inflect
from verbarium.lineage import cut
from verbarium.operators import claims as cl
from verbarium.operators import export, gates, graph, inference, nearby, resolution, search, workspace
from verbarium.plans import sql
from verbarium.sources import readers
from verbarium.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def _claims(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "staging_claims")


def _lexemes(spark: SparkSession, sf: str) -> DataFrame:
    return cl.resolved_lexemes(cl.normalized_lexemes(_claims(spark, sf)))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "edges")


def _entities(spark: SparkSession, sf: str, kind: str | None = None) -> DataFrame:
    df = table(spark, sf, "resolved_entities")
    return df.filter(F.col("entity_type") == kind) if kind else df


def _lex_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _entities(spark, sf, "LEXEME").select(F.col("resolved_id").alias("lexeme_id"), F.col("canonical_form").alias("lemma"), "pos").distinct()


def _form_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _entities(spark, sf, "FORM").select(F.col("resolved_id").alias("form_id"), F.col("canonical_form").alias("surface")).distinct()


def _gone(spark: SparkSession, sf: str) -> DataFrame:
    """Roots for expansions: lexemes that are deleted, whose surroundings are to be reviewed."""
    return _entities(spark, sf, "LEXEME").filter("deleted_at is not null").select(F.col("resolved_id").alias("root")).distinct()


# ---------------------------------------------------------------- claims and entities


@query(f"WITH {sql.LEX} SELECT claim_id, source, raw_lemma, lemma normalized_lemma, pos canonical_pos FROM nl")
def claims_lexemes(spark, sf):
    return cl.normalized_lexemes(_claims(spark, sf)).drop("raw_payload")


@query(f"WITH {sql.LEX}, {sql.FORMS} SELECT claim_id, source, raw_lemma, lemma normalized_lemma, surface, features, pos FROM nf")
def claims_forms(spark, sf):
    return cl.normalized_forms(_claims(spark, sf))


@query(f"WITH {sql.LEX} SELECT id, lemma, normalized_lemma, pos, lexeme_key, sources, n_claims FROM lex")
def entity_lexemes(spark, sf):
    return _lexemes(spark, sf).select("id", "lemma", "normalized_lemma", "pos", "lexeme_key", F.array_join("source_presence", ",").alias("sources"), "n_claims")


@query(f"""WITH {sql.LEX}, {sql.FORMS} SELECT {sql.uuid5("'eng:' || ns || ':' || f")} id, min(surface) surface, ns normalized_surface, f features, min({sql.form_type('lemma', 'ns')}) form_type
FROM nfs GROUP BY ns, f""")
def entity_forms(spark, sf):
    return cl.resolved_forms(cl.normalized_forms(_claims(spark, sf))).drop("form_key")


@query(f"""WITH {sql.LEX}, {sql.FORMS} SELECT DISTINCT {sql.uuid5("subject_id || ':HAS_FORM:' || object_id")} id, subject_id, object_id FROM hf""")
def entity_has_form(spark, sf):
    return cl.has_form_relations(cl.normalized_forms(_claims(spark, sf)), _lexemes(spark, sf)).select("id", "subject_id", "object_id")


@query(f"""WITH {sql.LEX}, {sql.FORMS} SELECT DISTINCT {sql.uuid5("subject_id || ':HAS_FORM:' || object_id")} relation_id, claim_id FROM hf""")
def provenance_has_form(spark, sf):
    norm, lex = cut(cl.normalized_forms(_claims(spark, sf))), cut(_lexemes(spark, sf))  # each is read twice
    return cl.form_claims(cl.has_form_relations(norm, lex), norm, lex)


@query(f"""WITH {sql.LEX}, fr AS (SELECT {sql.norm("coalesce(json_extract_string(object_json, '$.Word'), subject)")} w, TRY_CAST(json_extract_string(object_json, '$.FREQcount') AS BIGINT) raw_count,
    round(coalesce(TRY_CAST(json_extract_string(object_json, '$.Lg10WF') AS DOUBLE), 0) + 3, 2) zipf_score, extracted_at::TIMESTAMPTZ t, id FROM staging_claims WHERE claim_type = 'USAGE_FREQUENCY'),
la AS (SELECT w, arg_max(row(raw_count, zipf_score), row(t, id)) f FROM fr GROUP BY w)
SELECT lex.id, normalized_lemma, pos, f[1] raw_count, f[2] zipf_score, CASE WHEN f[2] >= 5 THEN 'VERY_COMMON' WHEN f[2] >= 4 THEN 'COMMON' WHEN f[2] >= 3 THEN 'LESS_COMMON' WHEN w IS NOT NULL THEN 'RARE' END tier
FROM lex LEFT JOIN la ON la.w = normalized_lemma""")
def entity_frequency(spark, sf):
    return cl.lexeme_frequencies(_claims(spark, sf), _lexemes(spark, sf)).select("id", "normalized_lemma", "pos", "raw_count", "zipf_score", "tier")


@query(f"""WITH parts AS (SELECT 'synsets' t, synset_id id, lemma, pos FROM staging_semantic_relations WHERE relation_type = 'MEMBER'
UNION ALL SELECT 'raw_lexical_entries', source_id, lemma, pos FROM staging_lexical_entries UNION ALL SELECT 'raw_inflections', id, lemma, pos FROM raw_inflections)
SELECT DISTINCT t source_table, id source_id, {sql.uuid5("'lexeme:' || lower(trim(lemma, ' ')) || ':' || lower(trim(pos, ' '))", NS_DNS)} resolved_id, CASE t WHEN 'synsets' THEN 'EXPLICIT' ELSE 'ATTESTED' END epistemic_status
FROM parts WHERE lemma IS NOT NULL AND pos IS NOT NULL""")
def entity_crosswalk(spark, sf):
    return cl.crosswalk({
        "synsets": table(spark, sf, "staging_semantic_relations").filter("relation_type = 'MEMBER'").select(F.col("synset_id").alias("id"), "lemma", "pos"),
        "raw_lexical_entries": table(spark, sf, "staging_lexical_entries").select(F.col("source_id").alias("id"), "lemma", "pos"),
        "raw_inflections": table(spark, sf, "raw_inflections").select("id", "lemma", "pos"),
    })


@query(f"""SELECT id, arg_min(row(source, lemma), row({sql.rank('source')}, source, lemma))[1] source, arg_min(row(source, lemma), row({sql.rank('source')}, source, lemma))[2] lemma
FROM (SELECT synset_id id, source, lemma FROM staging_semantic_relations WHERE relation_type = 'MEMBER') GROUP BY id""")
def dedupe_first_wins(spark, sf):
    m = table(spark, sf, "staging_semantic_relations").filter("relation_type = 'MEMBER'").select(F.col("synset_id").alias("id"), "source", "lemma")
    return cl.keyed_first(m, ["id"], [cl.source_rank(F.col("source")), F.col("source"), F.col("lemma")])


@query("""SELECT user_id, arg_max(row(event_type, value), row(ts, event_id))[1] event_type, arg_max(row(event_type, value), row(ts, event_id))[2] AS "value" FROM events GROUP BY user_id""")
def dedupe_last_wins(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("l")).select("user_id", "l.*")


# ---------------------------------------------------------------- features and inflection


@query(f"""WITH t AS (SELECT DISTINCT inflection_id, {sql.tags('features')} tg FROM staging_inflections)
SELECT inflection_id, {sql.tags_pos('tg')} pos, {', '.join(f"{sql.feature('tg', n)} {n}" for n in tx.FEATURE_NAMES)} FROM t""")
def features_parsed(spark, sf):
    t = table(spark, sf, "staging_inflections").select("inflection_id", tx.feature_tags(F.col("features")).alias("tg")).distinct()
    return t.select("inflection_id", tx.bundle_pos(F.col("tg")).alias("pos"), tx.bundle_features(F.col("tg")).alias("f")).select("inflection_id", "pos", "f.*")


@query("""SELECT DISTINCT id, array_to_string(coalesce(TRY_CAST(TRY_CAST(features_json AS JSON) AS VARCHAR[]), list_filter(list_transform(string_split(features_json, ','), lambda x: trim(x, ' ')), lambda x: x <> ''), []), '|') features
FROM raw_inflections""")
def features_json_list(spark, sf):
    return table(spark, sf, "raw_inflections").select("id", F.array_join(tx.json_list(F.col("features_json")), "|").alias("features")).distinct()


_SLOTS = list(dict.fromkeys((p, s) for p, s, *_ in sql.RULES))
_INFLECTED = f"""
base AS (SELECT DISTINCT normalized_lemma lemma, pos FROM lex WHERE pos IN ('VERB', 'ADJECTIVE', 'NOUN')),
irr(lemma, pos, slot, surface, form_type) AS (VALUES {', '.join(str(r) for r in sql.IRREGULAR)}),
reg AS ({' UNION ALL '.join(f"SELECT lemma, pos, '{s}' slot, {sql.slot('lemma', p, s)} surface FROM base WHERE pos = '{p}'" for p, s in _SLOTS)}),
infl AS (SELECT *, 'INFLECTED' form_type FROM reg WHERE (lemma, pos, slot) NOT IN (SELECT (lemma, pos, slot) FROM irr)
  UNION ALL SELECT irr.* FROM irr JOIN base USING (lemma, pos))
"""


@query(f"WITH {sql.LEX}, {_INFLECTED} SELECT * FROM infl")
def inflection_slots(spark, sf):
    return inflect(_lexemes(spark, sf).select(F.col("normalized_lemma").alias("lemma"), "pos"))


@query(f"""WITH {sql.LEX}, {_INFLECTED}, r AS (SELECT lex.id lid, infl.*, {sql.uuid5("'form:' || surface || ':' || slot")} fid, {sql.uuid5("'form:' || infl.lemma")} bid, CASE form_type WHEN 'INFLECTED' THEN 'GENERATED' ELSE 'ATTESTED' END e
  FROM infl JOIN lex ON lex.normalized_lemma = infl.lemma AND lex.pos = infl.pos)
SELECT DISTINCT lid subject_id, 'HAS_FORM' relation_type, fid object_id, e evidence_type FROM r UNION SELECT bid, 'INFLECTS_TO', fid, e FROM r""")
def inflection_relations(spark, sf):
    return inference.materialize_inflections(_lexemes(spark, sf).select("id", "normalized_lemma", "pos"))[1]


_DEG = """WITH f AS (SELECT lemma lexeme, CASE WHEN features LIKE '%CMPR%' THEN 'comparative' WHEN features LIKE '%SPRL%' THEN 'superlative' END degree, form FROM staging_inflections)
SELECT lexeme, max(form) FILTER (degree = 'comparative') comparative, max(form) FILTER (degree = 'superlative') superlative FROM f GROUP BY 1 HAVING comparative IS NOT NULL AND superlative IS NOT NULL"""


@query(_DEG)
def inflection_degrees(spark, sf):
    f = F.col("features")
    degree = F.when(f.contains("CMPR"), "comparative").when(f.contains("SPRL"), "superlative")
    return inference.degree_chains(table(spark, sf, "staging_inflections").select(F.col("lemma").alias("lexeme"), degree.alias("degree"), "form"))


_TOKENS = r"""tok AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}]+')) w FROM documents)"""


def _token_lexemes(spark: SparkSession, sf: str) -> DataFrame:
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("normalized_lemma")).distinct()
    return words.select(F.explode(F.array(F.lit("VERB"), F.lit("ADJECTIVE"))).alias("pos"), "normalized_lemma").withColumn("id", F.concat_ws(":", "normalized_lemma", "pos"))


_DERIVED = f"""WITH {_TOKENS},
c AS (SELECT w || ':VERB' subject_id, 'PREFIX_RE_VERB' rule, regexp_extract(w, '^re([a-z]+)$', 1) s, 'VERB' p, false sfx FROM tok
  UNION ALL SELECT w || ':ADJECTIVE', 'PREFIX_UN_ADJ', regexp_extract(w, '^un([a-z]+)$', 1), 'ADJECTIVE', false FROM tok
  UNION ALL SELECT w || ':ADJECTIVE', 'SUFFIX_ABLE_VERB_TO_ADJ', regexp_extract(w, '^([a-z]+)able$', 1), 'VERB', true FROM tok),
d AS (SELECT subject_id, rule, CASE WHEN s IN (SELECT w FROM tok) THEN s WHEN sfx AND s || 'e' IN (SELECT w FROM tok) THEN s || 'e' END base, p FROM c WHERE len(s) >= 3)
"""


@query(_DERIVED + f"""SELECT {sql.uuid5("'rel:inferred:' || subject_id || ':' || base || ':' || p")} id, subject_id, base || ':' || p object_id, rule, base base_lemma FROM d WHERE base IS NOT NULL""")
def inferred_derivations(spark, sf):
    lex = _token_lexemes(spark, sf)
    none = lex.select(F.col("id").alias("subject_id"), F.col("id").alias("object_id")).limit(0)
    return inference.infer_derivations(lex, none).select("id", "subject_id", "object_id", "rule", "base_lemma")


_REGISTERED = f"""WITH lx AS (SELECT DISTINCT resolved_id id, lower(trim(canonical_form, ' ')) w, CASE lower(trim(pos, ' ')) {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in tx.POS_TAGS.items())} END p
  FROM resolved_entities WHERE entity_type = 'LEXEME'),
c AS (SELECT id subject_id, 'PREFIX_RE_VERB' rule, regexp_extract(w, '^re([a-z]+)$', 1) s, 'VERB' bp, false sfx FROM lx WHERE p = 'VERB'
  UNION ALL SELECT id, 'PREFIX_UN_ADJ', regexp_extract(w, '^un([a-z]+)$', 1), 'ADJECTIVE', false FROM lx WHERE p = 'ADJECTIVE'
  UNION ALL SELECT id, 'SUFFIX_ABLE_VERB_TO_ADJ', regexp_extract(w, '^([a-z]+)able$', 1), 'VERB', true FROM lx WHERE p = 'ADJECTIVE'),
t AS (SELECT subject_id, rule, bp, s, 0 t FROM c WHERE len(s) >= 3 UNION ALL SELECT subject_id, rule, bp, s || 'e', 1 FROM c WHERE len(s) >= 3 AND sfx),
b AS (SELECT subject_id, rule, arg_min(row(lx.id, s), row(t, lx.id, s)) b FROM t JOIN lx ON lx.w = s AND lx.p = bp GROUP BY 1, 2),
d AS (SELECT subject_id, b[1] object_id, rule, b[2] base_lemma FROM b)
"""


@query(_REGISTERED + f"""SELECT {sql.uuid5("'rel:inferred:' || subject_id || ':' || object_id")} id, * FROM d WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE relation_type = 'DERIVED_FROM' AND e.source_id = d.subject_id AND e.target_id = d.object_id)""")
def inferred_derivations_registered(spark, sf):
    lex = _lex_nodes(spark, sf).select(F.col("lexeme_id").alias("id"), F.lower(F.trim("lemma")).alias("normalized_lemma"), tx.map_pos(F.col("pos")).alias("pos")).distinct()
    stated = _edges(spark, sf).filter("relation_type = 'DERIVED_FROM'").select(F.col("source_id").alias("subject_id"), F.col("target_id").alias("object_id"))
    return inference.infer_derivations(lex, stated).select("id", "subject_id", "object_id", "rule", "base_lemma")


# ---------------------------------------------------------------- resolution


@query("""SELECT subject, predicate, count(DISTINCT object_json) n_values, count(*) n_claims FROM staging_claims GROUP BY 1, 2 HAVING n_values > 1""")
def conflicts(spark, sf):
    return resolution.conflicts(_claims(spark, sf), ["subject", "predicate"], "object_json")


@query(f"""WITH k AS (SELECT subject, predicate FROM staging_claims GROUP BY 1, 2 HAVING count(DISTINCT object_json) > 1)
SELECT DISTINCT {sql.uuid5("'conflict:' || subject || ':' || predicate || ':' || object_json")} relation_id, id claim_id, subject, predicate, object_json, 'UNCERTAIN' evidence_type, 0.5::DOUBLE confidence, 'CONFLICTING' resolution_status
FROM staging_claims JOIN k USING (subject, predicate)""")
def conflict_relations(spark, sf):
    return resolution.conflict_relations(_claims(spark, sf), ["subject", "predicate"], "object_json", "id")


@query("""SELECT l_orderkey, l_linestatus, count(DISTINCT l_returnflag) n_values, count(*) n_claims FROM lineitem GROUP BY 1, 2 HAVING n_values > 1""")
def conflicts_at_scale(spark, sf):
    return resolution.conflicts(table(spark, sf, "lineitem"), ["l_orderkey", "l_linestatus"], "l_returnflag")


@query("""WITH e AS (SELECT DISTINCT id, source_id, relation_type, target_id, provenance FROM edges WHERE source_id IS NOT NULL AND target_id IS NOT NULL),
n AS (SELECT source_id, relation_type, target_id, count(DISTINCT provenance) n_sources FROM e GROUP BY ALL)
SELECT e.id, n_sources, CASE WHEN n_sources > 1 THEN 1.0 ELSE 0.85 END::DOUBLE confidence FROM e JOIN n USING (source_id, relation_type, target_id)""")
def corroboration(spark, sf):
    e = _edges(spark, sf).select("id", "source_id", "relation_type", "target_id", "provenance").filter("source_id is not null and target_id is not null").distinct().withColumn("confidence", F.lit(0.85))
    return resolution.corroborated(e, ["source_id", "relation_type", "target_id"], "provenance", "confidence").select("id", "n_sources", "confidence")


@query("""SELECT source_key, arg_min(object_json, row(extracted_at::TIMESTAMPTZ, id)) object_json, count(*) n_claims, CASE WHEN count(DISTINCT object_json) <= 1 THEN 'RESOLVED' ELSE 'CONFLICTING' END status,
CASE WHEN count(DISTINCT object_json) > 1 THEN 'UNCERTAIN' WHEN count(*) > 1 THEN 'ATTESTED' ELSE 'EXPLICIT' END evidence_type, CASE WHEN count(DISTINCT object_json) <= 1 THEN 1.0 ELSE 0.5 END::DOUBLE confidence,
array_to_string(list_sort(list(DISTINCT id)), ',') claim_ids FROM staging_claims GROUP BY source_key""")
def resolved_claims(spark, sf):
    r = resolution.resolve_claims(_claims(spark, sf), ["source_key"], "object_json", "id", [F.try_to_timestamp("extracted_at"), F.col("id")])
    return r.withColumn("claim_ids", F.array_join("claim_ids", ","))


@query("""SELECT lemma, form, coalesce(array_to_string(list_sort(list(DISTINCT features) FILTER (features IS NOT NULL)), ','), '') provenance FROM staging_inflections GROUP BY 1, 2""")
def provenance_lists(spark, sf):
    return resolution.provenance_list(table(spark, sf, "staging_inflections"), ["lemma", "form"], "features", "provenance")


_ERRATA = """WITH q AS (SELECT DISTINCT resolved_id id, CASE entity_type WHEN 'FORM' THEN 'MISSING_ETYMOLOGY' ELSE 'COMPETING_SOURCES' END ct, CASE WHEN deleted_at IS NULL THEN 'DONE' ELSE 'PENDING' END st FROM resolved_entities)
"""


def _errata(spark: SparkSession, sf: str):
    e = _entities(spark, sf).select(
        F.col("resolved_id").alias("id"), F.col("resolved_id").alias("target_entity_id"), F.when(F.col("entity_type") == "FORM", "MISSING_ETYMOLOGY").otherwise("COMPETING_SOURCES").alias("conflict_type"),
        F.when(F.col("deleted_at").isNull(), "DONE").otherwise("PENDING").alias("status"),
    ).distinct()
    return resolution.process_errata(e, _edges(spark, sf))


@query(_ERRATA + "SELECT id, id target_entity_id, ct conflict_type, CASE WHEN st = 'DONE' THEN 'DONE' WHEN ct = 'MISSING_ETYMOLOGY' THEN 'RESOLVED_UNATTESTED' ELSE 'RESOLVED_CONFLICT_PRESERVED' END status FROM q")
def errata_queue(spark, sf):
    return _errata(spark, sf)[0]


@query(_ERRATA + """, p AS (SELECT id FROM q WHERE st = 'PENDING')
SELECT id, source_id, target_id, CASE WHEN source_id IN (SELECT id FROM p) OR target_id IN (SELECT id FROM p) THEN 'UNCERTAIN' ELSE epistemic_class END epistemic_class FROM edges""")
def errata_edges(spark, sf):
    return _errata(spark, sf)[1].select("id", "source_id", "target_id", "epistemic_class")


@query("SELECT id, source_id, target_id FROM edges WHERE source_id IN (SELECT resolved_id FROM resolved_entities) AND target_id IN (SELECT resolved_id FROM resolved_entities)")
def edges_healed(spark, sf):
    return resolution.heal_edges(_edges(spark, sf), _entities(spark, sf).select(F.col("resolved_id").alias("node_id"))).select("id", "source_id", "target_id")


@query("""WITH e AS (SELECT source_id n FROM edges UNION ALL SELECT target_id FROM edges) SELECT n node_id, count(*) n_edges FROM e WHERE n IS NOT NULL AND n NOT IN (SELECT resolved_id FROM resolved_entities) GROUP BY 1""")
def nodes_missing(spark, sf):
    return resolution.missing_nodes(_edges(spark, sf), _entities(spark, sf).select(F.col("resolved_id").alias("node_id")))


@query("SELECT canonical_form, arg_min(resolved_id, row(created_at, resolved_id)) resolved_id FROM resolved_entities WHERE entity_type = 'LEXEME' GROUP BY 1")
def first_lexeme_ids(spark, sf):
    return resolution.first_ids(_entities(spark, sf, "LEXEME"), "canonical_form", "resolved_id", "created_at")


@query(f"""WITH lex AS (SELECT DISTINCT resolved_id l, lower(trim(canonical_form, ' ')) s FROM resolved_entities WHERE entity_type = 'LEXEME' AND trim(canonical_form, ' ') <> ''),
f AS (SELECT DISTINCT resolved_id f, lower(trim(canonical_form, ' ')) s FROM resolved_entities WHERE entity_type = 'FORM'), h AS (SELECT source_id l, s FROM edges JOIN f ON f = target_id WHERE relation_type = 'HAS_FORM'),
k AS (SELECT s, min(f) f FROM f GROUP BY 1), o AS (SELECT l, coalesce(f, {sql.uuid5("'form:' || lex.s")}) fid, f IS NULL n FROM lex LEFT JOIN k USING (s) WHERE (l, lex.s) NOT IN (SELECT (l, s) FROM h))
SELECT l lexeme_id, fid form_id, {sql.uuid5("l || ':HAS_FORM:' || fid || ':CANONICAL'")} edge_id, n is_new_form FROM o""")
def canonical_forms(spark, sf):
    return resolution.canonical_forms(_lex_nodes(spark, sf), _form_nodes(spark, sf), _edges(spark, sf))


@query("SELECT shape, \"type\", id, 'ATTESTED' status FROM (SELECT *, " + sql.uuid5("'morpheme:' || shape || ':' || \"type\"") + " id FROM (VALUES " + ", ".join(map(str, inference.AFFIXES)) + ") v(shape, \"type\"))")
def morpheme_catalogue(spark, sf):
    return inference.affix_morphemes(spark)


# ---------------------------------------------------------------- graph

_ADJ = "WITH RECURSIVE roots AS (SELECT DISTINCT resolved_id root FROM resolved_entities WHERE entity_type = 'LEXEME' AND deleted_at IS NOT NULL),\n"


def _adj(types: str, directed: bool = False) -> str:
    back = "" if directed else f" UNION SELECT target_id, source_id FROM edges WHERE source_id IS NOT NULL AND target_id IS NOT NULL AND relation_type IN ({types})"
    return f"adj AS (SELECT DISTINCT source_id node, target_id other FROM edges WHERE source_id IS NOT NULL AND target_id IS NOT NULL AND relation_type IN ({types}){back}),\n"


@query(_ADJ + _adj("'DERIVED_FROM', 'VARIANT_OF'") + """w AS (SELECT root, root node, 0 d FROM roots UNION SELECT w.root, a.other, d + 1 FROM w JOIN adj a ON a.node = w.node WHERE d < 3)
SELECT root, node, min(d)::INT AS "depth" FROM w GROUP BY 1, 2""")
def graph_reach(spark, sf):
    return graph.reach(graph.adjacency(_edges(spark, sf), ["DERIVED_FROM", "VARIANT_OF"]), _gone(spark, sf), 3)


@query(_ADJ + _adj("'HAS_FORM', 'INFLECTS_TO'", True) + """w AS (SELECT root, root node, root path, 0 d FROM roots UNION ALL SELECT w.root, a.other, path || '->' || a.other, d + 1 FROM w JOIN adj a ON a.node = w.node WHERE d < 3)
SELECT root, node, d::INT AS "depth", path FROM w WHERE d > 0""")
def graph_paths(spark, sf):
    w = graph.walks(graph.adjacency(_edges(spark, sf).distinct(), ["HAS_FORM", "INFLECTS_TO"], directed=True), _gone(spark, sf), 3, simple=False)
    return w.withColumn("path", F.array_join("path", "->"))


@query(_ADJ + _adj("'DERIVED_FROM'") + """w AS (SELECT root, root node, [root] path, 0 d FROM roots UNION ALL SELECT w.root, a.other, list_append(path, a.other), d + 1 FROM w JOIN adj a ON a.node = w.node WHERE d < 3 AND NOT list_contains(path, a.other))
SELECT DISTINCT root, node, d::INT AS "depth" FROM w WHERE d > 0""")
def graph_family(spark, sf):
    return graph.walks(graph.adjacency(_edges(spark, sf), ["DERIVED_FROM"]), _gone(spark, sf), 3).select("root", "node", "depth").distinct()


@query(_ADJ + _adj("'DERIVED_FROM', 'HAS_FORM'") + """w AS (SELECT root, root node, 0 d FROM roots UNION SELECT w.root, a.other, d + 1 FROM w JOIN adj a ON a.node = w.node WHERE d < 3), n AS (SELECT DISTINCT root, node FROM w),
ends AS (SELECT source_id node, id, source_id, relation_type, target_id FROM edges UNION SELECT target_id, id, source_id, relation_type, target_id FROM edges),
x AS (SELECT DISTINCT root, id, source_id, relation_type, target_id FROM n JOIN ends USING (node))
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY id, source_id, target_id, relation_type) r FROM x) WHERE r <= 200""")
def graph_incident_edges(spark, sf):
    return nearby.first_edges(_edges(spark, sf), _gone(spark, sf), graph.NEIGHBOUR_TYPES, 3, 200)


@query("""WITH n AS (SELECT DISTINCT resolved_id node_id FROM resolved_entities), e AS (SELECT source_id x FROM edges UNION ALL SELECT target_id FROM edges), c AS (SELECT x, count(*) d FROM e GROUP BY 1)
SELECT node_id, coalesce(d, 0) degree FROM n LEFT JOIN c ON x = node_id""")
def graph_degrees(spark, sf):
    return graph.degrees(_entities(spark, sf).select(F.col("resolved_id").alias("node_id")), _edges(spark, sf))


@query("""WITH n AS (SELECT DISTINCT resolved_id, entity_type FROM resolved_entities), e AS (SELECT source_id x FROM edges UNION SELECT target_id FROM edges),
g AS (SELECT entity_type node_type, count(*) n_nodes, count(*) FILTER (resolved_id NOT IN (SELECT x FROM e WHERE x IS NOT NULL)) n_isolated FROM n GROUP BY 1)
SELECT node_type, n_nodes, n_isolated, n_isolated / n_nodes ratio, n_isolated / n_nodes <= CASE node_type WHEN 'LEXEME' THEN 0.15 ELSE 0.05 END ok FROM g""")
def graph_isolation(spark, sf):
    nodes = _entities(spark, sf).select(F.col("resolved_id").alias("node_id"), F.col("entity_type").alias("node_type"))
    return graph.isolation(nodes, _edges(spark, sf), {"LEXEME": 0.15, "FORM": 0.05})


@query("""SELECT DISTINCT least(a.source_id, a.target_id) a, greatest(a.source_id, a.target_id) b FROM edges a JOIN edges b ON a.source_id = b.target_id AND a.target_id = b.source_id WHERE a.relation_type = 'SYNONYM_OF' AND b.relation_type = 'SYNONYM_OF'""")
def graph_mutual(spark, sf):
    return graph.mutual_pairs(_edges(spark, sf), "SYNONYM_OF")


@query("""SELECT id, source_id, target_id, s IS NULL source_missing, t IS NULL target_missing FROM edges
LEFT JOIN (SELECT DISTINCT resolved_id s FROM resolved_entities) a ON s = source_id LEFT JOIN (SELECT DISTINCT resolved_id t FROM resolved_entities) b ON t = target_id WHERE s IS NULL OR t IS NULL""")
def graph_dangling(spark, sf):
    return graph.dangling(_edges(spark, sf), _entities(spark, sf).select(F.col("resolved_id").alias("node_id"))).select("id", "source_id", "target_id", "source_missing", "target_missing")


@query("""WITH m AS (SELECT DISTINCT synset_id, lemma FROM staging_semantic_relations WHERE relation_type = 'MEMBER' AND lemma IS NOT NULL)
SELECT DISTINCT a.lemma, r.relation_type, b.lemma other_lemma FROM staging_semantic_relations r JOIN m a ON a.synset_id = r.synset_id JOIN m b ON b.synset_id = r.target_synset_id""")
def graph_member_pairs(spark, sf):
    t = table(spark, sf, "staging_semantic_relations")
    return graph.member_pairs(t, t.filter("relation_type = 'MEMBER'"))


_NODES = """WITH lex AS (SELECT DISTINCT resolved_id lexeme_id, canonical_form lemma, pos FROM resolved_entities WHERE entity_type = 'LEXEME'),
form AS (SELECT DISTINCT resolved_id form_id, canonical_form surface FROM resolved_entities WHERE entity_type = 'FORM'),
par AS (SELECT DISTINCT lexeme_id, lemma, form_id, surface FROM edges e JOIN lex ON lexeme_id = source_id JOIN form ON form_id = target_id WHERE relation_type = 'HAS_FORM')
"""


@query(_NODES + "SELECT * FROM par")
def paradigms(spark, sf):
    return graph.forms_of(_lex_nodes(spark, sf).drop("pos").distinct(), _edges(spark, sf), _form_nodes(spark, sf)).distinct()


@query(_NODES + """, t AS (SELECT DISTINCT lower(trim(lemma, ' ')) t FROM documents WHERE lemma IS NOT NULL)
SELECT DISTINCT t term, 'LEXEME' kind, lexeme_id id FROM lex JOIN t ON t = lower(trim(lemma, ' ')) UNION SELECT t, 'FORM', form_id FROM par JOIN t ON t = lower(trim(surface, ' '))""")
def lookup_terms(spark, sf):
    terms = table(spark, sf, "documents").filter("lemma is not null").select(F.lower(F.trim("lemma")).alias("term")).distinct()
    lex = _lex_nodes(spark, sf)
    a = lex.select(F.lower(F.trim("lemma")).alias("term"), F.lit("LEXEME").alias("kind"), F.col("lexeme_id").alias("id"))
    b = graph.forms_of(lex, _edges(spark, sf), _form_nodes(spark, sf)).select(F.lower(F.trim("surface")).alias("term"), F.lit("FORM").alias("kind"), F.col("form_id").alias("id"))
    return a.unionByName(b).distinct().join(terms, "term")


@query("""SELECT DISTINCT e.id relation_id, e.source_id, e.target_id, e.epistemic_class = 'UNCERTAIN' is_conflicting, c.id claim_id, c.source, c.predicate FROM edges e JOIN relation_claims r ON r.relation_id = e.id JOIN staging_claims c ON c.id = r.claim_id""")
def why_connected(spark, sf):
    e = _edges(spark, sf).select(F.col("id").alias("relation_id"), "source_id", "target_id", (F.col("epistemic_class") == "UNCERTAIN").alias("is_conflicting"))
    b = table(spark, sf, "relation_claims").select("relation_id", "claim_id").distinct()
    return e.join(b, "relation_id").join(_claims(spark, sf).select(F.col("id").alias("claim_id"), "source", "predicate"), "claim_id").distinct()


_WORDS = _NODES + f""", ids AS (SELECT DISTINCT lexeme_id FROM lex), mem AS (SELECT DISTINCT {sql.uuid5("'lexeme:' || lower(trim(lemma, ' ')) || ':' || lower(trim(pos, ' '))", NS_DNS)} lexeme_id, synset_id
  FROM staging_semantic_relations WHERE relation_type = 'MEMBER' AND lemma IS NOT NULL AND pos IS NOT NULL),
def AS (SELECT DISTINCT synset_id, definition FROM staging_semantic_relations WHERE relation_type = 'SYNSET_DEF' AND definition IS NOT NULL),
rows AS (SELECT DISTINCT lexeme_id, 'SENSE' kind, synset_id id, definition AS "text" FROM mem LEFT JOIN def USING (synset_id) WHERE lexeme_id IN (FROM ids)
  UNION ALL SELECT DISTINCT lexeme_id, 'FORM', form_id, surface FROM par
  UNION ALL SELECT DISTINCT source_id, 'BASE', target_id, NULL FROM edges WHERE relation_type = 'DERIVED_FROM' AND source_id IN (FROM ids)
  UNION ALL SELECT DISTINCT target_id, 'DERIVED', source_id, NULL FROM edges WHERE relation_type = 'DERIVED_FROM' AND target_id IN (FROM ids))
"""


def _word_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Senses are the synsets that a lexeme is a MEMBER of, by the registry's key, with the definitions that these have."""
    t = table(spark, sf, "staging_semantic_relations")
    members = cl.crosswalk({"synsets": t.filter("relation_type = 'MEMBER'").select(F.col("synset_id").alias("id"), "lemma", "pos")})
    defined = t.filter("relation_type = 'SYNSET_DEF' and definition is not null").select(F.col("synset_id").alias("sense_id"), "definition").distinct()
    senses = members.select(F.col("resolved_id").alias("lexeme_id"), F.col("source_id").alias("sense_id")).join(defined, "sense_id", "left")
    return graph.word_rows(_lex_nodes(spark, sf), senses, _edges(spark, sf), _form_nodes(spark, sf))


@query(_WORDS + "SELECT * FROM rows")
def word_page_rows(spark, sf):
    return _word_rows(spark, sf)


@query(_WORDS + """, n AS (SELECT lexeme_id, count(*) FILTER (kind = 'SENSE') s, count(*) FILTER (kind = 'FORM') f, count(*) FILTER (kind IN ('BASE', 'DERIVED')) k FROM rows GROUP BY 1)
SELECT lexeme_id, lemma, coalesce(s, 0) n_senses, coalesce(f, 0) n_forms, coalesce(k, 0) n_links FROM (SELECT DISTINCT lexeme_id, lemma FROM lex) LEFT JOIN n USING (lexeme_id)""")
def word_page_counts(spark, sf):
    return graph.word_counts(_lex_nodes(spark, sf), _word_rows(spark, sf))


# ---------------------------------------------------------------- search


@query("SELECT DISTINCT resolved_id, canonical_form FROM resolved_entities WHERE starts_with(canonical_form, 'tr')")
def search_prefix(spark, sf):
    return search.prefix(_entities(spark, sf), "canonical_form", "tr").select("resolved_id", "canonical_form").distinct()


@query("SELECT DISTINCT resolved_id, canonical_form FROM resolved_entities WHERE canonical_form >= 'tr' AND canonical_form < 'ts'")
def search_prefix_range(spark, sf):
    return search.prefix_range(_entities(spark, sf), "canonical_form", "tr").select("resolved_id", "canonical_form").distinct()


_AUTO = """WITH t AS (SELECT DISTINCT resolved_id, canonical_form, CASE epistemic_status WHEN 'EXPLICIT' THEN 1 WHEN 'ATTESTED' THEN 2 WHEN 'GENERATED' THEN 3 ELSE 4 END tr FROM resolved_entities)"""


def _tiered(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("epistemic_status")
    tier = F.when(s == "EXPLICIT", "VERY_COMMON").when(s == "ATTESTED", "COMMON").when(s == "GENERATED", "LESS_COMMON").otherwise("RARE")
    return _entities(spark, sf).select("resolved_id", "canonical_form", tier.alias("tier")).distinct()


@query(_AUTO + " SELECT resolved_id, canonical_form FROM t WHERE starts_with(canonical_form, 'tr') ORDER BY tr, len(canonical_form), canonical_form, resolved_id LIMIT 20")
def search_autocomplete(spark, sf):
    return search.autocomplete(_tiered(spark, sf), "canonical_form", "tier", "resolved_id", "tr").select("resolved_id", "canonical_form")


@query(_AUTO + """ SELECT prefix, resolved_id, r::INT AS "rank" FROM (SELECT *, substr(canonical_form, 1, 3) prefix, row_number() OVER (PARTITION BY substr(canonical_form, 1, 3) ORDER BY tr, len(canonical_form), canonical_form, resolved_id) r
FROM t WHERE len(canonical_form) >= 3) WHERE r <= 5""")
def search_autocomplete_all(spark, sf):
    return search.autocomplete_all(_tiered(spark, sf), "canonical_form", "tier", "resolved_id", 3).select("prefix", "resolved_id", "rank")


_FOLD = "strip_accents(lower({}))"
_INDEX = f"""WITH ix AS (SELECT unnest(regexp_extract_all({_FOLD.format('text')}, '[\\p{{L}}\\p{{N}}]+')) term, doc_id FROM documents WHERE text IS NOT NULL),
n AS (SELECT term, doc_id, count(*) n FROM ix GROUP BY 1, 2)"""


@query(_INDEX + " SELECT term, count(*) n_targets, sum(n)::BIGINT n FROM n GROUP BY 1")
def search_index_terms(spark, sf):
    ix = search.inverted_index(table(spark, sf, "documents"), "doc_id", "DOCUMENT", "text")
    return ix.groupBy("term").agg(F.count(F.lit(1)).alias("n_targets"), F.sum("n").alias("n"))


@query(_INDEX + """ SELECT doc_id target_id, sum(n)::BIGINT hits FROM n WHERE term = 'older' OR starts_with(term, 'spell') GROUP BY 1 HAVING bool_or(term = 'older') AND bool_or(starts_with(term, 'spell')) ORDER BY hits DESC, target_id LIMIT 20""")
def search_text(spark, sf):
    return search.search(search.inverted_index(table(spark, sf, "documents"), "doc_id", "DOCUMENT", "text"), "older, spell*!")


_CODES = "'ABCDEFGIJKLMNOPQRSTUVXYZ', '012301202245501262301202'"
_SDX = f"""(SELECT DISTINCT resolved_id, canonical_form w, CASE WHEN upper(canonical_form[1]) IN ('H', 'W') THEN '7' ELSE translate(upper(canonical_form[1]), {_CODES}) END
  || translate(regexp_replace(regexp_replace(upper(substr(canonical_form, 2)), '[HW]', '', 'g'), '[^A-Z]', 'A', 'g'), {_CODES}) c FROM resolved_entities WHERE canonical_form IS NOT NULL)"""
_ONCE = "c"
for _d in "0123456":
    _ONCE = f"regexp_replace({_ONCE}, '{_d}+', '{_d}', 'g')"


@query(f"""SELECT DISTINCT CASE WHEN regexp_matches(w, '^[A-Za-z]') THEN upper(w[1]) || rpad(substr(replace(substr({_ONCE}, 2), '0', ''), 1, 3), 3, '0') ELSE w END phonetic_key, 'SOUNDEX' algorithm, resolved_id target_id FROM {_SDX}""")
def search_phonetic(spark, sf):
    return search.phonetic_index(_entities(spark, sf), "resolved_id", "canonical_form")


# ---------------------------------------------------------------- gates, audits, inventory

_GATES = {
    "epistemic_domain": "SELECT 1 FROM edges WHERE epistemic_class IS NULL OR epistemic_class NOT IN ('EXPLICIT', 'GENERATED', 'ATTESTED', 'INFERRED', 'UNCERTAIN')",
    "endpoint_types": "SELECT 1 FROM edges WHERE (relation_type = 'HAS_FORM' AND NOT (source_type = 'LEXEME' AND target_type = 'FORM')) OR (relation_type IN ('DERIVED_FROM', 'SYNONYM_OF', 'ANTONYM_OF') AND NOT (source_type = 'LEXEME' AND target_type = 'LEXEME'))",
    "dangling_edges": "SELECT 1 FROM edges WHERE source_id IS NULL OR target_id IS NULL OR source_id NOT IN (SELECT resolved_id FROM resolved_entities) OR target_id NOT IN (SELECT resolved_id FROM resolved_entities)",
    "explicit_without_claim": "SELECT 1 FROM edges WHERE epistemic_class = 'EXPLICIT' AND id NOT IN (SELECT relation_id FROM relation_claims)",
    "bridge_without_claim": "SELECT 1 FROM relation_claims WHERE claim_id NOT IN (SELECT id FROM staging_claims)",
    "trap_pairs": "SELECT 1 FROM edges e JOIN (SELECT DISTINCT resolved_id i, lower(canonical_form) l FROM resolved_entities WHERE entity_type = 'LEXEME') a ON a.i = source_id JOIN (SELECT DISTINCT resolved_id i, lower(canonical_form) l FROM resolved_entities WHERE entity_type = 'LEXEME') b ON b.i = target_id WHERE (least(a.l, b.l), greatest(a.l, b.l)) IN (VALUES ('car', 'carpet'), ('art', 'article'), ('riddance', 'ride'), ('go', 'goal'), ('pan', 'panic'), ('ear', 'early'), ('rat', 'ratio'), ('he', 'hero'), ('cat', 'catch'))",
    "lexeme_form_collisions": "SELECT DISTINCT resolved_id FROM resolved_entities WHERE entity_type = 'LEXEME' AND resolved_id IN (SELECT resolved_id FROM resolved_entities WHERE entity_type = 'FORM')",
    "has_form_to_lexeme": "SELECT 1 FROM edges WHERE relation_type = 'HAS_FORM' AND target_id IN (SELECT resolved_id FROM resolved_entities WHERE entity_type = 'LEXEME')",
    "derivation_cycles": "SELECT DISTINCT least(a.source_id, a.target_id), greatest(a.source_id, a.target_id) FROM edges a JOIN edges b ON a.source_id = b.target_id AND a.target_id = b.source_id WHERE a.relation_type = 'DERIVED_FROM' AND b.relation_type = 'DERIVED_FROM'",
    "weak_prefix_derivations": "SELECT 1 FROM edges e JOIN (SELECT DISTINCT resolved_id i, canonical_form l FROM resolved_entities WHERE entity_type = 'LEXEME') a ON a.i = source_id JOIN (SELECT DISTINCT resolved_id i, canonical_form l FROM resolved_entities WHERE entity_type = 'LEXEME') b ON b.i = target_id WHERE relation_type = 'DERIVED_FROM' AND epistemic_class NOT IN ('EXPLICIT', 'ATTESTED') AND (starts_with(a.l, b.l) OR starts_with(b.l, a.l))",
    "phonetic_edges": "SELECT 1 FROM edges WHERE relation_type LIKE '%PHONETIC%' OR relation_type LIKE '%SOUNDEX%'",
}


@query(" UNION ALL ".join(f"SELECT '{g}' gate, count(*) violations, count(*) = 0 passed FROM ({q})" for g, q in _GATES.items()))
def gate_report(spark, sf):
    return gates.lexical_report(_edges(spark, sf), _entities(spark, sf), table(spark, sf, "relation_claims"), _claims(spark, sf))


@query("""WITH e AS (SELECT DISTINCT source_id, target_id FROM edges WHERE relation_type = 'MORPHOLOGICALLY_RELATED')
SELECT source_id, target_id FROM e WHERE (source_id, target_id) IN (SELECT (a.source_id, b.target_id) FROM e a JOIN e b ON a.target_id = b.source_id)""")
def gate_shortcuts(spark, sf):
    return gates.shortcuts(_edges(spark, sf), "MORPHOLOGICALLY_RELATED")


@query("SELECT canonical_form, count(DISTINCT pos) n FROM resolved_entities WHERE entity_type = 'LEXEME' GROUP BY 1 HAVING n > 1")
def gate_shared_paradigms(spark, sf):
    df = _entities(spark, sf, "LEXEME").withColumn("k", F.lit(1))
    return gates.shared_paradigms(df, "k", "pos", "canonical_form").select("canonical_form", "n")


@query(f"SELECT resolved_id, resolution_key FROM resolved_entities WHERE resolved_id IS DISTINCT FROM {sql.uuid5('resolution_key', NS_DNS)}")
def gate_wrong_ids(spark, sf):
    return gates.wrong_ids(_entities(spark, sf), "resolved_id", F.col("resolution_key")).select("resolved_id", "resolution_key")


@query("""WITH a AS (SELECT coalesce(provenance, 'none') p, count(*) n FROM edges GROUP BY 1), b AS (SELECT coalesce(provenance, 'none') p, count(*) n FROM (SELECT DISTINCT * REPLACE (coalesce(provenance, 'none') AS provenance) FROM edges) GROUP BY 1)
SELECT a.p provenance, a.n a, b.n b FROM a JOIN b ON a.p = b.p WHERE a.n <> b.n""")
def gate_parity(spark, sf):
    e = _edges(spark, sf).withColumn("provenance", F.coalesce("provenance", F.lit("none")))
    return gates.count_parity(e, e.distinct(), ["provenance"])


@query("SELECT relation_type, epistemic_class, source_type, target_type, count(*) n FROM edges GROUP BY ALL")
def inventory_edges(spark, sf):
    return _edges(spark, sf).groupBy("relation_type", "epistemic_class", "source_type", "target_type").agg(F.count(F.lit(1)).alias("n"))


_ALL = ["edges", "pronunciations", "relation_claims", "resolved_entities", "staging_claims", "staging_inflections", "staging_lexical_entries", "staging_semantic_relations"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) n FROM {t}" for t in _ALL))
def inventory_tables(spark, sf):
    return export.inventory({t: table(spark, sf, t) for t in _ALL})


@query("SELECT DISTINCT pos FROM staging_lexical_entries EXCEPT SELECT DISTINCT pos FROM staging_inflections")
def domain_difference(spark, sf):
    return table(spark, sf, "staging_lexical_entries").select("pos").subtract(table(spark, sf, "staging_inflections").select("pos"))


@query("SELECT canonical_form FROM resolved_entities WHERE entity_type = 'FORM' AND pos = 'n' INTERSECT SELECT canonical_form FROM resolved_entities WHERE entity_type = 'FORM' AND pos = 'v'")
def domain_intersection(spark, sf):
    f = _entities(spark, sf, "FORM")
    return f.filter("pos = 'n'").select("canonical_form").intersect(f.filter("pos = 'v'").select("canonical_form"))


@query("SELECT lemma FROM staging_lexical_entries UNION SELECT lemma FROM staging_inflections UNION SELECT lemma FROM raw_inflections")
def domain_union(spark, sf):
    one = lambda t: table(spark, sf, t).select("lemma")
    return one("staging_lexical_entries").unionByName(one("staging_inflections")).unionByName(one("raw_inflections")).distinct()


@query("""SELECT DISTINCT resolved_id, canonical_form, notation, transcription FROM resolved_entities LEFT JOIN pronunciations ON target_id = resolved_id AND target_type = entity_type""")
def pronunciations_of(spark, sf):
    p = table(spark, sf, "pronunciations").select(F.col("target_id").alias("resolved_id"), F.col("target_type").alias("entity_type"), "notation", "transcription")
    return _entities(spark, sf).select("resolved_id", "entity_type", "canonical_form").join(p, ["resolved_id", "entity_type"], "left").select("resolved_id", "canonical_form", "notation", "transcription").distinct()


# ---------------------------------------------------------------- workspace


def _records(spark: SparkSession, sf: str, local: bool) -> DataFrame:
    e = table(spark, sf, "events")
    return e.filter(F.col("event_type").isin("view", "click") if local else ~F.col("event_type").isin("view", "click")).select("user_id", "event_type", "value", F.struct("ts", "event_id").alias("v"))


_LWW = """WITH r AS (SELECT user_id, event_type, value, ts, event_id FROM events) SELECT user_id, arg_max(event_type, row(ts, event_id)) event_type, arg_max(value, row(ts, event_id)) AS "value" FROM r GROUP BY 1"""


@query(_LWW)
def workspace_sync(spark, sf):
    newest = lambda df: df.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value", "v"), "v").alias("r")).select("user_id", "r.*")
    return workspace.last_write_wins(newest(_records(spark, sf, True)), newest(_records(spark, sf, False)), "user_id", "v").drop("v")


@query("""SELECT event_id, user_id FROM events e WHERE event_type <> 'error' AND event_id >= coalesce((SELECT max(event_id) FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error'), -1)""")
def workspace_tombstones(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    stones = e.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("deleted_rev"))
    return workspace.apply_tombstones(e.filter("event_type <> 'error'"), stones, "user_id", "event_id").select("event_id", "user_id")


@query("SELECT user_id, count(*) sync_version, max(event_id) event_id, count(*) % 2 = 0 is_deleted FROM events WHERE event_type = 'click' GROUP BY 1")
def workspace_toggles(spark, sf):
    return workspace.toggles(table(spark, sf, "events").filter("event_type = 'click'"), "user_id", ["event_id"])


@query("SELECT event_id, user_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id LIMIT 50")
def workspace_favourites(spark, sf):
    return workspace.favourites(table(spark, sf, "events").filter("event_type = 'purchase'"), "ts", "event_id", 50).select("event_id", "user_id")


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT k FROM events")
def json_path(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# ---------------------------------------------------------------- sources and export


def _kaikki(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "kaikki_english_20260805").filter("word is not null and pos is not null")


@query("""WITH s AS (SELECT DISTINCT record_id, word, pos, list_filter(list_transform(senses, lambda x: array_to_string(list_filter(x.glosses, lambda g: g IS NOT NULL), '; ')), lambda g: g <> '') g FROM kaikki_english_20260805 WHERE word IS NOT NULL AND pos IS NOT NULL)
SELECT DISTINCT word, pos, i::INT AS "rank", v gloss FROM s, LATERAL (SELECT unnest(g) v, generate_subscripts(g, 1) i)""")
def source_senses(spark, sf):
    return readers.kaikki_senses(_kaikki(spark, sf)).distinct()


@query("""SELECT DISTINCT word, pos, f.form form, array_to_string(f.tags, ';') tags FROM (SELECT word, pos, unnest(forms) f FROM kaikki_english_20260805 WHERE word IS NOT NULL AND pos IS NOT NULL) WHERE f.form NOT LIKE '% %'""")
def source_forms(spark, sf):
    return readers.kaikki_forms(_kaikki(spark, sf)).distinct()


@query("""SELECT DISTINCT d.word derived, base FROM (SELECT word base, unnest(derived) d FROM kaikki_english_20260805 WHERE word IS NOT NULL AND pos IS NOT NULL) WHERE d.word IS NOT NULL AND d.word NOT LIKE '% %'""")
def source_derived(spark, sf):
    return readers.kaikki_derived(_kaikki(spark, sf)).distinct()


@query("""SELECT DISTINCT word, pos, list_filter(list_transform(sounds, lambda s: s.ipa), lambda x: x IS NOT NULL)[1] ipa FROM kaikki_english_20260805 WHERE word IS NOT NULL AND pos IS NOT NULL""")
def source_first_ipa(spark, sf):
    return readers.first_ipa(_kaikki(spark, sf)).distinct()


@query("""WITH l AS (SELECT lexicon x FROM oewn_2025), s AS (SELECT unnest(x.synsets) s FROM l), e AS (SELECT unnest(x.entries) e FROM l), m AS (SELECT e.lemma, unnest(e.senses) q FROM e)
SELECT DISTINCT claim_type, source_key, subject FROM (SELECT 'SYNSET' claim_type, s.id source_key, s.id subject FROM s UNION ALL SELECT 'LEXICAL_ENTRY', e.id, e.lemma FROM e UNION ALL SELECT 'SENSE_MEMBERSHIP', q.id, lemma FROM m)""")
def source_oewn_claims(spark, sf):
    return readers.oewn_claims(table(spark, sf, "oewn_2025")).select("claim_type", "source_key", "subject").distinct()


@query("""WITH l AS (SELECT lexicon x FROM oewn_2025), e AS (SELECT unnest(x.entries) e FROM l), m AS (SELECT e.lemma, unnest(e.senses) q FROM e),
c AS (SELECT 'OEWN_2025' s, q.id k, lemma, '{"synset":"' || q.synset || '"}' o FROM m WHERE q.id IS NOT NULL AND lemma IS NOT NULL AND q.synset IS NOT NULL)
SELECT DISTINCT """ + sql.uuid5("s || '|' || k || '|SENSE_MEMBERSHIP|' || lemma || '|MEMBER_OF_SYNSET|' || o") + """ id, k source_key, lemma subject, o object_json FROM c""")
def source_oewn_memberships(spark, sf):
    """Whole claims with their ids; null parts of an id are left out of it, so rows that have any are not compared."""
    c = readers.oewn_claims(table(spark, sf, "oewn_2025")).filter("claim_type = 'SENSE_MEMBERSHIP' and source_key is not null and subject is not null and object_json <> '{}'")
    return c.select("id", "source_key", "subject", "object_json").distinct()


@query(_NODES + """, own AS (SELECT DISTINCT lexeme_id FROM lex WHERE lower(lemma) IN (SELECT lower(lemma) FROM documents)),
ids AS (SELECT lexeme_id n FROM own UNION SELECT target_id FROM edges WHERE relation_type = 'HAS_FORM' AND source_id IN (SELECT lexeme_id FROM own))
SELECT id, source_id, target_id FROM edges WHERE source_id IN (SELECT n FROM ids) AND target_id IN (SELECT n FROM ids)""")
def export_slice(spark, sf):
    return export.closed_slice(table(spark, sf, "documents").filter("lemma is not null").select("lemma"), _lex_nodes(spark, sf), _edges(spark, sf)).select("id", "source_id", "target_id")


@query(_NODES + """, p AS (SELECT lexeme_id, count(DISTINCT form_id) n FROM par GROUP BY 1) SELECT lexeme_id, lemma, pos, coalesce(n, 0) n_forms FROM (SELECT DISTINCT lexeme_id, lemma, pos FROM lex) LEFT JOIN p USING (lexeme_id)""")
def export_ontolex(spark, sf):
    lex = _lex_nodes(spark, sf)
    one = lex.select("lexeme_id", "lemma").distinct()
    j = export.ontolex(lex, graph.forms_of(one, _edges(spark, sf), _form_nodes(spark, sf)))
    path = lambda p: F.get_json_object("json", p)
    n = F.size(F.from_json(path("$.lexicalForm"), "array<struct<writtenRep string>>"))
    parts = j.select("lexeme_id", path("$.canonicalForm.writtenRep").alias("lemma"), path("$.partOfSpeech").alias("pos"), n.alias("n"))
    return parts.groupBy("lexeme_id", "lemma", "pos").agg(F.sum("n").alias("n_forms"))
