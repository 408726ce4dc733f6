"""Queries of composed builds, layers, drawn subgraphs and planted gates, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.functions import text as tx
from verbarium.functions.ids import NS_DNS, NS_URL
from verbarium.operators import claims as cl
from verbarium.operators import gates, graph, inference, layers, resolution
from verbarium.plans import build as batch
from verbarium.plans import lexical, sql
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


# ---------------------------------------------------------------- the batch build

_BUILD = f"""WITH {sql.LEX}, {sql.FORMS},
fm AS (SELECT {sql.uuid5("'eng:' || ns || ':' || f")} id, min(surface) surface, ns, f, min({sql.form_type('lemma', 'ns')}) form_type FROM nfs GROUP BY ns, f),
c AS (SELECT id subject_id, pos p, 'VERB' bp, regexp_extract(normalized_lemma, '^re([a-z]+)$', 1) s, false sfx FROM lex WHERE pos = 'VERB'
  UNION ALL SELECT id, pos, 'ADJECTIVE', regexp_extract(normalized_lemma, '^un([a-z]+)$', 1), false FROM lex WHERE pos = 'ADJECTIVE'
  UNION ALL SELECT id, pos, 'VERB', regexp_extract(normalized_lemma, '^([a-z]+)able$', 1), true FROM lex WHERE pos = 'ADJECTIVE'),
d AS (SELECT DISTINCT subject_id, coalesce(a.id, b.id) object_id FROM c LEFT JOIN lex a ON a.normalized_lemma = s AND a.pos = bp LEFT JOIN lex b ON sfx AND b.normalized_lemma = s || 'e' AND b.pos = bp
  WHERE len(s) >= 3 AND coalesce(a.id, b.id) IS NOT NULL),
g AS (SELECT l.id lexeme, fm.id form, list_contains({sql.tags('fm.f')}, 'CMPR') cmp, list_contains({sql.tags('fm.f')}, 'SPRL') sup
  FROM (SELECT DISTINCT subject_id, object_id FROM hf) h JOIN lex l ON l.id = h.subject_id AND l.pos = 'ADJECTIVE' JOIN fm ON fm.id = h.object_id),
k AS (SELECT DISTINCT max(form) FILTER (cmp) a, max(form) FILTER (sup AND NOT cmp) b FROM g GROUP BY lexeme HAVING a IS NOT NULL AND b IS NOT NULL),
rel AS (SELECT DISTINCT {sql.uuid5("subject_id || ':HAS_FORM:' || object_id")} id, subject_id, 'HAS_FORM' relation_type, object_id, 'EXPLICIT' evidence_type, 1.0::DOUBLE confidence FROM hf
  UNION ALL SELECT {sql.uuid5("'rel:inferred:' || subject_id || ':' || object_id")}, subject_id, 'DERIVED_FROM', object_id, 'INFERRED', 0.75::DOUBLE FROM d
  UNION ALL SELECT {sql.uuid5("a || ':INFLECTS_TO:' || b")}, a, 'INFLECTS_TO', b, 'GENERATED', 0.85::DOUBLE FROM k),
br AS (SELECT DISTINCT {sql.uuid5("subject_id || ':HAS_FORM:' || object_id")} relation_id, claim_id FROM hf
  UNION SELECT id, {sql.uuid5("'claim:inferred:' || id")} FROM rel WHERE evidence_type = 'INFERRED'),
ix AS (SELECT id target_id, 'LEXEME' target_type, lemma term, normalized_lemma || ' ' || pos extra_text FROM lex UNION ALL SELECT id, 'FORM', surface, ns || ' ' || form_type FROM fm)
"""


def _built(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return batch.build(table(spark, sf, "staging_claims"))


@query(_BUILD + "SELECT * FROM rel")
def build_relations(spark, sf):
    return _built(spark, sf)["relations"].select("id", "subject_id", "relation_type", "object_id", "evidence_type", "confidence")


@query(_BUILD + "SELECT * FROM ix")
def build_search_index(spark, sf):
    return _built(spark, sf)["search_index"]


@query(_BUILD + "SELECT relation_id, claim_id FROM br")
def build_evidence(spark, sf):
    return _built(spark, sf)["relation_claims"]


@query(_BUILD + f""" SELECT 'lexemes' AS name, count(*) n FROM lex UNION ALL SELECT 'forms', count(*) FROM fm UNION ALL SELECT 'morphemes', {len(inference.AFFIXES)}::BIGINT UNION ALL SELECT 'structures', count(*) FROM d
UNION ALL SELECT 'relations', count(*) FROM rel UNION ALL SELECT 'relation_claims', count(*) FROM br UNION ALL SELECT 'search_index', count(*) FROM ix""")
def build_manifest(spark, sf):
    return batch.manifest(_built(spark, sf)).select("name", "n")


_BUILD_GATES = {
    "lexeme_keys": "SELECT lexeme_key FROM lex GROUP BY 1 HAVING count(*) > 1", "form_keys": "SELECT ns, f FROM fm GROUP BY 1, 2 HAVING count(*) > 1",
    "subjects": "FROM rel WHERE subject_id NOT IN (SELECT id FROM lex UNION SELECT id FROM fm)", "objects": "FROM rel WHERE object_id NOT IN (SELECT id FROM lex UNION SELECT id FROM fm)",
    "evidence_domain": "FROM rel WHERE evidence_type NOT IN ('EXPLICIT', 'GENERATED', 'ATTESTED', 'INFERRED', 'UNCERTAIN')",
    "explicit_without_claim": "FROM rel WHERE evidence_type = 'EXPLICIT' AND id NOT IN (SELECT relation_id FROM br)",
    "bridge_without_claim": f"FROM br WHERE claim_id NOT IN (SELECT id FROM staging_claims UNION SELECT {sql.uuid5(chr(39) + 'claim:inferred:' + chr(39) + ' || id')} FROM rel)",
    "parts_of_speech": "FROM lex WHERE pos NOT IN ('NOUN', 'VERB', 'ADJECTIVE', 'ADVERB', 'PRONOUN', 'DETERMINER', 'PREPOSITION', 'CONJUNCTION', 'INTERJECTION', 'NUMERAL', 'PARTICLE', 'AFFIX', 'OTHER')",
    "affixes": "FROM (VALUES " + ", ".join(f"('{a}')" for a, _ in inference.AFFIXES) + ") v(s) WHERE len(trim(s, '-')) NOT BETWEEN 1 AND 8",
    "form_of_form": "FROM rel WHERE relation_type = 'HAS_FORM' AND (subject_id NOT IN (SELECT id FROM lex) OR object_id NOT IN (SELECT id FROM fm))",
}


@query(_BUILD + " UNION ALL ".join(f"SELECT '{g}' gate, count(*) violations, count(*) = 0 passed FROM ({q})" for g, q in _BUILD_GATES.items()))
def build_gates(spark, sf):
    return gates.report(batch.build_gates(_built(spark, sf), table(spark, sf, "staging_claims")))


@query(f"""WITH f AS (SELECT lemma lexeme, {sql.tags('features')} t, form FROM staging_inflections WHERE form IS NOT NULL),
c AS (SELECT DISTINCT max(form) FILTER (list_contains(t, 'CMPR')) a, max(form) FILTER (list_contains(t, 'SPRL') AND NOT list_contains(t, 'CMPR')) b FROM f GROUP BY lexeme HAVING a IS NOT NULL AND b IS NOT NULL)
SELECT {sql.uuid5("a || ':INFLECTS_TO:' || b")} id, a subject_id, b object_id, 'GENERATED' evidence_type, 0.85::DOUBLE confidence FROM c""")
def degree_relations(spark, sf):
    f = table(spark, sf, "staging_inflections").select(F.col("lemma").alias("lexeme"), inference.degree_of(F.col("features")).alias("degree"), "form").filter("degree is not null")
    return inference.degree_relations(f).select("id", "subject_id", "object_id", "evidence_type", "confidence")


_FIRST = """lx AS (SELECT canonical_form lemma, arg_min(resolved_id, row(created_at, resolved_id)) lexeme_id FROM resolved_entities WHERE entity_type = 'LEXEME' GROUP BY 1),
fx AS (SELECT canonical_form surface, arg_min(resolved_id, row(created_at, resolved_id)) form_id FROM resolved_entities WHERE entity_type = 'FORM' GROUP BY 1)"""


def _first(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    return resolution.first_ids(lexical._entities(spark, sf, kind), "canonical_form", "resolved_id", "created_at")


@query(f"""WITH {_FIRST}, s AS (SELECT lemma, form, features tags, array_to_string(list_sort(list(DISTINCT source)), ',') p FROM staging_inflections WHERE lemma IS NOT NULL AND form IS NOT NULL GROUP BY ALL),
e AS (SELECT coalesce(lexeme_id, {sql.uuid5("lower(s.lemma) || ':noun'", NS_DNS)}) l, coalesce(form_id, {sql.uuid5('lower(form)', NS_URL)}) f, tags, p, lexeme_id IS NULL nl, form_id IS NULL nf FROM s LEFT JOIN lx ON lx.lemma = s.lemma LEFT JOIN fx ON surface = form)
SELECT DISTINCT {sql.uuid5("'has_form:' || l || ':' || f || ':' || coalesce(tags, 'None')")} id, l source_id, f target_id, tags features, p provenance, nl new_lexeme, nf new_form FROM e""")
def edges_mapped(spark, sf):
    said = table(spark, sf, "staging_inflections").select("lemma", "form", F.col("features").alias("tags"), "source")
    lex = _first(spark, sf, "LEXEME").withColumnsRenamed({"canonical_form": "lemma", "resolved_id": "lexeme_id"})
    return resolution.mapped_edges(said, lex, _first(spark, sf, "FORM").withColumnsRenamed({"canonical_form": "surface", "resolved_id": "form_id"}))


@query(f"""SELECT DISTINCT {sql.uuid5("lower(lemma) || ':noun'", NS_DNS)} lexeme_id, lemma, 'noun' pos FROM staging_inflections WHERE lemma IS NOT NULL AND lemma NOT IN (SELECT canonical_form FROM resolved_entities WHERE entity_type = 'LEXEME')""")
def lexemes_missing(spark, sf):
    return resolution.missing_lexemes(table(spark, sf, "staging_inflections"), lexical._lex_nodes(spark, sf))


@query(lexical._DERIVED + f""", m AS (SELECT subject_id, rule, base FROM d WHERE base IS NOT NULL),
p AS (SELECT subject_id, CASE rule WHEN 'PREFIX_RE_VERB' THEN 're-:PREFIX' WHEN 'PREFIX_UN_ADJ' THEN 'un-:PREFIX' ELSE base || ':ROOT' END k, 1 place FROM m
  UNION ALL SELECT subject_id, CASE rule WHEN 'SUFFIX_ABLE_VERB_TO_ADJ' THEN '-able:SUFFIX' ELSE base || ':ROOT' END, 2 FROM m),
t AS (SELECT subject_id, {sql.uuid5("'morpheme:' || k")} m, place FROM p)
SELECT DISTINCT {sql.uuid5("subject_id || ':CONTAINS_MORPHEME:' || m")} id, subject_id source_id, m target_id, place::INT place FROM t""")
def morpheme_edges(spark, sf):
    lex = lexical._token_lexemes(spark, sf)
    none = lex.select(F.col("id").alias("subject_id"), F.col("id").alias("object_id")).limit(0)  # every derivation counts, stated or not
    return inference.contains_morphemes(inference.infer_derivations(lex, none)).select("id", "source_id", "target_id", "place")


# ---------------------------------------------------------------- evidence

@query("""SELECT id, conflict_type, CASE st WHEN 'PENDING' THEN CASE conflict_type WHEN 'MISSING_ETYMOLOGY' THEN 'RESOLVED_UNATTESTED' ELSE 'RESOLVED_CONFLICT_PRESERVED' END ELSE st END status,
CASE st WHEN 'PENDING' THEN 'UNCERTAIN' END epistemic_class, CASE st WHEN 'PENDING' THEN key END source_a, CASE st WHEN 'PENDING' THEN CASE conflict_type WHEN 'MISSING_ETYMOLOGY' THEN 'UNATTESTED' ELSE 'CONFLICT_PRESERVED' END END resolved_as
FROM (SELECT DISTINCT resolved_id id, resolution_key key, CASE entity_type WHEN 'FORM' THEN 'MISSING_ETYMOLOGY' ELSE 'COMPETING_SOURCES' END conflict_type, CASE WHEN deleted_at IS NULL THEN 'DONE' ELSE 'PENDING' END st FROM resolved_entities)""")
def errata_records(spark, sf):
    e = lexical._entities(spark, sf)
    queue = e.select(
        F.col("resolved_id").alias("id"), F.when(F.col("entity_type") == "FORM", "MISSING_ETYMOLOGY").otherwise("COMPETING_SOURCES").alias("conflict_type"), F.col("resolution_key").alias("source_a_claim"),
        F.lit(None).cast("string").alias("source_b_claim"), F.lit(None).cast("string").alias("metadata"), F.when(F.col("deleted_at").isNull(), "DONE").otherwise("PENDING").alias("status"),
    ).distinct()
    record = F.get_json_object("metadata", "$.conflict_record")
    return resolution.errata_records(queue).select("id", "conflict_type", "status", "epistemic_class", F.get_json_object(record, "$.source_a").alias("source_a"), F.get_json_object(record, "$.resolved_as").alias("resolved_as"))


@query("""WITH r AS (SELECT DISTINCT e.id, lower(trim(canonical_form, ' ')) k FROM edges e JOIN resolved_entities n ON n.resolved_id = e.target_id WHERE relation_type = 'DERIVED_FROM' AND entity_type = 'LEXEME')
SELECT DISTINCT r.id relation_id, c.id claim_id FROM r JOIN staging_claims c ON lower(trim(c.subject, ' ')) = k WHERE c.predicate = 'ATTESTED_AS'""")
def etymology_evidence(spark, sf):
    """The tables state no etymologies, so derivations and attestations of their base stand for them."""
    base = lexical._lex_nodes(spark, sf).select(F.col("lexeme_id").alias("target_id"), F.col("lemma").alias("subject_lemma"))
    r = lexical._edges(spark, sf).filter("relation_type = 'DERIVED_FROM'").join(base, "target_id").select("id", F.lit("ETYMOLOGICALLY_FROM").alias("relation_type"), "subject_lemma")
    c = table(spark, sf, "staging_claims").withColumn("predicate", F.when(F.col("predicate") == "ATTESTED_AS", "ETYMOLOGICALLY_FROM").otherwise(F.col("predicate")))
    return resolution.etymology_claims(r, c)


# ---------------------------------------------------------------- drawn subgraphs and word pages

_MEMBERS = f"""mem AS (SELECT DISTINCT {sql.uuid5("'lexeme:' || lower(trim(lemma, ' ')) || ':' || lower(trim(pos, ' '))", NS_DNS)} lexeme_id, synset_id
  FROM staging_semantic_relations WHERE relation_type = 'MEMBER' AND lemma IS NOT NULL AND pos IS NOT NULL),
syn AS (SELECT synset_id, min(definition) definition, min(pos) pos FROM staging_semantic_relations WHERE relation_type = 'SYNSET_DEF' GROUP BY 1),
sen AS (SELECT lexeme_id, synset_id || ':' || lexeme_id sense_id, synset_id, definition, pos FROM mem LEFT JOIN syn USING (synset_id))"""


def _senses(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "staging_semantic_relations")
    m = cl.crosswalk({"synsets": t.filter("relation_type = 'MEMBER'").select(F.col("synset_id").alias("id"), "lemma", "pos")}).select(F.col("resolved_id").alias("lexeme_id"), F.col("source_id").alias("synset_id"))
    return graph.senses_with_synsets(m.withColumn("sense_id", F.concat_ws(":", "synset_id", "lexeme_id")), t.filter("relation_type = 'SYNSET_DEF'"))


@query(f"WITH {_MEMBERS} SELECT * FROM sen")
def word_senses(spark, sf):
    return _senses(spark, sf)


_SUBGRAPH = lexical._NODES + f""", {_MEMBERS}, lx AS (SELECT lexeme_id, min(lemma) lemma FROM lex GROUP BY 1), q AS (SELECT DISTINCT lower(trim(lemma, ' ')) term FROM documents WHERE lemma IS NOT NULL),
root AS (SELECT term, lexeme_id, lemma FROM (SELECT term, lexeme_id, lemma, row_number() OVER (PARTITION BY term ORDER BY lexeme_id) r FROM lx JOIN q ON term = lower(trim(lemma, ' '))) WHERE r <= 5),
own AS (SELECT source_id l, target_id o, relation_type t, min(epistemic_class) e FROM edges GROUP BY 1, 2, 3), fl AS (SELECT form_id o, min(surface) label FROM form GROUP BY 1),
fs AS (SELECT * FROM (SELECT term, l, o, t, e, label, row_number() OVER (PARTITION BY term, l ORDER BY o) r FROM own JOIN root ON lexeme_id = l JOIN fl USING (o) WHERE t = 'HAS_FORM') WHERE r <= 25),
bs AS (SELECT * FROM (SELECT term, l, o, t, e, x.lemma label, row_number() OVER (PARTITION BY term, l ORDER BY o) r FROM own JOIN root ON root.lexeme_id = l JOIN lx x ON x.lexeme_id = o WHERE t = 'DERIVED_FROM') WHERE r <= 10),
ss AS (SELECT * FROM (SELECT term, lexeme_id, sense_id, definition, synset_id, row_number() OVER (PARTITION BY term, lexeme_id ORDER BY sense_id, definition, synset_id) r FROM sen JOIN root USING (lexeme_id) WHERE definition IS NOT NULL) WHERE r <= 10)
"""


def _subgraph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    terms = table(spark, sf, "documents").select(F.col("lemma").alias("term"))
    return graph.subgraph(terms, lexical._lex_nodes(spark, sf), lexical._edges(spark, sf), lexical._form_nodes(spark, sf), _senses(spark, sf))


@query(_SUBGRAPH + """SELECT term, id, "type", min(label) label FROM (SELECT term, lexeme_id id, 'LEXEME' AS "type", lemma label FROM root UNION ALL SELECT term, o, 'FORM', label FROM fs UNION ALL SELECT term, o, 'LEXEME', label FROM bs
UNION ALL SELECT term, sense_id, 'SENSE', CASE WHEN len(definition) > 28 THEN substr(definition, 1, 25) || '...' ELSE definition END FROM ss UNION ALL SELECT term, synset_id, 'SYNSET', 'Concept: ' || substr(synset_id, 1, 8) FROM ss) GROUP BY ALL""")
def graph_subgraph_nodes(spark, sf):
    return _subgraph(spark, sf)[0]


@query(_SUBGRAPH + """SELECT DISTINCT term, l source, o target, t relation_type, e evidence_type FROM fs UNION SELECT term, l, o, t, e FROM bs UNION SELECT term, lexeme_id, sense_id, 'HAS_SENSE', 'EXPLICIT' FROM ss UNION SELECT term, sense_id, synset_id, 'MEMBER_OF_SYNSET', 'EXPLICIT' FROM ss""")
def graph_subgraph_links(spark, sf):
    return _subgraph(spark, sf)[1]


@query(lexical._NODES + "SELECT DISTINCT lexeme_id, form_id, surface FROM par WHERE lower(trim(lemma, ' ')) = lower(trim(surface, ' '))")
def word_base_forms(spark, sf):
    return graph.base_forms(lexical._lex_nodes(spark, sf), lexical._edges(spark, sf), lexical._form_nodes(spark, sf))


# ---------------------------------------------------------------- layers

_PAIRS = "SELECT DISTINCT lemma, lemma || ' (' || lang || ')' other_lemma, 'NOUN' pos, CASE WHEN source IS NULL THEN 'UNCERTAIN' ELSE 'ATTESTED' END e FROM documents WHERE lang <> 'en' AND lemma IS NOT NULL"


def _translations(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The tables have no dictionary of another language: documents in one, by the lemma they are about, stand for its entries."""
    d = table(spark, sf, "documents").filter("lang <> 'en' and lemma is not null")
    pairs = d.select("lemma", F.concat(F.col("lemma"), F.lit(" ("), F.col("lang"), F.lit(")")).alias("other_lemma"), F.lit("NOUN").alias("other_pos"), F.when(F.col("source").isNull(), "UNCERTAIN").otherwise("ATTESTED").alias("epistemic_class"))
    return layers.translation_layer(pairs, lexical._lex_nodes(spark, sf))


_OTHER = sql.uuid5("'lex.es.' || other_lemma", NS_DNS)


@query(f"SELECT {_OTHER} lexeme_id, other_lemma lemma, min(pos) pos FROM ({_PAIRS}) GROUP BY other_lemma")
def layer_translated_lexemes(spark, sf):
    return _translations(spark, sf)[0]


@query(lexical._NODES + f""", t AS (SELECT DISTINCT lexeme_id l, {_OTHER} o, e FROM ({_PAIRS}) p JOIN lex ON lex.lemma = p.lemma)
SELECT {sql.uuid5("'edge.trans.' || l || '.' || o", NS_DNS)} id, l source_id, o target_id, max(e) epistemic_class FROM t GROUP BY l, o""")
def layer_translations(spark, sf):
    return _translations(spark, sf)[1].select("id", "source_id", "target_id", "epistemic_class")


def _pronounced(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    k = table(spark, sf, "kaikki_english_20260805").select(F.col("word").alias("lemma"), F.lit("IPA").alias("notation"), F.explode("sounds.ipa").alias("transcription"))
    return layers.pronunciation_layer(k, lexical._lex_nodes(spark, sf))


_SAID = lexical._NODES + ", p AS (SELECT DISTINCT lexeme_id, lex.lemma, s.ipa t FROM (SELECT word, unnest(sounds) s FROM kaikki_english_20260805) k JOIN lex ON lex.lemma = k.word WHERE s.ipa IS NOT NULL)"


@query(_SAID + f"SELECT DISTINCT {sql.uuid5(chr(39) + 'pron.ipa.' + chr(39) + ' || lexeme_id || ' + chr(39) + '.' + chr(39) + ' || t', NS_DNS)} id, lexeme_id target_id, t transcription FROM p")
def layer_pronunciations(spark, sf):
    return _pronounced(spark, sf)[0].select("id", "target_id", "transcription")


@query(_SAID + "SELECT DISTINCT upper(lemma[1]) initial, lexeme_id target_id FROM p WHERE regexp_matches(lemma, '^[A-Za-z]')")
def layer_phonetic_index(spark, sf):
    return _pronounced(spark, sf)[1].filter(F.col("phonetic_key").rlike("^[A-Z][0-6]{3}$")).select(F.substring("phonetic_key", 1, 1).alias("initial"), "target_id").distinct()


@query(lexical._NODES + f"""SELECT DISTINCT {sql.uuid5("l.lexeme_id || ':REALIZES:' || r.synset_id")} id, l.lexeme_id source_id, r.synset_id target_id FROM staging_semantic_relations r JOIN lex l ON l.lemma = r.lemma WHERE r.relation_type = 'MEMBER' AND r.synset_id IS NOT NULL""")
def layer_constructions(spark, sf):
    """Synsets stand for constructions, which the tables do not have."""
    t = table(spark, sf, "staging_semantic_relations").filter("relation_type = 'MEMBER'")
    nodes = t.select(F.col("synset_id").alias("construction_id"), F.col("synset_id").alias("name"))
    ends = t.select("lemma", F.lit("REALIZES").alias("relation_type"), F.col("synset_id").alias("construction_id"))
    return layers.construction_layer(nodes, ends, lexical._lex_nodes(spark, sf))[1].select("id", "source_id", "target_id")


@query("""WITH n AS (SELECT DISTINCT resolved_id, entity_type FROM resolved_entities), p AS (SELECT id, target_id, CASE WHEN notation = 'IPA' THEN 'FORM' ELSE target_type END target_type FROM pronunciations)
SELECT id, target_id FROM p WHERE target_id IN (SELECT resolved_id FROM n) AND (target_id, target_type) NOT IN (SELECT (resolved_id, entity_type) FROM n)""")
def gate_mistyped_pronunciations(spark, sf):
    """IPA rows are planted as forms, so that there is something to find."""
    p = table(spark, sf, "pronunciations").withColumn("target_type", F.when(F.col("notation") == "IPA", "FORM").otherwise(F.col("target_type")))
    return layers.mistyped_pronunciations(p, lexical._entities(spark, sf).select(F.col("resolved_id").alias("node_id"), "entity_type")).select("id", "target_id")


@query("""WITH f AS (SELECT DISTINCT resolved_id FROM resolved_entities WHERE entity_type = 'FORM')
SELECT id, source_id, target_id FROM edges WHERE relation_type IN ('VARIANT_OF', 'HAS_FORM') AND (epistemic_class NOT IN ('ATTESTED', 'EXPLICIT', 'UNCERTAIN') OR source_id IN (FROM f) OR target_id IN (FROM f))""")
def gate_bad_translations(spark, sf):
    """Variants and forms are planted as translations, so that there is something to find."""
    e = lexical._edges(spark, sf).filter("relation_type in ('VARIANT_OF', 'HAS_FORM')").withColumn("relation_type", F.lit("TRANSLATION_OF"))
    return layers.bad_translations(e, lexical._entities(spark, sf).select(F.col("resolved_id").alias("node_id"), "entity_type")).select("id", "source_id", "target_id")


# ---------------------------------------------------------------- gates with planted violations

_PLANTED_NODES = [("t_car", "car", "LEXEME"), ("t_carpet", "carpet", "LEXEME"), ("t_both", "both", "LEXEME"), ("t_both", "both", "FORM")]
_PLANTED_EDGES = [
    ("x1", "t_car", "LEXEME", "DERIVED_FROM", "t_carpet", "LEXEME", "INFERRED"), ("x2", "t_carpet", "LEXEME", "DERIVED_FROM", "t_car", "LEXEME", "EXPLICIT"),
    ("x3", "t_car", "LEXEME", "HAS_FORM", "t_both", "LEXEME", "GUESSED"), ("x4", "t_car", "LEXEME", "PHONETIC_MATCH", "t_gone", "FORM", "ATTESTED"), ("x5", "t_both", "FORM", "SYNONYM_OF", "t_car", "LEXEME", "ATTESTED"),
]


@query("WITH e AS (SELECT id, source_id, source_type, relation_type, target_id, target_type, epistemic_class FROM edges UNION ALL VALUES " + ", ".join(map(str, _PLANTED_EDGES))
       + "), n AS (SELECT resolved_id, canonical_form, entity_type FROM resolved_entities UNION ALL VALUES " + ", ".join(map(str, _PLANTED_NODES)) + "), b AS (SELECT relation_id, claim_id FROM relation_claims UNION ALL VALUES ('x2', 'no claim')) "
       + " UNION ALL ".join(f"SELECT '{g}' gate, count(*) violations, count(*) = 0 passed FROM ({q.replace('FROM edges', 'FROM e').replace('JOIN edges', 'JOIN e').replace('resolved_entities', 'n').replace('relation_claims', 'b').replace('FROM e e ', 'FROM e ')})" for g, q in lexical._GATES.items()))
def gate_report_planted(spark, sf):
    cols = ["id", "source_id", "source_type", "relation_type", "target_id", "target_type", "epistemic_class"]
    e = lexical._edges(spark, sf).select(*cols).unionByName(spark.createDataFrame(_PLANTED_EDGES, ", ".join(f"{c} string" for c in cols)))
    n = lexical._entities(spark, sf).select("resolved_id", "canonical_form", "entity_type").unionByName(spark.createDataFrame(_PLANTED_NODES, "resolved_id string, canonical_form string, entity_type string"))
    b = table(spark, sf, "relation_claims").select("relation_id", "claim_id").unionByName(spark.createDataFrame([("x2", "no claim")], "relation_id string, claim_id string"))
    return gates.lexical_report(e, n, b, table(spark, sf, "staging_claims"))


@query("SELECT DISTINCT inflection_id, 'participle' form_category FROM staging_inflections WHERE list_contains(" + sql.tags("features") + ", 'PTCP') OR list_contains(" + sql.tags("features") + ", 'V.PTCP')")
def features_participles(spark, sf):
    t = table(spark, sf, "staging_inflections").select("inflection_id", tx.bundle_features(tx.feature_tags(F.col("features")))["form_category"].alias("form_category"))
    return t.filter("form_category = 'participle'").distinct()
