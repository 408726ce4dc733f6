"""Queries of the general problems: hierarchies, orphans, packed fields, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbarium.operators.hierarchy import descendants, hierarchy, taxonomy_links
from verbarium.operators.nested import dewey_nodes, dewey_table, placed_values
from verbarium.operators.orphans import lexical_orphans, orphan_counts
from verbarium.operators.packed import CANDIDATES, infer_delimiters, split_packed
from verbarium.sources.tables import table

# ---------------------------------------------------------------- 1. hierarchies


def _tree(spark: SparkSession, sf: str, with_path: bool = False) -> DataFrame:
    return hierarchy(taxonomy_links(table(spark, sf, "semantic_relations")), with_path)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    stuck = F.col("status") != "tree"
    return _tree(spark, sf).select(
        F.col("node").alias("node_id"),
        F.when(stuck, "cycle").otherwise(F.col("root")).alias("root_id"),
        F.when(F.col("status") == "cycle", -1).when(stuck, -2).otherwise(F.col("depth")).cast("int").alias("depth"),
    )


def p1_paths(spark: SparkSession, sf: str) -> DataFrame:
    return _tree(spark, sf, with_path=True).select("node", "parent", "root", "depth", "n_descendants", "status", F.array_join("path", ">").alias("path"))


def p1_descendants(spark: SparkSession, sf: str) -> DataFrame:
    return descendants(_tree(spark, sf))


def p1_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return _tree(spark, sf).filter("status <> 'tree'").groupBy("cycle_id").agg(F.count_if(F.col("status") == "cycle").alias("n_on_cycle"), F.count_if(F.col("status") == "below_cycle").alias("n_below"))


_LINKS = """
WITH RECURSIVE typed AS (
  SELECT subject_id s, object_id o, regexp_replace(upper(trim(relation_type)), '_OF$', '') k
  FROM semantic_relations WHERE subject_id IS NOT NULL AND object_id IS NOT NULL),
links AS (
  SELECT DISTINCT CASE WHEN k = 'HYPERNYM' THEN s ELSE o END child, CASE WHEN k = 'HYPERNYM' THEN o ELSE s END parent
  FROM typed WHERE k IN ('HYPERNYM', 'HYPONYM')),
nodes AS (SELECT child node FROM links UNION SELECT parent FROM links),
down AS (
  SELECT node, node root, 0 depth, node path FROM nodes WHERE node NOT IN (SELECT child FROM links)
  UNION ALL
  SELECT l.child, d.root, d.depth + 1, d.path || '>' || l.child FROM down d JOIN links l ON l.parent = d.node),
"""
_WALK = """
walk AS (
  SELECT node origin, node here, 0 n FROM nodes WHERE node NOT IN (SELECT node FROM down)
  UNION
  SELECT w.origin, l.parent, n + 1 FROM walk w JOIN links l ON l.child = w.here WHERE n < 400),
ring AS (SELECT DISTINCT origin FROM walk WHERE n > 0 AND here = origin)
"""

# ---------------------------------------------------------------- 2. orphans

_ORPHAN_TABLES = ("edges", "pronunciations", "relation_claims", "resolved_entities", "staging_claims")


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_orphans(*(table(spark, sf, t) for t in _ORPHAN_TABLES))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _orphans(spark, sf).select("ref_table", "ref_id", "ref_field", "target_id", "reason").distinct()


def p2_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_counts(_orphans(spark, sf))


_ORPHANS = """
WITH parents AS (
  SELECT entity_type pt, lower(trim(resolved_id)) key, min(created_at)::DOUBLE born, bool_and(deleted_at IS NOT NULL) gone
  FROM resolved_entities GROUP BY 1, 2
  UNION ALL
  SELECT 'claim', lower(trim(id)), min(epoch(extracted_at::TIMESTAMPTZ)), false FROM staging_claims GROUP BY 1, 2),
refs AS (
  SELECT 'edges' ref_table, id ref_id, 'source_id' ref_field, source_type pt, lower(trim(source_id)) key, created_at FROM edges
  UNION SELECT 'edges', id, 'target_id', target_type, lower(trim(target_id)), created_at FROM edges
  UNION SELECT 'pronunciations', id, 'target_id', target_type, lower(trim(target_id)), created_at FROM pronunciations
  UNION SELECT 'relation_claims', relation_id, 'claim_id', 'claim', lower(trim(claim_id)), created_at FROM relation_claims),
orphans AS (
  SELECT ref_table, ref_id, ref_field, r.key target_id, created_at,
    CASE WHEN p.key IS NULL THEN 'missing' WHEN p.gone THEN 'deleted' ELSE 'late' END reason
  FROM refs r LEFT JOIN parents p ON p.pt = r.pt AND p.key = r.key
  WHERE r.key IS NOT NULL AND (p.key IS NULL OR p.gone OR p.born > r.created_at))
"""

# ---------------------------------------------------------------- 3. packed fields


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    inf = split_packed(table(spark, sf, "staging_inflections"), F.col("inflection_id"), F.col("source"), F.col("features"))
    raw = split_packed(table(spark, sf, "raw_inflections"), F.col("id"), F.col("source"), F.col("features_json"), as_json=True)
    cols = ("src_table", "row_key", "value_pos", "feature_value")
    return inf.withColumn("src_table", F.lit("staging_inflections")).select(*cols).unionByName(raw.withColumn("src_table", F.lit("raw_inflections")).select(*cols))


def p3_delimiters(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "staging_inflections").select("source", "features").distinct()
    return infer_delimiters(rows, "source", "features").select("source", "delimiter", "n_texts", *[F.round(c, 6).alias(c) for c in ("presence", "consistency", "regularity", "score")], "rank")


def p3_staging_features(spark: SparkSession, sf: str) -> DataFrame:
    return split_packed(table(spark, sf, "staging_inflections"), F.col("inflection_id"), F.col("source"), F.col("features"))


_FEATURES = r"""
WITH t AS (SELECT DISTINCT inflection_id::VARCHAR row_key,
    regexp_extract_all(features, '[\p{L}\p{N}._-]+["'']?|"(?:[^"]|"")*"|''(?:[^'']|'''')*''') tok
  FROM staging_inflections WHERE features IS NOT NULL),
e AS (SELECT row_key, unnest(tok) tok, generate_subscripts(tok, 1) value_pos FROM t)
SELECT row_key, value_pos::INT value_pos,
  CASE WHEN tok LIKE '"%' THEN replace(tok[2:-2], '""', '"') WHEN tok LIKE '''%' THEN replace(tok[2:-2], '''''', '''')
       ELSE regexp_replace(tok, '["'']$', '') END feature_value
FROM e
"""

_CANDIDATES = ", ".join(f"({i}, {'chr(9)' if d == chr(9) else repr(d)})" for i, d in enumerate(CANDIDATES))
_DELIMITERS = r"""
WITH t AS (SELECT source, regexp_replace(features, '"(?:[^"]|"")*"|''(?:[^'']|'''')*''', 'Q', 'g') bare FROM (SELECT DISTINCT source, features FROM staging_inflections WHERE features IS NOT NULL)),
c(ord, d) AS (VALUES @CANDIDATES),
p AS (SELECT source, ord, d, instr(trim(bare, ' '), d) > 0 has, list_filter(list_transform(string_split(bare, d), lambda x: trim(x, ' ')), lambda x: x <> '') p FROM t, c),
g AS (SELECT source, ord, d, has, len(p) k, count(*) w, sum(len(list_filter(p, lambda x: regexp_matches(x, '^[\p{L}\p{N}._-]+$')))) plain FROM p GROUP BY ALL),
s AS (SELECT source, ord, d, sum(w) n, coalesce(sum(w) FILTER (has), 0) wi, coalesce(sum(w::DOUBLE * w) FILTER (has), 0) sq, coalesce(sum(w * k) FILTER (has), 0) pieces, coalesce(sum(plain) FILTER (has), 0) pl FROM g GROUP BY 1, 2, 3),
r AS (SELECT source, ord, d, n, wi / n presence, coalesce(sq / nullif(wi * wi, 0), 0) consistency, coalesce(pl / nullif(pieces, 0), 0) regularity FROM s)
SELECT source, d delimiter, n::BIGINT n_texts, round(presence, 6) presence, round(consistency, 6) consistency, round(regularity, 6) regularity, round(presence * consistency * regularity, 6) score,
  (row_number() OVER (PARTITION BY source ORDER BY presence * consistency * regularity DESC, ord))::INT AS "rank" FROM r
""".replace("@CANDIDATES", _CANDIDATES)

# ---------------------------------------------------------------- 5. nested records

_KAIKKI = ["sounds", "senses", "forms", "derived"]


def _kaikki(spark: SparkSession, sf: str, paths: set[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    key = F.concat(F.lit("kaikki:"), F.col("record_id"))
    return dewey_nodes(table(spark, sf, "kaikki_english_20260805"), key, columns or _KAIKKI, paths)


def _oewn(spark: SparkSession, sf: str, paths: set[str] | None = None) -> DataFrame:
    return dewey_nodes(table(spark, sf, "oewn_2025"), F.concat(F.lit("oewn:"), F.col("file_id")), ["lexicon"], paths)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    kaikki = _kaikki(spark, sf, {"senses.glosses", "sounds.ipa"}, ["sounds", "senses"])
    return placed_values(kaikki.unionByName(_oewn(spark, sf, {"lexicon.entries.id"})))


def p5_nodes(spark: SparkSession, sf: str) -> DataFrame:
    both = _kaikki(spark, sf).unionByName(_oewn(spark, sf))
    return both.select("root_key", "field_path", "label", "parent_label", "value").distinct()


def p5_sounds(spark: SparkSession, sf: str) -> DataFrame:
    return dewey_table(_kaikki(spark, sf, {"sounds"}, ["sounds"]), "sounds", {"ipa": "string", "audio": "string"})


def p5_examples(spark: SparkSession, sf: str) -> DataFrame:
    return dewey_table(_kaikki(spark, sf, {"senses.examples"}, ["senses"]), "senses.examples", {"text": "string", "type": "string"})


def p5_entries(spark: SparkSession, sf: str) -> DataFrame:
    return dewey_table(_oewn(spark, sf, {"lexicon.entries"}), "lexicon.entries", {"id": "string", "lemma": "string", "pos": "string"})


def p5_entry_senses(spark: SparkSession, sf: str) -> DataFrame:
    return dewey_table(_oewn(spark, sf, {"lexicon.entries.senses"}), "lexicon.entries.senses", {"id": "string", "synset": "string"})


def _unnested(alias: str, expr: str) -> str:
    return f"LATERAL (SELECT unnest({expr}) v, generate_subscripts({expr}, 1) i) {alias}"


def _nodes_of(prefix: str, path: str, place: int, up: str, array: str, fields: list, key: str, source: str, depth: int = 0) -> list[str]:
    """SELECTs of the nodes of an array of structs; ``fields``: (name, ordinal, None | "array" | fields of an array of structs)."""
    e = "abc"[depth]
    from_ = f"{source}, {_unnested(e, array)}"
    label = f"{prefix} || '{place}.' || {e}.i"
    row = lambda p, lab, parent, value: f"SELECT {key} root_key, '{p}' field_path, {lab} \"label\", {parent} parent_label, {value} AS \"value\" FROM "
    out = [row(path, label, up, "NULL::VARCHAR") + from_]
    for name, k, kind in fields:
        own = f"{path}.{name}"
        if kind is None:
            out.append(row(own, f"{label} || '.{k}'", label, f'{e}.v."{name}"') + from_)
        elif kind == "array":
            out.append(row(own, f"{label} || '.{k}.' || z.i", label, "z.v") + f"{from_}, {_unnested('z', f'{e}.v."{name}"')}")
        else:
            out += _nodes_of(f"{label} || '.'", own, k, label, f'{e}.v."{name}"', kind, key, from_, depth + 1)
    return out


_SCALARS = lambda *names: [(n, i, None) for i, n in enumerate(names, 1)]
_KAIKKI_TREE = {
    "sounds": [("ipa", 1, None), ("tags", 2, "array"), ("audio", 3, None)], "senses": [("glosses", 1, "array"), ("tags", 2, "array"), ("examples", 3, _SCALARS("text", "type"))],
    "forms": [("form", 1, None), ("tags", 2, "array")], "derived": _SCALARS("word"),
}
_OEWN_TREE = {"entries": (4, [*_SCALARS("id", "lemma", "pos"), ("senses", 4, _SCALARS("id", "synset"))]), "synsets": (5, _SCALARS("id", "pos", "definition"))}
_ALL_NODES = [x for i, (c, f) in enumerate(_KAIKKI_TREE.items(), 1) for x in _nodes_of("''", c, i, "''", f"k.{c}", f, "'kaikki:' || record_id", "kaikki_english_20260805 k")]
_ALL_NODES += [f"SELECT 'oewn:' || file_id, 'lexicon.{c}', '1.{i}', '1', o.lexicon.{c} FROM oewn_2025 o" for i, c in enumerate(("id", "label", "language"), 1)]
_ALL_NODES += [x for c, (i, f) in _OEWN_TREE.items() for x in _nodes_of("'1.'", f"lexicon.{c}", i, "'1'", f"o.lexicon.{c}", f, "'oewn:' || file_id", "oewn_2025 o")]

QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_paths, p1_descendants, p1_cycles, p2_found, p2_by_month, p3_found, p3_delimiters, p3_staging_features,
        p5_found, p5_nodes, p5_sounds, p5_examples, p5_entries, p5_entry_senses,
    )
}

ORACLE = {
    "p1_found": _LINKS + _WALK + """
SELECT node node_id, root root_id, depth::INT depth FROM down
UNION ALL SELECT DISTINCT origin, 'cycle', CASE WHEN origin IN (SELECT origin FROM ring) THEN -1 ELSE -2 END FROM walk""",
    "p1_paths": _LINKS + _WALK + """
, below AS (SELECT a.node, count(*) - 1 n FROM down a JOIN down b ON b.root = a.root AND (b.path = a.path OR starts_with(b.path, a.path || '>')) GROUP BY 1)
SELECT d.node, l.parent, d.root, d.depth::BIGINT depth, b.n n_descendants, 'tree' status, d.path
FROM down d JOIN below b ON b.node = d.node LEFT JOIN links l ON l.child = d.node
UNION ALL SELECT DISTINCT w.origin, l.parent, NULL, NULL, NULL, CASE WHEN w.origin IN (SELECT origin FROM ring) THEN 'cycle' ELSE 'below_cycle' END, NULL
FROM walk w JOIN links l ON l.child = w.origin""",
    "p1_descendants": _LINKS + """
pairs AS (SELECT node, unnest(string_split(path, '>')) anc FROM down)
SELECT anc ancestor, node descendant FROM pairs WHERE anc <> node""",
    "p1_cycles": _LINKS + _WALK + """
, ids AS (SELECT w.origin, min(w.here) cycle_id FROM walk w WHERE w.here IN (SELECT origin FROM ring) GROUP BY 1)
SELECT cycle_id, count(*) FILTER (origin IN (SELECT origin FROM ring)) n_on_cycle, count(*) FILTER (origin NOT IN (SELECT origin FROM ring)) n_below
FROM ids GROUP BY 1""",
    "p2_found": _ORPHANS + "SELECT DISTINCT ref_table, ref_id, ref_field, target_id, reason FROM orphans",
    "p2_by_month": _ORPHANS + "SELECT ref_table, ref_field, strftime(make_timestamp(created_at * 1000000), '%Y-%m') AS \"month\", reason, count(*) n_orphans FROM orphans GROUP BY ALL",
    "p3_staging_features": _FEATURES,
    "p3_delimiters": _DELIMITERS,
    "p5_found": f"""
SELECT DISTINCT * FROM (
  SELECT 'kaikki:' || record_id root_key, 'senses.glosses' field_path, a.i::INT outer_pos, b.i::INT inner_pos, b.v val
  FROM kaikki_english_20260805 k, {_unnested('a', 'k.senses')}, {_unnested('b', 'a.v.glosses')}
  UNION ALL SELECT 'kaikki:' || record_id, 'sounds.ipa', a.i::INT, 0, a.v.ipa FROM kaikki_english_20260805 k, {_unnested('a', 'k.sounds')}
  UNION ALL SELECT 'oewn:' || file_id, 'lexicon.entries.id', a.i::INT, 0, a.v.id FROM oewn_2025 o, {_unnested('a', 'o.lexicon.entries')})
WHERE regexp_matches(val, '[^\\s\\p{{Z}}]')""".replace("SELECT DISTINCT *", "SELECT DISTINCT root_key, field_path, outer_pos, inner_pos"),
    "p5_nodes": " UNION ".join(_ALL_NODES),
    "p5_sounds": f"""
SELECT DISTINCT 'kaikki:' || record_id root_key, '1.' || a.i AS label, '' parent_label, a.i::VARCHAR place, a.v.ipa ipa, a.v.audio audio
FROM kaikki_english_20260805 k, {_unnested('a', 'k.sounds')}""",
    "p5_examples": f"""
SELECT DISTINCT 'kaikki:' || record_id root_key, '1.' || a.i || '.3.' || b.i AS label, '1.' || a.i parent_label, a.i || '.' || b.i place, b.v.text AS "text", b.v."type" AS "type"
FROM kaikki_english_20260805 k, {_unnested('a', 'k.senses')}, {_unnested('b', 'a.v.examples')}""",
    "p5_entries": f"""
SELECT DISTINCT 'oewn:' || file_id root_key, '1.4.' || a.i AS label, '1' parent_label, a.i::VARCHAR place, a.v.id id, a.v.lemma lemma, a.v.pos AS pos
FROM oewn_2025 o, {_unnested('a', 'o.lexicon.entries')}""",
    "p5_entry_senses": f"""
SELECT DISTINCT 'oewn:' || file_id root_key, '1.4.' || a.i || '.4.' || b.i AS label, '1.4.' || a.i parent_label, a.i || '.' || b.i place, b.v.id id, b.v.synset synset
FROM oewn_2025 o, {_unnested('a', 'o.lexicon.entries')}, {_unnested('b', 'a.v.senses')}""",
}
