"""Results that must be whole, whatever the size of one group."""

import json

from pyspark.sql import functions as F

from verbarium.functions import text
from verbarium.operators import export, graph
from verbarium.plans import catalog


def test_all_shapes_of_features_are_decoded(spark, tmp_path):
    lists = ['["N", "SG"]', "[]", '["a,b", " c ", "q\\"x"]', '[1, true]', '["a", ["b", "c"]]', '["a", {"k": "v"}]']
    others = ['{"pos": "N", "number": "SG"}', '{"bundle": ["N", "SG"]}', '"N,SG"', '"N;SG"', '"{\\"pos\\": \\"N\\"}"', "N, SG,", "null", "3", "", '["a", "b"', "{x, y", ' , ', 'N,"a ""b"" c"']
    want = {None: []}
    for t in lists:
        want[t] = [x if isinstance(x, str) else json.dumps(x, separators=(",", ":")) for x in json.loads(t)]
    for t in others:
        want[t] = [x.strip(" ") for x in t.split(",") if x.strip(" ")]
    rows = [(str(i), t) for i, t in enumerate(want)]
    df = spark.createDataFrame(rows, "id string, features_json string")
    assert {r.features_json: r.x for r in df.withColumn("x", text.json_list(F.col("features_json"))).collect()} == want
    df.write.parquet(f"{tmp_path}/raw_inflections.parquet")
    got = catalog.QUERIES["features_json_list"](spark, str(tmp_path)).collect()
    assert {r.id: r.features for r in got} == {i: "|".join(want[t]) for i, t in rows} and len(got) == len(rows)


def test_ontolex_writes_all_forms_of_a_large_lexeme(spark):
    lex = spark.createDataFrame([("l1", "go", "VERB"), ("l2", "goal", "NOUN"), ("l3", "goer", "NOUN")], "lexeme_id string, lemma string, pos string")
    forms = spark.createDataFrame([("l1", f"f{i}", f"go{i}") for i in range(2345)] + [("l2", "g1", "goals"), ("l2", "g1", "goals")], "lexeme_id string, form_id string, surface string")
    rows = export.ontolex(lex, forms).collect()
    got = {}
    for r in rows:
        j = json.loads(r.json)
        assert j["@id"] == r.lexeme_id and 0 < len(j["lexicalForm"]) < 1500 or r.lexeme_id == "l3"
        got.setdefault(r.lexeme_id, []).extend((f["@id"], f["writtenRep"]) for f in j["lexicalForm"])
    assert sorted(got["l1"]) == sorted((f"f{i}", f"go{i}") for i in range(2345))
    assert got["l2"] == [("g1", "goals")] and got["l3"] == []
    assert sorted((r.lexeme_id, r.part_no) for r in rows) == [("l1", 1), ("l1", 2), ("l1", 3), ("l2", 1), ("l3", 1)]


def test_word_rows_and_counts_have_no_limit(spark):
    lex = spark.createDataFrame([("l1", "go", "VERB"), ("l2", "goal", "NOUN"), ("l3", "none", "NOUN")], "lexeme_id string, lemma string, pos string")
    forms = spark.createDataFrame([(f"f{i}", f"go{i}") for i in range(60)], "form_id string, surface string")
    pairs = [("l1", "HAS_FORM", f"f{i}") for i in range(60)] + [("l2", "DERIVED_FROM", "l1")] + [(f"x{i}", "DERIVED_FROM", "l1") for i in range(40)] + [("l1", "SYNONYM_OF", "l2"), ("l1", "HAS_FORM", "f1")]
    edges = spark.createDataFrame(pairs, "source_id string, relation_type string, target_id string")
    senses = spark.createDataFrame([("l1", f"s{i}", "move" if i else None) for i in range(30)] + [("gone", "s1", "x")], "lexeme_id string, sense_id string, definition string")
    rows = graph.word_rows(lex, senses, edges, forms)
    want = {("l1", "FORM", f"f{i}", f"go{i}") for i in range(60)} | {("l1", "SENSE", f"s{i}", "move" if i else None) for i in range(30)} | {("l1", "DERIVED", x, None) for x in ["l2", *[f"x{i}" for i in range(40)]]} | {("l2", "BASE", "l1", None)}
    got = [tuple(r) for r in rows.select("lexeme_id", "kind", "id", "text").collect()]
    assert len(got) == len(want) and set(got) == want
    assert {tuple(r) for r in graph.word_counts(lex, rows).select("lexeme_id", "n_senses", "n_forms", "n_links").collect()} == {("l1", 30, 60, 41), ("l2", 0, 0, 1), ("l3", 0, 0, 0)}


def test_family_and_neighbourhood_reach_depth_three(spark, tmp_path):
    rows = [("l1", "DERIVED_FROM", "l2"), ("l3", "DERIVED_FROM", "l2"), ("l4", "DERIVED_FROM", "l3"), ("l5", "DERIVED_FROM", "l4"), ("l3", "HAS_FORM", "f1"), ("l1", "SYNONYM_OF", "l9"), ("f1", "INFLECTS_TO", "f2"), ("l9", "HAS_FORM", "f9")]
    spark.createDataFrame([(f"e{i}", *r) for i, r in enumerate(rows)], "id string, source_id string, relation_type string, target_id string").write.parquet(f"{tmp_path}/edges.parquet")
    spark.createDataFrame([("l1", "LEXEME", 1), ("l4", "LEXEME", None)], "resolved_id string, entity_type string, deleted_at long").write.parquet(f"{tmp_path}/resolved_entities.parquet")
    family = catalog.QUERIES["graph_family"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in family} == {("l1", "l2", 1), ("l1", "l3", 2), ("l1", "l4", 3)} and len(family) == 3
    # reached: l1, l2, l3, l4 and f1; not l5, l9, f2
    near = catalog.QUERIES["graph_incident_edges"](spark, str(tmp_path)).collect()
    assert sorted((r.root, r.id) for r in near) == [("l1", f"e{i}") for i in range(7)]


def test_stated_derivations_and_other_parts_of_speech_are_not_inferred(spark, tmp_path):
    words = [("1", "run", "v"), ("2", "rerun", "v"), ("3", "happy", "a"), ("4", "unhappy", "a"), ("5", "play", "n"), ("6", "replay", "v"), ("7", "bake", "v"), ("8", "bakable", "a")]
    spark.createDataFrame([(i, w, p, "LEXEME") for i, w, p in words], "resolved_id string, canonical_form string, pos string, entity_type string").write.parquet(f"{tmp_path}/resolved_entities.parquet")
    spark.createDataFrame([("4", "DERIVED_FROM", "3"), ("2", "SYNONYM_OF", "1")], "source_id string, relation_type string, target_id string").write.parquet(f"{tmp_path}/edges.parquet")
    got = catalog.QUERIES["inferred_derivations_registered"](spark, str(tmp_path)).collect()
    assert sorted((r.subject_id, r.object_id) for r in got) == [("2", "1"), ("8", "7")]
