import json

import pytest
from pyspark.sql import functions as F

from verbarium.operators import export, gates, graph, layers, resolution
from verbarium.plans import build as batch

CLAIM = "id string, source string, source_key string, claim_type string, subject string, predicate string, object_json string, extracted_at string, extra string"


def ledger(spark):
    say = lambda i, source, kind, subject, body: (i, source, i, kind, subject, "P", json.dumps(body), "2026-01-01T00:00:00Z", "x")
    rows = [
        say("c1", "OEWN_2025", "LEXICAL_ENTRY", "Happy", {"pos": "a"}), say("c2", "WIKTIONARY", "LEXICAL_RECORD", " happy ", {"pos": "adj"}), say("c3", "OEWN_2025", "LEXICAL_ENTRY", "unhappy", {"pos": "a"}),
        say("c4", "UNIMORPH_ENG", "INFLECTION_RECORD", "happy", {"surface": "happier", "features": "ADJ;CMPR"}), say("c5", "UNIMORPH_ENG", "INFLECTION_RECORD", "happy", {"surface": "happiest", "features": "ADJ;SPRL"}),
        say("c6", "UNIMORPH_ENG", "INFLECTION_RECORD", "nobody", {"surface": "nobodies", "features": "N;PL"}), say("c7", "SUBTLEX_US_R1", "USAGE_FREQUENCY", "happy", {"Word": "happy", "FREQcount": 9, "Lg10WF": 2.5}),
    ]
    return spark.createDataFrame(rows, CLAIM)


def test_build_end_to_end(spark, tmp_path):
    claims = ledger(spark)
    t = batch.build(claims)
    rel = {(r.relation_type, r.evidence_type) for r in t["relations"].collect()}
    assert rel == {("HAS_FORM", "EXPLICIT"), ("DERIVED_FROM", "INFERRED"), ("INFLECTS_TO", "GENERATED")} and t["relations"].count() == 4
    lex = {r.normalized_lemma: r for r in t["lexemes"].collect()}
    assert set(lex) == {"happy", "unhappy"} and lex["happy"].tier == "VERY_COMMON" and lex["unhappy"].tier is None and lex["happy"].source_presence == ["OEWN_2025", "WIKTIONARY"]
    found = {(r.target_type, r.term) for r in t["search_index"].filter("term = 'happiest' or term = 'Happy'").collect()}
    assert found == {("FORM", "happiest"), ("LEXEME", "Happy")}
    report = {r.gate: r.violations for r in gates.report(batch.build_gates(t, claims)).collect()}
    assert not any(report.values())
    root = f"file://{tmp_path}"
    first = batch.publish_build(claims, root)
    assert export.current(spark, root) == first
    m = {r.name: (r.n, r.content) for r in spark.read.parquet(f"{first}/manifest.parquet").collect()}
    assert m["relations"][0] == 4 and set(m) == set(batch.KEYS)
    again = {r.name: (r.n, r.content) for r in batch.manifest(batch.build(claims.orderBy(F.desc("id")).repartition(3))).collect()}
    assert again == m  # contents do not depend on row order


def test_a_failed_gate_publishes_nothing(spark, tmp_path):
    claims = ledger(spark)
    t = batch.build(claims)
    t["relation_claims"] = t["relation_claims"].limit(0)
    report = gates.report(batch.build_gates(t, claims))
    assert {r.gate for r in report.filter("not passed").collect()} == {"explicit_without_claim"}
    with pytest.raises(ValueError, match="explicit_without_claim"):
        export.publish({"relations": (t["relations"], ["id"])}, f"file://{tmp_path}", report)
    assert not list(tmp_path.iterdir())


def test_empty_build(spark):
    t = batch.build(ledger(spark).limit(0))
    assert all(df.count() == (6 if name == "morphemes" else 0) for name, df in t.items())


def test_lookup_by_subject_reads_its_columns_only(spark, tmp_path):
    """A published relation is found with the filter and no column more than asked for at the scan."""
    root = batch.publish_build(ledger(spark), f"file://{tmp_path}")
    df = spark.read.parquet(f"{root}/relations.parquet").filter("subject_id = 'x' and relation_type = 'HAS_FORM'").select("object_id", "relation_type")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(subject_id,x)" in plan and "EqualTo(relation_type,HAS_FORM)" in plan and "ReadSchema: struct<subject_id:string,relation_type:string,object_id:string>" in plan


def test_layers(spark):
    lex = spark.createDataFrame([("l1", "run"), ("l2", "bank"), ("l3", "bank")], "lexeme_id string, lemma string")
    pairs = spark.createDataFrame([("run", "correr", "VERB", "ATTESTED"), ("bank", "banco", "NOUN", "UNCERTAIN"), ("bank", "banco", "NOUN", "UNCERTAIN"), (None, "x", None, None), ("lost", "perdido", "ADJ", "ATTESTED")], "lemma string, other_lemma string, other_pos string, epistemic_class string")
    others, edges = layers.translation_layer(pairs, lex)
    assert {r.lemma for r in others.collect()} == {"correr", "banco", "perdido"}
    assert sorted((r.source_id, r.epistemic_class) for r in edges.collect()) == [("l1", "ATTESTED"), ("l2", "UNCERTAIN"), ("l3", "UNCERTAIN")]
    registered = lex.select(F.col("lexeme_id").alias("node_id"), F.lit("LEXEME").alias("entity_type"))
    assert layers.bad_translations(edges, registered).count() == 0
    assert layers.bad_translations(edges, registered.withColumn("entity_type", F.lit("FORM"))).count() == 3
    sounds = spark.createDataFrame([("run", "IPA", "/ɹʌn/"), ("run", "ARPABET", "R AH1 N"), ("bank", "IPA", None)], "lemma string, notation string, transcription string")
    said, index = layers.pronunciation_layer(sounds, lex)
    assert said.count() == 2 and [tuple(r) for r in index.select("phonetic_key", "target_id", "algorithm").collect()] == [("R500", "l1", "SOUNDEX")]
    assert layers.mistyped_pronunciations(said, registered).count() == 0
    cxn = spark.createDataFrame([("cx", "Motion"), (None, "none")], "construction_id string, name string")
    ends = spark.createDataFrame([("run", "REALIZES", "cx"), ("run", "REALIZES", "gone"), ("run", "OTHER", "cx"), ("walk", "REALIZES", "cx")], "lemma string, relation_type string, construction_id string")
    nodes, tied = layers.construction_layer(cxn, ends, lex)
    assert nodes.count() == 1 and [(r.source_id, r.target_id, r.epistemic_class) for r in tied.collect()] == [("l1", "cx", "EXPLICIT")]


def test_errata_and_etymologies(spark):
    q = spark.createDataFrame(
        [("1", "MISSING_ETYMOLOGY", "a", None, '{"note":"n","conflict_record":"old"}', "PENDING"), ("2", "COMPETING_SOURCES", "a", "b", None, "PENDING"), ("3", "COMPETING_SOURCES", "a", "b", "{}", "DONE")],
        "id string, conflict_type string, source_a_claim string, source_b_claim string, metadata string, status string",
    )
    got = {r.id: r for r in resolution.errata_records(q).collect()}
    first = json.loads(got["1"].metadata)
    assert first["note"] == "n" and json.loads(first["conflict_record"]) == {"source_a": "a", "source_b": None, "resolved_as": "UNATTESTED"}
    assert json.loads(json.loads(got["2"].metadata)["conflict_record"])["source_b"] == "b" and got["2"].status == "RESOLVED_CONFLICT_PRESERVED"
    assert got["3"].metadata == "{}" and got["3"].epistemic_class is None
    r = spark.createDataFrame([("r1", "ETYMOLOGICALLY_FROM", " Bank"), ("r2", "HAS_FORM", "bank")], "id string, relation_type string, subject_lemma string")
    c = spark.createDataFrame([("c1", "ETYMOLOGICALLY_FROM", "bank"), ("c2", "ETYMOLOGICALLY_FROM", "other")], "id string, predicate string, subject string")
    assert [tuple(x) for x in resolution.etymology_claims(r, c).collect()] == [("r1", "c1")]


def test_subgraph_limits(spark):
    lex = spark.createDataFrame([(f"l{i}", "go") for i in range(7)] + [("b", "base")], "lexeme_id string, lemma string")
    forms = spark.createDataFrame([(f"f{i:02}", f"s{i}") for i in range(30)], "form_id string, surface string")
    edges = spark.createDataFrame([("l0", "HAS_FORM", f"f{i:02}", "EXPLICIT") for i in range(30)] + [("l1", "DERIVED_FROM", "b", "INFERRED")] * 2, "source_id string, relation_type string, target_id string, epistemic_class string")
    senses = spark.createDataFrame([("l0", f"s{i:02}", "a very long definition that is cut", "syn-1") for i in range(12)], "lexeme_id string, sense_id string, definition string, synset_id string")
    nodes, links = graph.subgraph(spark.createDataFrame([(" GO ",), (None,), ("none",)], "term string"), lex, edges, forms, senses)
    kinds = {r.type: r["count"] for r in nodes.groupBy("type").count().collect()}
    assert kinds == {"LEXEME": 6, "FORM": 25, "SENSE": 10, "SYNSET": 1} and links.count() == 25 + 10 + 10 + 1
    assert nodes.filter("type = 'SENSE'").first().label == "a very long definition th..."
