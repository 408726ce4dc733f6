import random

from verbarium.operators import export, gates, graph, inference, resolution, search, workspace

E = "id string, source_id string, source_type string, relation_type string, target_id string, target_type string, epistemic_class string"


def edges(spark, rows):
    return spark.createDataFrame([(str(i), s, "LEXEME", r, t, "FORM" if r == "HAS_FORM" else "LEXEME", c) for i, (s, r, t, c) in enumerate(rows)], E)


def test_reach_and_walks_against_brute_force(spark):
    rng = random.Random(6)
    pairs = {(rng.choice("abcdefghij"), rng.choice("abcdefghij")) for _ in range(14)}
    e = edges(spark, [(a, "DERIVED_FROM", b, "EXPLICIT") for a, b in pairs] + [("a", "OTHER", "z", "EXPLICIT"), (None, "DERIVED_FROM", "a", "EXPLICIT")])
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    roots = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "root string")
    dist, paths = set(), set()
    for r in "ab":
        seen, front = {r: 0}, {r}
        for d in range(1, 4):
            front = {y for x in front for y in near.get(x, ())} - set(seen)
            seen |= dict.fromkeys(front, d)
        dist |= {(r, n, d) for n, d in seen.items()}
        now = [(r,)]
        for d in range(1, 4):
            now = [p + (y,) for p in now for y in near.get(p[-1], ()) if y not in p]
            paths |= set(now)
    adj = graph.adjacency(e, ["DERIVED_FROM"])
    assert {tuple(x) for x in graph.reach(adj, roots, 3).collect()} == dist
    assert {tuple(x.path) for x in graph.walks(adj, roots, 3).collect()} == paths
    try:
        graph.reach(adj, roots, 4)
        raise AssertionError
    except ValueError:
        pass


def test_degrees_cycles_dangling(spark):
    e = edges(spark, [("a", "SYN", "b", "EXPLICIT"), ("b", "SYN", "a", "EXPLICIT"), ("c", "SYN", "c", "EXPLICIT"), ("a", "SYN", "x", "EXPLICIT"), ("a", "SYN", "b", "EXPLICIT")])
    nodes = spark.createDataFrame([("a", "LEXEME"), ("b", "LEXEME"), ("c", "LEXEME"), ("lonely", "FORM"), ("a", "LEXEME")], "node_id string, node_type string")
    assert {r.node_id: r.degree for r in graph.degrees(nodes, e).collect()} == {"a": 4, "b": 3, "c": 2, "lonely": 0}
    assert {(r.a, r.b) for r in graph.mutual_pairs(e, "SYN").collect()} == {("a", "b"), ("c", "c")}
    assert [(r.target_id, r.source_missing, r.target_missing) for r in graph.dangling(e, nodes).collect()] == [("x", False, True)]
    assert {(r.node_type, r.n_isolated, r.ok) for r in graph.isolation(nodes, e, {"LEXEME": 0.15, "FORM": 0.05}).collect()} == {("LEXEME", 0, True), ("FORM", 1, False)}
    assert {r.node_id for r in resolution.missing_nodes(e, nodes).collect()} == {"x"} and resolution.heal_edges(e, nodes).count() == 4


def words(spark):
    lex = spark.createDataFrame([("l1", "go", "VERB"), ("l2", "goal", "NOUN"), ("l3", "goer", "NOUN")], "lexeme_id string, lemma string, pos string")
    forms = spark.createDataFrame([("f1", "went"), ("f2", "goes"), ("f3", "goals")], "form_id string, surface string")
    e = edges(spark, [("l1", "HAS_FORM", "f1", "ATTESTED"), ("l1", "HAS_FORM", "f2", "GENERATED"), ("l2", "HAS_FORM", "f3", "EXPLICIT"), ("l3", "DERIVED_FROM", "l1", "INFERRED"), ("l2", "SYNONYM_OF", "l1", "UNCERTAIN")])
    return lex, forms, e


def test_lookup_page_and_slice(spark):
    lex, forms, e = words(spark)
    assert [(r.kind, r.id, r.parent_id) for r in graph.lookup_term(" WENT", lex, e, forms).collect()] == [("FORM", "f1", "l1")]
    senses = spark.createDataFrame([("l1", "s1", "move")], "lexeme_id string, sense_id string, definition string")
    rows = {tuple(r) for r in graph.word_rows(lex, senses, e, forms).collect()}
    assert rows == {("l1", "SENSE", "s1", "move"), ("l1", "FORM", "f1", "went"), ("l1", "FORM", "f2", "goes"), ("l2", "FORM", "f3", "goals"), ("l1", "DERIVED", "l3", None), ("l3", "BASE", "l1", None)}
    kept = export.closed_slice(spark.createDataFrame([("GO",)], "lemma string"), lex, e)
    assert {r.target_id for r in kept.collect()} == {"f1", "f2"}
    j = {r.lexeme_id: r.json for r in export.ontolex(lex, graph.forms_of(lex, e, forms)).collect()}
    assert '"writtenRep":"went"' in j["l1"] and '"lexicalForm":[]' in j["l3"]
    bridge = spark.createDataFrame([("4", "c1"), ("4", "c2")], "relation_id string, claim_id string")
    claims = spark.createDataFrame([("c1", "S", "P", "{}")], "id string, source string, predicate string, object_json string")
    why = graph.explain_connection("l1", "l2", e, bridge, claims).collect()
    assert {(r.claim_id, r.source, r.is_conflicting) for r in why} == {("c1", "S", True), ("c2", None, True)}


def test_gates_and_publishing(spark, tmp_path):
    lex, forms, e = words(spark)
    bad = gates.report({"traps": gates.trapped(e, lex), "weak": gates.unattested_prefixes(e, lex), "types": gates.badly_typed(e), "domain": gates.out_of_domain(lex, "pos", gates.POS)})
    got = {r.gate: r.violations for r in bad.collect()}
    assert got == {"traps": 1, "weak": 1, "types": 0, "domain": 0}
    assert "| traps | 1 | no |" in export.markdown(bad)
    root = f"file://{tmp_path}"
    try:
        export.publish({"lexemes": (lex, ["lexeme_id"])}, root, bad)
        raise AssertionError
    except ValueError as x:
        assert "traps" in str(x)
    first = export.publish({"lexemes": (lex, ["lexeme_id"])}, root)
    second = export.publish({"lexemes": (lex.limit(1), ["lexeme_id"])}, root)
    assert export.current(spark, root) == second != first and spark.read.parquet(f"{first}/lexemes.parquet").count() == 3
    assert gates.shortcuts(edges(spark, [("a", "D", "b", ""), ("b", "D", "c", ""), ("a", "D", "c", "")]), "D").count() == 1
    m = spark.createDataFrame([("re-",), ("-",), (None,), ("-abcdefghi",)], "shape string")
    assert gates.affix_anomalies(m).count() == 3
    assert gates.below_floor(spark.createDataFrame([("a", 5)], "name string, n long"), {"a": 5, "b": 1}).first().name == "b"


def test_inference(spark):
    lex = spark.createDataFrame([("1", "run", "VERB"), ("2", "rerun", "VERB"), ("3", "bake", "VERB"), ("4", "bakable", "ADJECTIVE"), ("5", "reed", "VERB"), ("6", "happy", "ADJECTIVE"), ("7", "unhappy", "ADJECTIVE"), ("8", None, "VERB"), ("9", "runable", "ADJECTIVE")], "id string, normalized_lemma string, pos string")
    old = spark.createDataFrame([("7", "6")], "subject_id string, object_id string")
    new = inference.infer_derivations(lex, old)
    assert {(r.subject_id, r.object_id, r.rule) for r in new.collect()} == {("2", "1", "PREFIX_RE_VERB"), ("4", "3", "SUFFIX_ABLE_VERB_TO_ADJ"), ("9", "1", "SUFFIX_ABLE_VERB_TO_ADJ")}
    parts = {r.target_id: [c["shape"] for c in r.components] for r in inference.structures(new).collect()}
    assert parts["2"] == ["re-", "run"] and parts["4"] == ["bake", "-able"]
    forms, rels = inference.materialize_inflections(lex)
    assert {r.evidence_type for r in forms.filter("surface = 'ran'").collect()} == {"ATTESTED"} and rels.filter("relation_type = 'INFLECTS_TO'").count() == rels.filter("relation_type = 'HAS_FORM'").count()
    d = spark.createDataFrame([("good", "comparative", "better"), ("good", "superlative", "best"), ("bad", "comparative", "worse"), ("x", "superlative", None)], "lexeme string, degree string, form string")
    assert [tuple(r) for r in inference.degree_chains(d).collect()] == [("good", "better", "best")]
    assert inference.derivation_links(old).first().evidence_type == "EXPLICIT"


def test_resolution(spark):
    from pyspark.sql import functions as F

    c = spark.createDataFrame([("1", "bank", "x", "A"), ("2", "bank", "y", "B"), ("3", "run", "z", "A"), ("4", "run", "z", "B"), ("5", "one", "q", "A")], "id string, k string, v string, source string")
    r = {x.k: x for x in resolution.resolve_claims(c, ["k"], "v", "id", [F.col("id")]).collect()}
    assert (r["bank"].status, r["bank"].v, r["bank"].confidence, r["bank"].claim_ids) == ("CONFLICTING", "x", 0.5, ["1", "2"])
    assert (r["run"].evidence_type, r["one"].evidence_type, r["one"].confidence) == ("ATTESTED", "EXPLICIT", 1.0)
    assert resolution.conflict_relations(c, ["k"], "v", "id").count() == 2 and resolution.conflicts(c.limit(0), ["k"], "v").count() == 0
    q = spark.createDataFrame([("a", "l1", "MISSING_ETYMOLOGY", "PENDING"), ("b", "f3", "OTHER", "PENDING"), ("c", None, "OTHER", "DONE")], "id string, target_entity_id string, conflict_type string, status string")
    done, marked = resolution.process_errata(q, words(spark)[2])
    assert {x.id: x.status for x in done.collect()} == {"a": "RESOLVED_UNATTESTED", "b": "RESOLVED_CONFLICT_PRESERVED", "c": "DONE"}
    assert marked.filter("epistemic_class = 'UNCERTAIN'").count() == 5


def test_search(spark):
    rows = spark.createDataFrame([("1", "Café bar"), ("2", "bar barn"), ("3", None), ("4", "100% bar_x")], "k string, t string")
    ix = search.inverted_index(rows, "k", "D", "t")
    assert [tuple(r) for r in search.search(ix, "BAR").collect()] == [("1", 1), ("2", 1), ("4", 1)]
    assert [r.target_id for r in search.search(ix, "cafe bar*").collect()] == ["1"] and search.search(ix, "* !").count() == 0
    assert [r.k for r in search.prefix(rows, "t", "100%").collect()] == ["4"] and search.prefix(rows, "t", "%").count() == 0
    ph = search.phonetic_index(rows, "k", "t")
    assert [r.target_id for r in search.sounds_like(ph, "barbarn").collect()] == ["2"]
    tr = search.translations(spark.createDataFrame([("l1", "bank")], "lexeme_id string, lemma string"), edges(spark, [("l1", "TRANSLATION_OF", "e1", "UNCERTAIN")]), spark.createDataFrame([("e1", "banco")], "lexeme_id string, lemma string"))
    assert [tuple(r) for r in tr.collect()] == [("bank", "banco", "UNCERTAIN")]


def test_workspace(spark):
    a = spark.createDataFrame([("n1", "old", 5), ("n2", "keep", 9), ("n3", "tie", 4)], "id string, body string, rev long")
    b = spark.createDataFrame([("n1", "new", 6), ("n2", "lose", 8), ("n3", "tie2", 4), ("n4", "add", 1), ("n5", "none", None)], "id string, body string, rev long")
    assert {r.id: r.body for r in workspace.last_write_wins(a, b, "id", "rev").collect()} == {"n1": "new", "n2": "keep", "n3": "tie", "n4": "add", "n5": "none"}
    t = spark.createDataFrame([("n1", 5), ("n2", 10), ("n2", 1)], "id string, deleted_rev long")
    assert {r.id for r in workspace.apply_tombstones(a, t, "id", "rev").collect()} == {"n1", "n3"}
    assert {r.id: r.body for r in workspace.upsert(a, b.filter("id = 'n1'"), ["id"]).collect()}["n1"] == "new"
    log = spark.createDataFrame([("l", 1), ("l", 2), ("m", 3)], "lexeme string, at long")
    assert {r.lexeme: (r.sync_version, r.is_deleted) for r in workspace.toggles(log, "lexeme", ["at"]).collect()} == {"l": (2, True), "m": (1, False)}
