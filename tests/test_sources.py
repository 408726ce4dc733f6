import hashlib
import json

from verbarium.functions import clock
from verbarium.operators.hierarchy import hierarchy
from verbarium.sources import readers as rd


def put(folder, name, body):
    p = folder / name
    p.write_text(body, encoding="utf-8")
    return str(p)


def test_oewn(spark, tmp_path):
    body = {"lexicon": {"entries": [{"id": "e1", "lemma": "go", "pos": "v", "senses": [{"id": "s1", "synset": "y1"}]}, {"id": "e2", "lemma": "car", "pos": "n", "senses": None}], "synsets": [{"id": "y1", "pos": "v", "definition": "move"}]}}
    df = rd.read_oewn(spark, put(tmp_path, "o.json", json.dumps(body, indent=1)))
    got = {(r.claim_type, r.subject) for r in rd.oewn_claims(df.unionByName(df)).collect()}
    assert got == {("SYNSET", "y1"), ("LEXICAL_ENTRY", "go"), ("LEXICAL_ENTRY", "car"), ("SENSE_MEMBERSHIP", "go")}
    assert rd.oewn_claims(df.unionByName(df)).count() == 4


def test_oewn_maps_and_yaml(spark, tmp_path):
    body = {
        "synsets": {"y1": {"partOfSpeech": "v", "definition": ["move", "x"], "lex_domain": "motion", "hypernyms": ["y0"], "members": ["go"]}},
        "entries": {"go": [{"partOfSpeech": "v", "senses": [{"id": "s1", "synset": "y1", "derivation": [{"target_lemma": "goer", "target_pos": "n"}]}]}]},
    }
    t = rd.oewn_map_tables(rd.read_oewn_maps(spark, put(tmp_path, "m.json", json.dumps(body))))
    assert [(r.synset_id, r.gloss) for r in t["synsets"].collect()] == [("y1", "move")]
    assert [tuple(r) for r in t["hypernyms"].collect()] == [("y1", "y0")]
    assert [(r.lemma, r.target_lemma) for r in t["derivations"].collect()] == [("go", "goer")]
    assert t["senses"].first()["rank"] == 1
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    (tmp_path / "y").mkdir()
    put(tmp_path / "y", "a.yaml", "00000001-v:\n  hypernym: [00000002-v, other]\n  members: [go]\ngo:\n  v: {}\n")
    parsed = rd.read_oewn_yaml(spark, str(tmp_path / "y"))
    assert {(r["key"], r.is_synset) for r in parsed.collect()} == {("00000001-v", True), ("go", False)}
    assert [tuple(r) for r in rd.yaml_relations(parsed).collect()] == [("00000001-v", "hypernym", "00000002-v")]


def test_kaikki(spark, tmp_path):
    lines = [
        {"word": "go", "pos": "verb", "lang_code": "en", "sounds": [{}, {"ipa": "/g/"}], "senses": [{"glosses": []}, {"glosses": ["move", "leave"]}], "forms": [{"form": "went", "tags": ["past"]}, {"form": "have gone"}], "derived": [{"word": "goer"}, {"word": "go on"}]},
        {"word": "aller", "pos": "verb", "lang_code": "fr"}, {"word": "old", "pos": "adj"}, {"pos": "noun"},
    ]
    path = put(tmp_path, "k.jsonl", "\n".join(map(json.dumps, lines)) + "\n{broken\n")
    df = rd.read_kaikki(spark, path, english_only=True)
    assert {r.word for r in df.collect()} == {"go", "old"} and rd.read_kaikki(spark, path).count() == 3
    assert [tuple(r) for r in rd.kaikki_senses(df).collect()] == [("go", "verb", 1, "move; leave")]
    assert [r.form for r in rd.kaikki_forms(df).collect()] == ["went"] and [tuple(r) for r in rd.kaikki_derived(df).collect()] == [("goer", "go")]
    assert {r.word: r.ipa for r in rd.first_ipa(df).collect()} == {"go": "/g/", "old": None}
    assert rd.kaikki_claims(df.unionByName(df)).count() == 2
    try:
        rd.read_kaikki(spark, path, strict=True).count()
        raise AssertionError("a malformed line should fail a strict read")
    except Exception as e:  # noqa: BLE001
        assert "should fail" not in str(e)


def test_tables_with_tabs(spark, tmp_path):
    u = rd.read_unimorph(spark, put(tmp_path, "u.tsv", "# x\nrun\tran \tV;PST\n\nbad\tline\ngo\twent\tV;PST\n"))
    assert {tuple(r) for r in u.collect()} == {("run", "ran", "V;PST"), ("go", "went", "V;PST")}
    assert rd.unimorph_claims(u).count() == 2
    s = rd.read_subtlex(spark, put(tmp_path, "s.tsv", "Lg10WF\tWord\tFREQcount\n4.4615\trun\t12\nx\tgo\tmany\n"))
    assert {(r.Word, r.FREQcount, r.Lg10WF) for r in s.collect()} == {("run", 12, 4.4615), ("go", None, None)}
    assert json.loads(rd.subtlex_claims(s).filter("subject = 'run'").first().object_json)["FREQcount"] == 12


def test_manifest(spark, tmp_path):
    path = put(tmp_path, "f.bin", "abc")
    good = hashlib.sha256(b"abc").hexdigest()
    m = {"ok": (path, good.upper()), "bad": (path, "0" * 64), "later": (path, "EXPECTED_SHA256"), "gone": (str(tmp_path / "none"), good)}
    assert {r.name: r.status for r in rd.verify_manifest(spark, m).collect()} == {"ok": "OK", "bad": "MISMATCH", "later": "PLACEHOLDER", "gone": "MISSING"}


def test_scale_tree(spark):
    rows = {r.node: r.depth for r in hierarchy(rd.scale_tree(spark, 1000)).collect()}
    assert len(rows) == 1000 and rows["n0"] == 0 and rows["n4"] == 2 and max(rows.values()) == 6


def test_yaml_members_and_preflight(spark, tmp_path):
    rows = [("00000001-n", True, '{"partOfSpeech":"n","members":["a","b"],"definition":["first","second"],"hypernym":["00000002-n"]}'), ("00000002-n", True, '{"partOfSpeech":"n"}'), ("word", False, '{"members":["x"]}')]
    parsed = spark.createDataFrame(rows, "key string, is_synset boolean, body string")
    got = {tuple(r) for r in rd.yaml_members(parsed).collect()}
    assert got == {("00000001-n", "MEMBER", "a", "n", None), ("00000001-n", "MEMBER", "b", "n", None), ("00000001-n", "SYNSET_DEF", None, "n", "first"), ("00000001-n", "SYNSET_DEF", None, "n", "second")}
    kept = rd.yaml_members(parsed, spark.createDataFrame([("b",)], "lemma string")).filter("relation_type = 'MEMBER'").collect()
    assert [r.lemma for r in kept] == ["b"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f").write_text("x" * 10)
    p = f"file://{tmp_path}/d"
    found = {r.name: (r.bytes, r.files, r.status) for r in rd.preflight(spark, {"ok": (p, 10, 1), "small": (p, 11, 1), "few": (p, 1, 2), "gone": (p + "x", 0, 0)}).collect()}
    assert found == {"ok": (10, 1, "OK"), "small": (10, 1, "SMALL"), "few": (10, 1, "FEW"), "gone": (0, 0, "MISSING")}


def test_clock(spark):
    from datetime import datetime, timedelta, timezone

    at = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone(timedelta(hours=2)))
    r = spark.range(1).select(clock.utc_iso(at).alias("iso"), clock.epoch_seconds(at).alias("s"), clock.epoch_millis(at).alias("ms"), clock.stamped("t", at)).first()
    assert r.iso == "2026-01-02T01:04:05.000000Z" and r.s * 1000 == r.ms == 1767315845000 and r.t is not None
