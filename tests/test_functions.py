import hashlib
import unicodedata
import uuid

from pyspark.sql import functions as F

from verbarium.functions import ids, morph, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_uuid5_golden(spark):
    golden = {
        "eng:run:VERB": "1399b459-4466-5d9c-b75d-605d64d52aeb", "eng:go:VERB": "fcc147ed-fcc8-5a39-a8a7-71f092a515c9",
        "eng:running:V;V.PTCP;PRS": "a33d1704-e313-5b31-ba12-250434b20fcf", "morpheme:un-:PREFIX": "7ab70c10-ada7-5071-b9c9-d108353d6f9b",
    }
    for name, want in golden.items():
        assert one(spark, ids.uuid5(F.lit(name))) == want
    for i in range(40):
        assert one(spark, ids.uuid5(F.lit(f"é{i}"), ids.NS_DNS)) == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"é{i}"))
    assert one(spark, ids.uuid5(F.lit(None).cast("string"))) is None
    assert one(spark, ids.lexeme_key(F.lit("bank"), F.lit("NOUN"), homograph=F.lit("river"))) == "eng:bank:NOUN:river"


def test_normalize_text(spark):
    for raw in ["  Run ", "cafe\u0301", "\u00a0Été\u2003", "", None, "ÅNGSTRÖM", "A\tb"]:
        want = "" if raw is None else unicodedata.normalize("NFC", raw.strip()).lower()
        assert one(spark, text.normalize_text(F.lit(raw).cast("string"))) == want


def test_pos_and_features(spark):
    for tag, want in [("s", "ADJECTIVE"), (" Verb ", "VERB"), ("adv", "ADVERB"), ("x", "OTHER"), (None, "OTHER"), ("num", "NUMERAL")]:
        assert one(spark, text.map_pos(F.lit(tag).cast("string"))) == want
    t = text.feature_tags(F.lit("V; v.ptcp ;PRS;;"))
    assert one(spark, text.bundle_pos(t)) == "VERB"
    f = one(spark, text.bundle_features(t))
    assert (f.form_category, f.tense, f.number) == ("participle", "present", None)
    assert one(spark, text.bundle_pos(text.feature_tags(F.lit("ADV")))) == "ADVERB"
    assert one(spark, text.canonical_features(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))) == '{"a":"1","b":"2"}'
    assert one(spark, text.json_list(F.lit('["a","b"]'))) == ["a", "b"] and one(spark, text.json_list(F.lit("a, b,"))) == ["a", "b"] and one(spark, text.json_list(F.lit(None).cast("string"))) == []


def test_frequency_and_search_text(spark):
    z = text.zipf(F.lit("4.4615"))
    assert one(spark, z) == 7.46 and one(spark, text.frequency_tier(z)) == "VERY_COMMON"
    assert one(spark, text.zipf(F.lit("x"))) == 3.0 and one(spark, text.frequency_tier(F.lit(2.9))) == "RARE"
    assert one(spark, text.tokens(F.lit("Café-Bar 2"))) == ["cafe", "bar", "2"]
    assert one(spark, text.clean_query(F.lit('a"b* (c)'))) == "a b*  c" and one(spark, text.shortened(F.lit("x" * 30), 25)) == "x" * 25 + "..."
    for word, key in {"run": "R500", "fast": "F230", "happy": "H100", "go": "G000", "good": "G300", "bad": "B300", "bank": "B520"}.items():
        assert one(spark, text.soundex(F.lit(word))) == key


def test_inflection(spark):
    words = [("run", "VERB"), ("go", "VERB"), ("be", "VERB"), ("carry", "VERB"), ("play", "VERB"), ("tie", "VERB"), ("see", "VERB"), ("bake", "VERB"), ("stop", "VERB"), ("fix", "VERB"), ("happy", "ADJECTIVE"), ("good", "ADJECTIVE"), ("large", "ADJECTIVE"), ("mouse", "NOUN"), ("church", "NOUN"), ("cat", "NOUN"), ("cat", "NOUN"), ("x", "ADVERB"), ("", "NOUN"), (None, "NOUN")]
    got = {(r.lemma, r.slot): (r.surface, r.form_type) for r in morph.inflect(spark.createDataFrame(words, "lemma string, pos string")).collect()}
    want = {
        ("run", "past"): "ran", ("run", "participle_pres"): "running", ("go", "past"): "went", ("go", "pres_3sg"): "gos", ("be", "past_pl"): "were", ("carry", "pres_3sg"): "carries", ("carry", "past"): "carried", ("play", "past"): "played",
        ("tie", "participle_pres"): "tying", ("see", "participle_pres"): "seeing", ("bake", "participle_pres"): "baking", ("stop", "past"): "stopped", ("fix", "pres_3sg"): "fixes", ("fix", "past"): "fixed", ("happy", "comparative"): "happier",
        ("good", "superlative"): "best", ("large", "superlative"): "largest", ("mouse", "plural"): "mice", ("church", "plural"): "churches", ("cat", "plural"): "cats",
    }
    for k, v in want.items():
        assert got[k][0] == v, k
    assert got["go", "past"][1] == "SUPPLETIVE" and got["mouse", "plural"][1] == "IRREGULAR" and not any(k[0] in ("x", "", None) for k in got)
    assert one(spark, morph.form_type(F.lit("go"), F.lit("went"))) == "SUPPLETIVE" and one(spark, morph.form_type(F.lit("a"), F.lit("a"))) == "BASE"


def test_keys_and_small_gates(spark):
    from verbarium.functions import ids
    from verbarium.operators import gates

    one = spark.range(1).select(
        ids.form_hash_key(F.lit("went"), F.lit('{"tense":"past"}')).alias("f"), ids.sense_key(F.lit("eng:go:VERB"), F.lit("s1")).alias("s"), F.lit(1.5).alias("score"), F.struct(F.lit(1).alias("x")).alias("node"),
    )
    r = one.first()
    assert r.f == "eng:went:" + hashlib.sha256(b'{"tense":"past"}').hexdigest()[:12] and r.s == "eng:go:VERB:sense:s1"
    assert gates.nested_columns(one, {"score"}) == ["node"]
    have, want = (spark.createDataFrame(x, "lemma string, form string") for x in ([("go", "went")], [("go", "went"), ("be", "was")]))
    assert [tuple(x) for x in gates.missing_pairs(have, want).collect()] == [("be", "was")]
