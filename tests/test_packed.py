from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbarium.operators.packed import _leaves, infer_delimiters, split_packed


def apart(t):
    """The value grammar, letter by letter."""
    out, i, val = [], 0, lambda c: c.isalnum() or c in "._-"
    while i < len(t):
        c = t[i]
        if val(c):
            j = i
            while j < len(t) and val(t[j]):
                j += 1
            out.append(t[i:j])
            i = j + (j < len(t) and t[j] in "\"'")
        elif c in "\"'":
            j, buf, closed = i + 1, "", False
            while j < len(t):
                if t[j] == c:
                    if j + 1 < len(t) and t[j + 1] == c:
                        buf, j = buf + c, j + 2
                        continue
                    closed = True
                    break
                buf, j = buf + t[j], j + 1
            if closed:
                out.append(buf)
            i = j + 1 if closed else i + 1
        else:
            i += 1
    return out


def run(spark, texts, as_json=False, source="s"):
    df = spark.createDataFrame([(i, source, t, "x") for i, t in enumerate(texts)], "id int, source string, t string, row_key string")
    got = {}
    for r in sorted(split_packed(df, F.col("id"), F.col("source"), F.col("t"), as_json).collect(), key=lambda r: r.value_pos):
        got.setdefault(int(r.row_key), []).append(r.feature_value)
    return [got.get(i, []) for i in range(len(texts))]


TEXTS = [
    "V;PST", "V ; PST", ";N;;PL;", "N|PL", "ADJ/CMPR", "N SG", "V; PRS,3|SG", 'N;"of animals; jocular";SG', "'N';SG", 'N;"said of ""old"" wares"', "N'PL;x'",
    'N"a b"', "", " ", '""', '"open;N', "V.PTCP;PST", "É;été-x", "a" * 5000 + ";b", "N\tSG", "it''s", "x'y'z",
]


def test_texts_as_grammar(spark):
    assert run(spark, TEXTS) == [apart(t) for t in TEXTS]
    assert run(spark, [None, "N;SG"]) == [[], ["N", "SG"]]
    assert run(spark, []) == []


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="aB1é.-;,|'\" \t", max_size=14), min_size=15, max_size=40))
def test_random_texts(spark, texts):
    assert run(spark, texts) == [apart(t) for t in texts]


def test_json(spark):
    texts = [
        '{"pos": "V", "n": 3, "x": null, "b": ["PL", "A;B"]}', '"{\\"pos\\": \\"N\\"}"', '"V, PST"', "N;SG", "[]", "3.50", '{"note": "\\"rare, dialectal\\""}', "null", '{"a": {"b": [true]}}', "[1,", '"[not json"',
    ]
    want = [["V", "3", "PL", "A", "B"], ["N"], ["V", "PST"], ["N", "SG"], [], ["3.50"], ["rare, dialectal"], [], ["true"], ["1"], ["not", "json"]]
    assert run(spark, texts, as_json=True) == want
    assert _leaves("[" * 100_000) is None


def test_delimiters(spark):
    rows = [("a", "x;y"), ("a", "x;y;z"), ("a", "p;q"), ("a", "u, v;w"), ("b", "x y"), ("b", "x|y"), ("b", "p|q"), ("c", None), ("c", "one"), ("d", '"k;l"|m')]
    df = spark.createDataFrame(rows, "source string, t string")
    best = {r.source: r.delimiter for r in infer_delimiters(df, "source", "t").filter("rank = 1 and score > 0").collect()}
    assert best == {"a": ";", "b": "|", "d": "|"}


def test_the_inferred_delimiter_decides(spark):
    """Where values may hold anything, each source's own delimiter cuts; the same text differs between sources."""
    odd = ["red wine;dry, old", 'k "p;q" l;m', "'a|b';c d", "none here"]
    rows = [(s, f"x{i}{d}y{d}z") for s, d in zip("abc", ";,|") for i in range(20)] + [(s, t) for s in "abc" for t in odd] + [("d", "one two"), ("d", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, source string, t string")
    got = {}
    for r in sorted(split_packed(df, F.col("id"), F.col("source"), F.col("t"), plain=False).collect(), key=lambda r: r.value_pos):
        got.setdefault(int(r.row_key), []).append(r.feature_value)
    values = {k: got.get(i) for i, k in enumerate(rows)}
    assert values["a", "x0;y;z"] == values["b", "x0,y,z"] == values["c", "x0|y|z"] == ["x0", "y", "z"]
    assert values["a", odd[0]] == ["red wine", "dry, old"] and values["b", odd[0]] == ["red wine;dry", "old"]
    assert values["a", odd[1]] == ['k "p;q" l', "m"] and values["a", odd[2]] == ["a|b", "c d"]
    assert values["d", None] is None


def test_a_text_is_cut_at_a_delimiter_it_has(spark):
    rows = [(i, "a", t) for i, t in enumerate(["p q;r"] * 30 + ["p q|r"] * 10 + ["p q"])]
    df = spark.createDataFrame(rows, "id int, source string, t string")
    got = {int(r.row_key): r.feature_value for r in split_packed(df, F.col("id"), F.col("source"), F.col("t"), plain=False).filter("value_pos = 1").collect()}
    assert got[0] == "p q" or got[0] == "p"
    assert {r.row_key for r in split_packed(df, F.col("id"), F.col("source"), F.col("t"), plain=False).filter("value_pos = 2").collect()} >= {str(i) for i in range(40)}
