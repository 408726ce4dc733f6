from collections import defaultdict
from decimal import Decimal
import json

from hypothesis import given, settings
from hypothesis import strategies as st

from verbarium.llm.restated import _number, json_pairs, restated

COLS = "id string, source string, kind string, subject string, body string, raw string"


def run(spark, rows):
    return {(r.id, r.keep, r.n_copies) for r in restated(spark.createDataFrame(rows, COLS), "id", ["source", "kind"], ["subject"], ["body"]).collect()}


def test_what_counts_as_a_copy(spark):
    rows = [
        ("b", "s", "k", "Go-to", '{"x": 1.0, "y": ["A b", null]}', "1"), ("a", "s", "k", " go TO.", '{ "y":["ab",null],"x":1 }', "2"), ("c", "s", "k", "goto", '{"x": "1", "y": ["ab", null]}', "3"),
        ("d", "s", "k", "goto", '{"x": 1, "y": [null, "ab"]}', "4"), ("e", "S", "k", "goto", '{"x": 1, "y": ["ab", null]}', "5"), ("f", "s", "k", None, '{"x": 1, "y": ["ab", null]}', "6"),
        ("g", "s", None, None, None, "7"), ("h", "s", None, None, None, "8"), ("i", "s", "k", "", "", "9"), ("j", "s", "k", "...", "!?", "10"), ("a", "s", "k", " go TO.", '{ "y":["ab",null],"x":1 }', "2"),
        (None, "s", "k", "goto", "{}", "11"), ("k", "s", "k", "goto", '{"X": 1, "y": ["ab", null]}', "12"), ("l", "s", "k", "goto", '{"x": true, "y": ["ab", null]}', "13"),
    ]
    groups = defaultdict(set)
    for i, keep, n in run(spark, rows):
        groups[keep, n].add(i)
    assert groups.pop(("a", 2)) == {"a", "b"} and groups.pop(("g", 2)) == {"g", "h"} and groups.pop(("i", 2)) == {"i", "j"}
    assert all(n == 1 and ids == {keep} for (keep, n), ids in groups.items())


def test_hot_group_and_empty(spark):
    rows = [(f"{i:04}", "s", "k", "x" if i % 2 else "X ", '{"a":[1]}', "") for i in range(1500)] + [("z", "t", "k", "x", "{}", "")]
    got = run(spark, rows)
    assert len(got) == 1501 and sum(keep == "0000" and n == 1500 for _, keep, n in got) == 1500
    assert run(spark, []) == set()


def test_numbers():
    for same in (["1", "1.0", "1e0", "10e-1", "0.1E1"], ["0", "-0", "0.00"], ["-250", "-2.5e2"], ["1" + "0" * 40, "1e40"]):
        assert len({_number(x) for x in same}) == 1
    assert _number("1.0000000000000000000000000000000001") != _number("1")


values = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text("aB -", max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from("pq/="), x, max_size=3), max_leaves=8)


@settings(max_examples=200, deadline=None)
@given(values, values)
def test_pairs_are_equal_exactly_for_equal_json(a, b):
    def canon(x):
        if isinstance(x, dict):
            return ("o", tuple(sorted((k, canon(v)) for k, v in x.items())))
        if isinstance(x, list):
            return ("a", tuple(map(canon, x)))
        if isinstance(x, bool) or x is None:
            return ("b", str(x))
        return ("s", "".join(c for c in x.lower() if c.isalnum())) if isinstance(x, str) else ("n", Decimal(x))

    assert (json_pairs(json.dumps(a)) == json_pairs(json.dumps(b))) == (canon(a) == canon(b))
