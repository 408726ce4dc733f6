from pyspark.sql import functions as F

from verbarium.operators.nested import dewey_nodes, dewey_table, placed_values

SCHEMA = "id int, label string, a array<struct<g array<string>, e array<struct<x string, n int>>, t string>>, s struct<q string, m array<array<int>>>, k map<string,int>"
ROWS = [
    (1, "z", [(["p", None, " "], [("u", 1), None], "t1"), None, ([], None, None)], ("q1", [[1, 2], None, [3]]), {"one": 1}),
    (1, "z", [(["p", None, " "], [("u", 1), None], "t1"), None, ([], None, None)], ("q1", [[1, 2], None, [3]]), {"one": 1}),
    (2, None, None, None, None),
    (3, "w", [], (None, []), {}),
]


def nodes(spark, paths=None):
    return dewey_nodes(spark.createDataFrame(ROWS, SCHEMA), F.col("id").cast("string"), ["a", "s", "k"], paths)


def test_labels_lead_to_parents(spark):
    rows = nodes(spark).drop("fields", "pos").distinct().collect()
    have = {(r.root_key, r.label) for r in rows}
    for r in rows:
        assert r.label.startswith(r.parent_label)
        if r.field_path in ("a.g", "a.e", "a.t"):
            assert (r.root_key, r.parent_label) in have
    by = {(r.field_path, r.label): r.value for r in rows if r.root_key == "1"}
    assert by["a.g", "1.1.1.1"] == "p" and by["s.m", "2.2.3.1"] == "3" and by["a.t", "1.1.3"] == "t1" and by["s.q", "2.1"] == "q1"


def test_places_and_tables(spark):
    got = {tuple(r) for r in placed_values(nodes(spark, {"a.g", "a.t", "s.m"})).collect()}
    assert got == {("1", "a.g", 1, 1), ("1", "a.t", 1, 0), ("1", "s.m", 1, 1), ("1", "s.m", 1, 2), ("1", "s.m", 3, 1)}
    table = sorted(tuple(r) for r in dewey_table(nodes(spark), "a.e", {"x": "string", "n": "int"}).collect() if r.x is not None)
    assert table == [("1", "1.1.2.1", "1.1", "1.1", "u", 1)]
    entries = dewey_table(nodes(spark), "k", {"key": "string", "value": "int"}).collect()
    assert [(r["key"], r["value"]) for r in entries] == [("one", 1)]


def test_only_wanted_paths(spark):
    assert {r.field_path for r in nodes(spark, {"a.e"}).collect()} == {"a.e"}
    assert nodes(spark).filter("root_key = '2'").filter("value is not null").count() == 0
