from pyspark.sql import functions as F

from verbarium.operators.orphans import child_refs, orphan_counts, orphan_references, parent_keys


def _run(spark, parents, children):
    p = spark.createDataFrame(parents, "t string, k string, born long, gone long, key string")
    c = spark.createDataFrame(children, "id string, t string, k string, at long, alive string")
    return orphan_references([parent_keys(p, F.col("t"), F.col("k"), F.col("born"), F.col("gone"))], [child_refs(c, "refs", F.col("id"), "k", F.col("t"), F.col("k"), F.col("at"))])


def test_reasons(spark):
    parents = [("L", " A ", 5, None, "x"), ("L", "a", 9, 1, "x"), ("L", "d", 1, 2, "x"), ("F", "b", 1, None, "x"), ("L", None, 1, None, "x")]
    children = [
        ("1", "L", "A", 5, None), ("2", "L", "a", 4, None), ("3", "L", "d", 9, None), ("4", "L", "B\t", 9, None), ("5", "F", "b", 9, None),
        ("6", "L", None, 9, None), ("7", None, "a", 9, None), ("8", "L", "a", None, None), ("2", "L", "a", 4, None),
    ]
    out = _run(spark, parents, children)
    assert {(r.ref_id, r.target_id, r.reason) for r in out.collect()} == {("2", "a", "late"), ("3", "d", "deleted"), ("4", "b", "missing"), ("7", "a", "missing")}
    assert out.count() == 4
    counts = {(r["month"], r.reason): r.n_orphans for r in orphan_counts(out).collect()}
    assert counts == {("1970-01", "late"): 1, ("1970-01", "deleted"): 1, ("1970-01", "missing"): 2}


def test_empty_and_hot(spark):
    assert _run(spark, [("L", "a", 1, None, "")], []).count() == 0
    many = [(str(i), "L", "hot", i, None) for i in range(500)]
    assert _run(spark, [], many).filter("reason = 'missing'").count() == 500
    assert _run(spark, [("L", "HOT ", 250, None, "")], many).filter("reason = 'late'").count() == 250
