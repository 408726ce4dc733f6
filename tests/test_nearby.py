import random

from verbarium.operators import graph, nearby
from verbarium.plans import catalog

COLUMNS = ["id", "source_id", "relation_type", "target_id"]
SCHEMA = "id string, source_id string, relation_type string, target_id string"


def brute(rows, roots, types, depth, limit):
    near = {}
    for _, s, r, t in rows:
        if s is not None and t is not None and r in types:
            near.setdefault(s, set()).add(t)
            near.setdefault(t, set()).add(s)
    out = set()
    for root in {r for r in roots if r is not None}:
        nodes = {root}
        for _ in range(depth):
            nodes |= {y for x in nodes for y in near.get(x, ())}
        own = {x for x in rows if x[1] in nodes or x[3] in nodes}
        out |= {(root, *x) for x in sorted(own, key=lambda x: [(v is None, v or "") for v in (x[0], x[1], x[3], x[2])])[:limit]}
    return out


def test_first_edges_against_brute_force(spark):
    rng = random.Random(11)
    for n, m, limit, depth in [(40, 60, 3, 3), (60, 60, 1, 3), (300, 330, 8, 3), (300, 400, 200, 3), (60, 80, 5, 1)]:
        pick = lambda: "hub" if rng.random() < 0.1 else rng.choice([None, *(f"n{rng.randrange(n)}" for _ in range(19))])  # noqa: B023, E731
        # equal ids, loops, missing ids, ends and types, repeated edges
        rows = [(rng.choice([None, *[f"e{rng.randrange(m)}"] * 9]), pick(), rng.choice(["A", "A", "B", "C", None]), pick()) for _ in range(m)]
        rows += rng.choices(rows, k=9)
        roots = ["hub", "nowhere", None, *(f"n{rng.randrange(n)}" for _ in range(12))]
        want = brute(rows, roots, ["A", "B"], depth, limit)
        e, r = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(x,) for x in roots], "root string")
        got = [tuple(x) for x in nearby.first_edges(e, r, ["A", "B"], depth, limit).collect()]
        assert len(got) == len(want) and set(got) == want
        listed = graph.incident_edges(graph.reach(graph.adjacency(e, ["A", "B"]), r, depth), e, limit).select("root", *COLUMNS)
        assert {tuple(x) for x in listed.collect()} == want


def test_edges_that_differ_in_type_only_are_taken_by_type(spark, tmp_path):
    rows = [("e", "l1", f"T{i:03d}", "l2") for i in range(300)] + [(None, "l1", "HAS_FORM", "f")]
    random.Random(3).shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/edges.parquet")
    spark.createDataFrame([("l1", "LEXEME", 1)], "resolved_id string, entity_type string, deleted_at long").write.parquet(f"{tmp_path}/resolved_entities.parquet")
    got = catalog.QUERIES["graph_incident_edges"](spark, str(tmp_path)).collect()
    assert sorted(r.relation_type for r in got) == [f"T{i:03d}" for i in range(200)]


def test_roots_around_a_hub_do_not_each_list_its_neighbours(spark, tmp_path):
    n = 1500
    rows = [(f"a{i:05d}", f"l{i}", "DERIVED_FROM", "hub") for i in range(n)] + [(f"b{i:05d}", f"l{i}", "HAS_FORM", f"f{i}") for i in range(n)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/edges.parquet")
    spark.createDataFrame([(f"l{i}", "LEXEME", 1) for i in range(n)], "resolved_id string, entity_type string, deleted_at long").write.parquet(f"{tmp_path}/resolved_entities.parquet")
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite()
    before = written()
    got = catalog.QUERIES["graph_incident_edges"](spark, str(tmp_path)).select("root", "id").collect()
    assert len(got) == 200 * n and {r.id for r in got} == {f"a{i:05d}" for i in range(200)}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    # the result itself is 300,000 rows, the pairs of roots and neighbours 2.25 million
    assert written() - before < 30e6, written() - before
