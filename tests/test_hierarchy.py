import random

from verbarium.operators import hierarchy as hierarchy_module
from verbarium.operators.hierarchy import descendants, hierarchy, taxonomy_links

LINKS = "child string, parent string"


def brute(links):
    parent = {}
    for c, p in links:
        if c is not None and p is not None:
            parent[c] = min(p, parent.get(c, p))
    nodes = {x for c, p in links if c is not None and p is not None for x in (c, p)}
    out = {}
    for v in nodes:
        path, u = [v], v
        while u in parent and parent[u] not in path:
            u = parent[u]
            path.append(u)
        if u in parent:
            w, ring = parent[v], {v}
            while w not in ring:
                ring.add(w)
                w = parent[w]
            out[v] = ("cycle" if w == v else "below_cycle", None, None, None)
        else:
            out[v] = ("tree", u, len(path) - 1, path[::-1])
    return out


def check(spark, links):
    want = brute(links)
    h = hierarchy(spark.createDataFrame(links, LINKS), with_path=True)
    rows = h.collect()
    assert len(rows) == len(want)
    got = {r.node: (r.status, r.root, r.depth, r.path) for r in rows}
    assert got == want
    below = {v: {x for x, w in want.items() if w[3] and v in w[3] and x != v} for v in want}
    place = {r.node: r for r in rows if r.status == "tree"}
    for v, r in place.items():
        assert r.n_descendants == len(below[v]) == r.rgt - r.lft - 1
        inside = {x for x, q in place.items() if r.lft < q.lft < r.rgt}
        assert inside == below[v]
    pairs = [tuple(x) for x in descendants(h).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(v, x) for v in place for x in below[v]}


def test_shapes(spark):
    deep = [(f"d{i:03}", f"d{i - 1:03}") for i in range(1, 70)]
    star = [(f"s{i}", "hub") for i in range(300)] + [("hub", "top")]
    rings = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("y", "x"), ("self", "self"), ("under", "self")]
    check(spark, deep + star + rings + [("a", "b"), (None, "q"), ("q", None)])


def test_random_forest(spark):
    rng = random.Random(3)
    links = [(f"n{i}", f"n{rng.randrange(max(0, i - 9), i)}") for i in range(1, 200) if rng.random() < 0.95]
    check(spark, links + rng.sample(links, 20))


def test_long_ring_with_tail(spark):
    ring = [(f"r{i}", f"r{(i + 1) % 37}") for i in range(37)]
    tail = [("t0", "r5")] + [(f"t{i}", f"t{i - 1}") for i in range(1, 50)]
    h = hierarchy(spark.createDataFrame(ring + tail, LINKS)).collect()
    assert {r.node for r in h if r.status == "cycle"} == {f"r{i}" for i in range(37)}
    assert {r.cycle_id for r in h} == {"r0"}


def test_empty_and_several_parents(spark):
    assert hierarchy(spark.createDataFrame([], LINKS), with_path=True).count() == 0
    rows = {r.node: r for r in hierarchy(spark.createDataFrame([("c", "p2"), ("c", "p1")], LINKS)).collect()}
    assert rows["c"].parent == "p1" and rows["c"].n_parents == 2 and rows["p2"].status == "tree"


def test_links_from_relations(spark):
    rows = [
        ("1", "a", " hypernym ", "b", "x"), ("2", "b", "HYPONYM_OF", "a", "x"), ("3", "a", "Antonym_Of", "z", None),
        ("4", None, "HYPERNYM_OF", "b", None), ("5", "a", "hypernym_of\t", None, None), ("6", "k", None, "l", None),
    ]
    df = spark.createDataFrame(rows, "id string, subject_id string, relation_type string, object_id string, child string")
    assert [tuple(r) for r in taxonomy_links(df).collect()] == [("a", "b")]


def test_hot_parents_and_blocks(spark, monkeypatch):
    """Keys looked up apart and many blocks of places give the same."""
    monkeypatch.setattr(hierarchy_module, "STALL", 5)
    rng = random.Random(6)
    check(spark, [(f"n{i}", "n0" if i % 3 else f"n{rng.randrange(i)}") for i in range(1, 150)] + [(f"m{i}", f"m{i // 2}") for i in range(1, 60)])
