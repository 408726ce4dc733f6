import random
import re

import pandas as pd

from verbarium.llm import leakage


def brute(docs, items, n):
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda t: {tuple(words(t)[i : i + n]) for i in range(len(words(t)) - n + 1)}
    return {(d, i) for d, t in docs if t for i, u in items if u and grams(t) & grams(u)}


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "x", i) for i, t in docs], "doc_id long, text string, hash string, item long")
    e = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc int")
    return {(r.doc_id, r.item_id) for r in leakage.leaks(d, "doc_id", e, "item_id", **kw).collect()}


def corpus(seed, vocabulary):
    rng = random.Random(seed)
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(rng.randrange(5, 60)))) for i in range(25)]
    docs = []
    for d in range(120):
        body = say(rng.randrange(0, 80))
        if d % 2:
            w = rng.choice(items)[1].split()
            k = rng.randrange(len(w))
            body = body + [x.upper() + "," for x in w[k : k + rng.randrange(8, 16)]] + say(5)
        docs.append((d, " ".join(body)))
    return docs, items


def test_against_brute_force(spark):
    for seed, words in ((1, [f"w{i}" for i in range(300)]), (2, ["a", "b", "é"])):
        docs, items = corpus(seed, words)
        assert run(spark, docs, items) == brute(docs, items, 12)


def test_without_broadcast(spark):
    docs, items = corpus(3, [f"w{i}" for i in range(300)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert run(spark, docs, items) == brute(docs, items, 12)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_spans_are_maximal(spark):
    docs, items = corpus(7, [f"w{i}" for i in range(40)])
    items.append((90, " ".join(f"v{i}" for i in range(50))))
    docs.append((900, "start " + " ".join(f"v{i}" for i in range(2, 44)) + " end " + " ".join(f"v{i}" for i in range(20, 33))))
    w = lambda t: re.findall(r"[^\W_]+", t.lower())
    want = set()
    for d, t in docs:
        for i, u in items:
            x, y = w(t), w(u)
            for a in range(len(x)):
                for b in range(len(y)):
                    if x[a] == y[b] and (not a or not b or x[a - 1] != y[b - 1]):
                        n = 0
                        while a + n < len(x) and b + n < len(y) and x[a + n] == y[b + n]:
                            n += 1
                        if n >= 12:
                            want.add((d, i, a, b, n))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    e = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in leakage.leaked_spans(d, "doc_id", e, "item_id").collect()}
    assert got == want and any(x[4] == 42 for x in got)


def test_long_texts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(leakage, "CHUNK", 50)
    docs, items = corpus(9, [f"w{i}" for i in range(100)])
    longest = " ".join(t for _, t in docs)
    for t in (longest, longest[:900]):
        flat = [(o, p) for f, own, place in leakage._pieces(pd.Series([t, "a b", t]), 12) for o, p in zip(own, place)]
        assert {p for o, p in flat if o == 2} == set(range(len(t.split()))) and all(o != 1 for o, _ in flat)
    assert run(spark, docs, items) == brute(docs, items, 12)


def test_edges(spark):
    twelve = " ".join(f"t{i}" for i in range(12))
    opening = " ".join(f"o{i}" for i in range(11))
    docs = [(None, twelve), (1, None), (2, ""), (3, twelve), (4, opening + " x " + opening), (5, "no " * 30_000 + twelve + " no" * 30_000), (6, twelve), (6, twelve)]
    items = [(None, twelve), (1, twelve + " tail"), (2, opening + " y"), (3, None), (4, "short"), (1, twelve + " tail")]
    assert run(spark, docs, items) == {(3, 1), (5, 1), (6, 1)}
    assert run(spark, [], items) == set() and run(spark, docs, []) == set()
