import random

import numpy as np
import pytest

from verbarium.llm import mixing

DOCS = "doc_id long, text string, source string, tokens int, rate double"
TARGETS = "source string, target_share double, max_repeats int"


def documents(n=400):
    rng = random.Random(4)
    words = {"a": "red green blue stone", "b": "run jump swim fly", "c": "one two three four"}
    out = []
    for i in range(n):
        s = "aaab"[i % 4] if i % 10 else "c"
        body = " ".join(rng.choice(words[s].split()) for _ in range(rng.randrange(5, 60)))
        out.append((i, body, {0: s, 1: f" {s.upper()} "}.get(i % 2), 0, 0.0))
    return out + [(9001, None, "a", 0, 0.0), (9002, "", "b", 0, 0.0), (9003, "red run", None, 0, 0.0), (9004, "red run", "other", 0, 0.0)]


def test_shares_are_met(spark):
    d = spark.createDataFrame(documents(), DOCS)
    t = spark.createDataFrame([("A", 0.3, 1), ("b", 0.4, 2), ("c", 0.2, 3), ("absent", 0.1, 5), ("zero", 0.0, 1), (None, 0.5, 1)], TARGETS)
    m = mixing.mixture(d, t)
    rows = m.collect()
    assert len(rows) == 402 and {r.source for r in rows} == {"a", "b", "c"}
    caps = {"a": 1, "b": 2, "c": 3}
    assert all(0 <= r.copies <= caps[r.source] and 0 <= r.rate <= caps[r.source] for r in rows)
    assert all(r.copies == 0 for r in rows if r.n_tokens == 0)
    got = {r.source: r for r in mixing.shares(m, t).collect()}
    for s, want in (("a", 3 / 9), ("b", 4 / 9), ("c", 2 / 9)):
        assert got[s].actual_share == pytest.approx(want, abs=0.005)
    assert got["absent"].tokens_used == 0 and got["absent"].actual_share == 0
    # as large as the caps allow: one source is used up
    assert any(got[s].tokens_used >= 0.97 * caps[s] * got[s].tokens_available for s in caps)


def test_rates_meet_expected_totals(spark):
    rng = np.random.default_rng(2)
    n = 3000
    s = rng.integers(0, 2, n)
    p = np.clip(np.column_stack([0.7 - 0.4 * s + rng.normal(0, 0.2, n)]), 0.02, 0.98)
    post = np.hstack([p, 1 - p])
    tok = rng.integers(1, 100, n)
    rows = [(i, "ab"[s[i]], int(tok[i]), post[i].tobytes()) for i in range(n)]
    import pandas as pd

    plan = mixing.fit_mixture(spark.createDataFrame(rows, "doc_id long, source string, n_tokens int, post binary"), pd.DataFrame({"source": ["a", "b"], "target_share": [0.6, 0.4], "max_repeats": [3, 3]}), total=60_000, soft=1e-3)
    r, _ = plan.rates(s, post)
    assert r.min() >= 0 and r.max() <= 3
    assert (r * tok)[s == 0].sum() == pytest.approx(36_000, rel=1e-3) and (r * tok)[s == 1].sum() == pytest.approx(24_000, rel=1e-3)
    assert (r * tok) @ post[:, 0] == pytest.approx(36_000, rel=0.02)


def test_classifier_on_held_out_documents(spark):
    d = spark.createDataFrame(documents(1500), DOCS)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 1), ("c", 0.2, 1)], TARGETS)
    # labels are missing from half of the documents; their true source is known from the vocabulary
    rows = [r for r in mixing.membership(d, t).collect() if r.source is None and r.doc_id < 9000]
    true = {i: ("aaab"[i % 4] if i % 10 else "c") for i in range(1500)}
    assert len(rows) > 300 or not rows
    all_rows = mixing.membership(spark.createDataFrame([(i, b, s if i % 3 else None, 0, 0.0) for i, b, s, _, _ in documents(1500)], DOCS), t).collect()
    held = [r for r in all_rows if r.source is None and r.doc_id < 9000 and r.n_tokens]
    assert np.mean([r.likely == true[r.doc_id] for r in held]) > 0.95


def test_nothing_to_mix(spark):
    d = spark.createDataFrame(documents(20), DOCS)
    t = spark.createDataFrame([("a", 0.5, 1)], TARGETS)
    assert mixing.mixture(d, t.limit(0)).count() == 0
    empty = mixing.mixture(d.limit(0), t)
    assert empty.count() == 0 and mixing.shares(empty, t).first().tokens_used == 0


def test_one_oversized_document(spark):
    """A document larger than its source's whole part must not push the small ones out."""
    d = spark.createDataFrame([(0, "word " * 5000, "a", 0, 0.0)] + [(i, f"red stone {i} " * (3 + i % 9), "ab"[i % 2], 0, 0.0) for i in range(1, 200)], DOCS)
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], TARGETS)
    m = mixing.mixture(d, t)
    for r in mixing.shares(m, t).collect():
        assert r.actual_share == pytest.approx(r.due_share, abs=0.005)


def test_unlabelled_documents_take_part(spark):
    rows = [(i, b, s if i % 3 else None, 0, 0.0) for i, b, s, _, _ in documents(900)]
    t = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.2, 3)], TARGETS)
    d = spark.createDataFrame(rows, DOCS)
    got = mixing.mixture(d, t, unlabelled=True).collect()
    free = [r for r in got if r.source is None and r.n_tokens]
    assert len(got) == len(rows) and any(r.copies for r in free) and max(r.copies for r in free) <= 3
    assert all(r.source not in (None, "other") for r in mixing.mixture(d, t).collect())
    for r in mixing.fit_report(d, t, unlabelled=True).filter("condition = 'label'").collect():
        assert r.fitted_tokens == pytest.approx(r.goal_tokens, rel=0.01)


def test_contradicting_targets(spark):
    d = spark.createDataFrame(documents(100), DOCS)
    t = spark.createDataFrame([("a", 0.2, 1), ("A ", 0.6, 1), ("b", 0.4, 1), ("b", 0.4, 1)], TARGETS)
    used = {s: sum(r.n_tokens * r.copies for r in mixing.mixture(d, t).collect() if r.source == s) for s in "ab"}
    assert used["a"] / (used["a"] + used["b"]) == pytest.approx(0.6, abs=0.02)
