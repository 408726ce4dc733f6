import random

import numpy as np
import pandas as pd
import pytest

from verbarium.llm import matching

ROW = "key string, side string, lemma string, pos string, gloss string, sound string, hw string"


def test_headword_keys():
    same = ["gleathorisation", "Gleathorization", "the gleathorisation", '"GLEATHORISATION"', "gléathorisation (2)", "glea​thor­isation#3", "gleathorisation.1", "gl&eacute;athorisation", "glea-thorisation,", "gleathorisation#3.1", "gleathorisation.2 (1)", "a gleathorisation¹", "  to\tgleathorisation "]
    assert {matching.headword_key(x) for x in same} == {"gleathorization"}
    assert matching.headword_key("theathor") == "theathor" and matching.headword_key(None) == "" == matching.headword_key(" \u200b")
    assert matching.headword_key("B12") == "b12" != matching.headword_key("B6") and matching.headword_key("24/7") == "247" and matching.headword_key("v1.2") == "v12"
    assert matching.headword_key("हिन्दी") != matching.headword_key("हिन्द") and matching.headword_key("?!") == "?!"
    assert matching.sound_key("/ˈɡɹiː/") == matching.sound_key("[gri]") and matching.sound_key(None) is None


def lexicon(seed=5, n=260):
    """Invented lexemes with two sources of noisy rows and the true pairs."""
    rng = random.Random(seed)
    syllables = ["gle", "thor", "ka", "mipo", "stru", "ven", "dai", "lox", "rim", "fau", "zeb", "nul"]
    nouns, verbs, adjectives = (["".join(rng.sample("bcdfgklmnprst", 3)) + w for w in ("oma", "ula", "iri", "eko") for _ in range(25)] for _ in range(3))
    rows, pairs, seen = [], set(), set()
    for i in range(n):
        word = "".join(rng.choice(syllables) for _ in range(4))
        pos = rng.choice("nva")
        for sense in range(2 if i % 10 == 0 else 1):
            if (word, pos, sense) in seen:
                continue
            seen.add((word, pos, sense))
            a, b, c = rng.choice(nouns), rng.choice(verbs), rng.choice(adjectives)
            slip = word[:5] + rng.choice("xyz") + word[6:] if i % 7 == 3 else word
            k = f"k{i}_{sense}"
            rows.append((k, "K", word.title() if i % 3 else f'"{word}"', None if i % 23 == 5 else pos, f"any {c} {a} that serves, to {b}", None, None))
            rows.append((f"o{i}_{sense}", "O", slip, pos, f"the act of {b} near a {c} {a}", None, None))
            pairs.add((k, f"o{i}_{sense}"))
            if i % 10 and i % 2:
                rows.append((f"inf_{i}", "I", word, pos, None, None, None))
                pairs.add((f"inf_{i}", k))
            if i % 5 == 1:  # a longer, derived word is another one
                rows.append((f"od{i}", "O", word + "ness", pos, f"the act of {rng.choice(verbs)} near a {rng.choice(adjectives)} {rng.choice(nouns)}", None, None))
    return rows, {tuple(sorted(p)) for p in pairs}


def test_recall_and_precision(spark):
    rows, true = lexicon()
    got = {(r.key_a, r.key_b): r.confidence for r in matching.scored_pairs(spark.createDataFrame(rows + rows[:30], ROW)).collect()}
    assert all(a < b and 0.5 <= c <= 1 for (a, b), c in got.items())
    assert len(true & set(got)) >= 0.95 * len(true)
    assert len(true & set(got)) >= 0.97 * len(got)


def jaccard(a, b):
    tri = lambda w: {f"\2\2{w}\3\3"[i : i + 3] for i in range(len(w) + 2)}
    return len(tri(a) & tri(b)) / len(tri(a) | tri(b))


def test_bands_keep_the_formula():
    rng = random.Random(3)
    pairs = []
    for _ in range(1500):
        w = "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(5, 16)))
        v = list(w)
        for _ in range(rng.randrange(1, 5)):
            v[rng.randrange(len(v))] = rng.choice("xyz")
        pairs.append((w, "".join(v)))
    for bands in (matching.LETTERS, matching.NEAR):
        a, b = (matching.letter_bands(pd.Series([p[i] for p in pairs]), bands) for i in (0, 1))
        met, want = (a == b).any(axis=1), np.array([matching.band_recall(jaccard(*p), bands) for p in pairs])
        for low in np.arange(0, 1, 0.1):
            own = (want >= low) & (want < low + 0.1)
            if own.sum() > 100:
                assert met[own].mean() == pytest.approx(want[own].mean(), abs=0.15)
    # weighted: sets agree in proportion to shared weight
    sets = pd.Series([["a", "b", "c"], ["b", "c", "d"]] * 300)
    many = matching.Bands(1, 400, 9)
    got = matching.word_bands(sets, pd.Series([[1.0, 3.0, 1.0], [3.0, 1.0, 5.0]] * 300), many)
    assert (got[0] == got[1]).mean() == pytest.approx(4 / 10, abs=0.08)
    long = matching.letter_bands(pd.Series(["ab" * 20_000, "ab" * 20_000, "b"]), matching.LETTERS)
    assert (long[0] == long[1]).all() and not (long[0] == long[2]).any()


def test_block_recall_against_brute_force(spark):
    """Every attribute leads to pairs: letters alone, letters with gloss, letters with sound."""
    rng = random.Random(8)
    letters = "abcdefghiklmnoprstuvz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(9, 15))) for _ in range(240)]
    vocabulary = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(200)]

    def slip(w, n):
        for _ in range(n):
            i = rng.randrange(1, len(w) - 1)
            w = w[:i] + rng.choice(("", "q", "q" + w[i])) + w[i + 1 :]
        return w

    rows, want = [], {"letters": set(), "gloss": set(), "sound": set()}
    for i, w in enumerate(words):
        kind = ("letters", "gloss", "sound")[i % 3]
        v = slip(w, 1 if kind == "letters" else 2)
        gloss = " ".join(rng.sample(vocabulary, 6)) if kind == "gloss" else None
        sound = "".join(rng.choice("abdefgiklmnoprstuvz") for _ in range(9)) if kind == "sound" else None
        rows += [(f"k{i}", "K", w, "n", gloss, sound), (f"o{i}", "O", v, "n", gloss, sound)]
        want[kind].add((matching.headword_key(w), matching.headword_key(v)))
    prof, glosses = matching.profiles(spark.createDataFrame(rows, "key string, side string, lemma string, pos string, gloss string, sound string"))
    got = {(r.hw, r.hw2) for r in matching.candidate_headwords(prof.drop("key").distinct(), glosses).collect()}
    for kind, pairs in want.items():
        assert len(pairs & got) >= 0.97 * len(pairs), kind
    assert len(got) < 0.1 * len(words) ** 2  # blocks are not all pairs


def test_labels_come_from_what_a_classifier_does_not_see():
    rng = np.random.default_rng(5)
    n = 4000
    true = rng.random(n) < 0.4
    f = pd.DataFrame({c: np.zeros(n, int) for c in matching._DIFFER})
    f["same"] = np.where(true, rng.random(n) < 0.9, rng.random(n) < 0.3).astype(int)
    f["far"] = 1 - f["same"]
    f["pos_same"], f["sound"], f["rivals"], f["peers"], f["taken"] = 1, 0, 0.0, 1, 0.0
    f["overlap"] = np.where(true, rng.uniform(0.5, 1, n), rng.uniform(0, 0.4, n))
    form, gloss, report = matching.fit(f)
    assert report["form"]["accuracy"] > 0.75 and report["gloss"]["accuracy"] > 0.7
    p = 1 / (1 + np.exp(-(matching._form_terms(f) @ form + gloss[0] + gloss[1] * f["overlap"])))
    assert ((p > 0.5) == true).mean() > 0.8
    few = matching.fit(f.head(0))  # without labels the prior holds
    assert np.allclose(few[0], matching._PRIOR_FORM, atol=0.2)


def test_hot_headword(spark):
    """One headword with very many senses: its glosses tell them apart and do not all meet."""
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(5)) for _ in range(400)]
    rows, true = [], set()
    for i in range(300):
        g = " ".join(rng.sample(vocabulary, 5))
        rows += [(f"k{i}", "K", "mistrovanel", "n", g, None), (f"o{i}", "O", "mistrovanel", "n", g + " indeed", None)]
        true.add((f"k{i}", f"o{i}"))
    for i in range(200):
        w, g = "".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(10)), " ".join(rng.sample(vocabulary, 5))
        rows += [(f"kx{i}", "K", w, "v", g, None), (f"ox{i}", "O", w, "v", "indeed " + g, None)]
        true.add((f"kx{i}", f"ox{i}"))
    got = {(r.key_a, r.key_b) for r in matching.scored_pairs(spark.createDataFrame(rows, "key string, side string, lemma string, pos string, gloss string, sound string")).collect()}
    assert len(true & got) >= 0.98 * len(true) and len(true & got) >= 0.98 * len(got)


def test_odd_rows(spark):
    rows = [("k1", "K", None, None, None, None, None), ("k2", "K", "", "n", "", "", None), ("k3", "K", "same", None, None, None, None), ("o3", "O", "same", None, None, None, None), ("o4", "O", "x" * 300, "n", "word " * 5000, None, None), ("k4", "K", "X" * 300, "n", None, None, None)]
    df = spark.createDataFrame(rows, ROW).filter("key is not null and lemma is not null")
    got = {(r.key_a, r.key_b) for r in matching.scored_pairs(df).collect()}
    assert got <= {("k3", "o3"), ("k4", "o4")}
    assert matching.scored_pairs(df.limit(0)).count() == 0


def test_staging_rows(spark):
    e = spark.createDataFrame([("k", "KAIKKI", "a", "noun", '{"senses":[{"glosses":["x y"]}],"sounds":[{"ipa":"/a/"}]}'), ("o", "OEWN_2025", "a", "n", "no json"), ("z", "OTHER", "a", "n", None)], "source_id string, source string, lemma string, pos string, raw_payload string")
    r = spark.createDataFrame([("m", "oewn-1-v", "MEMBER", "a", "x", None), ("n", "oewn-1-v", "hypernym", None, "v", None)], "row_id string, synset_id string, relation_type string, lemma string, pos string, definition string")
    i = spark.createDataFrame([(7, "a", "x", "V;PST"), (8, None, "n", None)], "inflection_id long, lemma string, pos string, features string")
    got = {r.key: (r.side, r.pos, r.gloss, r.sound) for r in matching.lexical_rows(e, r, i).collect()}
    assert got == {"k": ("K", "n", "x y", "/a/"), "o": ("O", "n", None, None), "m": ("M", "v", None, None), "inf_7": ("I", "v", None, None)}
