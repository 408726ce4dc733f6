"""Matching entities across sources without keys.

Rows become profiles (headword key, part of speech, gloss words, sound). Candidates come from min-hash signatures cut
into bands: of the headword's letters, and, for headwords further apart, of letters and gloss or letters and sound
together. Pairs of profiles get similarity features. Two logistic classifiers judge them: one by headword, part of
speech, sound and competition, fitted on pairs labelled by their glosses; one by gloss, fitted on pairs labelled by
their headwords. Neither sees what its labels come from; each is calibrated on held-out pairs, and their log odds add up.

Two sets of Jaccard similarity j share a band of r rows among b with probability ``1 - (1 - j ** r) ** b``, see
:func:`band_recall`. One slip in a headword of L letters leaves j = (L - 1) / (L + 5) of its trigrams, which is found with
probability 0.993 at 8 letters and 0.9996 at 10. What shares a band is verified: headwords that differ in
more than a third of their letters are no candidates.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbarium.lineage import cut, drop
from verbarium.operators.lookup import lookup, spread
from verbarium.shipping import ship


@dataclass(frozen=True)
class Bands:
    """A signature: ``n`` bands of ``rows`` min-hashes each; ``seed`` draws the hash functions."""

    rows: int
    n: int
    seed: int


#: Letter trigrams of headwords.
LETTERS = Bands(4, 56, 1)
#: Letters beside gloss or sound; a band of one is joined with the same band of the other.
NEAR, GLOSS, SOUND = Bands(2, 24, 2), Bands(2, 24, 3), Bands(2, 24, 4)
#: Gloss words among the profiles of a pair of headwords.
SENSE = Bands(1, 16, 5)
#: Labelled pairs the classifiers are fitted and calibrated on, at most, and profiles of one headword among them.
TRAIN_PAIRS, TRAIN_PER_HEADWORD = 30_000, 20
THRESHOLD = 0.5
#: Profiles of a headword from which on its pairs are found by band.
BUSY = 50

# Tags of the sources and the part of speech they stand for; others say nothing.
_POS = {
    "n": "n", "noun": "n", "v": "v", "verb": "v", "a": "a", "s": "a", "adj": "a", "adjective": "a", "r": "r", "adv": "r", "adverb": "r",
}
_PARTS = ["n", "v", "a", "r"]
#: Spellings of one ending in different regions, taken together.
_ENDINGS = [("isation", "ization"), ("ise", "ize"), ("yse", "yze"), ("our", "or"), ("ogue", "og")]
#: Marks that change a letter's look only: accents, and what stands around symbols; vowel signs of other scripts are letters.
_ACCENT = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")


def band_recall(j: float, bands: Bands) -> float:
    """The probability that two sets of Jaccard similarity ``j`` share a band."""
    return 1 - (1 - j**bands.rows) ** bands.n


def headword_key(lemma: str | None) -> str:
    """A headword's letters, vowel signs and digits: entities decoded, accents, articles and sense numbers dropped, regional endings folded.

    A headword of other characters only is its own key; one of white space and invisible characters has none.
    """
    if not lemma:
        return ""
    s = re.sub(r"[¹²³⁰-⁹]", "", html.unescape(lemma))
    s = "".join(c for c in _ACCENT.sub("", unicodedata.normalize("NFKD", s)) if unicodedata.category(c) != "Cf").lower()
    edge = " \t\n\r\"'.,;:“”‘’"
    s = whole = re.sub(r"\s+", " ", s).strip()
    s = s.strip(edge)
    s = re.sub(r"(?<=\S)(?:\s*(?:#\d+(?:\.\d+)?|\(\d+\)|(?<!\d)\.\d+))+$", "", s).strip(edge)
    s = re.sub(r"^(?:(?:to|the|an?)[\s_]+[\"'“‘]*(?=\S))+", "", s)
    s = "".join(c for c in s if c.isalnum() or unicodedata.category(c)[0] == "M") or whole
    for a, b in _ENDINGS:
        if s.endswith(a) and len(s) > len(a) + 2:
            return s[: -len(a)] + b
    return s


def sound_key(sound: str | None) -> str | None:
    """A transcription without brackets, stress and spelling habits."""
    if not sound:
        return None
    s = unicodedata.normalize("NFD", sound).replace("ɹ", "r").replace("ɡ", "g")
    return re.sub(r"[^\w]|[ˈˌː]", "", s).lower() or None


@F.pandas_udf(T.StructType([T.StructField("hw", T.StringType()), T.StructField("sound_k", T.StringType())]))
def _keys(lemmas: pd.Series, sounds: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"hw": lemmas.map(headword_key), "sound_k": sounds.map(sound_key)})


def _pos(tag: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in _POS.items() for x in kv])
    return F.try_element_at(table, F.regexp_replace(F.lower(tag), r"^[\s\p{Z}]+|[\s\p{Z}.]+$", ""))


def _words(gloss: Column) -> Column:
    return F.regexp_extract_all(F.lower(gloss), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


# ---------------------------------------------------------------- signatures


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _minima(flat: np.ndarray, starts: np.ndarray, bands: Bands, weight: np.ndarray | None = None) -> np.ndarray:
    """Min-hashes ``[set, bands.n * bands.rows]`` of sets that lie end to end in ``flat``; none is empty.

    With weights the smallest of exponential draws is kept, so that sets agree in proportion to shared weight.
    """
    rng = np.random.default_rng(bands.seed)
    k = bands.rows * bands.n
    mul, add = rng.integers(0, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, k, np.uint64)
    out = np.empty((len(starts), k), np.float64 if weight is not None else np.uint64)
    ends = np.append(starts[1:], len(flat))
    done = 0
    while done < len(starts):  # as many sets at a time as have few elements together
        upto = max(done + 1, int(np.searchsorted(ends, starts[done] + 8192, "right")))
        a, b = starts[done], ends[upto - 1]
        if b - a > 8192:  # one very large set, piece by piece
            cuts = [slice(i, min(i + 8192, b)) for i in range(a, b, 8192)]
            parts = [_minima(flat[c], np.zeros(1, int), bands, None if weight is None else weight[c]) for c in cuts]
            out[done] = np.min(np.vstack(parts), axis=0)
        else:
            with np.errstate(over="ignore"):
                h = flat[a:b, None] * mul + add
            if weight is not None:
                h = -np.log((_mixed(h) >> np.uint64(11)).astype(float) / 2**53 + 2**-54) / weight[a:b, None]
            out[done:upto] = np.minimum.reduceat(h, starts[done:upto] - a, axis=0)
        done = upto
    return out


def _folded(minima: np.ndarray, bands: Bands) -> np.ndarray:
    """One hash per band ``[set, bands.n]``."""
    rows = minima.view(np.uint64).reshape(len(minima), bands.n, bands.rows)
    out = np.tile(np.arange(bands.n, dtype=np.uint64) + np.uint64(1000 * bands.seed), (len(minima), 1))
    for i in range(bands.rows):
        with np.errstate(over="ignore"):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
    return out


def _trigrams(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter trigrams of non-empty texts, two marks at either end, end to end, and where each text's start."""
    padded = [f"\2\2{t}\3\3" for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    tri = codes[:-2] | codes[1:-1] << np.uint64(21) | codes[2:] << np.uint64(42)
    start = np.cumsum(size) - size
    own = np.ones(len(codes), bool)
    own[start + size - 1] = own[start + size - 2] = False
    return _mixed(tri[own[:-2]]), start - 2 * np.arange(len(padded))


def letter_bands(texts: pd.Series, bands: Bands) -> np.ndarray:
    flat, starts = _trigrams(texts)
    return _folded(_minima(flat, starts, bands), bands)


def word_bands(sets: pd.Series, weights: pd.Series, bands: Bands) -> np.ndarray:
    """Of non-empty arrays of words and their weights."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = _mixed(pd.util.hash_array(np.concatenate([np.asarray(x, object) for x in sets])))
    return _folded(_minima(flat, np.cumsum(size) - size, bands, np.concatenate([np.asarray(w, float) for w in weights])), bands)


def _listed(rows: np.ndarray) -> pd.Series:
    return pd.Series(list(rows.view(np.int64)), dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _letters(hw: pd.Series) -> pd.Series:
    return _listed(letter_bands(hw, LETTERS)) if len(hw) else pd.Series([], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _senses(words: pd.Series, weights: pd.Series) -> pd.Series:
    return _listed(word_bands(words, weights, SENSE)) if len(words) else pd.Series([], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _near_gloss(hw: pd.Series, words: pd.Series, weights: pd.Series) -> pd.Series:
    return _listed(_mixed(letter_bands(hw, NEAR) ^ word_bands(words, weights, GLOSS))) if len(hw) else pd.Series([], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _near_sound(hw: pd.Series, sound: pd.Series) -> pd.Series:
    return _listed(_mixed(letter_bands(hw, NEAR) ^ letter_bands(sound, SOUND))) if len(hw) else pd.Series([], dtype=object)


# ---------------------------------------------------------------- rows and profiles


_PAYLOAD = "senses array<struct<glosses array<string>, definition string>>, sounds array<struct<ipa string>>, pronunciation array<struct<value string>>"


def lexical_rows(entries: DataFrame, relations: DataFrame, inflections: DataFrame) -> DataFrame:
    """``(key, side, lemma, pos, gloss, sound)`` of the three staging tables.

    ``side``: K for KAIKKI entries, O for OEWN_2025 entries, M for MEMBER rows, I for inflections. Payloads
    that are no JSON count as missing.
    """
    p = F.from_json("raw_payload", _PAYLOAD)
    gloss = F.array_join(F.flatten(F.transform("p.senses", lambda s: F.concat(F.coalesce(s["glosses"], F.array()), F.array(s["definition"])))), " ")
    sound = F.coalesce(F.get(F.filter("p.sounds.ipa", lambda x: x.isNotNull()), F.lit(0)), F.get(F.filter("p.pronunciation.value", lambda x: x.isNotNull()), F.lit(0)))
    own = entries.filter(F.col("source").isin("KAIKKI", "OEWN_2025")).select("source_id", "source", "lemma", "pos", p.alias("p"))
    own = own.select(F.col("source_id").alias("key"), F.when(F.col("source") == "KAIKKI", "K").otherwise("O").alias("side"), "lemma", _pos(F.col("pos")).alias("pos"), gloss.alias("gloss"), sound.alias("sound"))
    member = relations.filter("relation_type = 'MEMBER'").select(
        F.col("row_id").alias("key"), F.lit("M").alias("side"), "lemma", F.coalesce(_pos(F.col("pos")), _pos(F.regexp_extract("synset_id", "-([a-z])$", 1))).alias("pos"), F.col("definition").alias("gloss"), F.lit(None).cast("string").alias("sound")
    )
    tag = F.lower(F.regexp_extract("features", r"(?:^|[^\p{L}])(N|V|ADJ|ADV)(?:[^\p{L}]|$)", 1))
    inf = inflections.select(
        F.concat(F.lit("inf_"), "inflection_id").alias("key"), F.lit("I").alias("side"), "lemma", F.coalesce(_pos(F.col("pos")), _pos(tag)).alias("pos"), F.lit(None).cast("string").alias("gloss"), F.lit(None).cast("string").alias("sound")
    )
    return own.unionByName(member).unionByName(inf).filter("key is not null and lemma is not null")


def _weighted_glosses(base: DataFrame) -> DataFrame:
    """``(gid, words, weights)`` of the distinct glosses that have words; a word weighs the square of the log of its rarity.

    Words that a third of all glosses have do not make a hot key: see :func:`lookup`.
    """
    glosses = base.filter("gid is not null").select("gid", "words").distinct()
    long = glosses.select("gid", F.explode("words").alias("w"))
    df = cut(long.groupBy("w").agg(F.count(F.lit(1)).alias("df")))
    n, total = glosses.count(), df.agg(F.sum("df")).first()[0] or 0
    rarity = F.log((F.lit(n) + 1.0) / F.col("df"))
    table = df.select("w", "df", (rarity * rarity + 1e-4).alias("weight"))
    return lookup(long, table, ["w"], "df", total).groupBy("gid").agg(F.array_sort(F.collect_list(F.struct("w", "weight"))).alias("x")).select("gid", F.col("x.w").alias("words"), F.col("x.weight").alias("weights"))


def _read_off(base: DataFrame) -> DataFrame:
    """``(side, gid, read_pos)``: the part of speech that a gloss's words speak for, where it is nine times likelier than not.

    Naive Bayes per side, from the glosses whose part of speech is given.
    """
    told = base.filter("pos is not null and gid is not null").select("side", "gid", "words", "pos").distinct()
    long = told.select("side", F.explode("words").alias("w"), "pos")
    by_word = long.groupBy("side", "w").agg(*[F.count_if(F.col("pos") == p).alias(p) for p in _PARTS], F.count(F.lit(1)).alias("m"))
    sums = told.groupBy("side").agg(*[F.count_if(F.col("pos") == p).alias("n_" + p) for p in _PARTS])  # a row per side
    lacking = base.filter("pos is null and gid is not null").select("side", "gid", "words").distinct().select("side", "gid", F.explode("words").alias("w"))
    by_word = cut(by_word)
    met = lookup(lacking, by_word, ["side", "w"], "m", by_word.agg(F.sum("m")).first()[0] or 0).join(F.broadcast(sums), "side")
    z = [F.sum(F.log((F.col(p) + 0.5) / (F.col("n_" + p) + 1.0))) + F.max(F.log(F.col("n_" + p) + 0.5)) for p in _PARTS]
    scored = met.groupBy("side", "gid").agg(*[x.alias("z_" + p) for x, p in zip(z, _PARTS)])
    best = F.greatest(*[F.struct(F.col("z_" + p).alias("z"), F.lit(p).alias("p")) for p in _PARTS])
    others = sum((F.exp(F.col("z_" + p) - F.col("b.z")) for p in _PARTS), F.lit(0.0))
    return scored.withColumn("b", best).filter(others <= 1 / 0.9).select("side", "gid", F.col("b.p").alias("read_pos"))


def profiles(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(key, pid, side, hw, pos, gid, sound_k)`` of the rows that have a headword, and ``(gid, words, weights)`` of their glosses.

    The pid is the same for rows that say the same on the same side; a gloss without words has no gid. A missing
    part of speech is read off the gloss's words, if rows that have one allow it.
    """
    ship(rows.sparkSession)
    base = spread(rows).select("key", "side", _keys("lemma", "sound").alias("k"), "pos", F.array_sort(F.array_distinct(_words(F.col("gloss")))).alias("words"))
    base = base.select("key", "side", "k.hw", "pos", "words", "k.sound_k", F.when(F.size("words") > 0, F.xxhash64("words")).alias("gid"))
    base = cut(base.filter("hw <> ''"))
    glosses = cut(_weighted_glosses(base))
    lacking = base.filter("pos is null and gid is not null").drop("words", "pos").join(_read_off(base).withColumnRenamed("read_pos", "pos"), ["side", "gid"], "left")
    full = base.filter("pos is not null or gid is null").drop("words").unionByName(lacking)
    prof = cut(full.select("key", F.unhex(F.md5(F.to_json(F.struct("side", "hw", "pos", "gid", "sound_k")))).alias("pid"), "side", "hw", "pos", "gid", "sound_k"))
    drop(base)
    return prof, glosses


# ---------------------------------------------------------------- candidates


def _met(rows: DataFrame, bands: Column, once: bool) -> DataFrame:
    """``(hw, hw2, e)`` of different headwords in rows ``(hw, left, right)`` that share a band, ``e`` edits apart, at most a third of the longer one's letters.

    A band holds each headword once, whatever glosses or sounds it has there; ``once``: it has one row anyway. Rows move once, to their bands.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a number of partitions of its own: small as the rows are, signatures take time
    long = rows.repartition(parts, "hw").select("hw", "left", "right", F.explode(bands).alias("h")).repartition(parts, "h")
    if not once:
        long = long.groupBy("h", "hw").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    other = long.filter("right").select("h", F.col("hw").alias("hw2"))
    # either side is spread over many partitions already, so none is sorted for it
    met = long.filter("left").join(other.hint("shuffle_hash"), "h").filter("hw <> hw2")
    e = F.expr("levenshtein(hw, hw2, cast(floor(greatest(length(hw), length(hw2)) / 3) as int))")
    return met.select("hw", "hw2", e.alias("e")).filter("e >= 0")


def candidate_headwords(one: DataFrame, glosses: DataFrame) -> DataFrame:
    """``(hw, hw2, ...)``: headwords of side K and of another side that share a band of letters, letters and gloss, or letters and sound.

    Bands hold distinct headwords, however many rows these have. Beside them stand how the two differ: ``same``,
    ``slip`` (one letter added, lost or changed, or two neighbours swapped), ``two`` (two edits), ``far`` (more), and ``longer``: one goes on for two letters
    or more where the other ends.
    """
    marked = one.select("hw", "gid", "sound_k", (F.col("side") == "K").alias("left"), (F.col("side") != "K").alias("right"))
    flags = [F.max("left").alias("left"), F.max("right").alias("right")]
    heads = cut(marked.groupBy("hw").agg(*flags))
    by_letters = _met(heads, _letters("hw"), True)
    told = marked.filter("gid is not null").groupBy("hw", "gid").agg(*flags).join(glosses, "gid")
    by_gloss = _met(told, _near_gloss("hw", "words", "weights"), False)
    heard = marked.filter("sound_k is not null").groupBy("hw", "sound_k").agg(*flags)
    by_sound = _met(heard, _near_sound("hw", "sound_k"), False)
    equal = heads.filter("left and right").select("hw", F.col("hw").alias("hw2"), F.lit(0).alias("e"))  # equal sets share all bands
    pairs = equal.unionByName(by_letters.unionByName(by_gloss).unionByName(by_sound).distinct())
    shorter = F.least(F.length("hw"), F.length("hw2"))
    stem = shorter - 2  # the end of a stem may change spelling before what is added
    longer = (F.greatest(F.length("hw"), F.length("hw2")) - shorter > 1) & (F.substring(F.col("hw"), F.lit(1), stem) == F.substring(F.col("hw2"), F.lit(1), stem))
    with_edits = pairs.select("hw", "hw2", "e", longer.cast("int").alias("longer"))
    swapped = (F.col("e") == 2) & (F.array_sort(F.split("hw", "")) == F.array_sort(F.split("hw2", "")))
    slip = (F.col("e") == 1) | swapped
    flag = lambda c, name: c.cast("int").alias(name)
    return with_edits.select("hw", "hw2", flag(F.col("e") == 0, "same"), flag(slip, "slip"), flag((F.col("e") == 2) & ~swapped, "two"), flag(F.col("e") > 2, "far"), "longer")


_SAID = ["pid", "side", "hw", "pos", "gid", "sound_k"]
_DIFFER = ["same", "slip", "two", "far", "longer"]


def _sides(one: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles of side K, and of the others with what competes for each.

    ``rivals``: the log of the number of profiles of side K whose headwords are the same or a slip away and whose part of
    speech does not clash; ``peers``: the number of profiles of its own side and headword.
    """
    own, other = one.filter("side = 'K'").drop("side"), one.filter("side <> 'K'")
    parts = {p: (F.col("pos") == p) for p in _PARTS} | {"none": F.col("pos").isNull()}
    held = own.groupBy("hw").agg(*[F.count_if(c).alias(p) for p, c in parts.items()])
    near = heads.filter("same + slip > 0").select("hw", "hw2").join(held, "hw").groupBy("hw2").agg(*[F.sum(p).alias(p) for p in parts])
    peers = other.groupBy("side", "hw").agg(F.count(F.lit(1)).alias("peers"))
    right = other.join(peers, ["side", "hw"]).select(*[F.col(c).alias(c + "2") for c in _SAID], "peers").join(near, "hw2", "left").na.fill(0, list(parts))
    n = F.coalesce(*[F.when(F.col("pos2") == p, F.col(p) + F.col("none")) for p in _PARTS], sum((F.col(p) for p in parts), F.lit(0)))
    return own, right.withColumn("rivals", F.log(F.greatest(F.lit(1), n)).cast("double")).drop(*parts)


def _paired(led: DataFrame, right: DataFrame, extra: list[str]) -> DataFrame:
    return led.join(right, ["hw2", *extra]).filter("pos is null or pos2 is null or pos = pos2")


def _compared(pairs: DataFrame, glosses: DataFrame) -> DataFrame:
    """Features of profile pairs. ``overlap``: shared weight of the gloss words, as a part of the smaller gloss's; null if either has none."""
    mine = glosses.select("gid", F.arrays_zip("words", "weights").alias("x"))
    other = glosses.select(F.col("gid").alias("gid2"), "words", F.aggregate("weights", F.lit(0.0), lambda a, w: a + w).alias("sum2"))
    both = pairs.filter("gid is not null and gid2 is not null").join(mine, "gid").join(other, "gid2")
    weight = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x["weights"])
    overlap = weight(F.filter("x", lambda x: F.array_contains("words", x["words"]))) / F.least(weight(F.col("x")), F.col("sum2"))
    none = pairs.filter("gid is null or gid2 is null").withColumn("overlap", F.lit(None).cast("double"))
    both = both.withColumn("overlap", overlap).select(*none.columns)
    heard = F.when(F.col("sound_k").isNull() | F.col("sound_k2").isNull(), 0).when(F.col("sound_k") == F.col("sound_k2"), 1).otherwise(-1)
    return none.unionByName(both).select("pid", "pid2", "side2", "rivals", "peers", *_DIFFER, F.coalesce((F.col("pos") == F.col("pos2")).cast("int"), F.lit(0)).alias("pos_same"), heard.alias("sound"), "overlap")


def candidate_pairs(led: DataFrame, right: DataFrame, glosses: DataFrame) -> DataFrame:
    """Pairs of profiles of side K, led to candidate headwords, and of another side whose parts of speech do not clash, with features.

    Two profiles with glosses are a pair if these share a band too, so that the many senses of a frequent headword do
    not all meet: of pairs that share a quarter of the weight all but one in 100 meet, of those that share half all but one in 60,000.
    """
    bands = cut(glosses.select("gid", _senses("words", "weights").alias("h")))
    one, two = (cut(df.join(bands.select(F.col("gid").alias(g), F.col("h").alias(h)), g, "left")) for df, g, h in ((led, "gid", "h1"), (right, "gid2", "h2")))
    # the same pairs either way: the few headwords with many profiles go by band, so that none has all its pairs looked at
    busy = one.groupBy("hw2").agg(F.count(F.lit(1)).alias("n")).unionByName(two.groupBy("hw2").agg(F.count(F.lit(1)).alias("n"))).filter(F.col("n") > BUSY).select("hw2").distinct()
    busy = cut(busy)
    some = _paired(one.join(busy, "hw2", "left_anti"), two.join(busy, "hw2", "left_anti"), []).filter("h1 is null or h2 is null or arrays_overlap(h1, h2)").drop("h1", "h2")
    many, more = one.join(busy, "hw2", "left_semi"), two.join(busy, "hw2", "left_semi")
    told = _paired(many.withColumn("h", F.explode("h1")), more.withColumn("h", F.explode("h2")), ["h"]).drop("h", "h1", "h2").distinct()
    unsaid = _paired(many.filter("gid is null"), more, []).unionByName(_paired(many.filter("gid is not null"), more.filter("gid2 is null"), [])).drop("h1", "h2")
    return _compared(some.unionByName(told).unionByName(unsaid), glosses)


def _training_pairs(led: DataFrame, right: DataFrame, glosses: DataFrame, most: int) -> DataFrame:
    """Pairs of profiles with glosses, whether these agree or not: the first of each headword, and of all, by hash."""

    def first(df: DataFrame, by: list[str], pid: str, gid: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.xxhash64(pid), pid)
        return df.filter(F.col(gid).isNotNull()).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= TRAIN_PER_HEADWORD).drop("_r")

    mine = cut(first(led, ["hw", "hw2"], "pid", "gid").orderBy(F.xxhash64("pid"), "pid", "hw2").limit(2 * most))
    others = cut(first(right, ["side2", "hw2"], "pid2", "gid2"))
    pairs = _paired(mine, others, []).orderBy(F.xxhash64("pid", "pid2"), "pid", "pid2").limit(most)
    # beside them some that chance brings together, for what different words have in common
    some = [df.orderBy(F.xxhash64(k), k).limit(most // 4).withColumn("_i", F.row_number().over(Window.orderBy(F.xxhash64(F.lit(k), k), k))) for df, k in ((mine.drop(*_DIFFER, "hw2"), "pid"), (others, "pid2"))]
    apart = [F.lit(int(c == "far")).alias(c) for c in _DIFFER]
    chance = some[0].join(some[1], "_i").filter("hw <> hw2").select("*", *apart).select(*pairs.columns)
    return _compared(pairs.unionByName(chance), glosses)


# ---------------------------------------------------------------- classifiers

#: Where the coefficients (intercept, then as in ``_form_terms``) are drawn to, by a Gaussian prior of unit weight: the fewer labels, the more.
_PRIOR_FORM = np.array([-3.0, 4.0, 3.0, 0.0, -3.0, -3.0, 1.0, 1.0, -1.0, -1.0, -2.0])
_PRIOR_GLOSS = np.array([-3.0, 9.0])


def _form_terms(f: pd.DataFrame) -> np.ndarray:
    sound = f["sound"].to_numpy(float)
    return np.column_stack([np.ones(len(f)), f[_DIFFER].to_numpy(float), f["pos_same"], sound > 0, sound < 0, f["rivals"], f["taken"]]).astype(float)


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Most probable coefficients under a Gaussian prior around ``prior``; Newton steps, halved until they lead downhill."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + ridge / 2 * ((w - prior) ** 2).sum())

    w, at = prior.copy(), loss(prior)
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]) + ridge * np.eye(x.shape[1]), x.T @ (q - y) + ridge * (w - prior))
        while (new := loss(w - step)) > at and np.abs(step).max() > 1e-9:
            step = step / 2
        w, at = w - step, new
        if np.abs(step).max() < 1e-6:
            break
    return w


def _calibrated(x: np.ndarray, y: np.ndarray, prior: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, dict]:
    """Coefficients from two thirds of the labels, scaled to the held-out third, and how they do there."""
    held = rng.random(len(y)) < 1 / 3
    w = _logistic(x[~held], y[~held], prior)
    scale = _logistic(np.column_stack([np.ones(held.sum()), x[held] @ w]), y[held], np.array([0.0, 1.0]))
    w = w * scale[1]
    w[0] += scale[0]
    q = 1 / (1 + np.exp(-np.clip(x[held] @ w, -30, 30)))
    return w, {"n": len(y), "accuracy": float(((q > 0.5) == y[held]).mean()) if held.any() else None, "brier": float(((q - y[held]) ** 2).mean()) if held.any() else None}


def fit(sample: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, dict]:
    """Coefficients by form and by gloss, and how each did on held-out labels.

    By form: labelled by glosses, half or more of the weight shared against a quarter or less. By gloss: labelled
    by headwords, the same, with the same part of speech and no other sense on either side, against far or longer ones and such as chance brings together; the log odds of these labels
    are taken off again, so that what the gloss says adds to what the form says.
    """
    rng = np.random.default_rng(1)
    clear = sample[(sample["overlap"] >= 0.5) | (sample["overlap"] <= 0.25)]
    form, a = _calibrated(_form_terms(clear), (clear["overlap"] >= 0.5).to_numpy(float), _PRIOR_FORM, rng)
    yes = (sample["same"] == 1) & (sample["pos_same"] == 1) & (sample["rivals"] == 0) & (sample["peers"] == 1)
    no = (sample["far"] == 1) | (sample["longer"] == 1)
    named = sample[yes | no]
    y = yes[yes | no].to_numpy(float)
    gloss, b = _calibrated(np.column_stack([np.ones(len(named)), named["overlap"]]).astype(float), y, _PRIOR_GLOSS, rng)
    gloss[0] -= np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    return form, gloss, {"form": a, "gloss": b}


def _good(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How many partners with half of the gloss each profile has; partial aggregates, no windows."""
    good = pairs.filter("overlap >= 0.5")
    return good.groupBy("pid2").agg(F.count(F.lit(1)).alias("n_good2")), good.groupBy("pid", "side2").agg(F.count(F.lit(1)).alias("n_good"))


def _contested(pairs: DataFrame, of_right: DataFrame, of_left: DataFrame) -> DataFrame:
    """Adds ``taken``: either profile has another partner whose gloss agrees."""
    good = F.coalesce((F.col("overlap") >= 0.5).cast("int"), F.lit(0))
    j = pairs.join(of_right, "pid2", "left").join(of_left, ["pid", "side2"], "left").na.fill(0, ["n_good", "n_good2"])
    return j.withColumn("taken", ((F.col("n_good") > good) | (F.col("n_good2") > good)).cast("double")).drop("n_good", "n_good2")


def matched_profiles(rows: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(pid, key)``, which row has which profile, and ``(pid, pid2, confidence)``, the matched profiles.

    They say all that :func:`scored_pairs` says, in place that grows with the rows and not with pairs of equal ones.
    """
    prof, glosses = profiles(rows.select("key", "side", "lemma", "pos", "gloss", "sound"))
    one = cut(prof.select(*_SAID).distinct())
    heads = cut(candidate_headwords(one, glosses))
    left, right = _sides(one, heads)
    led, right = cut(left.join(heads, "hw")), cut(right)
    pairs = cut(candidate_pairs(led, right, glosses))
    of_right, of_left = (cut(x) for x in _good(pairs))
    form, gloss, _ = fit(_contested(_training_pairs(led, right, glosses, TRAIN_PAIRS), of_right, of_left).toPandas())
    drop(one)
    terms = [F.lit(1.0), *[F.col(c) for c in _DIFFER], F.col("pos_same"), (F.col("sound") > 0).cast("int"), (F.col("sound") < 0).cast("int"), F.col("rivals"), F.when(F.col("overlap").isNull(), F.col("taken")).otherwise(0.0)]
    # where both glosses are known they speak for themselves, whatever other partners there are
    z = sum((t * F.lit(float(c)) for t, c in zip(terms, form)), F.lit(0.0))
    said = F.coalesce(F.lit(float(gloss[0])) + F.lit(float(gloss[1])) * F.col("overlap"), F.lit(0.0))
    matched = _contested(pairs, of_right, of_left).select("pid", "pid2", (1 / (1 + F.exp(-(z + said)))).alias("confidence")).filter(F.col("confidence") >= threshold)
    return prof.select("pid", "key").distinct(), matched


def scored_pairs(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(key_a, key_b, confidence)`` of matched rows, the smaller key first.

    ``rows`` as of :func:`lexical_rows`. Rows without a headword match nothing; missing parts of speech,
    glosses and sounds are judged by what else there is; repeated rows change nothing; extra columns are not
    read; empty tables give no rows. Matching is between distinct profiles, and only what matched is joined back to its rows.
    """
    ids, matched = matched_profiles(rows, threshold)
    full = matched.join(ids.withColumnRenamed("key", "k1"), "pid").join(ids.select(F.col("pid").alias("pid2"), F.col("key").alias("k2")), "pid2")
    return full.groupBy(F.least("k1", "k2").alias("key_a"), F.greatest("k1", "k2").alias("key_b")).agg(F.max("confidence").alias("confidence"))
