"""Evaluation texts in training text, by winnowing.

Of every window of ``w`` consecutive hashes of ``k`` words the smallest is kept, for test items and documents
alike. A shared run of ``w + k - 1`` words holds a whole window in both, so both keep the same hash there and
the run cannot be missed. Fingerprints meet by hash alone; the texts of the documents that any meets are read again
and hits extended word by word, which also rules out words that only hash alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbarium.lineage import cut
from verbarium.operators.lookup import spread
from verbarium.shipping import ship

K_WORDS = 5
RUN_WORDS = 12
#: Hits of a document are gathered in so many slices of items, so that very many leaking items are never one row.
SLICES = 64
#: Words hashed at a time.
CHUNK = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_LAST = np.uint64(2**64 - 1)


def words(text: str) -> list[str]:
    """Unbroken runs of letters and digits of any script, in lower case."""
    return _WORD.findall(text.lower())


def _slid(x: np.ndarray, w: int, least: bool) -> np.ndarray:
    """The smallest or largest of every ``w`` neighbours, by doubling."""
    op, span = (np.minimum if least else np.maximum), 1
    while span < w:
        step = min(span, w - span)
        x, span = op(x[: len(x) - step], x[step:]), span + step
    return x


def kept(hashes: np.ndarray, text: np.ndarray, k: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the ``k`` words that winnowing keeps, of word hashes of texts that lie end to end."""
    w = run - k + 1
    if len(hashes) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        grams = hashes[: len(hashes) - k + 1].copy()
        for i in range(1, k):
            grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - k + 1 + i]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
    least = _slid(grams, w, True)
    inside = text[: len(text) - run + 1] == text[run - 1 :]
    # a gram is kept if it is the smallest of any window around it that lies in one text
    least = np.where(inside, least, np.uint64(0))
    most = _slid(np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)]), w, False)
    any_inside = _slid(np.concatenate([np.zeros(w - 1, np.uint8), inside.astype(np.uint8), np.zeros(w - 1, np.uint8)]), w, False).astype(bool)
    at = np.flatnonzero(any_inside & (most == grams))
    return at, grams[at]


def _pieces(texts: pd.Series, run: int) -> Iterator[tuple[list[str], list[int], list[int]]]:
    """Words of several texts, which text each is of and its place; long texts in parts that share ``run - 1`` words."""
    flat: list[str] = []
    own: list[int] = []
    place: list[int] = []
    for i, t in enumerate(texts):
        mine = words(t)
        for a in range(0, len(mine) if len(mine) >= run else 0, CHUNK):
            part = mine[a : a + CHUNK + run - 1]
            flat += part
            own += [i] * len(part)
            place += range(a, a + len(part))
            if len(flat) >= CHUNK:
                yield flat, own, place
                flat, own, place = [], [], []
    if flat:
        yield flat, own, place


def winnow(texts: DataFrame, key: str, text: str, k: int = K_WORDS, run: int = RUN_WORDS, near: bool = False) -> DataFrame:
    """``(key, hash, place)``: the kept fingerprints of each text, place counted in words from 0.

    With ``near`` also the ``k`` words hashed and up to ``run - k`` words on either side, enough to hold any run of
    ``run`` words around them; the hashed ones start ``off`` words into it. Texts of fewer than ``run`` words,
    null ones and such with a null key keep none. One vectorised pass over all texts of a batch together.
    """
    if not 1 <= k <= run:
        raise ValueError("k is at least 1 and at most run")
    ship(texts.sparkSession)
    kind = texts.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for flat, own, place in _pieces(b["t"], run):
                codes, vocabulary = pd.factorize(np.array(flat, object))
                owner, where = np.array(own), np.array(place)
                # parts of a long text are texts of their own here
                text_no = np.cumsum(np.concatenate([[0], (np.diff(owner) != 0) | (np.diff(where) != 1)]))
                at, h = kept(pd.util.hash_array(vocabulary, categorize=False)[codes], text_no, k, run)
                out = {"key": b["key"].to_numpy()[owner[at]], "hash": h.view(np.int64), "place": where[at]}
                if near:
                    ends = np.append(np.flatnonzero(np.diff(text_no)) + 1, len(flat))
                    starts = np.concatenate([[0], ends[:-1]])
                    lo = np.maximum(at - (run - k), starts[text_no[at]])
                    hi = np.minimum(at + run, ends[text_no[at]])
                    out |= {"near": [flat[x:y] for x, y in zip(lo, hi)], "off": at - lo}
                yield pd.DataFrame(out)

    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("t")).filter("key is not null and t is not null")
    return spread(rows).mapInPandas(hashed, f"key {kind}, hash long, place int" + (", near array<string>, off int" if near else ""))


def _extended(mine: list[str], place: int, near: list[str], off: int, k: int, run: int) -> tuple[int, int] | None:
    """The run ``[start, end)`` in ``mine`` of equal words around the ``k`` at ``place``, as far as ``near`` goes; None if under ``run``."""
    if mine[place : place + k] != near[off : off + k]:
        return None
    back = 0
    while back < min(off, place) and mine[place - back - 1] == near[off - back - 1]:
        back += 1
    on = k
    while off + on < len(near) and place + on < len(mine) and mine[place + on] == near[off + on]:
        on += 1
    return (place - back, place + on) if back + on >= run else None


def leaked_spans(documents: DataFrame, doc_id: str, items: DataFrame, item_id: str, text: str = "text", k: int = K_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """``(doc_id, item_id, doc_start, item_start, n_words)``: every longest run of at least ``run`` words that a document shares with an item.

    Places count words from 0. Null and short texts, and rows with a null id, leak nothing; repeated rows of either
    table change nothing; texts of one id are searched each; other columns are not read.

    The test side is winnowed once; Spark sends it whole where its written size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles fingerprints (24 bytes a row) otherwise. Only documents with a hit are read again.
    """
    tests = winnow(items.select(item_id, text).distinct(), item_id, text, k, run, near=True)
    tests = cut(tests.select(F.col("key").alias("item"), "hash", F.col("place").alias("item_place"), "near", "off").distinct())
    marks = cut(tests.select("item", "hash", "item_place"))  # a table of its own, as small as what is to be sent
    docs = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("doc_text")).filter("doc_text is not null")
    found = winnow(docs, "doc", "doc_text", k, run).withColumnRenamed("key", "doc").join(marks, "hash").join(tests, ["item", "hash", "item_place"])
    hit = F.struct("item", "place", "item_place", "off", "near")
    by_doc = cut(found.groupBy("doc", F.pmod(F.xxhash64("item"), F.lit(SLICES)).alias("_s")).agg(F.collect_set(hit).alias("hits")))
    again = docs.join(by_doc.select("doc").distinct(), "doc", "left_semi").join(by_doc, "doc")
    kinds = (documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString())

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, body, hits in zip(b["doc"], b["doc_text"], b["hits"]):
                mine, runs = words(body), {}
                for h in hits:
                    if span := _extended(mine, h["place"], list(h["near"]), h["off"], k, run):
                        runs.setdefault((h["item"], h["place"] - h["item_place"]), []).append(span)
                for (item, shift), spans in runs.items():
                    spans.sort()
                    a, z = spans[0]
                    for x, y in [*spans[1:], (len(mine) + 1, 0)]:
                        if x <= z:  # of one diagonal, so what overlaps is one run
                            z = max(z, y)
                            continue
                        out.append((doc, item, a, a - shift, z - a))
                        a, z = x, y
            yield pd.DataFrame(out, columns=["doc", "item", "doc_start", "item_start", "n_words"])

    spans = again.mapInPandas(extend, f"doc {kinds[0]}, item {kinds[1]}, doc_start int, item_start int, n_words int")
    return spans.distinct().select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "doc_start", "item_start", "n_words")


def leaks(documents: DataFrame, doc_id: str, items: DataFrame, item_id: str, text: str = "text", k: int = K_WORDS, run: int = RUN_WORDS) -> DataFrame:
    """``(doc_id, item_id, n_spans, longest)``: documents with ``run`` consecutive words of an item, each pair once; see :func:`leaked_spans`."""
    return leaked_spans(documents, doc_id, items, item_id, text, k, run).groupBy(doc_id, item_id).agg(F.count(F.lit(1)).alias("n_spans"), F.max("n_words").alias("longest"))
