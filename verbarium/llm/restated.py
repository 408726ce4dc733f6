"""Duplicates hidden by formatting: dictionary-encoded columns and grouped integer tuples.

Columns are dictionary-encoded as Parquet does it, batch by batch: each distinct raw value of a task is canonicalised
once into field-value pairs, and each pair gets an integer. The integer is a 128-bit digest of the pair, so the
dictionaries of all tasks agree without meeting; among 10 ** 12 distinct pairs the chance of any two sharing one is
below 10 ** -14. A record becomes the sorted tuple of its pairs' integers, tuples meet by their own 128 bits, and raw
values never leave the task that reads them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbarium.lineage import cut
from verbarium.operators.lookup import lookup, spread
from verbarium.shipping import ship

#: Values a task remembers; beyond them it starts its dictionaries afresh.
REMEMBERED = 200_000
_NOT_ALNUM = re.compile(r"[\W_]+")


def _reduced(text: str) -> str:
    return _NOT_ALNUM.sub("", text.lower())


def _number(text: str) -> str:
    """One text for all spellings of a number's value."""
    sign, digits, exponent = Decimal(text).as_tuple()
    if not isinstance(exponent, int):  # NaN and infinities
        return text
    whole = "".join(map(str, digits)).lstrip("0")
    bare = whole.rstrip("0")
    return f"{'-' * sign}{bare}e{exponent + len(whole) - len(bare)}" if bare else "0"


class _Num(str):
    pass


def json_pairs(text: str) -> list[str]:
    """The canonical field-value pairs of a JSON text: names as written, order of fields dropped, of arrays kept.

    Strings are reduced to their letters and digits in lower case, numbers to their value; kinds never mix. A
    text that is no JSON is one reduced text.
    """
    try:
        top = json.loads(text, parse_int=_Num, parse_float=_Num, parse_constant=_Num)
    except (ValueError, RecursionError):
        return ["!" + _reduced(text)]
    out, todo = [], [("", top)]
    while todo:
        at, x = todo.pop()
        if isinstance(x, dict):
            todo += [(f"{at}/{json.dumps(k)}", v) for k, v in x.items()]
            if not x:
                out.append(at + "={}")
        elif isinstance(x, list):
            todo += [(f"{at}/{i}", v) for i, v in enumerate(x)]
            if not x:
                out.append(at + "=[]")
        elif x is None:
            out.append(at + "=null")
        elif isinstance(x, bool):
            out.append(f"{at}={x}")
        elif isinstance(x, _Num):
            out.append(f"{at}=n{_number(x)}")
        else:
            out.append(f"{at}=s{_reduced(x)}")
    return sorted(out)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class _Dictionary:
    """A column's values as the integers of their pairs, end to end in order; null has a code of its own."""

    def __init__(self, field: int, pairs: Callable[[str], list[str]]) -> None:
        self.field, self.pairs, self.known = f"{field}".encode(), pairs, {}

    def codes(self, value: str | None) -> bytes:
        if value is None:
            return _digest(self.field + b"0")
        return b"".join(sorted(_digest(self.field + b"1" + p.encode("utf-8", "surrogatepass")) for p in self.pairs(value)))

    def encode(self, column: pd.Series) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        at, distinct = pd.factorize(column, use_na_sentinel=False)
        mine = []
        for v in (None if pd.isna(x) else x for x in distinct):
            if v not in self.known:
                self.known[v] = self.codes(v)
            mine.append(self.known[v])
        return [mine[i] for i in at]


def _tuples(records: DataFrame, key: str, columns: dict[str, Callable[[str], list[str]]]) -> DataFrame:
    """``(key, hi, lo)``: the 128 bits of each record's tuple."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = [_Dictionary(i, f) for i, f in enumerate(columns.values())]
        for b in batches:
            coded = [e.encode(b[f"c{i}"]) for i, e in enumerate(encoders)]
            whole = b"".join(_digest(b"".join(len(x).to_bytes(4, "big") + x for x in row)) for row in zip(*coded)) if coded else b"\0" * 16 * len(b)
            two = np.frombuffer(whole, "<i8").reshape(-1, 2)
            yield pd.DataFrame({"key": b["key"], "hi": two[:, 0], "lo": two[:, 1]})

    rows = records.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    return spread(rows).mapInPandas(run, "key string, hi long, lo long")


def restated(records: DataFrame, key: str, exact: list[str], texts: list[str], jsons: list[str], least: int = 1) -> DataFrame:
    """``(key, keep, n_copies)`` for each distinct key: the smallest key of its group of copies, and the group's size.

    Records are copies if the ``exact`` columns are equal, the ``texts`` equal once reduced to letters and
    digits in lower case, and the ``jsons`` equal as JSON with their strings so reduced. Nulls equal nulls only.
    ``n_copies`` counts distinct keys, so repeated rows change nothing. Rows with a null key are left out; a key that
    stands on several different records counts in each of their groups. ``least``: only groups of at least so many
    copies. Other columns are not read. Empty tables give no rows.

    Only keys and 16 bytes a record are shuffled. A hot group is handled by :func:`lookup`; none is collected.
    """
    ship(records.sparkSession)
    columns = {c: (lambda x: [x]) for c in exact} | {c: (lambda x: [_reduced(x)]) for c in texts} | {c: json_pairs for c in jsons}
    tuples = cut(_tuples(records, key, columns).distinct())
    groups = tuples.groupBy("hi", "lo").agg(F.min("key").alias("keep"), F.count(F.lit(1)).alias("n_copies")).withColumn("n", F.col("n_copies")).filter(F.col("n_copies") >= least)
    return lookup(tuples, groups, ["hi", "lo"], "n", tuples.count()).select(F.col("key").alias(key), "keep", "n_copies").distinct()
