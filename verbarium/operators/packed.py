"""Several values packed in one field: delimiters inferred per source, then one row per value with its place.

Candidate delimiters are scored per source on how often they occur, how consistent their piece counts are and
how regular their pieces look. A text is cut, outside quotes, at the best delimiter of its source that it has. Its
pieces are the values; where values are known to be plain, a piece that is not is taken apart further by the value
grammar.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verbarium.lineage import cut
from verbarium.shipping import ship

#: Delimiters that are tried; letters, digits, '.', '_' and '-' belong to values.
CANDIDATES = [";", ",", "|", "/", "+", ":", "&", "\t", " "]
_VAL = r"\p{L}\p{N}._\-"
_QUOTED = "\"(?:[^\"]|\"\")*+\"|'(?:[^']|'')*+'"
#: A value: a run of value characters (a quote straight after it separates), or a quoted stretch.
GRAMMAR = rf"[{_VAL}]+[\"']?|{_QUOTED}"
_PLAIN = rf"^[{_VAL}]+$"


def _segments(delimiter: str, plain: bool) -> str:
    """A pattern for the stretches between unquoted delimiters; where values are plain, a run of value characters takes a quote after it along."""
    d = re.escape(delimiter)
    run = rf"[{_VAL}]+[\"']?|" if plain else ""
    return rf"(?:{run}{_QUOTED}|[^{d}])+" if not plain else rf"(?:{run}{_QUOTED}|[^{_VAL}{d}])+"


def _unquote(token: Column) -> Column:
    """A quoted stretch without its quotes, doubled ones halved; an unquoted run without the quote that ended it."""
    inner = F.substring(token, F.lit(2), F.length(token) - 2)
    return (
        F.when(token.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"')))
        .when(token.startswith("'"), F.replace(inner, F.lit("''"), F.lit("'")))
        .otherwise(F.regexp_replace(token, "[\"']$", ""))
    )


def _own(text: Column, ranked: Column) -> Column:
    """The best of its source's delimiters that a text holds outside quotes."""
    bare = F.trim(F.when(text.contains('"') | text.contains("'"), F.regexp_replace(text, _QUOTED, "Q")).otherwise(text))
    return F.get(F.filter(ranked, lambda d: F.contains(bare, d)), F.lit(0))


def _values(text: Column, own: Column, plain: bool) -> Column:
    """The values of a text in order. ``own``: the delimiter it is cut at; without one it is one piece."""
    pieces = F.array(text)
    quoted = text.contains('"') | text.contains("'")
    for d in reversed(CANDIDATES):
        cut_up = F.when(quoted, F.regexp_extract_all(text, F.lit(_segments(d, plain)), F.lit(0))).otherwise(F.split(text, re.escape(d)))
        pieces = F.when(own == d, cut_up).otherwise(pieces)

    def whole(piece: Column) -> Column:
        bare = F.trim(piece)
        return F.when(bare == "", F.array().cast("array<string>")).when(bare.rlike(rf"^(?:{_QUOTED})$"), F.array(_unquote(bare))).otherwise(F.array(bare))

    def taken(piece: Column) -> Column:
        bare = F.trim(piece)
        return F.when(bare.rlike(_PLAIN), F.array(bare)).when(bare == "", F.array().cast("array<string>")).otherwise(F.transform(F.regexp_extract_all(piece, F.lit(GRAMMAR), F.lit(0)), _unquote))

    return F.flatten(F.transform(pieces, taken if plain else whole))


def infer_delimiters(texts: DataFrame, source: str, text: str, n: str | None = None) -> DataFrame:
    """Scores of each candidate per source: ``(source, delimiter, n_texts, presence, consistency, regularity, score, rank)``.

    ``presence``: share of texts with the delimiter outside quotes; ``consistency``: chance that two of those
    texts have equal piece counts; ``regularity``: share of their pieces that are plain values; the score is
    the product. Ties go to the earlier candidate. Null texts count for nothing; a source without any
    delimiter has none. ``n`` names a column of multiplicities. All texts are counted, in one pass with partial
    aggregates whose groups are (source, candidate, piece count).
    """
    bare = F.regexp_replace(F.col(text), _QUOTED, "Q")  # a quoted stretch is one plain value
    weight = F.col(n) if n else F.lit(1)
    cand = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(d).alias("delimiter")) for i, d in enumerate(CANDIDATES)])
    # bundles are few and much repeated: each distinct one is taken apart once
    once = texts.filter(F.col(text).isNotNull()).groupBy(F.col(source).alias("source"), bare.alias("bare")).agg(F.sum(weight.cast("long")).alias("w"))
    per = once.select("source", "bare", "w", F.explode(cand).alias("c"))
    pieces = F.filter(F.transform(F.split(F.col("bare"), F.concat(F.lit(r"\Q"), F.col("c.delimiter"), F.lit(r"\E"))), lambda p: F.trim(p)), lambda p: p != "")
    per = per.select("source", "c.ord", "c.delimiter", "w", F.instr(F.trim("bare"), F.col("c.delimiter")).alias("at"), pieces.alias("p"))
    per = per.select("source", "ord", "delimiter", "w", (F.col("at") > 0).alias("has"), F.size("p").alias("k"), F.size(F.filter("p", lambda p: p.rlike(_PLAIN))).alias("plain"))
    by_count = per.groupBy("source", "ord", "delimiter", "has", "k").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("plain")).alias("plain"))
    on = F.col("has")
    nul = lambda c: F.coalesce(c, F.lit(0.0))
    scored = by_count.groupBy("source", "ord", "delimiter").agg(
        F.sum("w").alias("n_texts"),
        F.sum(F.when(on, F.col("w")).otherwise(0)).alias("with"),
        F.sum(F.when(on, F.col("w").cast("double") * F.col("w")).otherwise(0.0)).alias("sq"),
        F.sum(F.when(on, F.col("w") * F.col("k")).otherwise(0)).alias("pieces"),
        F.sum(F.when(on, F.col("plain")).otherwise(0)).alias("plain"),
    )
    scored = scored.select(
        "source", "ord", "delimiter", "n_texts",
        (F.col("with") / F.col("n_texts")).alias("presence"),
        nul(F.try_divide("sq", F.col("with").cast("double") * F.col("with"))).alias("consistency"),
        nul(F.try_divide("plain", "pieces")).alias("regularity"),
    ).withColumn("score", F.col("presence") * F.col("consistency") * F.col("regularity"))
    # groups of the window hold one row per candidate
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("score"), "ord"))
    return scored.withColumn("rank", rank).drop("ord")


def _leaves(text: str) -> list[tuple[str, bool]] | None:
    """Leaves of a JSON text as (text, whether it is to be taken apart); None if it is no JSON."""
    out: list[tuple[str, bool]] = []

    class Number(str):
        pass

    def parse(t: str):
        return json.loads(t, object_pairs_hook=lambda pairs: [v for _, v in pairs], parse_int=Number, parse_float=Number, parse_constant=Number)

    try:
        todo = [parse(text)]
    except (ValueError, RecursionError):
        return None
    while todo:
        x = todo.pop()
        if x is None:
            continue
        if isinstance(x, list):
            todo.extend(reversed(x))
        elif isinstance(x, bool):
            out.append(("true" if x else "false", False))
        elif isinstance(x, Number):
            out.append((str(x), False))
        else:
            inner = None
            if x.lstrip()[:1] in ("{", "["):
                try:
                    inner = parse(x)
                except (ValueError, RecursionError):
                    inner = None
            if inner is not None:
                todo.append(inner)
            else:
                out.append((x, True))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("apart", T.BooleanType())])))
def json_leaves(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Leaf values of JSON texts in stored order; null for null or for what is no JSON."""
    for s in texts:
        found = [None if t is None else _leaves(t) for t in s]
        yield pd.Series([None if f is None else [{"text": a, "apart": b} for a, b in f] for f in found], dtype=object)


def split_packed(rows: DataFrame, key: Column, source: Column, text: Column, as_json: bool = False, plain: bool = True) -> DataFrame:
    """``(row_key, value_pos, feature_value)``: one row per packed value, places from 1, distinct.

    A text is cut at the best delimiter of its source that it holds outside quotes. With ``plain`` a value is a
    run of letters, digits, ``.``, ``_`` and ``-``, so what is left between runs of a piece separates too, whatever it
    is, and the delimiters save work but change nothing; without, a piece is a value as it stands, trimmed, so the
    inferred delimiter decides, and a text of a source that has none is one value. Quoted stretches come without their quotes.

    ``as_json``: texts that parse as JSON give their leaves in stored order, nulls skipped; a string leaf that
    is a JSON object or array is read on, another is taken apart like any text, a number or truth value is its
    text. Null and blank texts have no values; an unclosed quote separates; an empty quoted stretch is an
    empty value. Repeated rows come out once; other columns of ``rows`` are not read.

    The texts move once, to the place of their key, where all that follows stays; a JSON text is parsed once.
    """
    ship(rows.sparkSession)
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = rows.select(key.cast("string").alias("row_key"), F.coalesce(source, F.lit("")).alias("source"), text.alias("text")).filter("text is not null")
    base = base.repartition(parts, "row_key").distinct()
    whole = F.array(F.struct(F.col("text"), F.lit(True).alias("apart")))
    if as_json:
        maybe = F.col("text").rlike(r"^\s*[\[{\"\-0-9tfnNI]")  # no JSON starts otherwise, and other texts stay in the JVM
        parsed = base.filter(maybe).select("row_key", "source", F.coalesce(json_leaves("text"), whole).alias("leaves"))
        base = cut(parsed.unionByName(base.filter(~maybe).select("row_key", "source", whole.alias("leaves"))))
        seen = base.select("source", F.explode("leaves").alias("l")).filter("l.apart").select("source", F.col("l.text").alias("text"))
        base = base.repartition(parts, "row_key")
    else:
        seen = base.select("source", "text")
        base = base.select("row_key", "source", whole.alias("leaves"))
    best = infer_delimiters(seen, "source", "text").filter("score > 0").groupBy("source").agg(F.array_sort(F.collect_list(F.struct("rank", "delimiter")))["delimiter"].alias("ranked"))
    # one row per source; adaptive execution broadcasts it if its measured size allows
    ranked = F.coalesce("ranked", F.array().cast("array<string>"))
    owned = base.join(best, "source", "left").select("row_key", F.transform("leaves", lambda x: F.struct(x["text"].alias("text"), x["apart"].alias("apart"), F.when(x["apart"], _own(x["text"], ranked)).alias("own"))).alias("leaves"))
    cut_up = owned.select("row_key", F.flatten(F.transform("leaves", lambda x: F.when(x["apart"], _values(x["text"], x["own"], plain)).otherwise(F.array(x["text"])))).alias("v"))
    # outer, as for the inner explode Catalyst would add a filter that splits a second time
    return cut_up.select("row_key", F.posexplode_outer("v").alias("value_pos", "feature_value")).filter("value_pos is not null").select("row_key", (F.col("value_pos") + 1).alias("value_pos"), "feature_value").distinct()
