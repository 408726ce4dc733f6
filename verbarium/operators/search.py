"""Prefix, autocomplete, full-text, phonetic and translation search."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verbarium.functions.text import tier_rank, tokens


def exact(rows: DataFrame, column: str, value: str) -> DataFrame:
    """Rows with the value; the filter reaches the Parquet scan."""
    return rows.filter(F.col(column) == value)


def prefix(rows: DataFrame, column: str, start: str) -> DataFrame:
    """Rows whose text starts so; ``%`` and ``_`` are plain characters. The filter reaches the Parquet scan."""
    return rows.filter(F.col(column).startswith(start))


def prefix_range(rows: DataFrame, column: str, start: str) -> DataFrame:
    """The prefix as a range up to its last character plus one, for stores that know ranges only."""
    if not start:
        return rows
    return rows.filter((F.col(column) >= start) & (F.col(column) < start[:-1] + chr(ord(start[-1]) + 1)))


def autocomplete(rows: DataFrame, lemma: str, tier: str, key: str, start: str, k: int = 20) -> DataFrame:
    """The ``k`` best lemmas with a prefix: by tier, length, lemma, key."""
    return prefix(rows, lemma, start).orderBy(tier_rank(F.col(tier)), F.length(lemma), lemma, key).limit(k)


def autocomplete_all(rows: DataFrame, lemma: str, tier: str, key: str, length: int, k: int = 5) -> DataFrame:
    """The ``k`` best lemmas of every prefix of ``length`` characters, with their rank."""
    w = Window.partitionBy("prefix").orderBy(tier_rank(F.col(tier)), F.length(lemma), lemma, key)
    return rows.filter(F.length(lemma) >= length).withColumn("prefix", F.substring(lemma, 1, length)).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def inverted_index(rows: DataFrame, key: str, kind: str, *texts: str) -> DataFrame:
    """``(term, target_type, target_id, n)``: tokens of the texts, diacritics folded; null texts have none."""
    words = F.concat(*[F.coalesce(tokens(F.col(t)), F.array().cast("array<string>")) for t in texts])
    return rows.select(F.col(key).alias("target_id"), F.explode(words).alias("term")).groupBy("term", F.lit(kind).alias("target_type"), "target_id").agg(F.count(F.lit(1)).alias("n"))


def search(index: DataFrame, query: str, k: int = 20) -> DataFrame:
    """Targets that have all words of a query, the ones with most hits first; a word with ``*`` at its end is a prefix."""
    words = query_words(query)
    if not words:
        return index.select("target_id", F.lit(0).cast("long").alias("hits")).limit(0)
    tests = [F.col("term").startswith(w[:-1]) if w.endswith("*") else F.col("term") == w for w in words]
    any_of = tests[0]
    for t in tests[1:]:
        any_of = any_of | t
    found = index.filter(any_of).groupBy("target_id").agg(F.sum("n").alias("hits"), *[F.max(t.cast("int")).alias(f"_{i}") for i, t in enumerate(tests)])
    for i in range(len(tests)):
        found = found.filter(F.col(f"_{i}") == 1)
    return found.select("target_id", "hits").orderBy(F.desc("hits"), "target_id").limit(k)


def query_words(query: str) -> list[str]:
    """The words of a query in lower case; only letters, digits, ``_`` and a ``*`` at the end stay."""
    return [w for w in re.sub(r"[^a-zA-Z0-9_*]+", " ", query).lower().split() if w.strip("*")]


def phonetic_index(rows: DataFrame, key: str, word: str) -> DataFrame:
    """``(phonetic_key, algorithm, target_id)`` by Soundex; null words have none."""
    return rows.filter(F.col(word).isNotNull()).select(F.soundex(word).alias("phonetic_key"), F.lit("SOUNDEX").alias("algorithm"), F.col(key).alias("target_id")).distinct()


def sounds_like(index: DataFrame, word: str) -> DataFrame:
    return index.filter((F.col("phonetic_key") == F.soundex(F.lit(word))) & (F.col("algorithm") == "SOUNDEX"))


def translations(lexemes: DataFrame, edges: DataFrame, other: DataFrame) -> DataFrame:
    """``lemma, other_lemma, epistemic_class`` over TRANSLATION_OF edges from ``lexemes`` to lexemes of another language."""
    e = edges.filter("relation_type = 'TRANSLATION_OF'").select(F.col("source_id").alias("lexeme_id"), F.col("target_id").alias("other_id"), "epistemic_class")
    return e.join(lexemes.select("lexeme_id", "lemma"), "lexeme_id").join(other.select(F.col("lexeme_id").alias("other_id"), F.col("lemma").alias("other_lemma")), "other_id").select("lemma", "other_lemma", "epistemic_class")
