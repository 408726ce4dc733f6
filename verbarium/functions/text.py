"""Text, part-of-speech, feature-bundle and frequency functions, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source tags and the canonical part of speech each stands for.
POS_TAGS = {
    "n": "NOUN", "v": "VERB", "a": "ADJECTIVE", "s": "ADJECTIVE", "r": "ADVERB",
    "noun": "NOUN", "verb": "VERB", "adj": "ADJECTIVE", "adjective": "ADJECTIVE", "adv": "ADVERB", "adverb": "ADVERB",
    "pron": "PRONOUN", "pronoun": "PRONOUN", "det": "DETERMINER", "determiner": "DETERMINER", "prep": "PREPOSITION", "preposition": "PREPOSITION",
    "conj": "CONJUNCTION", "conjunction": "CONJUNCTION", "intj": "INTERJECTION", "interjection": "INTERJECTION",
    "num": "NUMERAL", "numeral": "NUMERAL", "part": "PARTICLE", "particle": "PARTICLE",
}
# Feature tags, the attribute each sets and its value.
FEATURE_TAGS = [
    ("PST", "tense", "past"), ("PRS", "tense", "present"), ("FUT", "tense", "future"),
    ("PL", "number", "plural"), ("SG", "number", "singular"),
    ("1", "person", "first"), ("2", "person", "second"), ("3", "person", "third"),
    ("CMPR", "degree", "comparative"), ("SPRL", "degree", "superlative"),
    ("PROG", "aspect", "progressive"), ("PRF", "aspect", "perfect"),
    ("PTCP", "form_category", "participle"), ("V.PTCP", "form_category", "participle"), ("V.CVB", "form_category", "gerund"), ("NFIN", "form_category", "infinitive"),
]
FEATURE_NAMES = ["aspect", "degree", "form_category", "number", "person", "tense"]


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def normalize_text(text: Column) -> Column:
    """Trimmed (all Unicode white space), NFC, lower case; null gives ''. Only non-ASCII texts are composed in Python, others reach it as nulls."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$", "")
    ascii_only = bare.rlike(r"^\p{ASCII}*$")
    return F.lower(F.when(ascii_only, bare).otherwise(_nfc(F.when(~ascii_only, bare))))


def map_pos(tag: Column) -> Column:
    """The canonical part of speech of a source tag; OTHER if unknown or null."""
    table = F.create_map(*[F.lit(x) for kv in POS_TAGS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(tag))), F.lit("OTHER"))


def feature_tags(bundle: Column) -> Column:
    """The tags of a ``;`` bundle, trimmed, upper case, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(bundle, F.lit("")), ";"), lambda t: F.upper(F.trim(t))), lambda t: t != "")


def bundle_pos(tags: Column) -> Column:
    has = lambda t: F.array_contains(tags, t)
    return F.when(has("V"), "VERB").when(has("N"), "NOUN").when(has("ADJ"), "ADJECTIVE").when(has("ADV"), "ADVERB").otherwise("OTHER")


def bundle_features(tags: Column) -> Column:
    """A struct of the named features; where tags of one name conflict, the later in :data:`FEATURE_TAGS` holds."""

    def one(name: str) -> Column:
        out = F.lit(None).cast("string")
        for tag, attribute, value in FEATURE_TAGS:
            if attribute == name:
                out = F.when(F.array_contains(tags, tag), value).otherwise(out)
        return out.alias(name)

    return F.struct(*[one(n) for n in FEATURE_NAMES])


def canonical_features(features: Column) -> Column:
    """Compact JSON of a string map with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(features))))


def json_list(text: Column) -> Column:
    """A JSON array as texts; whatever is no JSON array, other JSON included, is split at commas; null gives an empty array."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.from_json(text, "array<string>"), parts, F.array().cast("array<string>"))


def zipf(log10_per_million: Column) -> Column:
    return F.round(F.coalesce(log10_per_million.try_cast("double"), F.lit(0.0)) + 3, 2)


def frequency_tier(z: Column) -> Column:
    return F.when(z >= 5, "VERY_COMMON").when(z >= 4, "COMMON").when(z >= 3, "LESS_COMMON").otherwise("RARE")


def tier_rank(tier: Column) -> Column:
    return F.when(tier == "VERY_COMMON", 1).when(tier == "COMMON", 2).when(tier == "LESS_COMMON", 3).otherwise(4)


def shortened(text: Column, most: int) -> Column:
    """A label of at most ``most`` characters, the rest as an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def clean_query(term: Column) -> Column:
    """A search term without what a full-text query would read as syntax; ``*`` stays."""
    return F.trim(F.regexp_replace(term, "[^a-zA-Z0-9_*]", " "))


def _foldings() -> tuple[str, str]:
    """Latin, Greek and Cyrillic letters whose canonical decomposition is a letter and marks, with that letter; then the marks, which go."""
    letters = {c: unicodedata.normalize("NFD", c) for c in map(chr, [*range(0xC0, 0x530), *range(0x1E00, 0x2000)])}
    made = {c: d[0] for c, d in letters.items() if len(d) > 1 and all(unicodedata.category(m) == "Mn" for m in d[1:])}
    return "".join(made) + "".join(map(chr, range(0x300, 0x370))), "".join(made.values())


_FOLD = _foldings()


def tokens(text: Column) -> Column:
    """Search tokens: runs of letters and digits, lower case, diacritics folded."""
    return F.regexp_extract_all(F.translate(F.lower(text), *_FOLD), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def soundex(word: Column) -> Column:
    return F.soundex(word)
