"""Deterministic identifiers: name-based UUIDs (version 5) computed in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The namespaces whose ids must join with existing data.
NS_OID = "6ba7b812-9dad-11d1-80b4-00c04fd430c8"
NS_DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
NS_URL = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def uuid5(name: Column, namespace: str = NS_OID) -> Column:
    """The UUIDv5 of a name; null for null."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "utf-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.when(
        name.isNotNull(),
        F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)),
    )


def lexeme_key(lemma: Column, pos: Column, language: str = "eng", homograph: Column | None = None) -> Column:
    """``eng:lemma:POS`` with a fifth segment for homographs that have one."""
    base = F.concat(F.lit(language + ":"), lemma, F.lit(":"), pos)
    return base if homograph is None else F.when(homograph.isNull() | (homograph == ""), base).otherwise(F.concat(base, F.lit(":"), homograph))


def form_key(surface: Column, features: Column, language: str = "eng") -> Column:
    return F.concat(F.lit(language + ":"), surface, F.lit(":"), F.coalesce(features, F.lit("")))


def form_hash_key(surface: Column, features_json: Column, language: str = "eng") -> Column:
    """The form key that holds the first 12 hex digits of the features' SHA-256."""
    return F.concat(F.lit(language + ":"), surface, F.lit(":"), F.substring(F.sha2(features_json, 256), 1, 12))


def sense_key(lexeme: Column, source_sense: Column) -> Column:
    return F.concat(lexeme, F.lit(":sense:"), source_sense)


def relation_key(subject: Column, relation: Column, obj: Column) -> Column:
    return F.concat_ws(":", subject, relation, obj)


def morpheme_key(shape: Column, kind: Column) -> Column:
    return F.concat(F.lit("morpheme:"), shape, F.lit(":"), kind)
