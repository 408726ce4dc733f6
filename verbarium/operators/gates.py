"""Quality gates: each is a DataFrame of violations; a report counts them all in one job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbarium.functions.ids import NS_DNS, uuid5
from verbarium.operators.graph import dangling, mutual_pairs

# Classes of evidence, parts of speech.
EPISTEMIC = ["EXPLICIT", "GENERATED", "ATTESTED", "INFERRED", "UNCERTAIN"]
POS = ["NOUN", "VERB", "ADJECTIVE", "ADVERB", "PRONOUN", "DETERMINER", "PREPOSITION", "CONJUNCTION", "INTERJECTION", "NUMERAL", "PARTICLE", "AFFIX", "OTHER"]
# Pairs of words that look related and are not.
TRAPS = [("car", "carpet"), ("art", "article"), ("ride", "riddance"), ("go", "goal"), ("pan", "panic"), ("ear", "early"), ("rat", "ratio"), ("he", "hero"), ("cat", "catch")]
# Which end types each relation may have.
ENDPOINTS = {"HAS_FORM": ("LEXEME", "FORM"), "DERIVED_FROM": ("LEXEME", "LEXEME"), "SYNONYM_OF": ("LEXEME", "LEXEME"), "ANTONYM_OF": ("LEXEME", "LEXEME")}


def out_of_domain(rows: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Rows whose value is not in the domain; null is not in any."""
    return rows.filter(~F.coalesce(F.col(column).isin(domain), F.lit(False)))


def epistemic_domain(rows: DataFrame) -> DataFrame:
    """Rows with a value outside the domain in any column whose name holds ``epistemic``."""
    cols = [c for c in rows.columns if "epistemic" in c.lower()]
    bad = reduce(lambda a, b: a | b, [~F.coalesce(F.col(c).isin(EPISTEMIC), F.lit(False)) for c in cols], F.lit(False))
    return rows.filter(bad)


def badly_typed(edges: DataFrame, endpoints: dict = ENDPOINTS) -> DataFrame:
    """Edges whose end types are not those of their relation."""
    wrong = [(F.col("relation_type") == r) & ~((F.col("source_type") == s) & (F.col("target_type") == t)) for r, (s, t) in endpoints.items()]
    return edges.filter(reduce(lambda a, b: a | b, wrong))


def orphan_keys(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent."""
    return children.filter(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def unbacked(relations: DataFrame, bridge: DataFrame, evidence: Column) -> DataFrame:
    """Relations of that evidence without a claim."""
    return relations.filter(evidence).join(bridge.select(F.col("relation_id").alias("id")), "id", "left_anti")


def trapped(edges: DataFrame, lexemes: DataFrame, traps: list[tuple[str, str]] = TRAPS) -> DataFrame:
    """Edges that connect a trap pair, in either direction."""
    pairs = F.broadcast(edges.sparkSession.createDataFrame([(min(p), max(p)) for p in traps], "a string, b string"))  # a fixed list
    lem = lexemes.select("lexeme_id", F.lower("lemma").alias("lemma")).distinct()
    named = edges.join(lem.withColumnsRenamed({"lexeme_id": "source_id", "lemma": "l1"}), "source_id").join(lem.withColumnsRenamed({"lexeme_id": "target_id", "lemma": "l2"}), "target_id")
    return named.join(pairs, (F.least("l1", "l2") == F.col("a")) & (F.greatest("l1", "l2") == F.col("b")), "left_semi")


def missing_pairs(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected rows that are not there."""
    return expected.join(actual, expected.columns, "left_anti")


def shared_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ids that both tables have."""
    return a.select(key).intersect(b.select(key))


def unattested_prefixes(edges: DataFrame, lexemes: DataFrame) -> DataFrame:
    """DERIVED_FROM edges between words of which one begins with the other, on weak evidence."""
    lem = lexemes.select("lexeme_id", "lemma").distinct()
    d = edges.filter((F.col("relation_type") == "DERIVED_FROM") & ~F.col("epistemic_class").isin("EXPLICIT", "ATTESTED"))
    n = d.join(lem.withColumnsRenamed({"lexeme_id": "source_id", "lemma": "l1"}), "source_id").join(lem.withColumnsRenamed({"lexeme_id": "target_id", "lemma": "l2"}), "target_id")
    return n.filter(F.col("l2").startswith(F.col("l1")) | F.col("l1").startswith(F.col("l2")))


def affix_anomalies(morphemes: DataFrame) -> DataFrame:
    """Affixes that are null, empty or longer than eight letters."""
    bare = F.regexp_replace("shape", "^-|-$", "")
    return morphemes.filter(F.col("shape").isNull() | (bare == "") | (F.length(bare) > 8))


def cycles(edges: DataFrame, kind: str) -> DataFrame:
    """Loops and two-node cycles of a relation that should have none."""
    return mutual_pairs(edges, kind)


def wrong_ids(rows: DataFrame, key: str, name: Column, namespace: str = NS_DNS) -> DataFrame:
    """Rows whose id is not the UUIDv5 of their name."""
    return rows.filter(~F.col(key).eqNullSafe(uuid5(name, namespace)))


def shortcuts(edges: DataFrame, kind: str) -> DataFrame:
    """Edges a to c although a to b and b to c exist: only immediate parents should be stated."""
    e = edges.filter(F.col("relation_type") == kind).select("source_id", "target_id").distinct()
    two = e.select("source_id", F.col("target_id").alias("mid")).join(e.select(F.col("source_id").alias("mid"), "target_id"), "mid").select("source_id", "target_id")
    return e.join(two, ["source_id", "target_id"], "left_semi")


def shared_paradigms(forms: DataFrame, key: str, pos: str, surface: str) -> DataFrame:
    """Surfaces that two parts of speech of one key share."""
    return forms.groupBy(key, surface).agg(F.countDistinct(pos).alias("n")).filter("n > 1")


def below_floor(counts: DataFrame, floors: dict[str, int]) -> DataFrame:
    """``(name, n, floor)`` of ``counts (name, n)`` under their floor; a name without rows counts 0."""
    want = counts.sparkSession.createDataFrame(list(floors.items()), "name string, floor long")
    return want.join(counts, "name", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < floor")


def count_parity(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose row counts differ between two copies."""
    both = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("a")).join(b.groupBy(*keys).agg(F.count(F.lit(1)).alias("b")), keys, "full")
    return both.na.fill(0, ["a", "b"]).filter("a <> b")


def nested_columns(workspace: DataFrame, allowed: set[str]) -> list[str]:
    """Columns of a workspace table that are not plain strings, numbers or flags: it holds no references into the graph."""
    return [f.name for f in workspace.schema.fields if f.name not in allowed and f.dataType.typeName() not in ("string", "long", "integer", "boolean", "array")]


def report(gates: dict[str, DataFrame]) -> DataFrame:
    """``(gate, violations, passed)`` of all gates, as one union, so that one job computes them all."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("gate"), "violations") for name, df in gates.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).withColumn("passed", F.col("violations") == 0)


def lexical_report(edges: DataFrame, entities: DataFrame, bridge: DataFrame, claims: DataFrame) -> DataFrame:
    """``(gate, violations, passed)`` of the gates over the edge graph and its registry.

    What edges are judged by is joined to them once, and one conditional aggregate counts the violations of all
    gates; only the search for cycles reads edges again. A gate that compares lemmas counts every pair of lemmas of the two ends.
    """
    is_lex = F.col("entity_type") == "LEXEME"
    nodes = entities.filter("resolved_id is not null").groupBy("resolved_id").agg(F.max(is_lex).alias("lex"), F.max(F.col("entity_type") == "FORM").alias("form"), F.collect_set(F.when(is_lex, F.col("canonical_form"))).alias("lemmas"))
    end = lambda k, p: nodes.select(F.col("resolved_id").alias(k), F.lit(True).alias(p + "known"), F.col("lex").alias(p + "lex"), F.col("lemmas").alias(p + "lemmas"))
    backed = bridge.select(F.col("relation_id").alias("id")).filter("id is not null").distinct().withColumn("backed", F.lit(True))
    e = edges.select("id", "source_id", "source_type", "relation_type", "target_id", "target_type", "epistemic_class")
    e = e.join(end("source_id", "s_"), "source_id", "left").join(end("target_id", "t_"), "target_id", "left").join(backed, "id", "left")
    wrong_ends = reduce(lambda a, b: a | b, [(F.col("relation_type") == r) & ~((F.col("source_type") == s) & (F.col("target_type") == t)) for r, (s, t) in ENDPOINTS.items()])

    def pairs(test) -> Column:  # of the distinct lemmas of the two ends
        low = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("s_lemmas", "t_lemmas")]
        return F.size(F.filter(F.flatten(F.transform(low[0], lambda a: F.transform(low[1], lambda b: F.struct(a.alias("a"), b.alias("b"))))), lambda x: test(x["a"], x["b"]))).cast("long")

    trap_keys = [f"{min(p)} {max(p)}" for p in TRAPS]
    trapped_pairs = lambda a, b: F.concat_ws(" ", F.least(F.lower(a), F.lower(b)), F.greatest(F.lower(a), F.lower(b))).isin(trap_keys)
    weak = (F.col("relation_type") == "DERIVED_FROM") & ~F.col("epistemic_class").isin("EXPLICIT", "ATTESTED")
    counts = {
        "epistemic_domain": F.count_if(~F.coalesce(F.col("epistemic_class").isin(EPISTEMIC), F.lit(False))), "endpoint_types": F.count_if(wrong_ends), "dangling_edges": F.count_if(F.col("s_known").isNull() | F.col("t_known").isNull()),
        "explicit_without_claim": F.count_if((F.col("epistemic_class") == "EXPLICIT") & F.col("backed").isNull()), "trap_pairs": F.coalesce(F.sum(pairs(trapped_pairs)), F.lit(0)),
        "has_form_to_lexeme": F.count_if((F.col("relation_type") == "HAS_FORM") & F.col("t_lex")), "weak_prefix_derivations": F.coalesce(F.sum(F.when(weak, pairs(lambda a, b: a.startswith(b) | b.startswith(a)))), F.lit(0)),
        "phonetic_edges": F.count_if(F.col("relation_type").contains("PHONETIC") | F.col("relation_type").contains("SOUNDEX")),
    }
    row = e.agg(*[c.cast("long").alias(g) for g, c in counts.items()])
    told = row.select(F.explode(F.array(*[F.struct(F.lit(g).alias("gate"), F.col(g).alias("violations")) for g in counts])).alias("x")).select("x.*").withColumn("passed", F.col("violations") == 0)
    rest = {"bridge_without_claim": orphan_keys(bridge, "claim_id", claims, "id"), "lexeme_form_collisions": nodes.filter("lex and form"), "derivation_cycles": cycles(edges, "DERIVED_FROM")}
    return told.unionByName(report(rest))
