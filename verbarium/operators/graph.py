"""Graph queries over typed edges ``(source_id, relation_type, target_id)``.

Undirected questions use an adjacency with both directions, so that every hop is an equi-join. Bounded
expansions keep the set of reached nodes and drop them from the next frontier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbarium.functions.text import shortened

MAX_DEPTH = 3
# The relation types that a neighbourhood follows; links between synsets are no edges of the lexical tables.
NEIGHBOUR_TYPES = ["DERIVED_FROM", "HYPERNYM", "SIMILAR", "ALSO", "HAS_FORM"]


def adjacency(edges: DataFrame, types: list[str] | None = None, directed: bool = False) -> DataFrame:
    """``(node, other)``, distinct, in both directions unless ``directed``; rows without an end are ignored."""
    e = edges.filter("source_id is not null and target_id is not null")
    e = e.filter(F.col("relation_type").isin(types)) if types else e
    out = e.select(F.col("source_id").alias("node"), F.col("target_id").alias("other"))
    return (out if directed else out.unionByName(e.select(F.col("target_id").alias("node"), F.col("source_id").alias("other")))).distinct()


def bounded_depth(depth: int) -> int:
    """1 to ``MAX_DEPTH``; more is an error."""
    if depth > MAX_DEPTH:
        raise ValueError(f"depth is at most {MAX_DEPTH}")
    return max(1, depth)


def reach(adj: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """``(root, node, depth)``: nodes within ``depth`` hops of each root, at their least depth; the root at 0."""
    seen = roots.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth")).filter("root is not null").distinct()
    front = seen
    for d in range(1, bounded_depth(depth) + 1):
        step = front.select("root", "node").join(adj, "node").select("root", F.col("other").alias("node")).distinct()
        front = step.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(d))
        seen = seen.unionByName(front)
    return seen


def walks(adj: DataFrame, roots: DataFrame, depth: int, simple: bool = True) -> DataFrame:
    """``(root, node, depth, path)``: every path of 1 to ``depth`` hops; a simple one meets no node twice."""
    front = roots.select("root", F.col("root").alias("node"), F.array("root").alias("path")).filter("root is not null").distinct()
    out = None
    for d in range(1, bounded_depth(depth) + 1):
        step = front.join(adj, "node")
        step = step.filter(~F.array_contains("path", F.col("other"))) if simple else step
        front = step.select("root", F.col("other").alias("node"), F.concat("path", F.array("other")).alias("path"))
        rows = front.select("root", "node", F.lit(d).alias("depth"), "path")
        out = rows if out is None else out.unionByName(rows)
    return out


def incident_edges(reached: DataFrame, edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Edges at the reached nodes, once per root; the first ``limit`` per root by id, ends and type, nulls last.

    It lists all that every root reaches; :func:`verbarium.operators.nearby.first_edges` does not.
    """
    ends = edges.select(F.col("source_id").alias("node"), "id", "source_id", "relation_type", "target_id").unionByName(edges.select(F.col("target_id").alias("node"), "id", "source_id", "relation_type", "target_id"))
    out = reached.select("root", "node").join(ends, "node").drop("node").distinct()
    if limit is None:
        return out
    order = [F.col(c).asc_nulls_last() for c in ("id", "source_id", "target_id", "relation_type")]
    return out.withColumn("_r", F.row_number().over(Window.partitionBy("root").orderBy(*order))).filter(F.col("_r") <= limit).drop("_r")


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node_id, degree)`` of every node, 0 included; a loop counts twice."""
    ends = edges.select(F.col("source_id").alias("node_id")).unionByName(edges.select(F.col("target_id").alias("node_id")))
    n = ends.groupBy("node_id").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.select("node_id").distinct().join(n, "node_id", "left").select("node_id", F.coalesce("degree", F.lit(0)).alias("degree"))


def isolation(nodes: DataFrame, edges: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Per node type the share of nodes without edges, and whether it is within its limit; ``nodes``: ``node_id, node_type``."""
    d = nodes.select("node_id", "node_type").distinct().join(degrees(nodes, edges), "node_id")
    most = F.try_element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("node_type"))
    g = d.groupBy("node_type").agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("degree") == 0).alias("n_isolated"))
    ratio = F.col("n_isolated") / F.col("n_nodes")
    return g.withColumn("ratio", ratio).withColumn("ok", F.coalesce(ratio <= most, F.lit(True)))


def mutual_pairs(edges: DataFrame, kind: str) -> DataFrame:
    """``(a, b)`` with ``a <= b`` where edges of a type lead both ways; loops are pairs with themselves."""
    e = edges.filter(F.col("relation_type") == kind).select(F.col("source_id").alias("s"), F.col("target_id").alias("t")).filter("s is not null and t is not null").distinct()
    # both ways: two directions of one unordered pair, or a loop; no self-join needed
    p = e.groupBy(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return p.filter("n = 2 or a = b").select("a", "b")


def member_pairs(relations: DataFrame, members: DataFrame) -> DataFrame:
    """Relations between synsets as relations between their members: ``lemma, relation_type, other_lemma``, distinct.

    ``relations``: ``synset_id, relation_type, target_synset_id``; ``members``: ``synset_id, lemma``.
    """
    m = members.filter("lemma is not null").select("synset_id", "lemma").distinct()
    r = relations.filter("target_synset_id is not null").select("synset_id", "relation_type", "target_synset_id").distinct()
    return r.join(m, "synset_id").join(m.select(F.col("synset_id").alias("target_synset_id"), F.col("lemma").alias("other_lemma")), "target_synset_id").select("lemma", "relation_type", "other_lemma").distinct()


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that no node has; each once, with which ends are missing. Null ends count as missing."""
    ids = nodes.select("node_id").filter("node_id is not null").distinct()
    a = edges.join(ids.select(F.col("node_id").alias("source_id"), F.lit(True).alias("_s")), "source_id", "left").join(ids.select(F.col("node_id").alias("target_id"), F.lit(True).alias("_t")), "target_id", "left")
    return a.filter("_s is null or _t is null").withColumn("source_missing", F.col("_s").isNull()).withColumn("target_missing", F.col("_t").isNull()).drop("_s", "_t")


def forms_of(lexemes: DataFrame, edges: DataFrame, forms: DataFrame) -> DataFrame:
    """``lexeme_id, lemma, form_id, surface``: the paradigm of each lexeme by its HAS_FORM edges."""
    return (
        edges.filter("relation_type = 'HAS_FORM'").select(F.col("source_id").alias("lexeme_id"), F.col("target_id").alias("form_id")).distinct()
        .join(lexemes.select("lexeme_id", "lemma"), "lexeme_id").join(forms.select("form_id", "surface"), "form_id").select("lexeme_id", "lemma", "form_id", "surface")
    )


def lookup_term(term: Column | str, lexemes: DataFrame, edges: DataFrame, forms: DataFrame) -> DataFrame:
    """Lexemes with that lemma, and forms with that surface and the lexeme they belong to; compared trimmed in lower case."""
    want = F.lower(F.trim(F.lit(term) if isinstance(term, str) else term))
    lex = lexemes.filter(F.lower(F.trim("lemma")) == want).select(F.lit("LEXEME").alias("kind"), F.col("lexeme_id").alias("id"), F.col("lemma").alias("text"), F.lit(None).cast("string").alias("parent_id"))
    form = forms_of(lexemes, edges, forms.filter(F.lower(F.trim("surface")) == want)).select(F.lit("FORM").alias("kind"), F.col("form_id").alias("id"), F.col("surface").alias("text"), F.col("lexeme_id").alias("parent_id"))
    return lex.unionByName(form)


def explain_connection(a: str, b: str, edges: DataFrame, bridge: DataFrame, claims: DataFrame) -> DataFrame:
    """Why two nodes are connected: their edges in either direction with the claims behind them; edges without claims stay."""
    between = edges.filter((F.least("source_id", "target_id") == min(a, b)) & (F.greatest("source_id", "target_id") == max(a, b)))
    e = between.select(F.col("id").alias("relation_id"), "source_id", "relation_type", "target_id", "epistemic_class", (F.col("epistemic_class") == "UNCERTAIN").alias("is_conflicting"))
    return e.join(bridge.select("relation_id", "claim_id").distinct(), "relation_id", "left").join(claims.select(F.col("id").alias("claim_id"), "source", "predicate", "object_json"), "claim_id", "left")


def derivational_links(edges: DataFrame) -> DataFrame:
    """``(lexeme_id, other, direction)``, distinct: DERIVED_FROM edges from both ends."""
    d = edges.filter("relation_type = 'DERIVED_FROM'")
    return d.select(F.col("source_id").alias("lexeme_id"), F.col("target_id").alias("other"), F.lit("BASE").alias("direction")).unionByName(d.select(F.col("target_id").alias("lexeme_id"), F.col("source_id").alias("other"), F.lit("DERIVED").alias("direction"))).distinct()


def word_rows(lexemes: DataFrame, senses: DataFrame, edges: DataFrame, forms: DataFrame) -> DataFrame:
    """``(lexeme_id, kind, id, text)``: all senses, forms and links of each lexeme, one distinct row each.

    Kinds are SENSE (its definition), FORM (its surface), BASE and DERIVED (links, whose text is null).
    """
    ids = lexemes.select("lexeme_id").distinct()
    s = senses.select("lexeme_id", F.lit("SENSE").alias("kind"), F.col("sense_id").alias("id"), F.col("definition").alias("text"))
    k = derivational_links(edges).select("lexeme_id", F.col("direction").alias("kind"), F.col("other").alias("id"), F.lit(None).cast("string").alias("text"))
    f = forms_of(lexemes, edges, forms).select("lexeme_id", F.lit("FORM").alias("kind"), F.col("form_id").alias("id"), F.col("surface").alias("text"))
    return s.unionByName(k).join(ids, "lexeme_id", "left_semi").unionByName(f).distinct()


def word_counts(lexemes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(lexeme_id, lemma, n_senses, n_forms, n_links)`` of each lexeme, counted over all of :func:`word_rows`."""
    n = rows.groupBy("lexeme_id").agg(F.count_if(F.col("kind") == "SENSE").alias("n_senses"), F.count_if(F.col("kind") == "FORM").alias("n_forms"), F.count_if(F.col("kind").isin("BASE", "DERIVED")).alias("n_links"))
    return lexemes.select("lexeme_id", "lemma").distinct().join(n, "lexeme_id", "left").na.fill(0, ["n_senses", "n_forms", "n_links"])


def subgraph(terms: DataFrame, lexemes: DataFrame, edges: DataFrame, forms: DataFrame, senses: DataFrame, roots: int = 5, n_forms: int = 25, n_senses: int = 10, n_bases: int = 10) -> tuple[DataFrame, DataFrame]:
    """The drawn surroundings of each of ``terms (term)``: nodes ``(term, id, type, label)`` and links ``(term, source, target, relation_type, evidence_type)``.

    A term's roots are its first ``roots`` lexemes; each shows its first forms, senses with their synset, and bases; first by id.
    The limits are the drawing's, per root; whole pages are :func:`word_rows`. ``lexemes``: ``lexeme_id, lemma``; ``senses``: ``lexeme_id, sense_id,
    definition, synset_id``. Labels of senses are cut at 28 characters. Terms compare trimmed in lower case; unknown and null ones have no rows.
    """
    from verbarium.operators.claims import latest

    key = lambda c: F.lower(F.trim(c))
    lex = lexemes.groupBy("lexeme_id").agg(F.min("lemma").alias("lemma"))
    asked = terms.filter("term is not null").select(key("term").alias("term")).distinct()
    root = latest(lex.withColumn("term", key("lemma")).join(asked, "term"), ["term"], roots, [F.col("lexeme_id")]).select("term", "lexeme_id", "lemma")
    own = edges.select(F.col("source_id").alias("lexeme_id"), F.col("target_id").alias("other"), "relation_type", "epistemic_class").distinct()
    own = own.groupBy("lexeme_id", "other", "relation_type").agg(F.min("epistemic_class").alias("evidence_type"))
    shown = forms.groupBy(F.col("form_id").alias("other")).agg(F.min("surface").alias("label"))

    def first(kind: str, ends: DataFrame, n: int) -> DataFrame:
        mine = own.filter(F.col("relation_type") == kind).join(root.select("term", "lexeme_id"), "lexeme_id").join(ends, "other")
        return latest(mine, ["term", "lexeme_id"], n, [F.col("other")])

    f = first("HAS_FORM", shown, n_forms)
    b = first("DERIVED_FROM", lex.select(F.col("lexeme_id").alias("other"), F.col("lemma").alias("label")), n_bases)
    told = senses.filter("synset_id is not null and definition is not null").select("lexeme_id", "sense_id", "definition", "synset_id").distinct()
    s = latest(told.join(root.select("term", "lexeme_id"), "lexeme_id"), ["term", "lexeme_id"], n_senses, [F.col("sense_id"), F.col("definition"), F.col("synset_id")])
    link = lambda df, a, z, kind, evidence: df.select("term", F.col(a).alias("source"), F.col(z).alias("target"), kind.alias("relation_type"), evidence.alias("evidence_type"))
    links = link(f, "lexeme_id", "other", F.col("relation_type"), F.col("evidence_type")).unionByName(link(b, "lexeme_id", "other", F.col("relation_type"), F.col("evidence_type")))
    links = links.unionByName(link(s, "lexeme_id", "sense_id", F.lit("HAS_SENSE"), F.lit("EXPLICIT"))).unionByName(link(s, "sense_id", "synset_id", F.lit("MEMBER_OF_SYNSET"), F.lit("EXPLICIT")))
    node = lambda df, i, kind, label: df.select("term", F.col(i).alias("id"), F.lit(kind).alias("type"), label.alias("label"))
    short = F.when(F.length("definition") > 28, shortened(F.col("definition"), 25)).otherwise(F.col("definition"))
    nodes = node(root, "lexeme_id", "LEXEME", F.col("lemma")).unionByName(node(f, "other", "FORM", F.col("label"))).unionByName(node(b, "other", "LEXEME", F.col("label")))
    nodes = nodes.unionByName(node(s, "sense_id", "SENSE", short)).unionByName(node(s, "synset_id", "SYNSET", F.concat(F.lit("Concept: "), F.substring("synset_id", 1, 8))))
    return nodes.groupBy("term", "id", "type").agg(F.min("label").alias("label")), links.distinct()


def base_forms(lexemes: DataFrame, edges: DataFrame, forms: DataFrame) -> DataFrame:
    """``(lexeme_id, form_id, surface)``: the form of each lexeme that is spelled like it."""
    return forms_of(lexemes, edges, forms).filter(F.lower(F.trim("lemma")) == F.lower(F.trim("surface"))).select("lexeme_id", "form_id", "surface").distinct()


def senses_with_synsets(members: DataFrame, synsets: DataFrame) -> DataFrame:
    """``(lexeme_id, sense_id, synset_id, definition, pos)``: senses with what their synset says; senses without a known synset stay.

    ``members``: ``lexeme_id, sense_id, synset_id``; ``synsets``: ``synset_id, definition, pos``, of which the first definition by text holds.
    """
    one = synsets.groupBy("synset_id").agg(F.min("definition").alias("definition"), F.min("pos").alias("pos"))
    return members.select("lexeme_id", "sense_id", "synset_id").distinct().join(one, "synset_id", "left").select("lexeme_id", "sense_id", "synset_id", "definition", "pos")
