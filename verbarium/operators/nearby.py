"""The first edges around each root, without listing the nodes that each root reaches.

The edges at nodes within d + 1 hops of a node are those within d hops of it and of its neighbours, and the first of a
union are among the first of its parts. So each node hands on its first edges once for all roots, which costs edges and
not roots times nodes. A node with ``limit`` edges or more, a hub, hands on its number in place of its list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbarium.lineage import cut, drop
from verbarium.operators.graph import bounded_depth

#: The order of edges, nulls last.
ORDER = ["id", "source_id", "target_id", "relation_type"]
#: Above all numbers of edges and ends.
FAR = 2**63 - 1


def _numbered(edges: DataFrame) -> DataFrame:
    """Distinct edges with ``r``, which ascends in their order: ranges of the order are the partitions."""
    order = [F.col(c).asc_nulls_last() for c in ORDER]
    e = edges.select(*ORDER).repartitionByRange(*order).distinct().sortWithinPartitions(*order)
    return cut(e.withColumn("r", F.monotonically_increasing_id()))


def _ends(e: DataFrame, roots: DataFrame, types: list[str]) -> DataFrame:
    """``(c, follows, root, node, n)``: ends ``c`` of edges, ``2 r`` or ``2 r + 1``, each the ``n``-th of its node.

    ``node`` is the node's first end, which no other node has. A loop has one end. A root has a row more, at ``FAR``.
    """
    follows = F.coalesce(F.col("relation_type").isin(types) & (F.col("source_id") != F.col("target_id")), F.lit(False)).alias("follows")
    none = F.lit(None).cast("string").alias("root")
    out = e.filter("source_id is not null").select(F.col("source_id").alias("name"), (F.col("r") * 2).alias("c"), follows, none)
    back = e.filter("target_id is not null and not (source_id <=> target_id)").select(F.col("target_id").alias("name"), (F.col("r") * 2 + 1).alias("c"), follows, none)
    marks = roots.filter("root is not null").select("root").distinct().select(F.col("root").alias("name"), F.lit(FAR).alias("c"), F.lit(False).alias("follows"), "root")
    w = Window.partitionBy("name").orderBy("c")
    return cut(out.unionByName(back).unionByName(marks).select("c", "follows", "root", F.min("c").over(w).alias("node"), F.row_number().over(w).alias("n")))


def _key(item: str) -> Column:
    """The first edge that an item stands for: an edge is its own, a hub is stored as the complement of its node."""
    return F.when(F.col(item) < 0, F.shiftright(F.bitwise_not(F.col(item)), 1)).otherwise(F.col(item))


def _first(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """The first ``most`` rows of each node."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy(key))).filter(F.col("_r") <= most).drop("_r")


def first_edges(edges: DataFrame, roots: DataFrame, types: list[str], depth: int, limit: int) -> DataFrame:
    """``(root, id, source_id, relation_type, target_id)``: the same rows as ``graph.incident_edges`` of ``graph.reach``.

    Hops lead over edges of ``types`` in both directions; edges of all types count. Whatever is past a bound is dropped:
    a hub's ``limit``-th edge is a bound for all that have it within reach, and a node needs no edges past the largest
    bound of those it hands them to.
    """
    depth = bounded_depth(depth)
    e = _numbered(edges)
    ends = _ends(e, roots, types)
    first = ends.filter((F.col("c") < FAR) & (F.col("n") <= limit)).select("node", F.shiftright("c", 1).alias("r"), "n")
    marks = ends.filter(F.col("root").isNotNull() & (F.col("node") < FAR)).select("node", "root")
    pairs = cut(ends.filter("follows").groupBy(F.shiftright("c", 1)).agg(F.min("node").alias("a"), F.max("node").alias("b")).select("a", "b").distinct())
    adj = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))

    def spread(rows: DataFrame, best) -> DataFrame:
        """``(node, b)``: the best bound of each node and its neighbours."""
        return rows.unionByName(adj.join(rows.withColumnRenamed("node", "other"), "other").select("node", "b")).groupBy("node").agg(best("b").alias("b"))

    # ceiling[d]: a bound for the edges within d hops of a node, where there is a hub as near
    ceiling = [cut(first.filter(F.col("n") == limit).select("node", F.col("r").alias("b")))]
    for _ in range(depth):
        ceiling.append(cut(spread(ceiling[-1], F.min)))
    # wanted[d]: the nodes that hand on what is within d hops of them, and their bounds
    wanted: dict[int, DataFrame] = {}
    for d in range(depth, -1, -1):
        nodes = marks.select("node", F.lit(FAR).alias("b")) if d == depth else spread(wanted[d + 1], F.max)
        wanted[d] = cut(nodes.join(ceiling[d].withColumnRenamed("b", "_most"), "node", "left").select("node", F.least("b", "_most").alias("b")))
    drop(*ceiling[1:])

    hubs = ceiling[0].select("node", F.lit(True).alias("_hub"))
    item = F.when(F.col("_hub").isNull(), F.col("r")).when(F.col("n") == 1, F.bitwise_not("node"))
    items = first.join(wanted[0], "node").join(hubs, "node", "left").select("node", "b", item.alias("item")).filter(_key("item") <= F.col("b")).select("node", "item")
    for d in range(1, depth + 1):
        to = wanted[d]
        links = adj.join(to, "node").select("node", "b", "other").unionByName(to.select("node", "b", F.col("node").alias("other")))
        got = links.join(items.withColumnRenamed("node", "other"), "other").filter(_key("item") <= F.col("b")).select("node", "item").distinct()
        # an edge is the key of three items at most, itself and the hubs at its ends
        items = _first(got, _key("item"), 3 * limit)
    lists = first.join(hubs, "node").select(F.bitwise_not("node").alias("item"), "r")
    got = items.join(lists, "item", "left").select("node", F.coalesce("r", "item").alias("r"))
    got = got.join(wanted[depth], "node").filter("r <= b").select("node", "r").distinct()
    return _first(got, F.col("r"), limit).join(marks, "node").join(e, "r").select("root", "id", "source_id", "relation_type", "target_id")
