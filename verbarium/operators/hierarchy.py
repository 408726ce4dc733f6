"""Parent-child links to full hierarchies, as nested sets.

Subtree sizes are computed upward, sibling ranges are allocated by prefix sums downward, all trees side by side in
one numbering, and the resulting ranges ``[lft, rgt)`` answer what there is to ask: a node's depth is the number
of ranges that are open at its place, its root the last tree begun there, its ancestors and descendants the ranges
around and inside its own. Nodes without children take no part in the passes and hang on their parents at the end.
Both passes move along pointers that double their reach each round, so a tree of depth ``d`` takes about ``log2(d) + 1``
rounds instead of ``d``, and a round moves only the nodes that have not arrived. Nodes that no round can finish
stand on, or below, a cycle.

No group of children is ever collected, and the key of a parent with very many never stalls a join: see
:func:`lookup`. Its sibling prefix sum is cut into ``SALTS`` slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from verbarium.lineage import cut, cut_and_count, drop
from verbarium.operators.lookup import lookup

#: Slices of one parent's children in the sibling prefix sum.
SALTS = 256
#: Rows of one key that a single task takes in its stride.
STALL = 200_000
#: Places are scanned in blocks of two to this power, and no tile of a range is larger.
BLOCK = 16


def taxonomy_links(relations: DataFrame) -> DataFrame:
    """``(child, parent)``, distinct, from HYPERNYM(_OF) and HYPONYM(_OF) rows in any case and padding.

    HYPERNYM_OF: the object is the parent; HYPONYM_OF: the object is the child. Other types and rows with a
    null end give no link; an empty table gives no rows.
    """
    kind = F.regexp_replace(F.upper(F.regexp_replace("relation_type", r"^\s+|\s+$", "")), "_OF$", "")
    is_up = kind == "HYPERNYM"
    return (
        relations.filter(kind.isin("HYPERNYM", "HYPONYM") & F.col("subject_id").isNotNull() & F.col("object_id").isNotNull())
        .select(F.when(is_up, F.col("subject_id")).otherwise(F.col("object_id")).alias("child"), F.when(is_up, F.col("object_id")).otherwise(F.col("subject_id")).alias("parent"))
        .distinct()
    )


def _parents(links: DataFrame) -> DataFrame:
    """One row per node: its parent, or null for a root; ``n_parents`` counts the distinct parents stated, ``inner``: it has children."""
    ends = links.select(F.col("child").alias("node"), "parent", F.lit(False).alias("inner")).unionByName(links.select(F.col("parent").alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(True).alias("inner")))
    return ends.groupBy("node").agg(F.min("parent").alias("parent"), F.count("parent").alias("n_parents"), F.max("inner").alias("inner"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _pointed(moving: DataFrame, *sums: Column) -> tuple[DataFrame, int]:
    """``(node, n, ...)``: how many point to a node; and the largest such number."""
    seen = Observation()
    table = cut(moving.groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n"), *sums).observe(seen, F.max("n").alias("n")))
    return table, seen.get["n"] or 0


def _follow(rows: DataFrame, target: DataFrame, hottest: int, total: int, how: str = "inner") -> DataFrame:
    """``rows`` with what their pointers lead to. Only where a key is large enough to stall a task are hot ones looked up apart; the result is the same."""
    if hottest > STALL:
        return lookup(rows, target, ["up"], "n", total, how)
    return rows.join(target.drop("n"), "up", how)


def _sizes_upward(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None, list[int], list[DataFrame]]:
    """``(node, size)`` of the inner nodes of trees, the nodes that never arrive at a root, the most pointers to one node in each round, and the tables read.

    In round ``k`` a node that has not arrived points to its ancestor ``2 ** k`` steps up and knows the size of what
    lies less than ``2 ** k`` steps below it. It hands this to the ancestor and takes over its pointer; where there
    is none it has arrived, and what nodes further below still hand it are sums to add at the end. Nodes of cycles
    keep their pointers; ``low`` is then the smallest id on the way.
    """
    leaves = nodes.filter("not inner").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    start = nodes.filter("inner").join(leaves, "node", "left").select("node", F.col("parent").alias("up"), (F.coalesce("n", F.lit(0)) + 1).alias("size"), F.col("node").alias("low"))
    state, open_now = cut_and_count(start, "up is not null")
    tables, rounds = [state], []
    while open_now:
        moving = state.filter("up is not null").select("node", "up", "size", "low")
        # a row for what is handed to a node, beside the node's own if it has not arrived
        handed, hottest = _pointed(moving, F.sum("size").alias("more"))
        sized = moving.join(handed, "node", "full").select("node", "up", (F.coalesce("size", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("size"), "low", "n")
        # who is pointed to and moves too; not there: it has arrived
        target = sized.filter("up is not null and n > 0").select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"), "n")
        jumped = _follow(sized.filter("up is not null").drop("n"), target, hottest, open_now, "left")
        moved = jumped.select("node", F.col("up2").alias("up"), "size", F.least("low", F.coalesce("low2", "low")).alias("low"))
        before = open_now
        state, open_now = cut_and_count(moved.unionByName(sized.filter("up is null").drop("n")), "up is not null")
        drop(handed)
        tables.append(state)
        rounds.append(hottest)
        if open_now == before:
            break
    stuck = state.filter("up is not null").select("node", "up", "low") if open_now else None
    parts = _union([t.filter("up is null").select("node", "size") for t in tables])
    return parts.groupBy("node").agg(F.sum("size").alias("size")), stuck, rounds, tables


def _sibling_offsets(kids: DataFrame) -> DataFrame:
    """Adds ``off``: one plus the sizes of the siblings before; siblings stand in the order of hash slice, id. Roots are siblings, from 0 on."""
    kids = kids.withColumn("_p", F.coalesce("parent", F.lit("\0"))).withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    before = (Window.unboundedPreceding, -1)
    inside = F.sum("size").over(Window.partitionBy("_p", "_salt").orderBy("node").rowsBetween(*before))
    slices = kids.groupBy("_p", "_salt").agg(F.sum("size").alias("_s"))
    slices = slices.withColumn("_start", F.coalesce(F.sum("_s").over(Window.partitionBy("_p").orderBy("_salt").rowsBetween(*before)), F.lit(0))).drop("_s")
    placed = kids.withColumn("_in", F.coalesce(inside, F.lit(0))).join(slices, ["_p", "_salt"])
    return placed.withColumn("off", F.col("parent").isNotNull().cast("long") + F.col("_start") + F.col("_in")).drop("_start", "_in", "_salt", "_p")


def _ranges_downward(placed: DataFrame, rounds: list[int]) -> tuple[DataFrame, list[DataFrame]]:
    """``(node, lft)`` of inner nodes: the sum of the offsets from the root down; and the tables read.

    The pointers of a round are those of the same round upward, so its hottest key is known.
    """
    state, open_now = cut_and_count(placed.filter("inner").select("node", F.col("parent").alias("up"), F.col("off").alias("lft")), "up is not null")
    tables = [state]
    for hottest in rounds:
        if not open_now:
            break
        moving = state.filter("up is not null")
        # the pointer leads to one that has arrived, in any round, or to one that moves too
        target = _union([*[t.filter("up is null") for t in tables], moving]).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("lft").alias("lft2"))
        if hottest > STALL:
            target = target.join(moving.groupBy("up").agg(F.count(F.lit(1)).alias("n")), "up")
        moved = _follow(moving, target, hottest, open_now).select("node", F.col("up2").alias("up"), (F.col("lft") + F.col("lft2")).alias("lft"))
        state, open_now = cut_and_count(moved, "up is not null")
        tables.append(state)
    return _union([t.filter("up is null").select("node", "lft") for t in tables]), tables


def _read_off(ranges: DataFrame) -> DataFrame:
    """Adds ``root`` and ``depth`` to nodes with ranges ``[lft, rgt)`` of one numbering without gaps.

    As many ranges have begun at a place as it counts, so depth is what is left after those that have ended; the
    root is the one begun last. Both are running totals over places, in blocks that start from the totals of the
    blocks before: one row per block is all that is ever in one place.
    """
    opens = ranges.withColumn("at", F.col("lft")).withColumn("begun", F.when(F.col("parent").isNull(), F.struct("lft", "node"))).withColumn("ended", F.lit(0))
    blank = [F.lit(None).cast(t).alias(c) for c, t in ranges.dtypes]
    closes = ranges.groupBy(F.col("rgt").alias("at")).agg(F.count(F.lit(1)).alias("ended")).select(*blank, "at", F.lit(None).cast(opens.schema["begun"].dataType).alias("begun"), F.col("ended"))
    places = opens.unionByName(closes).withColumn("block", F.shiftright("at", BLOCK))
    totals = places.groupBy("block").agg(F.sum("ended").alias("e"), F.max("begun").alias("b"))
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", F.coalesce(F.sum("e").over(upto), F.lit(0)).alias("e"), F.max("b").over(upto).alias("b"))
    # at one place ranges end before one begins
    here = Window.partitionBy("block").orderBy("at", F.desc("ended")).rowsBetween(Window.unboundedPreceding, 0)
    told = places.withColumn("_e", F.sum("ended").over(here)).withColumn("_b", F.max("begun").over(here)).filter("node is not null").join(starts, "block")
    return told.withColumn("depth", F.col("lft") - F.col("_e") - F.col("e")).withColumn("root", F.coalesce("_b", "b")["node"]).select(*ranges.columns, "root", "depth")


def _cycle_members(stuck: DataFrame) -> DataFrame:
    """``(node, on_cycle, cycle_id)`` for inner nodes ``(node, up, low)`` that never reach a root.

    The image of the parent function applied often enough is exactly the set of cycle nodes; it is reached
    when doubling the steps no longer shrinks it. ``low`` then spans whole cycles once doubling no longer
    lowers it anywhere. A cycle is named by its smallest node.
    """
    state, size = stuck, None
    while True:
        size = state.select("up").distinct().count() if size is None else size
        target = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"))
        step = state.join(target, "up").select("node", F.col("up2").alias("up"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("fell"))
        after, fell = cut_and_count(step, "fell")
        before, size = size, after.select("up").distinct().count()
        drop(state)
        state = after
        if before == size and not fell:
            break
    members = state.select(F.col("up").alias("node")).distinct().withColumn("on_cycle", F.lit(True))
    # low is the same all round a cycle, so the cycle node that a node leads to names its cycle
    names = state.select(F.col("node").alias("up"), F.col("low").alias("cycle_id"))
    return state.join(members, "node", "left").withColumn("on_cycle", F.coalesce("on_cycle", F.lit(False))).join(names, "up", "left").select("node", "on_cycle", "cycle_id")


def hierarchy(links: DataFrame, with_path: bool = False) -> DataFrame:
    """Every node of ``links (child, parent)`` with its place in its tree.

    Columns: ``node, parent, root, depth, lft, rgt, n_descendants, status, cycle_id, n_parents`` and, with
    ``with_path``, ``path`` (root first). ``status`` is ``tree``, ``cycle`` or ``below_cycle``; the last two
    have null places. ``rgt - lft`` is the size of the subtree; ``x`` is below ``y`` if ``y.lft < x.lft < y.rgt``.

    Rows with a null end are ignored, repeated links count once, a self-link is a cycle of one node, an
    empty table gives no rows. A node stated under several parents is placed under the smallest and
    reports how many in ``n_parents``. Extra columns are not read.
    """
    pairs = links.select("child", "parent").filter("child is not null and parent is not null").distinct()
    nodes = cut(_parents(pairs))
    sizes, stuck, rounds, read = _sizes_upward(nodes)
    sized = nodes.filter("inner").join(sizes, "node").unionByName(nodes.filter("not inner").withColumn("size", F.lit(1).cast("long")))
    placed = cut(_sibling_offsets(sized))
    drop(*(read if stuck is None else read[:-1]))
    inner, read = _ranges_downward(placed, rounds)
    inner = cut(inner)
    drop(*read)
    leaves = placed.filter("not inner")
    hanging = leaves.select("node", F.col("parent").alias("up"), "n_parents", "off")
    kids, hottest = _pointed(hanging)
    above = inner.join(kids, "node").select(F.col("node").alias("up"), F.col("lft").alias("_l"), "n")
    hung = _follow(hanging, above, hottest, leaves.count()).select("node", F.col("up").alias("parent"), "n_parents", (F.col("_l") + F.col("off")).alias("lft"))
    ranges = placed.join(inner, "node").select("node", "parent", "n_parents", "lft", (F.col("lft") + F.col("size")).alias("rgt"))
    ranges = cut(ranges.unionByName(hung.select("node", "parent", "n_parents", "lft", (F.col("lft") + 1).alias("rgt"))))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    tree = _read_off(ranges).select("node", "parent", "root", "depth", "lft", "rgt", (F.col("rgt") - F.col("lft") - 1).alias("n_descendants"), F.lit("tree").alias("status"), none("string", "cycle_id"), "n_parents")
    if with_path:
        tree = cut(tree)
        above = descendants(tree).join(tree.select(F.col("node").alias("ancestor"), F.col("lft").alias("_l")), "ancestor")
        path = above.groupBy(F.col("descendant").alias("node")).agg(F.array_sort(F.collect_list(F.struct("_l", "ancestor")))["ancestor"].alias("_a"))  # as many as it is deep
        tree = tree.join(path, "node", "left").withColumn("path", F.concat(F.coalesce("_a", F.array().cast("array<string>")), F.array("node"))).drop("_a")
    if stuck is None:
        return tree
    members = _cycle_members(stuck)
    below = leaves.select("node", F.col("parent").alias("_p")).join(members.select(F.col("node").alias("_p"), "cycle_id"), "_p").select("node", F.lit(False).alias("on_cycle"), "cycle_id")
    rest = nodes.join(members.unionByName(below), "node").select(
        "node", "parent", none("string", "root"), none("long", "depth"), none("long", "lft"), none("long", "rgt"), none("long", "n_descendants"),
        F.when(F.col("on_cycle"), "cycle").otherwise("below_cycle").alias("status"), "cycle_id", "n_parents", *([none("array<string>", "path")] if with_path else []),
    )
    return tree.unionByName(rest)


#: Aligned blocks that tile [lo, hi): at each level below the last at most the first and the last one, at the last all that fit in.
_TILES = f"""
concat(
    filter(flatten(transform(sequence(0, {BLOCK - 1}), k -> transform(
        array(
            if(shiftright(lo + shiftleft(1L, k) - 1, k) % 2 = 1 and shiftright(lo + shiftleft(1L, k) - 1, k) < shiftright(hi, k),
               shiftright(lo + shiftleft(1L, k) - 1, k), null),
            if(shiftright(hi, k) % 2 = 1 and shiftright(lo + shiftleft(1L, k) - 1, k) < shiftright(hi, k), shiftright(hi, k) - 1, null)),
        b -> named_struct('level', k, 'block', b)))), x -> x.block is not null),
    if(shiftright(lo + {2**BLOCK - 1}L, {BLOCK}) < shiftright(hi, {BLOCK}),
       transform(sequence(shiftright(lo + {2**BLOCK - 1}L, {BLOCK}), shiftright(hi, {BLOCK}) - 1), b -> named_struct('level', {BLOCK}, 'block', b)),
       cast(array() as array<struct<level int, block bigint>>)))
"""


def descendants(tree: DataFrame) -> DataFrame:
    """``(ancestor, descendant)`` pairs of :func:`hierarchy` rows, from the nested-set ranges.

    A range is tiled by aligned power-of-two blocks of at most ``2 ** BLOCK`` places and a place belongs to one
    block per level, so the containment join is an equi-join that gives each pair exactly once, and no key has more
    than ``2 ** BLOCK`` places, however large a tree is.
    """
    places = tree.filter("status = 'tree'")
    ranges = (
        places.filter("n_descendants > 0").select(F.col("node").alias("ancestor"), (F.col("lft") + 1).alias("lo"), F.col("rgt").alias("hi"))
        .select("ancestor", F.explode(F.expr(_TILES)).alias("_b")).select("ancestor", "_b.level", "_b.block")
    )
    spots = places.select(F.col("node").alias("descendant"), "lft", F.explode(F.sequence(F.lit(0), F.lit(BLOCK))).alias("level")).select("descendant", "level", F.expr("shiftright(lft, level)").alias("block"))
    return ranges.join(spots, ["level", "block"]).select("ancestor", "descendant")
