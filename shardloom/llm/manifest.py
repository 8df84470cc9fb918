"""Merkle manifest of a data set, built with lag and lead windows.

Every row is a leaf.  Within a group (a source) the leaves stand in key order;
``ARITY`` consecutive nodes, fewer at the end, become their parent until one is
left, the group's subroot.  The subroots, in group order, give the root likewise.
H is lowercase hex SHA-256 of its inputs joined; digests go in as hex text.

Levels are windows over rows that stay where they are.  At level l a node is held
by its first leaf, place p with p mod 3^l = 0, and its neighbours' first leaves
stand at the fixed offsets 3^l and 2 * 3^l, so ``lag`` and ``lead`` by these
offsets, masked by the node's slot among its siblings and by the length of their
run, supply the siblings.  The row in slot 0 hashes the parent; ``last`` non-null
value hands the siblings on to the other leaves below the node.

A group is cut into blocks of ``BLOCK`` = 3^7 leaves: no run crosses a block, so
seven levels need one exchange by (group, block) and one sort, and a hot source
is as many tasks' work as its blocks.  The blocks' tops are the leaves of the next
round, 2,187 times fewer, until every group has one node.  Then the siblings are
handed down: each round is joined with the round above by (group, block).  Texts
are read once, to hash them; digests and keys alone are shuffled.  Only sizes and
the root reach the driver.

Edge cases: null fields count as ``-``; a null key comes first in its group, a null
group first among groups; rows with equal keys stand in the order of their leaves,
so the result does not depend on the layout of the files; a group of one row has
its leaf as subroot, a single group's subroot is the root; an empty table has no
rows and no root; very long texts are hashed in the scan and go no further; other
columns of the input play no part but can be carried along.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import broadcast_within, quoted, stage
from shardloom.operators.ordering import ordinal

ARITY = 3
#: Levels of a round, and the leaves they cover: within Spark's in-memory window buffer of 4,096 rows.
LEVELS = 7
BLOCK = ARITY**LEVELS
STEP = "struct<slot:int,left:string,right:string>"
PATH = f"array<{STEP}>"


def digest(*parts: Column) -> Column:
    """H of parts; a null part adds nothing."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256)


def field(value: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """H of the fields in order."""
    return digest(*map(field, fields))


def parent(node: Column, step: Column) -> Column:
    """H of a node and its siblings (slot of the node, then the others from left to right)."""
    slot, left, right = step["slot"], step["left"], step["right"]
    first = F.when(slot == 0, node).otherwise(left)
    middle = F.when(slot == 0, left).when(slot == 1, node).otherwise(right)
    return digest(first, middle, F.when(slot == 2, node).otherwise(right))


def fold(node: Column, path: str) -> Column:
    """The root that ``node`` and the siblings of ``path`` give."""
    return F.aggregate(path, node, parent)


def proof(path: str) -> Column:
    """H of the siblings, level by level, from left to right."""
    pair = F.transform(path, lambda x: F.concat(F.coalesce(x["left"], F.lit("")), F.coalesce(x["right"], F.lit(""))))
    return F.sha2(F.concat_ws("", pair), 256)


def _levels(nodes: DataFrame, levels: int) -> DataFrame:
    """(g, pos, m, node, ...) with ``m`` the nodes of the group -> the same with
    ``path``, the siblings of up to ``levels`` levels, and ``top``, the block's node
    after them on the block's first row (null on the others)."""
    place = F.col("pos")
    rows = nodes.withColumn("block", F.floor(place / F.lit(BLOCK)).cast("long"))
    whole = Window.partitionBy("g", "block").orderBy("pos")
    so_far = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("top", F.col("node"))
    for level in range(levels):
        width = ARITY**level
        holder = place % width == 0
        here = F.floor(place / F.lit(width)).cast("long")
        slot = (here % ARITY).cast("int")
        at_level = F.ceil(F.col("m") / F.lit(width)).cast("long")
        run = F.least(F.lit(ARITY).cast("long"), at_level - (here - slot))
        alive = F.col("m") > width  # else the group has one node already
        for d in (1, 2):
            rows = rows.withColumn(f"next{d}", F.lead("top", d * width).over(whole)).withColumn(f"prior{d}", F.lag("top", d * width).over(whole))
        left = F.when((slot == 0) & (run > 1), F.col("next1")).when(slot == 1, F.col("prior1")).when(slot == 2, F.col("prior2"))
        right = F.when((slot == 0) & (run > 2), F.col("next2")).when((slot == 1) & (run > 2), F.col("next1")).when(slot == 2, F.col("prior1"))
        step = F.struct(slot.alias("slot"), left.alias("left"), right.alias("right"))
        rows = rows.withColumn("step", F.when(alive & holder, step))
        first = alive & (place % (width * ARITY) == 0)
        rows = rows.withColumn("top", F.when(first, parent(F.col("top"), F.col("step"))).when(~alive, F.col("top")))
        found = F.col("step") if width == 1 else F.when(alive, F.last("step", ignorenulls=True).over(so_far))
        rows = rows.withColumn(f"step{level}", found).drop("step", "next1", "next2", "prior1", "prior2")
    steps = [f"step{i}" for i in range(levels)]
    path = F.filter(F.array(*steps), lambda x: x.isNotNull()).cast(PATH)
    return rows.withColumn("path", path).drop(*steps)


def _tree(nodes: DataFrame, largest: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(g, pos, m, node, ...), ``m`` being ``largest`` at most -> rounds joined:
    ``nodes`` with the ``path`` to the group's top, and (g, top)."""
    rounds = []
    while not rounds or largest > 1:
        height = next(i for i in range(LEVELS + 1) if ARITY**i >= largest or i == LEVELS)
        climbed = stage(_levels(nodes, height), f"{name}-{len(rounds)}")
        rounds.append(climbed)
        above = F.ceil(F.col("m") / F.lit(BLOCK)).cast("long").alias("m")
        nodes = climbed.where(F.col("pos") % BLOCK == 0).select("g", F.col("block").alias("pos"), above, F.col("top").alias("node"))
        largest = -(-largest // BLOCK)
    tops = nodes.select("g", F.col("node").alias("top"))
    known = rounds.pop().drop("block", "top", "m")
    while rounds:
        upper = known.select(F.col("g").alias("__g"), F.col("pos").alias("__pos"), F.col("path").alias("__path"))
        lower = rounds.pop()
        joined = lower.join(upper, (F.col("g") == F.col("__g")) & (F.col("block") == F.col("__pos")))
        known = joined.withColumn("path", F.concat("path", "__path")).drop("block", "top", "m", "__g", "__pos", "__path")
    return known, tops


def build(
    rows: DataFrame, key: Column, group: Column, fields: Sequence[Column], carry: Mapping[str, Column] | None = None
) -> DataFrame:
    """(leaf, subroot, root, path, carried columns): one row for each of ``rows``.

    ``path`` holds the siblings from the leaf to the root (slot of the node,
    siblings left to right); ``carry`` names narrow expressions to keep, such as
    the key or the leaf of another copy of the row."""
    carry = dict(carry or {})
    clash = {"__key", "__group", "__row", "g", "pos", "m", "node", "path", "block", "top", "leaf", "subroot", "root"} & {c.lower() for c in carry}
    if clash:
        raise ValueError(f"carried columns need other names: {sorted(clash)}")
    leaves = rows.select(
        key.alias("__key"), group.cast("string").alias("__group"), leaf(fields).alias("node"), *(c.alias(n) for n, c in carry.items())
    )
    leaves = stage(leaves.withColumn("__row", F.monotonically_increasing_id()), "manifest-leaves")
    keys = leaves.select("__group", "__key", "node", "__row")
    sizes = keys.groupBy("__group").agg(F.count(F.lit(1)).alias("m")).withColumn("all", F.lit(0))
    groups = stage(ordinal(sizes, ["all"], ["__group"], "g"), "manifest-groups").select(F.col("__group").alias("__of"), "g", "m")
    number, largest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("m"), F.lit(0))).first()
    placed = ordinal(leaves, ["__group"], ["__key", "node", "__row"], "pos")
    small = broadcast_within(groups, F.coalesce(F.octet_length("__of"), F.lit(0)) + 24)
    nodes = placed.join(small, F.col("__group").eqNullSafe(F.col("__of"))).drop("__group", "__of", "__key", "__row")
    known, subroots = _tree(nodes, largest, "manifest")
    subroots = stage(subroots, "manifest-subroots")
    upper = subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(number).cast("long").alias("m"), F.col("top").alias("node"))
    tops, roots = _tree(upper, number, "manifest-root")
    root = (roots.first() or {"top": None})["top"]
    tops = tops.select(F.col("pos").alias("__g"), F.col("node").alias("subroot"), F.col("path").alias("__path"))
    tops = broadcast_within(stage(tops, "manifest-tops"), F.lit(300) + F.size("__path") * 150)
    whole = known.join(tops, F.col("g") == F.col("__g"))
    kept = [F.col(quoted(n)) for n in carry]
    return whole.select(F.col("node").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), F.concat("path", "__path").alias("path"), *kept)
