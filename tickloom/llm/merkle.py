"""A manifest of hash trees over a table: one tree per group, and one over the roots of the groups.

Leaves are the digests of rows. On each level ``fanout`` consecutive nodes have one parent. Slot pivot:
an aggregate by parent with a condition per slot spreads its children into that many columns; the columns
together are hashed into the parent, and without the own slot they are the siblings of a child. Levels go up
until every group has one node, then down again, where each parent hands its path to its children.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import stored_narrow
from tickloom.session import stored

FANOUT = 2

# The steps from a leaf to the root: what stands left and right of the own digest in its parent.
PATH = "array<struct<left: string, right: string>>"

_ROW_BITS = 33  # of monotonically_increasing_id: the row within its partition

# Levels that are worked out together on the way down, before their paths are written.
_LEVELS_AT_ONCE = 4



def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields in order: ``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    texts = [field.cast("string") for field in fields]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return F.sha2(F.concat(*[F.coalesce(own, F.lit("-")) for own in sized]), 256)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the path, leaf level first, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, their position in the ``order`` of their ``tree``, and ``n``, its size.

    Range partitioning on the whole order makes even slices, however large a tree is. Rows are numbered in
    their written slice; the slices before are added from one row per tree and slice.
    """
    sorted_rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    slices = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "merkle-rows")
    slices = slices.withColumn("slice", F.shiftright("at", _ROW_BITS)).withColumn("row", F.col("at").bitwiseAND(F.lit(2**_ROW_BITS - 1)))
    totals = slices.groupBy("tree", "slice").agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")
    bases = totals.select("tree", "slice", base.alias("base"), F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    joined = slices.join(stored_narrow(bases, "merkle-slices"), ["tree", "slice"])
    return joined.withColumn("idx", F.col("base") + F.col("row")).drop("at", "slice", "row", "base")


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """(tree, idx, n, hash, s0, s1, ...) of the next level; trees with one node have reached their root."""
    slots = [f"s{j}" for j in range(fanout)]
    children = [F.max(F.when(F.col("idx") % fanout == j, F.col("hash"))).alias(slot) for j, slot in enumerate(slots)]
    spread = nodes.filter("n > 1").groupBy("tree", F.expr(f"idx div {fanout}").alias("idx")).agg(F.max("n").alias("below"), *children)
    size = F.expr(f"(below + {fanout - 1}) div {fanout}").alias("n")
    return spread.select("tree", "idx", size, F.sha2(F.concat_ws("", *slots), 256).alias("hash"), *slots)


def _grown(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The written levels above ``nodes``, and (tree, level, hash) of the top node of every tree."""
    size = nodes.agg(F.max("n")).first()[0] or 0
    found = [nodes.select("tree", "idx", "n", "hash")]
    while size > 1:
        size = -(-size // fanout)
        found.append(stored_narrow(_parents(found[-1], fanout), "merkle-level"))
    tops = [level.filter("n = 1").select("tree", F.lit(k).alias("level"), "hash") for k, level in enumerate(found)]
    heads = tops[0]
    for more in tops[1:]:
        heads = heads.unionAll(more)
    return found[1:], stored_narrow(heads, "merkle-heads")


def _children(parents: DataFrame, fanout: int) -> DataFrame:
    """Each child with its path: its siblings, then the path of its parent."""
    slots = [f"s{j}" for j in range(fanout)]
    step = [
        F.struct(
            F.lit(j).alias("slot"),
            F.col(slot).alias("hash"),
            F.struct(F.concat_ws("", *slots[:j]).alias("left"), F.concat_ws("", *slots[j + 1 :]).alias("right")).alias("step"),
        )
        for j, slot in enumerate(slots)
    ]
    each = parents.select("tree", "idx", "subroot", "root", "path", F.inline(F.array(*step))).filter("hash is not null")
    return each.select("tree", (F.col("idx") * fanout + F.col("slot")).alias("idx"), "subroot", "root", F.concat(F.array("step"), "path").alias("path"))


def _paths(levels: list[DataFrame], heads: DataFrame, fanout: int) -> DataFrame:
    """(tree, idx, subroot, root, path) of the lowest nodes from what the top node of each tree has."""

    def tops(level: int) -> DataFrame:
        return heads.filter(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("idx"), "subroot", "root", "path")

    known = tops(len(levels))
    for level in range(len(levels) - 1, -1, -1):
        known = _children(levels[level].join(known, ["tree", "idx"]), fanout).unionAll(tops(level))
        if level and level % _LEVELS_AT_ONCE == 0:
            known = stored_narrow(known, "merkle-paths")
    return known


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[Column],
    tree: Column,
    order: Column,
    keep: Mapping[str, Column],
    fanout: int = FANOUT,
) -> DataFrame:
    """Per row: the ``keep`` columns, leaf, subroot, root and path (array of left and right siblings).

    ``tree`` names the group of a row (null is a group of its own and comes first, the others in UTF-8 byte
    order), ``order`` its place among the leaves (null first; equal ones by their leaf, so repeated rows are
    leaves beside each other). A group of one row has its leaf as subroot. No rows give no rows. Whole texts
    are hashed as they are scanned; only digests go on, so their length and that of a group do not matter.
    Columns are taken by expression, so names in ``docs`` cannot clash.
    """
    if fanout < 2:
        raise ValueError("at least two children a node")
    group = F.coalesce(F.concat(F.lit("+"), tree.cast("string")), F.lit(""))
    own = F.struct(*[value.alias(name) for name, value in keep.items()])
    leaves = docs.select(group.alias("tree"), order.alias("place"), leaf_digest(fields).alias("hash"), own.alias("own"))
    leaves = _placed(leaves, ("place", "hash"))
    levels, heads = _grown(leaves, fanout)

    # The roots of the groups are the leaves of the tree above them.
    above = heads.select(F.lit("").alias("tree"), F.col("tree").alias("place"), "level", "hash")
    above = _placed(above, ("place",))
    top_levels, top = _grown(above, fanout)
    top = top.select("*", F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"), F.array().cast(PATH).alias("path"))
    way = _paths(top_levels, top, fanout).select("tree", "idx", "root", "path")
    known = above.join(way, ["tree", "idx"]).select(F.col("place").alias("tree"), "level", F.col("hash").alias("subroot"), "root", "path")

    paths = _paths(levels, stored_narrow(known, "merkle-heads"), fanout)
    return leaves.join(paths, ["tree", "idx"]).select("own.*", F.col("hash").alias("leaf"), "subroot", "root", "path")
