"""Sums along and below the nodes of a tree, and its nested-set intervals, in rounds of the logarithm of its depth.

Every round doubles the reach of a pointer per node, so no table is larger than
the tree: there are no (node, ancestor) pairs, whatever the depth. The tables are
joined by merges: written, their columns of ids are small enough to be broadcast
by mistake in every round.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from taxaloom.operators.ordered import running
from taxaloom.session import freeze, shuffle_width


def _linked(tree: DataFrame) -> DataFrame:
    """``(taxid, jump)``: the parent, null for a root or where the parent isn't a node."""
    nodes = tree.select(F.col("taxid").alias("_parent"))
    return tree.join(nodes.hint("merge"), F.col("parent") == F.col("_parent"), "left").select("taxid", F.col("_parent").alias("jump"))


def _jumps(tree: DataFrame) -> list[DataFrame]:
    """Tables ``(taxid, jump)`` of the nodes' 1st, 2nd, 4th, ... ancestors, while any node has one. A cycle is an error."""
    jump = freeze(_linked(tree).where("jump IS NOT NULL"))
    made, reach, nodes = [], 1, tree.count()
    while not jump.isEmpty():
        if reach > nodes:
            raise ValueError("the tree has a cycle")
        made.append(jump)
        higher = jump.select(F.col("taxid").alias("jump"), F.col("jump").alias("_next"))
        jump = freeze(jump.join(higher.hint("merge"), "jump").select("taxid", F.col("_next").alias("jump")))
        reach *= 2
    return made


def _below(tree: DataFrame, jumps: Sequence[DataFrame], values: Sequence[str]) -> DataFrame:
    """A node's sum after round k covers what is less than 2^k levels below it; the next adds the nodes 2^k below."""
    state = tree.select("taxid", *values)
    for jump in jumps:
        # Summed per task before the exchange, so that a node with many children is no task's whole work.
        add = state.join(jump.hint("merge"), "taxid").groupBy("jump").agg(*[F.sum(c).alias(f"_{c}") for c in values])
        state = freeze(
            state.join(add.withColumnRenamed("jump", "taxid").hint("merge"), "taxid", "left").select(
                "taxid", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in values]
            )
        )
    return state


def _above(tree: DataFrame, jumps: Sequence[DataFrame], values: Sequence[str]) -> DataFrame:
    """The same upwards: after round k a sum covers the node and its nearest 2^k - 1 ancestors."""
    state = tree.select("taxid", *values)
    for jump in jumps:
        higher = state.select(F.col("taxid").alias("jump"), *[F.col(c).alias(f"_{c}") for c in values])
        add = jump.join(higher.hint("merge"), "jump").drop("jump")
        state = freeze(
            state.join(add.hint("merge"), "taxid", "left").select(
                "taxid", *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in values]
            )
        )
    return state


def subtree_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``taxid`` and the sums of the columns ``values`` over each node and all below it, for ``(taxid, parent, ...)``."""
    return _below(tree, _jumps(tree), values)


def path_sums(tree: DataFrame, values: Sequence[str]) -> DataFrame:
    """``taxid`` and the sums of the columns ``values`` over each node and all its ancestors."""
    return _above(tree, _jumps(tree), values)


def nested_sets(tree: DataFrame) -> DataFrame:
    """``(taxid, enter, leave, depth)``: node b is in the subtree of a when ``a.enter <= b.enter < a.leave``.

    ``enter`` numbers the nodes from 0 in the order of an Euler tour that takes
    children by id, ``leave`` is the number after the last one below, ``depth``
    counts the nodes up to the root. ``enter`` is a sum over the path to the root:
    of each node on it, one and the sizes of the subtrees of earlier siblings.
    """
    tree = freeze(tree.select("taxid", "parent"))
    jumps = _jumps(tree)
    sizes = _below(tree.withColumn("size", F.lit(1).cast("long")), jumps, ["size"])
    # Roots are siblings below nothing.
    siblings = _linked(tree).join(sizes, "taxid").withColumn("jump", F.coalesce("jump", F.lit(-(1 << 62))))
    placed = freeze(running(siblings, ["jump"], "taxid", sums=["size"]))
    steps = placed.select(
        "taxid", (F.col("size_before") + F.when(F.col("jump") == -(1 << 62), F.lit(0)).otherwise(F.lit(1))).alias("enter"),
        F.lit(1).cast("long").alias("depth"),
    )
    return (
        _above(steps, jumps, ["enter", "depth"])
        .join(sizes, "taxid")
        .select("taxid", "enter", (F.col("enter") + F.col("size")).alias("leave"), "depth")
    )


def clade_sums(values: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``taxid`` and the sum of ``column`` over each node and all below it, as a difference of two prefix sums.

    ``values``: ``(taxid, column)``, one row per node at most; ``sets`` from
    :func:`nested_sets`, made once for any number of tables. Nodes without a
    positive sum are left out.
    """
    whole = F.col(column).cast("long") if dict(values.dtypes)[column] in ("int", "bigint") else F.col(column)
    at = sets.join(values.select("taxid", whole.alias("_v")), "taxid", "left").na.fill(0, ["_v"])
    n, width = sets.count(), 4 * shuffle_width(sets.sparkSession)
    # Entries are 0 to n - 1, so equal stretches of them are equal parts of the rows.
    stretch = F.floor(F.col("enter") / max(1, -(-n // width)))
    prefix = freeze(running(at, [], "enter", sums=["_v"], bucket=stretch).select("taxid", "enter", "leave", "_v_before", "_v_total"))
    after = prefix.select(F.col("enter").alias("leave"), F.col("_v_before").alias("_after"))
    total = F.coalesce("_after", "_v_total") - F.col("_v_before")
    return prefix.join(after, "leave", "left").select("taxid", total.alias(column)).where(F.col(column) > 0)
