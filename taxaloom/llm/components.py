"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.session import freeze


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``links`` but the smallest of each component, which is its label.

    Each round ties the larger neighbours of a node, then its smaller ones, to
    the smallest; the tree's depth falls by half in about two rounds. Minima are
    summed per task before the exchange and joined back, so a node with any
    number of links is no task's whole work. Rounds go on until nothing changes
    and are cut by written tables. Nulls and loops are left out.
    """
    u, v = F.col(f"`{a}`"), F.col(f"`{b}`")
    edges = freeze(
        links.where(u.isNotNull() & v.isNotNull() & (u != v))
        .select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct()
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = freeze(small)
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = tuple(found)
