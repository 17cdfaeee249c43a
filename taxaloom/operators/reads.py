"""Read-level tables: statistics, host removal, classification reports, abundance re-estimation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from taxaloom.operators.ordered import quantiles_of_counts, running
from taxaloom.operators.trees import clade_sums
from taxaloom.session import broadcast_rows, freeze

# Alignment flag bits.
PAIR_PROPER, UNMAPPED, MATE_UNMAPPED, FIRST, SECOND, SECONDARY = 2, 4, 8, 64, 128, 256

#: Rows of one ancestor above which its rows are joined where they are.
HOT_ROWS = 1_000_000


def read_stats(df: DataFrame) -> DataFrame:
    """Statistics per ``file``: counts, length summary and quartiles, N50, gaps, Q20/Q30 and GC percent.

    Base counts use lengths before and after deletion of characters, so a read is
    never exploded. Quartiles and N50 come from the distinct lengths of a file.
    """
    def count(column: str, characters: str):
        return F.length(column) - F.length(F.translate(column, characters, ""))

    # Phred+33: quality 20 is '5', quality 30 is '?'
    least = lambda c: "".join(map(chr, range(ord(c), 127)))

    length = F.length("seq").cast("bigint")
    rows = df.select(
        "file", length.alias("len"),
        count("seq", "GCgc").cast("bigint").alias("gc"),
        count("seq", "-. ").cast("bigint").alias("gap"),
        count("qual", least("5")).cast("bigint").alias("q20"),
        count("qual", least("?")).cast("bigint").alias("q30"),
    )
    per_length = rows.groupBy("file", "len").agg(
        F.count(F.lit(1)).alias("n"), F.sum("len").alias("bases"),
        *[F.sum(c).alias(c) for c in ("gc", "gap", "q20", "q30")],
    )
    ranked = running(per_length, ["file"], "len", sums=["n", "bases"])
    quart = quantiles_of_counts(ranked, ["file"], "len", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    # Bases in reads at least this long reach half of all bases.
    at_least = F.col("bases_total") - F.col("bases_before")
    n50 = F.max(F.when(2 * at_least >= F.col("bases_total"), F.col("len")))
    total = F.sum("bases")
    stats = ranked.groupBy("file").agg(
        F.sum("n").alias("num_seqs"), total.alias("sum_len"), F.min("len").alias("min_len"),
        (total / F.sum("n")).alias("avg_len"), F.max("len").alias("max_len"), n50.alias("n50"),
        F.sum("gap").alias("sum_gap"),
        *[(100.0 * F.sum(c) / F.nullif(total, F.lit(0))).alias(f"{c}_percent") for c in ("q20", "q30", "gc")],
    )
    return stats.join(quart, "file")


def host_removed_pairs(df: DataFrame, mode: str = "unmapped") -> DataFrame:
    """Read pairs free of host: ``(qname, mate, seq, qual)``, both mates present.

    ``unmapped``: both mates unmapped and not secondary. ``unconcordant``: the
    pair did not align properly. A name with several records of one mate keeps
    the first by sequence.
    """
    flag = F.col("flag")
    if mode == "unmapped":
        wanted = UNMAPPED + MATE_UNMAPPED
        kept = df.filter((flag.bitwiseAND(wanted) == wanted) & (flag.bitwiseAND(SECONDARY) == 0))
    else:
        kept = df.filter((flag.bitwiseAND(PAIR_PROPER) == 0) & (flag.bitwiseAND(SECONDARY) == 0))
    record = F.struct("seq", "qual")
    pairs = kept.groupBy("qname").agg(
        F.min(F.when(flag.bitwiseAND(FIRST) != 0, record)).alias("r1"),
        F.min(F.when(flag.bitwiseAND(SECOND) != 0, record)).alias("r2"),
    ).filter(F.col("r1").isNotNull() & F.col("r2").isNotNull())
    mates = F.array(
        F.struct(F.lit(1).alias("mate"), F.col("r1.seq"), F.col("r1.qual")),
        F.struct(F.lit(2).alias("mate"), F.col("r2.seq"), F.col("r2.qual")),
    )
    return pairs.select("qname", F.inline(mates))


def taxon_counts(df: DataFrame) -> DataFrame:
    """Reads per taxon of the classified reads."""
    return df.filter(F.col("status") == "C").groupBy("taxid").agg(F.count(F.lit(1)).alias("reads"))


def split_classified(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col("status") == "C"), df.filter(F.col("status") == "U")


def clade_report(counts: DataFrame, tree: DataFrame, sets: DataFrame, unclassified=None) -> DataFrame:
    """``(pct, clade_reads, taxon_reads, rank_code, taxid, name)`` of every node holding reads.

    ``sets`` are the tree's intervals (:func:`taxaloom.operators.trees.nested_sets`).
    ``unclassified`` (a scalar column) adds to the total the percentages refer to.
    """
    clades = clade_sums(counts, sets, "reads").withColumnRenamed("reads", "clade_reads")
    total = counts.agg(F.sum("reads")).scalar()
    if unclassified is not None:
        total = total + unclassified
    direct = counts.select(F.col("taxid"), F.col("reads").alias("taxon_reads"))
    return (
        tree.join(clades, "taxid").join(direct, "taxid", "left")
        .select(
            (100.0 * F.col("clade_reads") / total).alias("pct"), "clade_reads",
            F.coalesce("taxon_reads", F.lit(0)).alias("taxon_reads"), "rank_code", "taxid", "name",
        )
    )


def reestimate(
    report: DataFrame, sets: DataFrame, shares: DataFrame, levels: Sequence[str], threshold: int = 0
) -> DataFrame:
    """Reads held above a level shared out to the taxa of that level, for all levels at once.

    ``shares(taxid, ancestor, share)``: expected share of a taxon's reads that
    is only resolved to the ancestor; rows whose ``ancestor`` isn't above the
    taxon by ``sets`` are left out. A taxon of the level gets, from each of its
    ancestors, reads in proportion to share × its own clade reads. Returns
    ``(level, taxid, name, kraken_assigned, added, new_est, fraction)``.
    """
    at_level = report.filter(F.col("rank_code").isin(list(levels)) & (F.col("clade_reads") > threshold)).select(
        F.col("rank_code").alias("level"), "taxid", "name", F.col("clade_reads").alias("kraken_assigned")
    )
    held = report.filter("taxon_reads > 0").select("taxid", "taxon_reads").join(sets, "taxid").select(
        F.col("taxid").alias("ancestor"), "taxon_reads", F.col("enter").alias("_from"), F.col("leave").alias("_to")
    )
    below = (F.col("enter") > F.col("_from")) & (F.col("enter") < F.col("_to"))
    paired = shares.join(at_level, "taxid").join(sets.select("taxid", "enter"), "taxid").withColumn(
        "_w", F.col("share") * F.col("kraken_assigned")
    )
    weights = freeze(
        _split_join(paired, held, "ancestor").filter(below).select("level", "taxid", "ancestor", "taxon_reads", "_w")
    )
    # The weights of one ancestor are summed by aggregation: the root spans all taxa.
    per_node = weights.groupBy("level", "ancestor").agg(F.sum("_w").alias("_total")).filter("_total > 0")
    added = (
        _split_join(weights, per_node.withColumnRenamed("level", "_level"), "ancestor").filter("level = _level")
        .groupBy("level", "taxid").agg(F.sum(F.col("taxon_reads") * F.col("_w") / F.col("_total")).alias("added"))
    )
    est = at_level.join(added, ["level", "taxid"], "left").withColumn("added", F.coalesce("added", F.lit(0.0)))
    est = est.withColumn("new_est", F.col("kraken_assigned") + F.col("added"))
    totals = est.groupBy("level").agg(F.sum("new_est").alias("_all"))
    return est.join(totals, "level").select(
        "level", "taxid", "name", "kraken_assigned", "added", "new_est",
        (F.col("new_est") / F.col("_all")).alias("fraction"),
    )


def _split_join(rows: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Inner join of many ``rows`` with few ``nodes`` per ``key``; keys of more than ``HOT_ROWS`` rows are broadcast.

    There are at most ``rows / HOT_ROWS`` of them; they would each be one task's work in an exchange.
    """
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS).select(key)
    hot = freeze(hot)
    if hot.isEmpty():
        return rows.join(nodes, key)
    few = broadcast_rows(hot, hot.count())
    return (
        rows.join(few, key, "left_anti").join(nodes.join(few, key, "left_anti"), key)
        .unionByName(rows.join(broadcast_rows(nodes.join(few, key, "left_semi"), hot.count()), key))
    )
