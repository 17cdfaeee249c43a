"""Boilerplate lines by their frequency relative to the site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.session import freeze

from .common import text_of, unused

#: White space that doesn't tell lines apart.
_EDGES = " \t\r\x0b\x0c"


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(_EDGES))))


def line_dedup(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = 0.05,
    min_pages: int = 5,
    n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """``docs`` without the lines that more than ``max_ratio`` of their host's pages have.

    A page counts once for a line, however often it repeats it; each row is a
    page, repeated rows too. Lines on fewer than ``min_pages`` pages of the host
    stay, so small hosts lose nothing; blank lines stay. Lines are equal when
    they are so without white space at their ends. A null host is a host of its
    own; a null text becomes an empty one. A document of which no line is left
    stays with an empty text. ``n_lines`` and ``n_dropped`` name count columns.

    Only (host, 16-byte key) counts are exchanged, summed per task first, so a
    hot host or line costs one row per task. A host has at most
    (its lines per page / ``max_ratio``) such lines, since each of them takes up
    that share of its pages: their list per host is joined, and texts are not
    exchanged where that table is small enough for Spark to broadcast.
    """
    host = F.col(f"`{host_col}`")
    lines = F.split(text_of(text_col), "\n")
    pages = docs.groupBy(host.alias("__host")).agg(F.count("*").alias("__pages"))
    counts = (
        docs.select(host.alias("__host"), F.explode(F.array_distinct(F.transform(lines, _key))).alias("__key"))
        .groupBy("__host", "__key")
        .agg(F.count("*").alias("__on"))
    )
    blank = F.unhex(F.md5(F.lit("")))
    common = (
        counts.where((F.col("__on") >= min_pages) & (F.col("__key") != blank))
        .join(pages.withColumnRenamed("__host", "__of"), F.col("__host").eqNullSafe(F.col("__of")))
        .where(F.col("__on") > max_ratio * F.col("__pages"))
        .groupBy("__host")
        .agg(F.collect_list("__key").alias("__common"))
    )
    common = freeze(common)
    of, list_of, kept_lines = unused(docs, "__host", "__common", "__kept")
    kept = F.when(F.col(list_of).isNull(), lines).otherwise(
        F.filter(lines, lambda line: ~F.array_contains(F.col(list_of), _key(line)))
    )
    common = common.select(F.col("__host").alias(of), F.col("__common").alias(list_of))
    out = docs.join(common, host.eqNullSafe(F.col(of)), "left").withColumn(kept_lines, kept)
    columns = [
        F.array_join(kept_lines, "\n").alias(text_col) if c == text_col else F.col(f"`{c}`") for c in docs.columns
    ]
    if n_lines:
        columns.append(F.size(lines).cast("long").alias(n_lines))
    if n_dropped:
        columns.append((F.size(lines) - F.size(kept_lines)).cast("long").alias(n_dropped))
    return out.select(*columns)
