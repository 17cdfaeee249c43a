"""Composition: totals, top-k with an ``Other`` bucket, sample orders, prevalence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from taxaloom.functions import lineage as L
from taxaloom.operators.ordered import place, quantiles_of_counts, running, value_counts
from taxaloom.session import broadcast_rows

OTHER = "Other"
FEW_OTHER = "other"


def group_totals(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Summed value of every feature per group."""
    return df.join(meta, "sample_name").groupBy("group", "feature").agg(F.sum("value").alias("total"))


def _best(totals: DataFrame, keys: Sequence[str], n: int, digits: int = 9) -> DataFrame:
    """The ``n`` largest totals per key; ties by name. The row-number filter prunes
    before the shuffle, so no key is gathered whole."""
    order = [F.round("total", digits).desc(), F.col("feature").asc()]
    if not keys:
        return totals.orderBy(*order).limit(n).select("feature")
    w = W.partitionBy(*keys).orderBy(*order)
    return totals.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).select(*keys, "feature")


def top_n_by_group(df: DataFrame, meta: DataFrame, n: int) -> DataFrame:
    """Per sample, the top ``n`` features of its group, everything else as ``Other``."""
    grouped = df.join(meta, "sample_name")
    totals = grouped.groupBy("group", "feature").agg(F.sum("value").alias("total"))
    groups = meta.select("group").distinct().count()
    best = broadcast_rows(_best(totals, ["group"], n).withColumn("_top", F.lit(True)), n * groups)
    name = F.when(F.col("_top"), F.col("feature")).otherwise(OTHER)
    return (
        grouped.join(best, ["group", "feature"], "left")
        .groupBy("group", "sample_name", name.alias("feature"))
        .agg(F.sum("value").alias("value"))
    )


def top_n(df: DataFrame, n: int) -> DataFrame:
    """Per sample, the top ``n`` features overall, everything else as ``Other``."""
    best = _best(df.groupBy("feature").agg(F.sum("value").alias("total")), [], n).withColumn("_top", F.lit(True))
    best = broadcast_rows(best, n)
    name = F.when(F.col("_top"), F.col("feature")).otherwise(OTHER)
    return (
        df.join(best, "feature", "left")
        .groupBy("sample_name", name.alias("feature"))
        .agg(F.sum("value").alias("value"))
    )


def order_by_total(df: DataFrame, digits: int = 6) -> DataFrame:
    """Features of a (collapsed) table with their total and their place by descending total."""
    totals = df.groupBy("feature").agg(F.round(F.sum("value"), digits).alias("total"))
    return place(totals, [], [("total", True), ("feature", False)])


def top_by_mean(df: DataFrame, n_samples: Column, n: int, by: Sequence[str] = (), digits: int = 9) -> DataFrame:
    """Top ``n`` strata by mean over all samples (ties: name descending), the rest as ``other``,
    ``unclassified`` kept apart and last. ``place`` is the legend position; the bar stack is its reverse."""
    by = list(by)
    means = df.groupBy(*by, "feature").agg((F.sum("value") / n_samples).alias("mean"))
    named = means.filter(F.col("feature") != L.UNCLASSIFIED)
    order = [F.round("mean", digits).desc(), F.col("feature").desc()]
    if by:
        w = W.partitionBy(*by).orderBy(*order)
        best = named.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    else:
        # At most n rows are left to number.
        best = named.orderBy(*order).limit(n).withColumn("_rn", F.row_number().over(W.orderBy(*order)))
    last = F.when(F.col("feature") == L.UNCLASSIFIED, n + 2).otherwise(n + 1)
    label = F.when(
        F.col("_rn").isNotNull() | (F.col("feature") == L.UNCLASSIFIED), F.col("feature")
    ).otherwise(FEW_OTHER)
    return (
        df.filter("value > 0")
        .join(best.select(*by, "feature", "_rn"), [*by, "feature"], "left")
        .groupBy(*by, "sample_name", label.alias("feature"), F.coalesce("_rn", last).alias("place"))
        .agg(F.sum("value").alias("value"))
    )


def as_genera(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Strata collapsed to the part before the first dot."""
    return df.groupBy(*by, "sample_name", L.genus_of("feature").alias("feature")).agg(F.sum("value").alias("value"))


def zero_samples(df: DataFrame, samples: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(n_total, n_kept, n_lost)`` samples with a positive sum, per ``by``."""
    live = df.groupBy(*by, "sample_name").agg(F.sum("value").alias("_s")).filter("_s > 0")
    total = samples.select(F.count_distinct("sample_name")).scalar()
    return live.groupBy(*by).agg(F.count(F.lit(1)).alias("n_kept")).select(
        *by, total.alias("n_total"), "n_kept", (total - F.col("n_kept")).alias("n_lost")
    )


def remove_zero_samples(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of samples with a positive sum. Values are never negative, so a positive row is enough."""
    live = df.filter("value > 0").select(*by, "sample_name").distinct()
    return df.join(live, [*by, "sample_name"], "left_semi")


def collapse_levels(meta: DataFrame, n: int, level: str = "group", by: Sequence[str] = ()) -> DataFrame:
    """Metadata with all but the ``n`` most frequent levels (ties by name) named ``other``, for each ``by`` key."""
    by = list(by)
    counts = meta.groupBy(*by, level).agg(F.count(F.lit(1)).alias("_c"))
    if by:
        place_ = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("_c"), level))
        best = counts.withColumn("_p", place_).filter(F.col("_p") <= n)
    else:
        best = broadcast_rows(counts.orderBy(F.desc("_c"), level).limit(n), n)
    best = best.select(*by, level, F.lit(True).alias("_top"))
    return meta.join(best, [*by, level], "left").select(
        *by, "sample_name", F.when(F.col("_top"), F.col(level)).otherwise(FEW_OTHER).alias(level)
    )


def sample_order(
    df: DataFrame,
    samples: DataFrame,
    methods: Sequence[str] = ("sum",),
    meta: DataFrame | None = None,
    file_order: DataFrame | None = None,
    by: Sequence[str] = (),
    digits: int = 9,
    whole: bool = True,
) -> DataFrame:
    """``(sample_name, position)`` after stable sorts by each method in turn.

    ``samples(sample_name, position)`` is the input order. Methods: ``none``,
    ``sum`` (descending), ``metadata``, ``file``, ``dominant`` (descending by the
    overall maximum of the sample's largest taxon, then the amount of it),
    ``braycurtis`` and ``braycurtis_w`` (leaf order of the dendrogram by average
    linkage, on shares or on values; one job for all keys).
    With ``by``, every focal feature has an order of its own.
    """
    by = list(by)
    if by:
        order = df.select(*by, "sample_name").distinct().join(samples, "sample_name")
    else:
        order = samples.select("sample_name", "position")
    for method in methods:
        if method == "none":
            continue
        if method == "sum":
            key = df.groupBy(*by, "sample_name").agg(F.round(F.sum("value"), digits).alias("_k1"))
            cols = [("_k1", True)]
        elif method == "metadata":
            key, cols = meta.select("sample_name", F.col("group").alias("_k1")), [("_k1", False)]
        elif method == "file":
            key, cols = file_order.select("sample_name", F.col("position").alias("_k1")), [("_k1", False)]
        elif method == "dominant":
            key, cols = _dominant(df, by), [("_k1", True), ("_k2", True), ("_k3", True)]
        elif method in ("braycurtis", "braycurtis_w"):
            # Imported late: these modules build on this one's neighbours.
            from taxaloom.operators.ordination import bray_curtis_order

            leaves = bray_curtis_order(df, method == "braycurtis_w", order.select(*by, "sample_name"), by)
            key, cols = leaves.withColumnRenamed("position", "_k1"), [("_k1", False)]
        else:
            raise ValueError(f"unknown sort method: {method}")
        names = [c for c, _ in cols]
        joined = order.withColumnRenamed("position", "_was").join(
            key, [c for c in [*by, "sample_name"] if c in key.columns], "left"
        )
        if method in ("sum", "dominant"):
            fills = {c: "" if c == "_k2" else 0.0 for c in names}
            joined = joined.na.fill(fills)
        order = place(joined, by, [*cols, ("_was", False)], whole=whole).select(*by, "sample_name", "position")
    return order


def _dominant(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per sample its largest taxon (ties: later name), keyed by that taxon's maximum, its name and its value."""
    by = list(by)
    peak = df.groupBy(*by, "feature").agg(F.max("value").alias("_k1"))
    top = (
        df.groupBy(*by, "sample_name")
        .agg(F.max(F.struct("value", "feature")).alias("_m"))
        .select(*by, "sample_name", F.col("_m.feature").alias("feature"), F.col("_m.value").alias("_k3"))
    )
    return top.join(peak, [*by, "feature"]).select(
        *by, "sample_name", "_k1", F.col("feature").alias("_k2"), "_k3"
    )


def level_separators(ordered: DataFrame, level: str = "group") -> DataFrame:
    """Positions at which ``level`` differs from the sample before.

    The neighbour is found by an equi-join on the position, not by one long window.
    """
    before = ordered.select((F.col("position") + 1).alias("position"), F.col(level).alias("_prev"))
    return ordered.join(before, "position").filter(F.col(level) != F.col("_prev")).select("position", level)


def mean_variance(df: DataFrame, n_samples: Column) -> DataFrame:
    """Mean and sample variance per feature over all samples, absent cells being 0."""
    stats = df.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_nz"), F.avg("value").alias("_m"), F.var_pop("value").alias("_v")
    )
    zeros = n_samples - F.col("_nz")
    m2 = F.col("_nz") * F.col("_v") + F.col("_m") * F.col("_m") * F.col("_nz") * zeros / n_samples
    return stats.select(
        "feature",
        (F.col("_m") * F.col("_nz") / n_samples).alias("mean"),
        (m2 / (n_samples - 1)).alias("variance"),
    )


def box_stats(df: DataFrame, keys: Sequence[str], value: str = "value", whole: bool = True) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and range per key."""
    counted = value_counts(df, keys, value, whole)
    q = quantiles_of_counts(counted, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col(value) >= F.col("q1") - 1.5 * iqr) & (F.col(value) <= F.col("q3") + 1.5 * iqr)
    return counted.join(q, list(keys)).groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min(value).alias("least"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.max(value).alias("most"),
    )


def top_significant(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of the order (per-partition heads first)."""
    return df.orderBy(*order).limit(n)


def direction_counts(df: DataFrame) -> DataFrame:
    """Number of features per class; all three classes are present."""
    counts = [F.count_if(F.col("direction") == d).alias(d) for d in ("Up", "Down", "NS")]
    return df.agg(*counts).unpivot([], ["Up", "Down", "NS"], "direction", "n")


def top_variable(df: DataFrame, n_samples: Column, n: int = 1000, digits: int = 9) -> DataFrame:
    """Rows of the ``n`` features with the largest variance (ties by name)."""
    var = mean_variance(df, n_samples)
    best = var.orderBy(F.round("variance", digits).desc(), F.col("feature")).limit(n).select("feature")
    return df.join(broadcast_rows(best, n), "feature", "left_semi")


def prevalence(df: DataFrame, meta: DataFrame, by_group: bool = False) -> DataFrame:
    """Share of samples in which each feature is present, overall or per group."""
    if not by_group:
        total = meta.select(F.count(F.lit(1))).scalar()
        live = df.filter("value > 0").groupBy("feature").agg(F.count_distinct("sample_name").alias("n_present"))
        return live.withColumn("prevalence", F.col("n_present") / total)
    sizes = meta.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    live = (
        df.filter("value > 0").join(meta, "sample_name").groupBy("feature", "group")
        .agg(F.count_distinct("sample_name").alias("n_present"))
    )
    return live.join(sizes, "group").select(
        "feature", "group", "n_present", (F.col("n_present") / F.col("_n")).alias("prevalence")
    )


def cumulative_abundance(df: DataFrame, n_samples: Column, digits: int = 9) -> DataFrame:
    """Features by descending mean with the running sum of means."""
    means = df.groupBy("feature").agg(F.round(F.sum("value") / n_samples, digits).alias("mean"))
    ranked = place(means, [], [("mean", True), ("feature", False)])
    summed = running(ranked, [], "position", sums=["mean"])
    return summed.select(
        "feature", "mean", F.col("position"), (F.col("mean_before") + F.col("mean")).alias("cumulative")
    )
