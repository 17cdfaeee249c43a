"""Reshaping between the long model and wide matrices, and selection of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from taxaloom.functions import lineage as L
from taxaloom.operators.ordered import quantiles, running
from taxaloom.session import freeze


# -- lineage selections ------------------------------------------------------

def annotate(df: DataFrame, clean_names: bool = True) -> DataFrame:
    """Add ``taxonomy``, ``rank`` and - when tax paths are present - ``tax_id``."""
    last = L.last_level("clade_name")
    out = df.select("*", (L.clean_name(last) if clean_names else last).alias("taxonomy"),
                    L.rank_by_prefix(last).alias("rank"))
    return out.withColumn("tax_id", L.last_level("ncbi_tax_id")) if "ncbi_tax_id" in df.columns else out


def select_rank(
    df: DataFrame, rank: str, method: str = "prefix", clean_names: bool = True, value: str = "relative_abundance"
) -> DataFrame:
    """Rows of one rank as ``(sample_name, feature, value)``; equal names of a sample are summed."""
    last = L.last_level("clade_name")
    row_rank = L.rank_by_prefix(last) if method == "prefix" else L.rank_by_depth("clade_name")
    name = L.clean_name(last) if clean_names else last
    return (
        df.filter(row_rank == rank)
        .groupBy("sample_name", name.alias("feature"))
        .agg(F.sum(value).alias("value"))
    )


def drop_unknown(df: DataFrame, pattern: str = L.UNKNOWN_TAXA, column: str = "feature") -> DataFrame:
    return df.filter(~F.col(column).rlike(pattern))


def drop_strains(df: DataFrame, column: str = "clade_name") -> DataFrame:
    return df.filter(~F.col(column).contains("t__"))


def unstratified(df: DataFrame, column: str = "term") -> DataFrame:
    return df.filter(~L.is_stratified(column))


def focal_rows(df: DataFrame, codes: Sequence[str] | None, exclude_unclassified: bool = False) -> DataFrame:
    """Stratified rows of the focal codes as ``(code, name, sample_name, stratum, value)``; no codes = all."""
    parts = df.select("sample_name", L.split_feature("feature").alias("_p"), "value").select(
        "_p.code", "_p.name", "sample_name", "_p.stratum", "value"
    )
    keep = F.col("stratum").isNotNull()
    if codes is not None:
        keep = keep & F.col("code").isin(list(codes))
    if exclude_unclassified:
        keep = keep & (F.col("stratum") != L.UNCLASSIFIED)
    return parts.filter(keep)


def drop_zero_features(df: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    live = df.groupBy(feature).agg(F.sum(value).alias("_s")).filter("_s > 0").select(feature)
    return df.join(live, feature, "left_semi")


def feature_key(df: DataFrame, kind: str) -> DataFrame:
    """Gene counts keyed by ``gene_id``, or by the made-unique ``gene_name`` without placeholders."""
    if kind == "gene_id":
        return df.select("sample_name", F.col("gene_id").alias("feature"), F.col("count").alias("value"))
    names = make_unique(df.filter(F.col("gene_name") != "-").select("gene_id", "gene_name").distinct())
    return df.join(names, ["gene_id", "gene_name"]).select(
        "sample_name", F.col("unique_name").alias("feature"), F.col("count").alias("value")
    )


def make_unique(df: DataFrame, name: str = "gene_name", order: str = "gene_id") -> DataFrame:
    """Add ``unique_name``: repeats of a name get ``.1``, ``.2``, … in ``order``.

    Occurrences are counted with the distributed running total, since one name
    may be shared by a large part of the rows. ``order`` must be unique.
    """
    placed = running(df.withColumn("_one", F.lit(1).cast("bigint")), [name], order, sums=["_one"])
    n = F.col("_one_before")
    return placed.select(
        *df.columns,
        F.when(n == 0, F.col(name)).otherwise(F.concat_ws(".", F.col(name), n.cast("string"))).alias("unique_name"),
    )


def duplicate_samples(samples: DataFrame) -> DataFrame:
    return samples.groupBy("sample_name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def sample_agreement(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Samples found on one side only: ``(sample_name, missing_in)``."""
    data = df.select("sample_name").distinct()
    names = meta.select("sample_name").distinct()
    return (
        data.join(names, "sample_name", "left_anti").withColumn("missing_in", F.lit("metadata"))
        .unionByName(names.join(data, "sample_name", "left_anti").withColumn("missing_in", F.lit("data")))
    )


def drop_undefined(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


# -- joins -------------------------------------------------------------------

def with_group(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Inner join with the metadata; Spark broadcasts it only below its size threshold."""
    return df.join(meta, "sample_name")


def lookup_zero(df: DataFrame, table: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Left look-up of ``value``; unknown keys give 0."""
    return df.join(table, list(key), "left").withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))


def gather(df: DataFrame, key: str, item: str) -> DataFrame:
    """Items of a key as one sorted list (file lists: a handful per sample)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias(item))


# -- reshape -----------------------------------------------------------------

def merge_samples(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (keys, sample): the long form of an N-way outer merge; duplicates are summed."""
    return df.groupBy(*keys, "sample_name").agg(F.sum(value).alias(value))


def to_wide(df: DataFrame, samples: Sequence[str], keys: Sequence[str] = ("feature",), value: str = "value") -> DataFrame:
    """Matrix with one column per listed sample and 0 for absent cells, in the order of the list."""
    wide = df.groupBy(*keys).pivot("sample_name", list(samples)).agg(F.sum(value))
    return wide.na.fill(0, list(samples)).select(*keys, *[F.col(f"`{s}`") for s in samples])


def to_long(wide: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Non-zero cells of a matrix as rows."""
    cols = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), cols, "sample_name", "value").filter("value <> 0")


def transpose(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Samples as rows, the listed features as columns."""
    wide = df.groupBy("sample_name").pivot("feature", list(features)).agg(F.sum("value"))
    return wide.na.fill(0, list(features))


def densify(df: DataFrame, samples: DataFrame, features: DataFrame | None = None, block: int = 1024) -> DataFrame:
    """Zeros made explicit for the given samples (and features; else those of the table).

    The output is features × samples by definition; the statistics here use
    sparse formulas instead. A feature is paired with blocks of sample names, so
    neither side is replicated whole, and meets its own rows as one list per
    block: what is exchanged grows with the rows of ``df`` and the blocks, and
    the zeros are made where they are written. Rows of other samples go there too.
    """
    df = freeze(df.select("sample_name", "feature", "value"))
    named = samples.select("sample_name").distinct()
    n_blocks = named.count() // block + 1
    part = F.pmod(F.xxhash64("sample_name"), F.lit(n_blocks)).cast("int").alias("_b")
    lists = freeze(named.groupBy(part).agg(F.collect_list("sample_name").alias("_names")))
    names = df.select("feature").distinct() if features is None else features.select("feature").distinct()
    held = (
        df.filter("sample_name IS NOT NULL").na.fill(0, ["value"]).select("feature", part, "sample_name", "value")
        .groupBy("feature", "_b").agg(F.collect_list(F.struct("sample_name", "value")).alias("_held"))
    )
    grid = names.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    zero = F.lit(0).cast(df.schema["value"].dataType)
    none = F.array().cast(held.schema["_held"].dataType)
    holders = F.transform(F.col("_held"), lambda e: e["sample_name"])
    # Names are searched only where a row is of another sample.
    all_known = F.size(F.array_distinct(holders)) == F.size("_names") - F.size("_rest")
    named_only = F.filter("_held", lambda e: F.array_contains("_names", e["sample_name"]))
    known = F.when(all_known, F.col("_held")).otherwise(named_only)
    rest = F.transform("_rest", lambda name: F.struct(name.alias("sample_name"), zero.alias("value")))
    return (
        grid.join(held, ["feature", "_b"], "left").withColumn("_held", F.coalesce("_held", none))
        .join(lists, "_b").withColumn("_rest", F.array_except("_names", holders))
        .select("feature", F.inline(F.concat(known, rest)))
    )


# -- normalisation -----------------------------------------------------------

def _with_total(df: DataFrame, total: Column, key: str = "sample_name", bucketed: bool = False) -> DataFrame:
    """Rows with ``_total`` of their sample: aggregate and join, so no sample sits in one task.

    The totals, one row per sample, are written first: with their size known the
    planner broadcasts them if they are small, and the large table is not shuffled.
    A table ``bucketed`` by the key is summed and joined where its buckets are.
    """
    totals = df.groupBy(key).agg(total.alias("_total"))
    return df.join(totals if bucketed else freeze(totals), key)


def relative(df: DataFrame, scale: float = 100.0, value: str = "value", bucketed: bool = False) -> DataFrame:
    """Values scaled to a common sum per sample (100 = percent, 1e6 = per million); empty samples give 0.

    ``bucketed``: the table is bucketed by sample, so nothing is exchanged.
    """
    share = F.coalesce(F.col(value) / F.nullif(F.col("_total"), F.lit(0.0)), F.lit(0.0)) * F.lit(scale)
    return _with_total(df, F.sum(value), bucketed=bucketed).withColumn(value, share).drop("_total")


def renorm_community(
    df: DataFrame, special: Sequence[str] = ("UNMAPPED", "UNINTEGRATED", "UNGROUPED"), value: str = "abundance"
) -> DataFrame:
    """All rows over the sample's sum of *unstratified* rows; special rows are dropped."""
    base = F.get(L.levels("term"), F.lit(0))
    kept = df.filter(~base.isin(list(special)))
    total = F.sum(F.when(~L.is_stratified("term"), F.col(value)))
    share = F.coalesce(F.col(value) / F.nullif(F.col("_total"), F.lit(0.0)), F.lit(0.0))
    return _with_total(kept, total).withColumn(value, share).drop("_total")


def split_stratified(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(stratified, unstratified)`` parts of a functional table."""
    return df.filter(L.is_stratified("term")), df.filter(~L.is_stratified("term"))


def log2_pseudo(c: Column | str, pseudo: float) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.log2(c + F.lit(pseudo))


def log_half_min(df: DataFrame) -> DataFrame:
    """``log_value`` of the non-zeros and ``log_zero``, what a zero of the feature counts as."""
    least = df.filter("value > 0").groupBy("feature").agg(F.min("value").alias("_min"))
    return (
        df.filter("value > 0").join(least, "feature")
        .select("sample_name", "feature", "value", F.log2("value").alias("log_value"),
                F.log2(F.col("_min") / 2).alias("log_zero"))
    )


def row_zscore(df: DataFrame) -> DataFrame:
    """Row z-scores of a *dense* table over the cohort; constant features give null."""
    stats = df.groupBy("feature").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_sd"))
    return df.join(stats, "feature").withColumn(
        "value", (F.col("value") - F.col("_m")) / F.nullif(F.col("_sd"), F.lit(0.0))
    ).drop("_m", "_sd")


def size_factors(df: DataFrame, n_samples: Column, kind: str = "ratio") -> DataFrame:
    """Median of ratios to the features' geometric means: ``(sample_name, size_factor)`` of every sample of ``df``.

    ``ratio`` uses the features counted in every sample, and ends with an error
    where there is none. ``poscounts`` takes the n-th root of the product of a
    feature's positive counts as its mean, the median over a sample's positive
    counts, and scales the factors to a geometric mean of 1.
    """
    live = df.filter("value > 0")
    gene = live.groupBy("feature").agg(F.sum(F.ln("value")).alias("_l"), F.count(F.lit(1)).alias("_n"))
    gene = gene.withColumn("_lgm", F.col("_l") / n_samples)
    used = gene if kind == "poscounts" else gene.filter(F.col("_n") == n_samples)
    ratio = live.join(used.select("feature", "_lgm"), "feature").select("sample_name", (F.ln("value") - F.col("_lgm")).alias("_r"))
    medians = quantiles(ratio, ["sample_name"], "_r", {"_m": 0.5})
    if kind == "poscounts":
        mean = medians.select(F.avg("_m")).scalar()
        return medians.select("sample_name", F.exp(F.col("_m") - mean).alias("size_factor"))
    none = F.raise_error(F.lit("no feature is counted in every sample; kind='poscounts' does without"))
    return df.select("sample_name").distinct().join(medians, "sample_name", "left").select(
        "sample_name", F.coalesce(F.exp("_m"), none.cast("double")).alias("size_factor")
    )


def normalised(df: DataFrame, factors: DataFrame) -> DataFrame:
    return df.join(factors, "sample_name").withColumn("value", F.col("value") / F.col("size_factor")).drop("size_factor")


def norm_transform(df: DataFrame, factors: DataFrame) -> DataFrame:
    """``log2(count / size factor + 1)``; zeros stay 0, so the result is sparse too."""
    return normalised(df, factors).withColumn("value", log2_pseudo("value", 1.0))


def vst(c: Column | str, a0: Column | float, a1: Column | float) -> Column:
    """Variance-stabilising transform for the dispersion trend ``a1/μ + a0``; c is a normalised count."""
    c = F.col(c) if isinstance(c, str) else c
    a0 = F.lit(a0) if isinstance(a0, float) else a0
    a1 = F.lit(a1) if isinstance(a1, float) else a1
    inner = (1 + a1 + 2 * a0 * c + 2 * F.sqrt(a0 * c * (1 + a1 + a0 * c))) / (4 * a0)
    return F.ln(inner) / F.ln(F.lit(2.0))


def stack_scale(
    df: DataFrame, mode: str, by: Sequence[str] = (), floor_column: str | None = None, share_column: str | None = None
) -> DataFrame:
    """Display heights of stacked bars: ``original``, ``totalsum`` shares or ``logstack``.

    ``floor_column`` names a column for the level the bars stand on: the floor in
    ``logstack``, else 0.

    ``share_column`` names one for the share of the sample's sum, in ``logstack``.

    In ``logstack`` the bar top is log10 of the sample sum above the floor of the
    smallest non-zero sum (per ``by``), shared out by relative contribution.
    """
    by = list(by)
    level = [] if floor_column is None else [floor_column]
    if mode != "logstack" and level:
        df = df.withColumn(floor_column, F.lit(0.0))
    if mode == "original":
        return df.withColumn("height", F.col("value"))
    sums = df.groupBy(*by, "sample_name").agg(F.sum("value").alias("_sum")).filter("_sum > 0")
    if mode == "totalsum":
        scaled = df.join(sums, [*by, "sample_name"], "left")
        return scaled.withColumn("height", F.coalesce(F.col("value") / F.col("_sum"), F.lit(0.0))).drop("_sum")
    floor = F.floor(F.log10(F.min("_sum"))).cast("double").alias("_floor")
    if by:
        tops = sums.join(sums.groupBy(*by).agg(floor), by)
    else:
        tops = sums.withColumn("_floor", sums.select(floor).scalar())
    tops = tops.withColumn("_h", F.greatest(F.log10("_sum"), F.col("_floor")) - F.col("_floor"))
    out = df.join(tops, [*by, "sample_name"], "left")
    out = out.withColumn("height", F.coalesce(F.col("value") / F.col("_sum") * F.col("_h"), F.lit(0.0)))
    for c in level:
        out = out.withColumn(c, F.col("_floor"))
    if share_column is not None:
        out = out.withColumn(share_column, F.coalesce(F.col("value") / F.col("_sum"), F.lit(0.0)))
    return out.drop("_sum", "_floor", "_h")


def stack_bases(df: DataFrame, position: str, by: Sequence[str] = (), floor_column: str | None = None) -> DataFrame:
    """``base`` of each bar segment: the heights below it, above the level of ``floor_column``.

    A stack has at most top-n + 2 segments.
    """
    below = W.partitionBy(*by, "sample_name").orderBy(position).rowsBetween(W.unboundedPreceding, -1)
    base = F.coalesce(F.sum("height").over(below), F.lit(0.0))
    return df.withColumn("base", base if floor_column is None else base + F.col(floor_column))
