"""Rank and linear-model tests per feature on sparse data, and multiple-testing correction.

Zeros are never stored: they form one tie block whose size is the number of
samples less the feature's non-zeros, and enter every formula in closed form.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.functions.special import chi2_upper, normal_two_sided, rank_sum_exact, t_two_sided
from taxaloom.operators.ordered import quantiles_of_counts, running, value_counts
from taxaloom.session import freeze

TREATMENT, CONTROL = "treatment", "control"


def group_size(meta: DataFrame, group: str | None = None) -> Column:
    """Number of samples (of a group) as a scalar subquery."""
    rows = meta if group is None else meta.filter(F.col("group") == group)
    return rows.select(F.count(F.lit(1)).cast("double")).scalar()


def _by_key(rows: DataFrame, keys: Sequence[str], whole: bool) -> DataFrame:
    """Rows brought together by key once, where a task takes whole keys: the counts,
    the ranks and the sums that follow then need no further shuffle."""
    return rows.repartition(*keys) if whole else rows


def _value_groups(
    df: DataFrame, meta: DataFrame, treatment: str, control: str, keys: Sequence[str], whole: bool
) -> DataFrame:
    """Distinct non-zero values per key with the number of samples of either group holding them."""
    two = meta.filter(F.col("group").isin(treatment, control))
    return (
        _by_key(df.filter("value <> 0").join(two, "sample_name"), keys, whole)
        .groupBy(*keys, "value")
        .agg(F.count_if(F.col("group") == treatment).alias("n_t"), F.count_if(F.col("group") == control).alias("n_c"))
        .withColumn("n", F.col("n_t") + F.col("n_c"))
    )


def rank_sum(
    df: DataFrame,
    meta: DataFrame,
    treatment: str = TREATMENT,
    control: str = CONTROL,
    exact: str = "auto",
    keys: Sequence[str] = ("feature",),
    whole: bool = True,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Two-sided Mann–Whitney / Wilcoxon rank-sum test per key.

    ``exact``: ``auto`` = untied and both groups below 50; ``small`` = untied and
    the smaller group at most 8; ``never``. Otherwise the normal approximation
    with tie and continuity correction. ``u`` is the statistic of the treatment.
    A key has at most one value per sample and is ranked by one task; ``whole=False``
    cuts the values into buckets instead. ``sizes(keys, n_t, n_c)`` gives the
    group sizes of keys that not all samples have a value for.
    """
    keys = list(keys)
    n_t, n_c = group_size(meta, treatment), group_size(meta, control)
    ranked = running(_value_groups(df, meta, treatment, control, keys, whole), keys, "value", sums=["n"], whole=whole)
    mid = F.col("n_before") + (F.col("n") + 1) / 2
    n = F.col("n").cast("double")
    sums = ranked.groupBy(*keys).agg(
        F.sum("n_t").alias("_nz_t"),
        F.sum("n").alias("_nz"),
        F.sum(F.col("n_t") * mid).alias("_r"),
        F.sum(n * n * n - n).alias("_ties"),
    )
    if sizes is None:
        sums = sums.withColumn("n_t", n_t).withColumn("n_c", n_c)
    else:
        sums = sums.join(sizes.select(*keys, F.col("n_t").cast("double"), F.col("n_c").cast("double")), keys)
    total = F.col("n_t") + F.col("n_c")
    zeros = total - F.col("_nz")
    r_t = F.col("_r") + F.col("_nz_t") * zeros + (F.col("n_t") - F.col("_nz_t")) * (zeros + 1) / 2
    stats = sums.select(
        *keys,
        "n_t",
        "n_c",
        (r_t - F.col("n_t") * (F.col("n_t") + 1) / 2).alias("u"),
        (F.col("_ties") + zeros * zeros * zeros - zeros).alias("ties"),
    )
    sigma = F.sqrt(F.col("n_t") * F.col("n_c") / 12 * ((total + 1) - F.col("ties") / (total * (total - 1))))
    z = (F.abs(F.col("u") - F.col("n_t") * F.col("n_c") / 2) - 0.5) / F.nullif(sigma, F.lit(0.0))
    # A constant feature has no z, and no p-value.
    stats = stats.withColumn("z", F.when(z < 0, 0.0).otherwise(z))
    normal = normal_two_sided(F.col("z"))
    if exact == "never":
        return stats.withColumn("p", normal)
    small = (
        (F.col("n_t") < 50) & (F.col("n_c") < 50) if exact == "auto" else F.least("n_t", "n_c") <= 8
    ) & (F.col("ties") == 0)
    # The UDFs see all rows; rows of the other kind are given a trivial case.
    size = [F.when(small, F.col(c)).otherwise(1.0).cast("int") for c in ("n_t", "n_c")]
    p_exact = rank_sum_exact(F.when(small, F.col("u")).otherwise(0.0), *size)
    return stats.withColumn("p", F.when(small, p_exact).otherwise(normal))


def kruskal(df: DataFrame, meta: DataFrame, keys: Sequence[str] = ("feature",), whole: bool = True) -> DataFrame:
    """Kruskal–Wallis H with tie correction over all groups of the metadata, p from χ²."""
    keys = list(keys)
    sizes = meta.groupBy("group").agg(F.count(F.lit(1)).cast("double").alias("n_g"))
    total = group_size(meta)
    n_groups = sizes.select(F.count(F.lit(1)).cast("double")).scalar()
    cells = (
        _by_key(df.filter("value <> 0").join(meta, "sample_name"), keys, whole)
        .groupBy(*keys, "value", "group").agg(F.count(F.lit(1)).alias("k"))
    )
    values = cells.groupBy(*keys, "value").agg(
        F.sum("k").alias("n"), F.collect_list(F.struct("group", "k")).alias("cells")
    )
    ranked = running(values, keys, "value", sums=["n"], whole=whole)
    mid = (F.col("n_before") + (F.col("n") + 1) / 2).alias("mid")
    n = F.col("n").cast("double")
    tie = ranked.groupBy(*keys).agg(F.sum("n").cast("double").alias("_nz"), F.sum(n * n * n - n).alias("_ties"))
    by_group = (
        ranked.select(*keys, mid, F.inline("cells"))
        .groupBy(*keys, "group")
        .agg(F.sum("k").cast("double").alias("_k"), F.sum(F.col("k") * F.col("mid")).alias("_r"))
    )
    # A group without non-zeros still holds zeros: Σ R²/n over all groups is built
    # from the all-zero rank sums plus the change in the groups that are present.
    base = by_group.join(sizes, "group").join(tie, keys).withColumn("_n", total)
    zeros = F.col("_n") - F.col("_nz")
    zero_rank = (zeros + 1) / 2
    full = F.col("_r") + F.col("_k") * zeros + (F.col("n_g") - F.col("_k")) * zero_rank
    none = F.col("n_g") * zero_rank
    change = (full * full - none * none) / F.col("n_g")
    agg = base.groupBy(*keys).agg(
        F.sum(change).alias("_change"), F.first("_nz").alias("_nz"), F.first("_ties").alias("_ties"),
        F.first("_n").alias("_n"),
    )
    n_all = F.col("_n")
    zeros = n_all - F.col("_nz")
    squares = n_all * ((zeros + 1) / 2) * ((zeros + 1) / 2) + F.col("_change")
    ties = F.col("_ties") + zeros * zeros * zeros - zeros
    h = (12 / (n_all * (n_all + 1)) * squares - 3 * (n_all + 1)) / F.nullif(
        1 - ties / (n_all * n_all * n_all - n_all), F.lit(0.0)
    )
    return agg.select(*keys, h.alias("h"), (n_groups - 1).alias("df")).withColumn("p", chi2_upper("h", "df"))


def bh(df: DataFrame, p: str = "p", by: Sequence[str] = (), out: str = "q") -> DataFrame:
    """Benjamini–Hochberg adjusted ``out``; null p-values are left out of the count and stay null.

    Equal p-values share one row of the ordering. The input is frozen, so that
    the ordering and the rows that look it up hold identical numbers.
    """
    by = list(by)
    df = freeze(df)
    counts = df.filter(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count(F.lit(1)).alias("n"))
    ranked = running(counts, by, p, sums=["n"])
    raw = ranked.select(
        *by, p, (F.col(p) * F.col("n_total") / (F.col("n_before") + F.col("n"))).alias("_raw")
    )
    q = running(raw, by, p, later_min=["_raw"])
    adjusted = q.select(*by, p, F.least(F.lit(1.0), F.col("_raw_floor")).alias(out))
    return df.join(adjusted, [*by, p], "left").select(*df.columns, out)


def bonferroni(df: DataFrame, p: str = "p", clamp: bool = False, out: str = "adjusted") -> DataFrame:
    """p times the number of rows; not limited to 1 unless asked."""
    product = F.col(p) * df.select(F.count(F.lit(1))).scalar()
    return df.withColumn(out, F.least(product, F.lit(1.0)) if clamp else product)


def log2fc(
    df: DataFrame,
    meta: DataFrame,
    kind: str = "means",
    pseudo: float | None = None,
    treatment: str = TREATMENT,
    control: str = CONTROL,
) -> DataFrame:
    """Fold change per feature: ``means`` = log2 of the ratio of means (pseudo-count 1),
    ``logs`` = difference of mean logs (pseudo-count 1e-9). Zeros take part."""
    pseudo = pseudo if pseudo is not None else (1.0 if kind == "means" else 1e-9)
    n_t, n_c = group_size(meta, treatment), group_size(meta, control)
    x = F.col("value") if kind == "means" else F.log2(F.col("value") + pseudo)
    is_t, is_c = F.col("group") == treatment, F.col("group") == control
    sums = df.filter("value <> 0").join(meta, "sample_name").groupBy("feature").agg(
        F.sum(F.when(is_t, x).otherwise(0.0)).alias("_s_t"),
        F.sum(F.when(is_c, x).otherwise(0.0)).alias("_s_c"),
        F.count_if(is_t).alias("_z_t"),
        F.count_if(is_c).alias("_z_c"),
    ).withColumn("_n_t", n_t).withColumn("_n_c", n_c)
    if kind == "means":
        effect = F.log2((F.col("_s_t") / F.col("_n_t") + pseudo) / (F.col("_s_c") / F.col("_n_c") + pseudo))
    else:
        zero = F.log2(F.lit(pseudo))
        effect = (F.col("_s_t") + (F.col("_n_t") - F.col("_z_t")) * zero) / F.col("_n_t") - (
            F.col("_s_c") + (F.col("_n_c") - F.col("_z_c")) * zero
        ) / F.col("_n_c")
    return sums.select("feature", effect.alias("log2fc"))


def classify(df: DataFrame, effect: str, sig: str, threshold: float, cutoff: float) -> DataFrame:
    """``direction`` Up / Down / NS and ``neg_log10`` of the significance; a null significance gives null."""
    hit = (F.col(sig) < threshold) & (F.abs(F.col(effect)) > cutoff)
    direction = F.when(F.col(sig).isNull() | F.col(effect).isNull(), F.lit(None).cast("string")).otherwise(
        F.when(hit & (F.col(effect) > 0), "Up").when(hit, "Down").otherwise("NS")
    )
    return df.withColumn("direction", direction).withColumn("neg_log10", -F.log10(F.col(sig)))


def labels(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.filter(F.col("direction") != "NS").orderBy(*order).limit(n)


def stars(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < 0.001, "***").when(c < 0.01, "**").when(c < 0.05, "*").otherwise("ns")


def group_labels(df: DataFrame, meta: DataFrame, hide_ns: bool = True, **options) -> DataFrame:
    """Significance stars of the rank test per feature."""
    out = rank_sum(df, meta, **options).withColumn("label", stars("p"))
    return out.filter(F.col("label") != "ns") if hide_ns else out


def lm_prefilter(df: DataFrame, n_samples: Column, min_prevalence: float = 0.0) -> DataFrame:
    """Features seen in more than the given share of samples and not constant over the cohort."""
    stats = df.filter("value > 0").groupBy("feature").agg(
        F.count(F.lit(1)).alias("_nz"), F.min("value").alias("_a"), F.max("value").alias("_b")
    ).withColumn("_n", n_samples)
    keep = stats.filter(
        (F.col("_nz") > F.col("_n") * min_prevalence) & ((F.col("_a") < F.col("_b")) | (F.col("_nz") < F.col("_n")))
    )
    return df.join(keep.select("feature"), "feature", "left_semi")


def linear_model(
    df: DataFrame,
    meta: DataFrame,
    reference: str = CONTROL,
    treatment: str = TREATMENT,
    min_prevalence: float = 0.0,
) -> DataFrame:
    """Per-feature linear model on log2 abundance (zeros at half the feature's minimum), one binary effect.

    With ``y = log2(x) − log2(min/2)`` zeros contribute nothing, so both sums
    come from the non-zeros alone.
    """
    n_t, n_c = group_size(meta, treatment), group_size(meta, reference)
    kept = lm_prefilter(df, n_t + n_c, min_prevalence) if min_prevalence > 0 else df
    is_t = F.col("group") == treatment
    two = meta.filter(F.col("group").isin(treatment, reference))
    x = F.log2("value")
    sums = kept.filter("value > 0").join(two, "sample_name").groupBy("feature").agg(
        F.log2(F.min("value") / 2).alias("_z"),
        F.max("value").alias("_max"), F.min("value").alias("_min"),
        *[
            e
            for g, cond in (("t", is_t), ("c", ~is_t))
            for e in (
                F.count_if(cond).cast("double").alias(f"_k_{g}"),
                F.sum(F.when(cond, x).otherwise(0.0)).alias(f"_s_{g}"),
                F.sum(F.when(cond, x * x).otherwise(0.0)).alias(f"_q_{g}"),
            )
        ],
    ).withColumn("_n_t", n_t).withColumn("_n_c", n_c)
    total = F.col("_n_t") + F.col("_n_c")
    present = F.col("_k_t") + F.col("_k_c")
    sums = sums.filter((F.col("_min") < F.col("_max")) | (present < total))

    def mean(g):
        return (F.col(f"_s_{g}") - F.col(f"_k_{g}") * F.col("_z")) / F.col(f"_n_{g}")

    def squares(g):
        z = F.col("_z")
        raw = F.col(f"_q_{g}") - 2 * z * F.col(f"_s_{g}") + F.col(f"_k_{g}") * z * z
        return raw - F.col(f"_n_{g}") * mean(g) * mean(g)

    pooled = (squares("t") + squares("c")) / (total - 2)
    fit = sums.select(
        "feature",
        (mean("t") - mean("c")).alias("coef"),
        F.sqrt(F.greatest(pooled, F.lit(0.0)) * (1 / F.col("_n_t") + 1 / F.col("_n_c"))).alias("stderr"),
        total.cast("bigint").alias("n"),
        present.cast("bigint").alias("n_not_0"),
        (total - 2).alias("_df"),
    )
    fit = fit.withColumn("t", F.col("coef") / F.nullif(F.col("stderr"), F.lit(0.0)))
    fit = fit.withColumn("pval", t_two_sided("t", "_df")).drop("_df")
    return bh(fit, "pval", out="qval")


def roc(df: DataFrame, meta: DataFrame, positive: str = TREATMENT, negative: str = CONTROL,
        whole: bool = True) -> DataFrame:
    """ROC points per feature, one per distinct value as threshold (x ≥ threshold is positive)."""
    n_t, n_c = group_size(meta, positive), group_size(meta, negative)
    cells = _value_groups(df, meta, positive, negative, ["feature"], whole)
    up = running(cells, ["feature"], "value", sums=["n_t", "n_c"], whole=whole)
    points = up.select(
        "feature",
        F.col("value").alias("threshold"),
        ((F.col("n_t_total") - F.col("n_t_before")) / n_t).alias("tpr"),
        ((F.col("n_c_total") - F.col("n_c_before")) / n_c).alias("fpr"),
    )
    # Zero is a threshold of the features that some sample lacks.
    origin = cells.groupBy("feature").agg(F.sum("n").alias("_nz")).filter(F.col("_nz") < n_t + n_c).select(
        "feature", F.lit(0.0).alias("threshold"), F.lit(1.0).alias("tpr"), F.lit(1.0).alias("fpr")
    )
    return points.unionByName(origin)


def auc(df: DataFrame, meta: DataFrame, **options) -> DataFrame:
    """Area under the ROC curve = U / (n₁·n₂)."""
    return rank_sum(df, meta, exact="never", **options).select(
        "feature", (F.col("u") / (F.col("n_t") * F.col("n_c"))).alias("auc")
    )


def lowess(x: list[float], y: list[float], share: float = 0.2, rounds: int = 3) -> list[float]:
    """Robust locally weighted lines through a few points, at the points.

    A point leans on its nearest ``share`` of the points by the tricube of their
    distances; points with large residuals weigh less in each of ``rounds`` repeats.
    """
    xs, ys = np.asarray(x, float), np.asarray(y, float)
    near = max(min(len(xs), int(share * len(xs) + 1e-7)), 2)
    gaps = np.abs(xs[:, None] - xs)
    reach = np.sort(gaps, axis=1)[:, min(near, len(xs)) - 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        tricube = np.where(gaps <= 0.001 * reach[:, None], 1.0, (1 - (gaps / reach[:, None]) ** 3) ** 3)
    tricube[gaps > 0.999 * reach[:, None]] = 0
    robust, fit = np.ones(len(xs)), ys
    for step in range(rounds + 1):
        w = tricube * robust
        total = w.sum(1)
        centre = (w * xs).sum(1) / np.where(total > 0, total, 1)
        spread = (w * (xs - centre[:, None]) ** 2).sum(1) / np.where(total > 0, total, 1)
        mean = (w * ys).sum(1) / np.where(total > 0, total, 1)
        cross = (w * (xs - centre[:, None]) * ys).sum(1) / np.where(total > 0, total, 1)
        straight = np.sqrt(spread) > 0.001 * np.ptp(xs)
        slope = np.where(straight, cross / np.where(straight, spread, 1), 0)
        fit = np.where(total > 0, mean + slope * (xs - centre), ys)
        left = np.abs(ys - fit)
        scale = 6 * np.median(left)
        # Residuals of mere rounding say nothing about outliers.
        if step == rounds or scale < 1e-7 * left.mean() or scale < 1e-12 * np.abs(ys).max():
            break
        ratio = left / scale
        robust = np.where(ratio <= 0.001, 1.0, np.where(ratio <= 0.999, (1 - ratio**2) ** 2, 0.0))
    return fit.tolist()


def chosen_cut(rejections: list[int], shares: list[float], rule: str) -> int:
    """Place of the cut-off: ``most`` takes the first one with most rejections.

    ``smoothed`` takes the first one whose rejections exceed the smoothed curve's
    maximum less one residual deviation, and the lowest where no cut-off has more
    than ten.
    """
    if rule == "most":
        return rejections.index(max(rejections))
    if max(rejections) <= 10:
        return 0
    curve = lowess(shares, rejections)
    left = [r - c for r, c in zip(rejections, curve, strict=True) if r > 0]
    limit = max(curve) - math.sqrt(sum(d * d for d in left) / len(left))
    return next((i for i, r in enumerate(rejections) if r > limit), 0)


def independent_filter(
    df: DataFrame, p: str = "pvalue", mean: str = "base_mean", alpha: float = 0.1, points: int = 50, rule: str = "most"
) -> DataFrame:
    """BH after dropping features of low mean; the cut-off is a mean quantile that the rejections choose (:func:`chosen_cut`).

    All cut-offs are judged in one pass: features that pass a cut-off pass all
    lower ones, so each distinct p-value has one count per cut-off, and running
    totals of these counts give the rejections. No feature is copied.
    """
    df = freeze(df)
    low = F.try_divide(F.count_if(F.col(mean) == 0), F.count(F.lit(1)))
    # The grid starts at the share of all-zero features, known only at run time.
    lowest = df.select(low.alias("lo")).first()["lo"] or 0.0
    upper = 0.95 if lowest < 0.95 else 1.0
    shares = [lowest + (upper - lowest) * i / (points - 1) for i in range(points)]
    counted = freeze(value_counts(df.withColumn("_k", F.lit(0)), ["_k"], mean))
    names = {f"q{i}": s for i, s in enumerate(shares)}
    picks = quantiles_of_counts(counted, ["_k"], mean, names).first()
    if picks is None:
        return bh(df.withColumn("_p", F.col(p)), "_p", out="padj").drop("_p")
    cuts = [picks[n] for n in names]
    passed = [F.count_if(F.col(mean) >= c).alias(f"c{i}") for i, c in enumerate(cuts)]
    counts = df.filter(F.col(p).isNotNull()).groupBy(F.col(p).alias("_p")).agg(*passed)
    ranked = running(counts, [], "_p", sums=[f"c{i}" for i in range(points)])
    found = ranked.agg(*[
        F.max(F.when(
            (F.col(f"c{i}") > 0) & (F.col("_p") * F.col(f"c{i}_total") / (F.col(f"c{i}_before") + F.col(f"c{i}")) < alpha),
            F.col(f"c{i}_before") + F.col(f"c{i}"),
        )) for i in range(points)
    ]).first()
    best = cuts[chosen_cut([r or 0 for r in found], shares, rule)]
    used = df.withColumn("_p", F.when(F.col(mean) >= best, F.col(p)))
    return bh(used, "_p", out="padj").drop("_p")
