"""The end-to-end analyses: each returns its result tables by name, ready to be written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.operators import (
    composition as C,
    discriminant as D,
    functional as K,
    matrix as M,
    negbinom as B,
    ordination as N,
    pairs as P,
    reads as R,
    testing as X,
)
from taxaloom.operators.trees import nested_sets
from taxaloom.session import freeze

Tables = dict[str, DataFrame]


def community(
    profiles: DataFrame, meta: DataFrame, rank: str = "SPECIES", top_n: int = 10, permutations: int = 500, base: float = 2.0
) -> Tables:
    """Composition, alpha and beta diversity of one rank.

    The renormalised table of known taxa is written once; every product reads it.
    """
    table = freeze(M.relative(freeze(M.drop_unknown(M.select_rank(profiles, rank)))))
    diversity = freeze(M.with_group(P.alpha(table, base, meta), meta))
    distances = freeze(P.bray_curtis(table, samples=meta))
    points = M.with_group(N.axes_wide(freeze(N.pcoa(distances))), meta)
    return {
        "top_by_group": C.top_n_by_group(table, meta, top_n),
        "top_overall": M.with_group(C.top_n(table, top_n), meta),
        "diversity": diversity,
        "diversity_tests": P.alpha_test(table, meta, base),
        "diversity_boxes": C.box_stats(
            M.with_group(P.alpha_long(diversity), meta), ["feature", "group"]
        ),
        "distances": distances,
        "ordination": points,
        "ellipses": N.ellipse(points),
        "permanova": P.permanova(distances, meta, permutations),
    }


def rank_difference(
    df: DataFrame, meta: DataFrame, sig_type: str = "padj", sig_thresh: float = 0.05, logfc_thresh: float = 1.0,
    label_size: int = 10, kind: str = "means",
) -> Tables:
    """Two-group rank test with fold changes, classes and the tables behind its plots."""
    df = freeze(df)
    tested = X.bh(X.rank_sum(df, meta).withColumnRenamed("p", "pvalue"), "pvalue", out="padj")
    result = freeze(X.classify(tested.join(X.log2fc(df, meta, kind), "feature"), "log2fc", sig_type, sig_thresh, logfc_thresh))
    order = ["padj", "pvalue", "feature"]
    best = C.top_significant(result, order, 1).select("feature")
    rows = C.top_significant(result, order, 30).select("feature")
    heat = M.densify(df.join(F.broadcast(rows), "feature", "left_semi"), meta)
    return {
        "result": result,
        "directions": C.direction_counts(result),
        "labels": X.labels(result, label_size, order),
        "boxes": C.box_stats(
            M.with_group(df.join(F.broadcast(best), "feature", "left_semi"), meta), ["feature", "group"]
        ),
        "heatmap": M.row_zscore(heat.withColumn("value", M.log2_pseudo("value", 1.0))),
        "bars": C.top_significant(result, order, 20).orderBy("log2fc"),
    }


def model_difference(
    df: DataFrame, meta: DataFrame, sig_type: str = "qval", sig_thresh: float = 0.05, effect_cutoff: float = 1.0,
    boxplot_num: int = 10, boxplot_pseudo: float = 1.0,
) -> Tables:
    """Linear model per feature merged with discriminant scores; star labels and boxes of the best features."""
    df = freeze(df)
    model = freeze(X.linear_model(df, meta))
    scores = freeze(D.lda_effect(df, meta, kw=1.0, threshold=0.0))
    classed = X.classify(model, "coef", sig_type, sig_thresh, effect_cutoff)
    best = C.top_significant(model.join(scores, "feature", "left"), ["qval", "feature"], boxplot_num)
    best = freeze(best.withColumn("label", X.stars(sig_type)))
    logs = df.join(best.select("feature"), "feature", "left_semi").withColumn(
        "value", M.log2_pseudo("value", boxplot_pseudo)
    )
    return {
        "result": model.join(scores, "feature", "left"),
        "directions": C.direction_counts(classed),
        "classes": classed,
        "best": best,
        "boxes": C.box_stats(M.with_group(logs, meta), ["feature", "group"]),
        "rank_labels": X.group_labels(df.join(best.select("feature"), "feature", "left_semi"), meta),
    }


def biomarkers(df: DataFrame, meta: DataFrame, top_num: int = 50, kw: float = 0.05, threshold: float = 2.0) -> Tables:
    """Discriminant scores above the threshold, and the strongest of them."""
    scores = freeze(D.lda_effect(df, meta, kw=kw, threshold=threshold))
    return {"result": scores, "top": C.top_significant(scores, [F.abs("score").desc(), "feature"], top_num)}


def expression(
    genes: DataFrame, meta: DataFrame, feature_type: str = "gene_id", sig_type: str = "padj", sig_thresh: float = 0.05,
    logfc_thresh: float = 1.0, variable: int = 1000, size_kind: str = "ratio",
) -> Tables:
    """Negative-binomial differential expression with the sample-level views of the transformed counts."""
    counts = freeze(M.drop_zero_features(M.feature_key(genes, feature_type)))
    n = X.group_size(meta)
    fitted = B.dispersions(counts, meta, factors=size_kind)
    result = freeze(B.nb_glm(counts, meta, fitted=fitted))
    factors = freeze(M.size_factors(counts, n, size_kind))
    transformed = freeze(M.norm_transform(counts, factors))
    # The stabilised value of a zero count is a constant; subtracting it keeps the table sparse. A local trend has no
    # closed form, so the logarithms stand in for it.
    stable = transformed
    if isinstance(fitted[1], tuple):
        a0, a1 = fitted[1]
        stable = M.normalised(counts, factors).withColumn(
            "value", M.vst("value", a0, a1) - M.vst(F.lit(0.0), a0, a1)
        )
    distances = freeze(P.euclidean(C.top_variable(freeze(stable), n, variable)))
    classed = X.classify(result, "log2_fold_change", sig_type, sig_thresh, logfc_thresh).na.drop(subset=["direction"])
    scores = freeze(N.pca(transformed))
    points = M.with_group(N.axes_wide(scores), meta)
    return {
        "result": result,
        "dispersions": fitted[0],
        "mean_variance": C.mean_variance(counts, n),
        "directions": C.direction_counts(classed),
        "classes": classed,
        "ma": result.select("feature", "base_mean", "log2_fold_change", "padj"),
        "pca": points,
        "pca_explained": scores.select("axis", F.round(F.col("explained") * 100, 1).alias("percent")).distinct(),
        "ellipses": N.ellipse(points, kind="robust"),
        "distances": distances,
        "distance_order": N.leaf_order(distances, "complete"),
        "correlation": P.spearman(transformed),
    }


def functional_tables(
    families: DataFrame, maps: dict[str, DataFrame], modules: DataFrame, steps: DataFrame, ko: str = "KO"
) -> Tables:
    """Regrouped, renormalised and split functional tables, KEGG module sums and gut-module scores."""
    out: Tables = {}
    for name, mapping in maps.items():
        table = freeze(M.renorm_community(K.regroup(families, mapping)))
        out[f"{name}_stratified"], out[f"{name}_unstratified"] = M.split_stratified(table)
    values = out[f"{ko}_unstratified"].select(
        "sample_name", F.col("term").alias("ko"), F.col("abundance").alias("value")
    )
    out["modules"] = K.module_sum(values, modules)
    out["gut_modules"] = K.module_steps(values, steps)
    return out


def contributions(
    terms: DataFrame, meta: DataFrame, samples: DataFrame, codes: Sequence[str], scaling: str = "logstack",
    sort: Sequence[str] = ("braycurtis",),
) -> DataFrame:
    """Stratified contributions of the focal features, samples in the order of the sort methods in turn."""
    rows = freeze(terms.select("sample_name", F.col("term").alias("feature"), F.col("abundance").alias("value")))
    return K.stratified_contributions(rows, meta, samples, codes, sort=sort, scaling=scaling)


def classification(
    assignments: DataFrame, tree: DataFrame, shares: DataFrame, levels: Sequence[str], n_unclassified: Column | None = None
) -> Tables:
    """Clade report and re-estimated abundances of classified reads."""
    sets = freeze(nested_sets(tree))
    counts = freeze(R.taxon_counts(assignments))
    report = freeze(R.clade_report(counts, tree, sets, n_unclassified))
    return {"counts": counts, "report": report, "estimates": R.reestimate(report, sets, shares, levels)}


__all__ = [
    "biomarkers", "classification", "community", "contributions", "expression", "functional_tables",
    "model_difference", "rank_difference",
]
