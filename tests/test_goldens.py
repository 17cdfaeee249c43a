"""Hand-computed values on the toy cohort."""

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import composition as C, matrix as M, pairs as P, reads as R, testing as X

GROUPS = dict(treatment="North", control="South")


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_rank_sum(toy, toy_meta):
    out = X.bh(X.rank_sum(toy, toy_meta, **GROUPS)).collect()
    got = {r["feature"]: (r["u"], r["ties"], round(r["p"], 6), round(r["q"], 6)) for r in out}
    assert got == {
        "Quill": (9.0, 0.0, 0.1, 0.4),
        "Marl": (6.0, 0.0, 0.7, 0.7),
        "Tansy": (2.5, 12.0, 0.500184, 0.7),
        "Reed": (3.0, 12.0, 0.653095, 0.7),
    }
    normal = by(X.rank_sum(toy, toy_meta, exact="never", **GROUPS), "feature", "p")
    assert normal["Quill"] == pytest.approx(0.080856, abs=1e-6)


def test_rank_sum_in_buckets(toy, toy_meta):
    got = by(X.bh(X.rank_sum(toy, toy_meta, whole=False, **GROUPS)), "feature", "q")
    assert {k: round(v, 6) for k, v in got.items()} == {"Quill": 0.4, "Marl": 0.7, "Tansy": 0.7, "Reed": 0.7}


def test_kruskal(toy, toy_meta):
    h = by(X.kruskal(toy, toy_meta), "feature", "h")
    assert {k: round(v, 6) for k, v in h.items()} == {
        "Quill": 3.857143, "Marl": 0.428571, "Tansy": 0.808081, "Reed": 0.454545
    }


def test_fold_changes(toy, toy_meta):
    means = by(X.log2fc(toy, toy_meta, "means", **GROUPS), "feature", "log2fc")
    logs = by(X.log2fc(toy, toy_meta, "logs", **GROUPS), "feature", "log2fc")
    names = ["Quill", "Marl", "Tansy", "Reed"]
    assert [round(means[c], 6) for c in names] == [2.938599, 0.229482, -2.08092, -0.874469]
    assert [round(logs[c], 6) for c in names] == [12.991389, 11.686951, -1.421011, -0.861654]


def test_alpha(toy, toy_meta):
    rows = {r["sample_name"]: r for r in P.alpha(toy, samples=toy_meta).collect()}
    full = ("T1", "T2", "T3", "T4", "T5")
    assert [round(rows[s]["shannon"], 6) for s in full] == [1.484684, 1.545153, 0.99176, 1.379114, 0.826902]
    assert [round(rows[s]["simpson"], 6) for s in full] == [0.559172, 0.648526, 0.395, 0.537775, 0.289062]
    assert [round(rows[s]["pielou_e"], 6) for s in full] == [0.742342, 0.974883, 0.625731, 0.689557, 0.413451]
    assert [rows[s]["species_richness"] for s in (*full, "T6")] == [4, 3, 3, 4, 4, 0]
    assert [rows[s]["chao1"] for s in (*full, "T6")] == [4, 3, 3, 4, 5, 0]
    assert rows["T6"]["shannon"] is rows["T6"]["pielou_e"] is None


def test_alpha_test_leaves_missing_metrics_out(toy, toy_meta):
    got = {r["feature"]: (r["n_t"], r["n_c"], r["u"], round(r["p"], 6)) for r in P.alpha_test(toy, toy_meta, **GROUPS).collect()}
    assert got["pielou_e"] == (3, 2, 5.0, 0.4)
    assert got["species_richness"][:2] == (3, 3)


DISTANCES = {
    "T1T2": 0.319149, "T1T3": 0.606061, "T1T4": 0.283582, "T1T5": 0.783784, "T2T3": 0.47541, "T2T4": 0.548387,
    "T2T5": 0.797101, "T3T4": 0.703704, "T3T5": 0.909091, "T4T5": 0.640449,
}


@pytest.mark.parametrize("blocks", [{}, {"sample_block": 1, "feature_chunk": 1}])
def test_bray_curtis_and_permanova(spark, toy, toy_meta, blocks):
    d = P.bray_curtis(toy, samples=toy_meta, **blocks)
    got = {r["s1"] + r["s2"]: round(r["d"], 6) for r in d.collect()}
    assert got == DISTANCES | {f"T{i}T6": 1.0 for i in range(1, 6)}
    one = P.permanova(d, toy_meta, permutations=20, sample_block=2).first()
    assert [round(one[c], 6) for c in ("sst", "ssw", "f")] == [1.509639, 1.035118, 1.833687]
    assert 0 < one["p"] <= 1
    plain = P.bray_curtis(toy, **blocks)
    assert {r["s1"] + r["s2"]: round(r["d"], 6) for r in plain.collect()} == DISTANCES
    with pytest.raises(ValueError, match="1 samples"):
        P.permanova(plain, toy_meta)
    kept = P.permanova(plain, toy_meta, permutations=20, unmatched="drop").first()
    sst = sum(v * v for v in DISTANCES.values()) / 5
    ssw = (0.319149**2 + 0.606061**2 + 0.47541**2) / 3 + 0.640449**2 / 2
    assert kept["f"] == pytest.approx((sst - ssw) / (ssw / 3), rel=1e-4)


def test_two_empty_samples_are_equal(spark, toy):
    names = spark.createDataFrame([("T1",), ("x",), ("y",)], "sample_name string")
    got = {r["s1"] + r["s2"]: r["d"] for r in P.bray_curtis(toy.filter("sample_name = 'T1'"), samples=names).collect()}
    assert got == {"T1x": 1.0, "T1y": 1.0, "xy": 0.0}
    e = {r["s1"] + r["s2"]: r["d"] for r in P.euclidean(toy.filter("sample_name = 'T1'"), samples=names).collect()}
    assert e["xy"] == 0 and e["T1x"] == pytest.approx((16 + 256 + 25 + 1) ** 0.5)
    r = P.spearman(toy.filter("sample_name = 'T1'"), samples=names).collect()
    assert len(r) == 3 and all(x["r"] is None for x in r)


def test_size_factors_need_a_common_feature(spark, toy):
    n = F.lit(6.0)
    with pytest.raises(Exception, match="no feature is counted in every sample"):
        M.size_factors(toy, n).collect()
    got = by(M.size_factors(toy, F.lit(5.0), "poscounts"), "sample_name", "size_factor")
    import numpy as np

    x = np.array([[4, 9, 30, 2, 1], [16, 7, 8, 25, 1], [5, 5, 0, 12, 40], [1, 0, 2, 2, 6]], float)
    with np.errstate(divide="ignore"):
        means = np.where(x > 0, np.log(x), 0).sum(1) / 5
        f = np.array([np.median((np.log(c) - means)[c > 0]) for c in x.T])
    assert [got[f"T{i}"] for i in range(1, 6)] == pytest.approx(np.exp(f - f.mean()))


def test_roc_has_one_point_per_value(spark, toy, toy_meta):
    points = X.roc(toy, toy_meta, "North", "South").filter("feature = 'Quill'").collect()
    assert sorted(r["threshold"] for r in points) == [0, 1, 2, 4, 9, 30]
    full = spark.createDataFrame([(f"T{i}", "f", float(i)) for i in range(1, 7)], "sample_name string, feature string, value double")
    assert sorted(r["threshold"] for r in X.roc(full, toy_meta, "North", "South").collect()) == [1, 2, 3, 4, 5, 6]


def test_disjoint_samples_are_kept(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("b", "y", 2.0), ("c", "x", 3.0)], "sample_name string, feature string, value double"
    )
    got = {r["s1"] + r["s2"]: r["d"] for r in P.bray_curtis(df, feature_chunk=1, sample_block=1).collect()}
    assert got == {"ab": 1.0, "ac": 0.5, "bc": 1.0}


def test_all_tied_feature_has_no_p(spark, toy_meta):
    df = spark.createDataFrame([(f"T{i}", "f", 5.0) for i in range(1, 7)], "sample_name string, feature string, value double")
    row = X.rank_sum(df, toy_meta, **GROUPS).first()
    assert row["p"] is None and row["u"] == 4.5


def test_bonferroni_is_not_clamped(spark):
    df = spark.createDataFrame([(0.6,), (0.9,)], "p double")
    assert sorted(r["adjusted"] for r in X.bonferroni(df).collect()) == [1.2, 1.8]
    assert sorted(r["adjusted"] for r in X.bonferroni(df, clamp=True).collect()) == [1.0, 1.0]


def test_bh_skips_nulls_and_is_monotone(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.01, 0.04, 0.03, None, 0.5, 0.5])], "i int, p double")
    q = [r["q"] for r in X.bh(df).orderBy("i").collect()]
    assert q[3] is None
    assert [round(v, 6) for v in q if v is not None] == [0.05, 0.066667, 0.066667, 0.5, 0.5]


def test_direction_counts_keep_empty_classes(spark):
    df = spark.createDataFrame([(0.001, 2.0), (0.5, 2.0), (None, 1.0)], "p double, e double")
    counts = by(C.direction_counts(X.classify(df, "e", "p", 0.05, 1.0)), "direction", "n")
    assert counts == {"Up": 1, "Down": 0, "NS": 1}


def test_linear_model(toy, toy_meta):
    out = X.linear_model(toy, toy_meta, reference="South", treatment="North").filter(F.col("feature") == "Quill").first()
    import math

    # The zero counts as half the minimum.
    a, b = [2.0, math.log2(9), math.log2(30)], [1.0, 0.0, -1.0]
    coef = sum(a) / 3 - sum(b) / 3
    pooled = (sum((x - sum(a) / 3) ** 2 for x in a) + sum((x - sum(b) / 3) ** 2 for x in b)) / 4
    error = math.sqrt(pooled * 2 / 3)
    assert out["coef"] == pytest.approx(coef) and out["stderr"] == pytest.approx(error)
    # Student's t with four degrees of freedom in closed form.
    t = abs(coef / error)
    y = t / math.sqrt(4 + t * t)
    assert out["pval"] == pytest.approx(1 - y * (3 - y * y) / 2, rel=1e-9)
    assert (out["n"], out["n_not_0"]) == (6, 5)
