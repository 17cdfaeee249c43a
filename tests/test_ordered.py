"""Orderings, by whole keys and in buckets, agree with plain sorting."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from taxaloom.operators import ordered as O, testing as X


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows and one value shared by a third of them."""
    rng = np.random.default_rng(3)
    key = np.where(rng.random(600) < 0.7, "hot", rng.choice(["a", "b"], 600))
    value = np.where(rng.random(600) < 0.33, 1.5, rng.normal(size=600).round(2))
    return pd.DataFrame({"k": key, "i": range(600), "v": value})


def check_ranks(spark, pdf, whole):
    df = spark.createDataFrame(pdf)
    got = df.join(O.average_rank(df, ["k"], "v", whole), ["k", "v"]).orderBy("i").toPandas()
    want = pdf.groupby("k")["v"].rank().to_numpy()
    assert np.allclose(got["rank"], want)


@pytest.mark.parametrize("whole", [True, False])
def test_average_rank(spark, skewed, whole):
    check_ranks(spark, skewed, whole)


def test_place(spark, skewed):
    pdf, df = skewed, spark.createDataFrame(skewed)
    got = O.place(df, [], [("k", True), ("v", False), ("i", True)]).orderBy("position")
    want = pdf.sort_values(["k", "v", "i"], ascending=[False, True, False])["i"].tolist()
    rows = got.collect()
    assert [r["i"] for r in rows] == want
    assert [r["position"] for r in rows] == list(range(len(pdf)))


def test_place_within_keys(spark, skewed):
    df = spark.createDataFrame(skewed)
    order = [("v", False), ("i", True)]
    a, b = (O.place(df, ["k"], order, whole).orderBy("i").toPandas() for whole in (True, False))
    assert a["position"].tolist() == b["position"].tolist()


@pytest.mark.parametrize("whole", [True, False])
def test_quantiles(spark, skewed, whole):
    got = O.quantiles(spark.createDataFrame(skewed), ["k"], "v", {"q1": 0.25, "m": 0.5, "x": 0.9}, whole).toPandas()
    want = skewed.groupby("k")["v"].quantile([0.25, 0.5, 0.9]).unstack()
    got = got.set_index("k").sort_index()
    assert np.allclose(got[["q1", "m", "x"]].to_numpy(), want.to_numpy())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1), min_size=1, max_size=30))
def test_bh_properties(spark, ps):
    df = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    q = [r["q"] for r in X.bh(df).orderBy("i").collect()]
    m = len(ps)
    ranked = sorted(range(m), key=lambda i: ps[i])
    want, low = [0.0] * m, 1.0
    for place in range(m, 0, -1):
        i = ranked[place - 1]
        low = min(low, ps[i] * m / place)
        want[i] = low
    assert np.allclose(q, want)
    assert all(a >= b - 1e-15 for a, b in zip(q, ps))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4), min_size=6, max_size=14))
def test_rank_sum_is_symmetric(spark, values):
    half = len(values) // 2
    meta = spark.createDataFrame(
        [(f"s{i}", "treatment" if i < half else "control") for i in range(len(values))], "sample_name string, group string"
    )
    rows = [(f"s{i}", "f", float(v)) for i, v in enumerate(values) if v]
    if not rows:
        return
    df = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    one = X.rank_sum(df, meta, exact="never").first()
    two = X.rank_sum(df, meta, treatment="control", control="treatment", exact="never").first()
    assert one["u"] + two["u"] == half * (len(values) - half)
    assert one["p"] == two["p"]
    ranks = pd.Series(values).rank()
    assert one["u"] == ranks[:half].sum() - half * (half + 1) / 2


def test_independent_filter(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"feature": [f"f{i}" for i in range(80)], "base_mean": rng.gamma(1, 50, 80), "pvalue": rng.random(80)})
    pdf.loc[pdf["base_mean"] > 60, "pvalue"] *= 0.01
    out = X.independent_filter(spark.createDataFrame(pdf)).toPandas()

    def adjusted(p):
        order = np.argsort(p)
        q = np.minimum.accumulate((p[order] * len(p) / np.arange(1, len(p) + 1))[::-1])[::-1]
        back = np.empty(len(p))
        back[order] = np.minimum(q, 1)
        return back

    low = (pdf["base_mean"] == 0).mean()
    cuts = [np.quantile(pdf["base_mean"], t) for t in np.linspace(low, 0.95, 50)]
    hits = [int((adjusted(pdf.loc[pdf["base_mean"] >= c, "pvalue"].to_numpy()) < 0.1).sum()) for c in cuts]
    best = cuts[int(np.argmax(hits))]
    kept = pdf["base_mean"] >= best
    merged = pdf.merge(out[["feature", "padj"]], on="feature")
    assert merged.loc[~kept, "padj"].isna().all()
    assert np.allclose(merged.loc[kept, "padj"], adjusted(pdf.loc[kept, "pvalue"].to_numpy()))


def test_text_order_is_kept_in_buckets(spark):
    words = ["b", "ab", "a", "éa", "zz", "abc", "abcd", "Z", "0"]
    df = spark.createDataFrame([(w,) for w in words], "w string").withColumn("one", F.lit(1).cast("bigint"))
    got = [r["w"] for r in O.running(df, [], "w", sums=["one"]).orderBy("one_before").collect()]
    assert got == sorted(words, key=lambda w: w.encode())


def test_many_buckets_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(O, "SPREAD", 225)
    pdf = pd.DataFrame({"v": np.random.default_rng(7).gamma(0.3, 10, 3000)})
    df = O.value_bucket(spark.createDataFrame(pdf), "v")
    got = df.orderBy("v").toPandas()
    assert got["_bucket"].is_monotonic_increasing
    assert got["_bucket"].max() <= 900 and got["_bucket"].value_counts().max() < 30


def test_staged_tables_can_be_dropped(spark):
    from taxaloom import session

    session.freeze(spark.range(3))
    session.clear_staging(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(session.staging_root(spark) + "/*")


def test_texts_with_a_common_start_spread_over_buckets(spark):
    df = spark.range(4000).select(F.concat(F.lit("SRR00"), F.lpad("id", 6, "0")).alias("w"))
    got = O.value_bucket(df, "w").orderBy("w").toPandas()
    assert got["_bucket"].is_monotonic_increasing and got["_bucket"].nunique() > 8
