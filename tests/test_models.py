"""Iterative operators against dense solutions and brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from taxaloom.operators import discriminant as D, negbinom as B, ordination as N, pairs as P


def long_table(spark, x, names):
    rows = [(names[i], f"f{j:02d}", float(x[i, j])) for i in range(x.shape[0]) for j in range(x.shape[1]) if x[i, j] > 0]
    return spark.createDataFrame(rows, "sample_name string, feature string, value double")


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(1)
    x = rng.poisson(3, size=(14, 9)).astype(float)
    x[:7, 0] += 6
    names = [f"s{i:02d}" for i in range(14)]
    meta = spark.createDataFrame(
        [(n, "treatment" if i < 7 else "control") for i, n in enumerate(names)], "sample_name string, group string"
    )
    return x, names, long_table(spark, x, names), meta


def test_lda_against_dense_solves(cohort):
    """The mean replicate score, every replicate solved as one dense system."""
    x, names, df, meta = cohort
    boots = 3
    picks = {r.sample_name: r.picks for r in D.draw_samples(meta, boots, 1234).collect()}
    m = x / x.sum(1, keepdims=True) * 1e6
    treated = np.arange(14) < 7
    sd = np.sqrt((m[treated].var(0) * 7 + m[~treated].var(0) * 7) / 12)
    scaled, score = m / sd, np.zeros(m.shape[1])
    for boot in range(boots):
        held = np.array([picks[n][boot] > 0 for n in names])
        t, c = scaled[held & treated], scaled[held & ~treated]
        within = sum((v - v.mean(0)).T @ (v - v.mean(0)) for v in (t, c)) / (len(t) + len(c) - 2)
        gap = t.mean(0) - c.mean(0)
        w = np.linalg.solve(within + 0.05 * np.eye(len(sd)), gap) / sd
        raw = gap * sd
        score += (np.abs(raw) + np.abs(w) * abs(w @ raw) / (w @ w)) / 2 / boots
    sign = np.where(m[treated].mean(0) >= m[~treated].mean(0), 1, -1)
    want = sign * np.log10(1 + score)
    got = D.lda_effect(df, meta, kw=1.0, threshold=0, boots=boots).toPandas().set_index("feature")["score"]
    assert np.allclose([got[f"f{j:02d}"] for j in range(9)], want, atol=1e-6)
    assert got["f00"] == got.max() > 0


@pytest.mark.parametrize("inertia", ["positive", "trace"])
def test_pcoa_against_dense_eigenvectors(cohort, inertia):
    """Bray-Curtis distances have negative eigenvalues too."""
    _, names, df, _ = cohort
    pairs = P.bray_curtis(df)
    d = np.zeros((14, 14))
    for r in pairs.collect():
        i, j = names.index(r.s1), names.index(r.s2)
        d[i, j] = d[j, i] = r.d
    centre = np.eye(14) - 1 / 14
    values, vectors = np.linalg.eigh(-0.5 * centre @ d**2 @ centre)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert values[-1] < -1e-3
    total = values[values > 0].sum() if inertia == "positive" else values.sum()
    made = N.pcoa(pairs, k=4, inertia=inertia).toPandas()
    for axis in range(4):
        own = made[made["axis"] == axis + 1].set_index("sample_name").loc[names]
        assert np.allclose(np.abs(own["score"]), np.abs(vectors[:, axis]) * values[axis] ** 0.5, atol=1e-8)
        assert np.allclose(own["explained"], values[axis] / total, atol=1e-8)
        assert own["score"].iloc[own["score"].abs().round(9).to_numpy().argmax()] > 0


def test_axes_of_equal_size_and_opposite_sign(spark):
    """Such axes don't mix; a matrix of zeros has no axes."""
    plane = np.linalg.qr(np.random.default_rng(3).normal(size=(6, 6)))[0]
    m = plane @ np.diag([2.0, -2.0, 1.0, -1.0, 0, 0]) @ plane.T
    rows = [(f"s{i}", f"s{j}", float(m[i, j])) for i in range(6) for j in range(6)]
    made = N._axes(spark.createDataFrame(rows, "a string, b string, v double"), 3, "positive").toPandas()
    assert sorted(made["eigenvalue"].round(9).unique().tolist()) == [1.0, 2.0]
    first = made[made["axis"] == 1].sort_values("sample_name")["score"]
    assert np.allclose(np.abs(first), np.abs(plane[:, 0]) * 2**0.5, atol=1e-8)
    assert np.allclose(made[made["axis"] == 1]["explained"], 2 / 3)
    zero = spark.createDataFrame([(a, b, 0.0) for a, b, _ in rows], "a string, b string, v double")
    assert N._axes(zero, 2, "trace").collect() == [] and N._axes(zero.limit(0), 2, "trace").collect() == []


def test_pca_matches_svd(cohort):
    x, names, df, _ = cohort
    got = N.axes_wide(N.pca(df)).toPandas().sort_values("sample_name")
    c = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    for axis, col in enumerate(("pc1", "pc2")):
        want = u[:, axis] * s[axis]
        assert np.allclose(np.abs(got[col]), np.abs(want), atol=1e-8)


def test_pcoa_of_euclidean_distances_keeps_them(cohort):
    x, names, df, _ = cohort
    pts = N.pcoa(P.euclidean(df), k=9).toPandas().pivot(index="sample_name", columns="axis", values="score").to_numpy()
    want = np.linalg.norm(x[:, None] - x[None], axis=2)
    got = np.linalg.norm(pts[:, None] - pts[None], axis=2)
    assert np.allclose(got, want, atol=1e-6)


def plain_leaf_order(names, d, method):
    """One merge at a time: the nearest two clusters, the lower one to the left."""
    clusters = [([n], -1.0) for n in sorted(names)]

    def gap(a, b):
        between = [d[min(x, y), max(x, y)] for x in a for y in b]
        return round(max(between) if method == "complete" else sum(between) / len(between), 9)

    while len(clusters) > 1:
        _, _, _, i, j = min(
            (gap(a, b), *sorted((min(a), min(b))), i, j)
            for i, (a, _) in enumerate(clusters) for j, (b, _) in enumerate(clusters) if i < j
        )
        (a, ha), (b, hb) = clusters[i], clusters[j]
        first, second = (a, b) if (ha, min(a)) <= (hb, min(b)) else (b, a)
        clusters = [c for k, c in enumerate(clusters) if k not in (i, j)] + [(first + second, gap(a, b))]
    return clusters[0][0]


@pytest.mark.parametrize("method", ["average", "complete"])
def test_leaf_order_against_single_merges(spark, method):
    """Two keys at once, one of them with many equal distances."""
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for key, x in (("k", rng.normal(size=(9, 3))), ("l", rng.integers(0, 3, size=(8, 2)).astype(float))):
        names = [f"s{i}" for i in range(len(x))]
        d = {(names[i], names[j]): float(np.linalg.norm(x[i] - x[j])) for i in range(len(x)) for j in range(i + 1, len(x))}
        rows += [(key, a, b, v) for (a, b), v in d.items()]
        want[key] = plain_leaf_order(names, d, method)
    df = spark.createDataFrame(rows, "key string, s1 string, s2 string, d double")
    made = N.leaf_order(df, method, by=["key"]).orderBy("key", "position").collect()
    for key, order in want.items():
        assert [r.sample_name for r in made if r.key == key] == order


def test_spearman_matches_pandas(cohort):
    x, names, df, _ = cohort
    got = {(r.s1, r.s2): r.r for r in P.spearman(df).collect()}
    want = pd.DataFrame(x.T, columns=names).corr("spearman")
    assert all(abs(v - want.loc[a, b]) < 1e-9 for (a, b), v in got.items())


@pytest.fixture(scope="module")
def counts(spark):
    """Size factors of exactly 1: most features are constant over the cohort."""
    rng = np.random.default_rng(4)
    n = 12
    flat = np.tile(rng.integers(20, 60, size=15).astype(float), (n, 1))
    mu = np.where(np.arange(n)[:, None] < 6, 40, 20) * np.ones((n, 6))
    noisy = rng.negative_binomial(4, 4 / (4 + mu)).astype(float)
    x = np.hstack([flat, noisy])
    names = [f"s{i:02d}" for i in range(n)]
    meta = spark.createDataFrame(
        [(s, "treatment" if i < 6 else "control") for i, s in enumerate(names)], "sample_name string, group string"
    )
    return x, long_table(spark, x, names), meta


def profile_likelihood(k, treated, a):
    mu = np.where(treated, k[treated].mean(), k[~treated].mean())
    ll = sum(
        math.lgamma(v + 1 / a) - math.lgamma(1 / a) + v * math.log(a * m) - (v + 1 / a) * math.log1p(a * m)
        for v, m in zip(k, mu)
    )
    w = mu / (1 + a * mu)
    return ll - 0.5 * math.log(w[treated].sum() * w[~treated].sum())


def test_nb_dispersion_against_brute_force(counts):
    x, df, meta = counts
    treated = np.arange(12) < 6
    fitted, (a0, a1), _ = B.dispersions(df, meta)
    got = {r.feature: r for r in fitted.collect()}
    grid = np.exp(np.linspace(math.log(1e-3), math.log(12), 4000))
    for j in range(15, 21):
        want = grid[np.argmax([profile_likelihood(x[:, j], treated, a) for a in grid])]
        if want > 2e-3:
            assert math.log(got[f"f{j:02d}"].disp_gene) == pytest.approx(math.log(want), abs=0.02)
    assert a0 > 0


def test_nb_glm_fold_changes(counts):
    x, df, meta = counts
    out = {r.feature: r for r in B.nb_glm(df, meta).collect()}
    assert len(out) == 21
    for j in range(15, 21):
        r = out[f"f{j:02d}"]
        # with equal size factors the estimates are the group means
        assert r.log2_fold_change == pytest.approx(math.log2(x[:6, j].mean() / x[6:, j].mean()), abs=1e-6)
        assert r.pvalue == pytest.approx(math.erfc(abs(r.stat) / math.sqrt(2)), rel=1e-9)
        assert r.base_mean == pytest.approx(x[:, j].mean())
