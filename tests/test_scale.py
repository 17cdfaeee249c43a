"""Small tests of what grows with the table: exchanged rows, partial sums, states."""

import numpy as np
import pytest

from taxaloom.operators import matrix as M, ordination as N, pairs as P
from taxaloom.sources import tables as T


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_densify_exchanges_no_zeros(spark):
    rows = spark.createDataFrame(
        [("a", "x", 2.0), ("a", "x", 3.0), ("b", "y", None), ("b", None, 7.0), ("z", "x", 1.0)],
        "sample_name string, feature string, value double",
    )
    samples = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "sample_name string")
    out = M.densify(rows, samples, block=1)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("x", "a", 2.0), ("x", "a", 3.0), ("x", "b", 0.0), ("y", "a", 0.0), ("y", "b", 0.0), (None, "a", 0.0),
         (None, "b", 0.0)], key=str,
    )
    assert out.dtypes == [("feature", "string"), ("sample_name", "string"), ("value", "double")]
    # The zeros are made after the last join: nothing but a projection is above them.
    plan = physical(out)
    assert "Join" not in plan[: plan.index("Generate")]


@pytest.mark.parametrize("kind", ["dot", "min"])
def test_a_pair_leaves_its_cell_once(spark, kind):
    """Rare and common features, repeated rows, samples without rows; every pair once whatever the features' number."""
    rng = np.random.default_rng(3)
    m = rng.poisson(0.04, (90, 400)) + rng.poisson(1.0, (90, 400)) * (np.arange(400) < 15)
    rows = [(f"s{i:02d}", f"f{j}", float(v) / 2) for i, j in zip(*np.nonzero(m)) for v in [m[i, j]] * 2]
    df = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    names = [f"s{i:02d}" for i in range(90)] + ["t"]
    samples = spark.createDataFrame([(n,) for n in names], "sample_name string")
    out = P.pair_sums(df, kind, samples, feature_chunk=7)
    x = np.vstack([m, np.zeros(400)])
    want = x @ x.T if kind == "dot" else np.minimum(x[:, None, :], x[None, :, :]).sum(axis=2)
    got = {(r["s1"], r["s2"]): r["acc"] for r in out.collect()}
    assert len(got) == out.count() == 91 * 92 // 2
    assert all(abs(got[a, b] - want[i, j]) < 1e-9 for i, a in enumerate(names) for j, b in enumerate(names) if i <= j)
    # The sums that leave the cells are whole: no aggregate of pairs follows them.
    plan = physical(out)
    assert "Aggregate" not in plan[: plan.index("FlatMapGroupsIn")]


def test_axes_that_hardly_differ_settle(spark):
    """Eigenvalues next to each other, which the iteration of a single vector doesn't part in 300 rounds."""
    n = 160
    plane = np.linalg.qr(np.random.default_rng(5).normal(size=(n, n)))[0]
    values = np.r_[1.001, 1.0, np.linspace(0.999, -0.99, n - 2)]
    m = plane @ np.diag(values) @ plane.T
    rows = [(f"s{i:03d}", f"s{j:03d}", float(m[i, j])) for i in range(n) for j in range(n)]
    made = N._axes(spark.createDataFrame(rows, "a string, b string, v double"), 2, "positive").toPandas()
    total = values[values > 0].sum()
    for axis in (1, 2):
        own = made[made["axis"] == axis].sort_values("sample_name")
        assert np.allclose(np.abs(own["score"]), np.abs(plane[:, axis - 1]) * values[axis - 1] ** 0.5, atol=1e-6)
        assert np.allclose(own["explained"], values[axis - 1] / total, atol=1e-7)


def test_clades_of_short_paths(spark):
    """Deep clades are summed where they were dealt; a short path counts at each of the depths that it stands for."""
    leaves = [("a", "k|p|c|o|f|g|s", 1.0), ("a", "k|p|c|o|f|g|t", 2.0), ("a", "k|p|c|o|e|g|s", 4.0), ("a", "k|p", 8.0),
              ("a", "k|p|c|o|f", 16.0), ("b", "k|p|c|o|f|g|s", 32.0), (None, "k|q", 64.0)]
    obs = spark.createDataFrame(leaves, "sample_name string, leaf string, q double")
    for depths in ((1, 2, 3, 4, 5, 6, 7), (2, 6), (1,), (6, 7)):
        want = {}
        for s, path, q in leaves:
            for d in depths:
                at = s, "|".join(path.split("|")[:d])
                want[at] = want.get(at, 0.0) + q
        made = T._clades(obs, ["leaf"], ["clade_name"], depths)
        got = [((r["sample_name"], r["clade_name"]), r["cnt"]) for r in made.collect()]
        assert len(got) == len(want) and dict(got) == want
    plan = T._clades(obs, ["leaf"], ["clade_name"], (1, 5, 6, 7))
    plan.collect()
    # The lines and the sums above are exchanged, the deep clades are not.
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("REPARTITION_BY_COL") + text.count("ENSURE_REQUIREMENTS") + text.count("ReusedExchange") <= 4
