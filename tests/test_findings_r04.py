"""Distances of all samples without a table sent once per block, and sums over pairs without a row per pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.operators import matrix as M, ordination as N, pairs as P
from taxaloom.plans import queries_diversity as Q


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def many_genes(spark, tmp_path_factory):
    """Two suppliers with 1000 varying genes, and two with a gene each that varies less than those."""
    path = tmp_path_factory.mktemp("genes")
    part = [(i, f"p{i}", "TIN", "Brand#1", 7) for i in range(1, 1003)]
    lines = [(i, s, 64.0) for i in range(1, 1001) for s in (1, 2)] + [(1001, 3, 1.0), (1002, 4, 1.0)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(s, 1.0) for s in range(1, 6)], "s_suppkey long, s_acctbal double").write.parquet(f"{path}/supplier.parquet")
    return str(path)


def test_samples_without_variable_genes_have_distances(spark, many_genes):
    """samples that have none of the 1000 genes are zeros there, as in the SQL text, and not left out."""
    got = {(r.s1, r.s2): r.d for r in Q.euclidean(spark, many_genes).collect()}
    assert set(got) == {("S1", "S2"), ("S1", "S3"), ("S1", "S4"), ("S2", "S3"), ("S2", "S4"), ("S3", "S4")}
    assert got["S3", "S4"] == 0 and got["S1", "S2"] < 1e-3 and got["S1", "S3"] == got["S2", "S4"] > 1


def test_cells_read_blocks_that_are_exchanged_once(spark, toy, toy_meta):
    """no copy of a block per other block, and no join of the pairs with totals."""
    for made in (P.bray_curtis(toy, samples=toy_meta), P.euclidean(toy), P.spearman(toy)):
        text = plan(made).split("== Initial Plan ==")[-1]
        assert "Generate" not in text and "SortMergeJoin" not in text and "BroadcastHashJoin" not in text
        assert text.count("FlatMapGroupsInPandas") == text.count("REPARTITION_BY_NUM") == 2


def test_keys_are_worked_on_apart(spark):
    """Blocks of other keys, null ones too, don't meet."""
    rng = np.random.default_rng(8)
    rows = [(k, f"s{i:02d}", f"f{j}", float(v)) for k in ("a", "b", None) for i, x in enumerate(rng.poisson(0.6, (7, 9))) for j, v in enumerate(x)]
    df = spark.createDataFrame(rows, "code string, sample_name string, feature string, value double")
    got = {(r.code, r.s1, r.s2): r.d for r in P.bray_curtis(df, by=["code"], sample_block=2).collect()}
    x = {k: np.array([v for c, _, _, v in rows if c == k]).reshape(7, 9) for k in ("a", "b")}
    assert {k: sum(c == k for c, *_ in got) for k in ("a", "b", None)} == {"a": 21, "b": 21, None: 21}
    for (k, a, b), d in got.items():
        if k is not None:
            p, q = x[k][int(a[1:])], x[k][int(b[1:])]
            assert d == pytest.approx(1 - 2 * np.minimum(p, q).sum() / (p.sum() + q.sum()) if p.sum() + q.sum() else 0)


def test_permanova_writes_no_pairs(spark, toy, toy_meta, monkeypatch):
    """the same from packed distances and from pairs; of the packed ones no row per pair is made."""
    want = [P.permanova(P.bray_curtis(toy, samples=toy_meta), toy_meta, permutations=50, sample_block=2).first()]
    want.append(P.permanova(P.bray_curtis(toy), toy_meta, permutations=50, unmatched="drop").first())
    frozen = []
    monkeypatch.setattr(P, "freeze", lambda df, made=P.freeze: frozen.append(df.columns) or made(df))
    monkeypatch.setattr(P, "_as_pairs", None)
    monkeypatch.setattr(P, "_lists", lambda *a, made=P._lists: made(*a))
    packed = P.bray_curtis(toy, samples=toy_meta, packed=True, sample_block=1)
    got = [P.permanova(packed, toy_meta, permutations=50).first()]
    got.append(P.permanova(P.bray_curtis(toy, packed=True), toy_meta, permutations=50, unmatched="drop").first())
    for a, b in zip(want, got):
        assert [a[c] for c in a.asDict()] == pytest.approx([b[c] for c in a.asDict()])
    assert not any({"s1", "d"} & set(columns) for columns in frozen)


def test_components_without_a_matrix_of_the_samples(spark, monkeypatch):
    """F4, F8, F13: repeated rows, rows without a feature; no sums of pairs, and all axes of a table of low rank from narrow blocks."""
    rng = np.random.default_rng(4)
    m = rng.poisson(0.5, (40, 6)).astype(float)
    m[0, 0] = 3
    rows = [(f"s{i:02d}", f"f{j}", float(m[i, j]) / 2) for i, j in zip(*np.nonzero(m)) for _ in range(2)] + [("s00", None, 5.0), (None, "f1", 1.0)]
    rows += [("t", None, 2.0)]
    df = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    monkeypatch.setattr(N, "_blocks", None)
    monkeypatch.setattr(N, "SPARE", 2)
    monkeypatch.setattr(N, "BASIS_NUMBERS", 500)
    seen = []
    monkeypatch.setattr(N, "_gram_times", lambda lists, x, made=N._gram_times: seen.append(x.shape[1]) or made(lists, x))
    monkeypatch.setattr(N, "AT_ONCE", 20)
    names = sorted({r[0] for r in rows if r[0] and (r[1] or r[0] == "t")})
    x = np.array([m[int(s[1:])] if s != "t" else np.zeros(6) for s in names])
    x -= x.mean(axis=0)
    values = np.linalg.eigvalsh(x.T @ x)[::-1]
    got = N.pca(df, len(names)).toPandas()
    assert sorted(got["sample_name"].unique()) == names and max(seen) <= 4
    points = got.pivot(index="sample_name", columns="axis", values="score").to_numpy()
    assert np.allclose(points @ points.T, x @ x.T, atol=1e-8) and points.shape == (len(names), 6)
    first = got[got["sample_name"] == names[0]].sort_values("axis")
    assert np.allclose(first["eigenvalue"], values) and np.allclose(first["explained"], values / values.sum())


def test_densify_reads_its_table_once(spark, monkeypatch):
    """rows of other samples, of none and without a value; the rows are exchanged by feature alone."""
    rows = [("a", "x", 1.0), ("a", "x", 1.0), ("b", "x", None), ("z", "x", 4.0), (None, "y", 5.0), ("z", "y", 6.0), ("c", "w", 7.0)]
    df = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    samples = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "sample_name string")
    frozen = []
    monkeypatch.setattr(M, "freeze", lambda df, made=M.freeze: frozen.append(df.columns) or made(df))
    out = M.densify(df, samples, block=2)
    got = sorted((r.feature, r.sample_name, r.value) for r in out.collect())
    want = [(f, s, 0.0) for f in "wxy" for s in "abc" if (f, s) not in {("x", "a"), ("w", "c")}]
    assert got == sorted([*want, ("x", "a", 1.0), ("x", "a", 1.0), ("w", "c", 7.0)])
    assert frozen[0] == ["sample_name", "feature", "value"] and "LeftSemi" not in plan(out)
