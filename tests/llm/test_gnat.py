"""Hard negatives: exact against all pairs, whatever the tree."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import gnat

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    clean = []
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        clean.append((i, [math.floor(float(np.float32(x)) * scale) for x in vec], label))
    made = []
    for a, q, mine in clean:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, v, label in clean if i != a)
        for s, p, _ in [r for r in scored if r[2] == mine][:positives]:
            fits = [(-t, n) for t, n, label in scored if label != mine and low * -s <= 100 * -t <= high * -s]
            made += [(a, p, rank, n, -s, t) for rank, (t, n) in enumerate(fits[:negatives], 1)]
    return sorted(made)


def mined(df, anchor, **how):
    return sorted(map(tuple, gnat.hard_negatives(df, anchor, **how).collect()))


@pytest.fixture
def small_tree(monkeypatch):
    """Many levels, leaves in stretches, anchors in blocks."""
    for name, value in (("FANOUT", 4), ("SPLIT", 6), ("LEAF_ROWS", 7), ("ANCHORS", 5), ("SAMPLE", 60), ("STRIPE", 40)):
        monkeypatch.setattr(gnat, name, value)


def clustered(seed, n, dims=5):
    spread = np.random.default_rng(seed)
    centre = spread.normal(size=(6, dims))
    rows = []
    for i in range(n):
        c = int(spread.integers(6))
        vec = centre[c] * spread.choice([0.5, 1.0, 2.0]) + spread.normal(size=dims) * 0.05
        rows.append((i, [float(x) for x in vec.astype(np.float32)], int(spread.integers(3))))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_all_pairs_agree(spark, small_tree, seed):
    rows = clustered(seed, 240)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert mined(df, F.col("vec_id") % 11 == 0) == brute(rows, lambda i: i % 11 == 0)


def test_production_tree_on_clusters(spark):
    rows = clustered(9, 900)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, F.col("vec_id") % 50 == 0) == brute(rows, lambda i: i % 50 == 0)


def test_many_copies_and_ties(spark, small_tree):
    """A third of the rows are one vector; equal scores go by id; negative and zero scores."""
    rows = [(i, [1.0, 0.5, 0.0], i % 2) for i in range(60)]
    rows += [(100 + i, [float(i % 3 - 1), float(i % 5 - 2) / 2, 0.25], i % 4) for i in range(110)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert mined(df, F.col("vec_id") % 10 == 0) == brute(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark, small_tree):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [math.sin(i), math.cos(3 * i), math.sin(i * i)], i % 3) for i in range(40)]
    rows += [
        (40, None, 1), (41, [1.0, None, 0.0], 1), (42, [nan, 0.0, 0.0], 1), (43, [inf, 0.0, 0.0], 1), (44, [1.0, 1.0, 1.0], None),
        (None, [1.0, 1.0, 1.0], 1), (45, [], 1), (46, [0.5], 2), (47, [0.0, 0.0, 0.0], 0), (48, [-0.001, 0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute([(i, v if v is None else v + [0.0] * (3 - len(v)), l) for i, v, l in rows], lambda i: i % 4 == 0)
    assert mined(df, F.col("vec_id") % 4 == 0) == want
    clash = df.select("*", *(F.lit("x").alias(c) for c in ("key", "id", "w", "cell", "part", "block", "score", "anchor", "vec", "least")))
    assert mined(clash, F.col("vec_id") % 4 == 0) == want
    assert mined(df.where("false"), F.col("vec_id") % 4 == 0) == []
    assert mined(df.where("vec_id = 4"), F.col("vec_id") % 4 == 0) == []


def test_repeated_rows(spark):
    rows = [(i // 2, [math.sin(i // 2), math.cos(i // 2)], (i // 2) % 2) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, F.col("vec_id") == 6) == brute(rows, lambda i: i == 6)


def test_tree_leaves_subtrees_out():
    """On separated clusters most cells are ruled out, and never one with a row in the window."""
    spread = np.random.default_rng(0)
    centres = spread.normal(size=(12, 8)) * 100
    rows = np.floor(centres[spread.integers(12, size=3000)] + spread.normal(size=(3000, 8)))
    longest = float((rows * rows).sum(1).max())
    tree = gnat.Tree(rows[:2000], longest)
    tree.low, tree.high = tree.no_ranges()
    tree.measure(rows, tree.low, tree.high)
    cell = tree.cell_of(rows)
    queries = rows[:40]
    scores = queries @ rows.T
    least, most = np.quantile(scores, 0.97, axis=1), scores.max(1) * 0.99
    visits = {(i, c) for at, c in tree.cells_in(queries, least, most) for i in at.tolist()}
    inside = (scores >= least[:, None]) & (scores <= most[:, None])
    assert {(i, int(cell[j])) for i, j in zip(*np.nonzero(inside))} <= visits
    assert len(visits) < 0.6 * 40 * tree.cells


def test_best_of_equal_scores_are_the_first():
    scores = np.array([5.0, 9.0, 5.0, 5.0, 1.0])
    assert sorted(gnat.best(scores, np.ones(5, bool), 3).tolist()) == [0, 1, 2]
    assert gnat.best(scores, scores < 0, 3).tolist() == []
