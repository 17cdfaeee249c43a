"""Nested sets, sums along and below nodes, and the tables that use them."""

import random

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import reads as R, trees

TREE = "taxid long, parent long"


def some_tree(seed, n):
    """Chains, stars and in between; several roots, and a parent that isn't a node."""
    spread = random.Random(seed)
    ids = spread.sample(range(10 * n), n)
    parent = {v: spread.choice([None, ids[i - 1], ids[0], spread.choice(ids[:i])]) if i else None for i, v in enumerate(ids)}
    parent[ids[-1]] = -5
    return parent


def below(parent, v):
    """The nodes of the subtree of ``v``."""
    found = {v}
    while True:
        more = {u for u, p in parent.items() if p in found} - found
        if not more:
            return found
        found |= more


def path(parent, v):
    out = [v]
    while parent[out[-1]] in parent:
        out.append(parent[out[-1]])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_and_intervals_of_any_tree(spark, seed):
    parent = some_tree(seed, 60)
    tree = spark.createDataFrame([(v, p, v % 7) for v, p in parent.items()], TREE + ", x long").repartition(3)
    down = {r.taxid: r.x for r in trees.subtree_sums(tree, ["x"]).collect()}
    assert down == {v: sum(u % 7 for u in below(parent, v)) for v in parent}
    up = {r.taxid: r.x for r in trees.path_sums(tree, ["x"]).collect()}
    assert up == {v: sum(u % 7 for u in path(parent, v)) for v in parent}
    sets = {r.taxid: r for r in trees.nested_sets(tree).collect()}
    assert sorted(r.enter for r in sets.values()) == list(range(60))
    for v, r in sets.items():
        assert r.depth == len(path(parent, v))
        assert {u for u, s in sets.items() if r.enter <= s.enter < r.leave} == below(parent, v)


def test_children_enter_by_id(spark):
    tree = spark.createDataFrame([(1, None), (7, 1), (3, 1), (5, 7), (2, 7)], TREE)
    made = {r.taxid: (r.enter, r.leave, r.depth) for r in trees.nested_sets(tree).collect()}
    assert made == {1: (0, 5, 1), 3: (1, 2, 2), 7: (2, 5, 2), 2: (3, 4, 3), 5: (4, 5, 3)}


def test_a_long_chain_and_a_cycle(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, 1) for i in range(200)], TREE + ", x long")
    assert {r.taxid: r.x for r in trees.path_sums(chain, ["x"]).collect()} == {i: i + 1 for i in range(200)}
    assert {r.taxid: r.leave for r in trees.nested_sets(chain).collect()} == dict.fromkeys(range(200), 200)
    for rows in ([(1, 2), (2, 3), (3, 1)], [(1, 1)], [(1, None), (2, 3), (3, 2)]):
        with pytest.raises(ValueError, match="cycle"):
            trees.nested_sets(spark.createDataFrame(rows, TREE))


def test_empty_trees_and_counts(spark):
    none = spark.createDataFrame([], TREE)
    assert trees.nested_sets(none).collect() == [] and trees.subtree_sums(none, []).collect() == []
    sets = trees.nested_sets(spark.createDataFrame([(1, None), (2, 1)], TREE))
    nothing = spark.createDataFrame([], "taxid long, reads long")
    assert trees.clade_sums(nothing, sets, "reads").collect() == []
    stray = spark.createDataFrame([(2, 4), (99, 5)], "taxid long, reads long")
    assert {r.taxid: r.reads for r in trees.clade_sums(stray, sets, "reads").collect()} == {1: 4, 2: 4}


@pytest.mark.parametrize("seed", [3, 4])
def test_clade_reads_are_sums_over_subtrees(spark, seed):
    parent = some_tree(seed, 80)
    spread = random.Random(seed)
    reads = {v: spread.randrange(1, 50) for v in spread.sample(sorted(parent), 25)}
    tree = spark.createDataFrame(list(parent.items()), TREE)
    counts = spark.createDataFrame(list(reads.items()), "taxid long, reads long")
    made = {r.taxid: r.reads for r in trees.clade_sums(counts, trees.nested_sets(tree), "reads").collect()}
    want = {v: sum(reads.get(u, 0) for u in below(parent, v)) for v in parent}
    assert made == {v: n for v, n in want.items() if n}


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_reestimate_shares_out_what_is_held_above(spark, monkeypatch, hot):
    """Also with every ancestor hot; a share of a node that isn't above the taxon is left out."""
    monkeypatch.setattr(R, "HOT_ROWS", hot)
    names = {1: "R", 2: "G", 3: "G", 4: "S", 5: "S", 6: "S"}
    parent = {1: None, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3}
    tree = spark.createDataFrame([(v, p, names[v], f"n{v}") for v, p in parent.items()], TREE + ", rank_code string, name string")
    reads = {1: 10, 2: 6, 4: 8, 5: 4, 6: 2}
    sets = trees.nested_sets(tree)
    report = R.clade_report(spark.createDataFrame(list(reads.items()), "taxid long, reads long"), tree, sets)
    shares = [(4, 2, 0.5), (5, 2, 0.25), (4, 1, 0.5), (5, 1, 0.5), (6, 1, 1.0), (6, 2, 9.0)]
    made = R.reestimate(report, sets, spark.createDataFrame(shares, "taxid long, ancestor long, share double"), ["S"]).collect()
    want = {4: 8.0, 5: 4.0, 6: 2.0}
    for above, held in ((2, 6), (1, 10)):
        weight = {t: s * reads[t] for t, a, s in shares if a == above and t in (4, 5, 6) and not (t == 6 and a == 2)}
        for t, w in weight.items():
            want[t] += held * w / sum(weight.values())
    assert {r.taxid: r.new_est for r in made} == pytest.approx(want)
    assert sum(r.fraction for r in made) == pytest.approx(1)
    assert {r.taxid: r.kraken_assigned for r in made} == {t: reads[t] for t in (4, 5, 6)}
