"""Inputs and steps that must not grow beyond their tables."""

import os

import numpy as np
from pyspark.sql import functions as F

from taxaloom.operators import ordered as O, trees
from taxaloom.plans import queries_functional as K, queries_tables as Q
from taxaloom.session import freeze
from taxaloom.sources import files, sinks, tables as T


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def small_shop(spark, path) -> str:
    """Parts with deep, shallow and missing names; order lines with and without their supplier."""
    part = [(1, "a alpha x", "TIN", "Brand#1", 7), (2, "b beta", "TIN", "Brand#2", 10), (3, "c gamma", None, "Brand#1", 7), (4, "d delta", "ZINC", "Brand#3", 3),
            (5, "e eta", "BRASS", "Brand#4", 4), (None, "f zeta", "BRASS", "Brand#4", 4), (1, "a alpha x", "TIN", "Brand#1", 7)]
    lines = [(1, 1, 2.0), (1, 2, None), (2, 1, 1.0), (3, 2, 4.0), (3, 3, 1.0), (4, None, 3.0), (None, 1, 3.0), (9, 1, 1.0)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_type string, p_brand string, p_size int").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_clades_are_those_of_the_profile(spark, tmp_path):
    sf = small_shop(spark, tmp_path)
    for with_tax, keys in ((True, ["clade_name", "ncbi_tax_id"]), (False, ["clade_name"])):
        made, want = T.clades(spark, sf, with_tax), T.profile(spark, sf, with_tax=with_tax).select(*keys).distinct()
        assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
    assert not {"sample_name", "l_quantity"} & set(plan(Q.rank_by_prefix(spark, sf)).replace("#", " ").replace("[", " ").split())
    assert {r["rank"] for r in Q.distinct(spark, sf).collect()} == {r["rank"] for r in Q.M.annotate(T.profile(spark, sf)).collect()}


def test_rows_land_from_many_tasks(spark):
    """No file of a landing holds all rows of it, as one task would have written it."""
    df = spark.range(3000).select(F.concat(F.lit("S"), "id").alias("sample_name"), F.lit(1.0).alias("value"))
    seen = []
    made = K.S.stream_profiles
    try:
        K.S.stream_profiles = lambda spark, path, schema, files_per_trigger: seen.append((path, files_per_trigger))
        K._landed(spark, df, "landed", parts=3)
    finally:
        K.S.stream_profiles = made
    path, at_once = seen[0]
    files = [f for f in os.listdir(path.removeprefix("file:").replace("//", "/")) if f.endswith(".parquet")]
    assert len(files) == 3 * at_once > 3
    assert spark.read.parquet(path).exceptAll(df).isEmpty() and spark.read.parquet(path).count() == 3000


def test_rounds_over_a_tree_broadcast_nothing(spark, monkeypatch):
    """Ids in order are small when written; that must not make every round broadcast them."""
    plans = []
    monkeypatch.setattr(trees, "freeze", lambda df, made=trees.freeze: plans.append(plan(df)) or made(df))
    tree = spark.range(1, 200).select(F.col("id").alias("taxid"), F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"))
    sums = trees.path_sums(tree.withColumn("n", F.lit(1).cast("long")), ["n"])
    assert all(r.n == r.taxid for r in sums.collect())
    assert plans and not any("Broadcast" in p for p in plans)


def test_place_is_one_sort(spark):
    """Equal rows share a position, rows without a key or value go, and no step joins by the values."""
    rows = [("a", 2.0, "x"), ("a", 2.0, "y"), ("a", 3.0, "x"), ("a", 2.0, "y"), ("a", None, "z"), (None, 1.0, "x"), ("b", 1.0, None)]
    rows += [("c", float(i % 7), f"f{i:03d}") for i in range(300)]
    df = spark.createDataFrame(rows, "sample_name string, value double, feature string")
    placed = O.place(df, ["sample_name"], [("value", True), ("feature", False)])
    assert placed.columns == [*df.columns, "position"]
    assert sum(plan(placed).split("== Initial Plan ==")[-1].count(j) for j in ("MergeJoin", "HashJoin", "LoopJoin")) == 1
    want = {}
    for r in rows:
        if None not in r:
            want[r] = sum(o[0] == r[0] and (-o[1], o[2]) < (-r[1], r[2]) for o in rows if None not in o)
    made = [tuple(r) for r in placed.collect()]
    assert len(made) == sum(None not in r for r in rows) and {r[:3]: r[3] for r in made} == want
    assert sorted(r.position for r in O.place(df.select("feature").distinct(), [], [("feature", True)]).collect()) == list(range(303))


def test_matrix_parts_follow_its_cells(spark, tmp_path, monkeypatch):
    """Lines are made where they are written, in as many parts as their cells ask for, zeros counted."""
    monkeypatch.setattr(sinks, "PART_CELLS", 100)
    rows = [(f"S{i:02d}", f"f{j:02d}", float(i + j)) for i in range(40) for j in range(60) if (i * j) % 7 == 1]
    rows += [("S39", "f00", 0.0), ("S00", "f01", float("nan"))]
    df = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    names = spark.createDataFrame([(f"S{i:02d}", i) for i in range(40)], "sample_name string, position long")
    path = str(tmp_path / "m")
    sinks.write_matrix(df, names, path)
    parts = [sum(1 for _ in open(f"{path}/{f}")) for f in sorted(os.listdir(path)) if f.startswith("part-")]
    lines = 1 + len({f for _, f, _ in rows})
    assert sum(parts) == lines and max(parts) <= 10 and sum(p > 0 for p in parts) > 8
    back = files.read_matrix(spark, path)
    assert sorted(str(tuple(r)) for r in back.collect()) == sorted(str(r) for r in rows if r[2] != 0)
    assert "transform(" not in plan(back)


def test_files_of_keys_share_a_folder(spark, tmp_path):
    """No folder per key, the lines of Spark's own writer, and every row comes back by its file."""
    rows = [(f"S{i % 23}", f'a "b"\t{i}', float(i)) for i in range(500)] + [("S1", None, 3.0), ("S 2%+/ä", "", 1.0), (None, "x", 2.0)]
    df = spark.createDataFrame(rows, "sample_name string, term string, abundance double")
    for apart in (True, False):
        root = str(tmp_path / f"files{apart}")
        made = sinks.write_files(df, root, "sample_name", header=True, apart=apart)
        own = str(tmp_path / f"own{apart}")
        df.repartition(1).drop("sample_name").write.option("sep", "\t").csv(own)
        lines = [x for f in os.listdir(root) for x in open(f"{root}/{f}").read().splitlines() if x != "term\tabundance"]
        assert all(os.path.isfile(f"{root}/{f}") for f in os.listdir(root))
        assert sorted(lines) == sorted(r.value for r in spark.read.text(own).collect())
        assert sorted(r.path for r in made.collect()) == sorted(f"{root}/{f}" for f in os.listdir(root))
        back = files.read_terms(spark, root, made).groupBy("sample_name").count().collect()
        want = {k or sinks.NO_KEY: sum(r[0] == k for r in rows) for k in {r[0] for r in rows}}
        assert {r[0]: r[1] for r in back} == want
    assert len(os.listdir(root)) == len(want)
    empty = sinks.write_files(df.limit(0), str(tmp_path / "none"), "sample_name")
    assert empty.isEmpty() and os.path.isdir(tmp_path / "none")


def test_tree_of_pieces_walks_every_piece():
    """Each character is one step from the one before it; nothing but the pieces and their starts is in the tree."""
    from taxaloom.llm.pieces import load
    from taxaloom.llm.queries import piece_model

    pieces = load(piece_model())
    found, open_ = {}, [("", pieces.tree)]
    while open_:
        start, below = open_.pop()
        for c, (score, more) in below.items():
            found[start + c] = score
            open_ += [(start + c, more)] if more else []
    assert found == pieces.onward


def test_leaf_orders_write_no_row_per_pair(spark, monkeypatch):
    """Rounds write rows of the matrix, and of later rounds those of new clusters alone; the order is that of single merges."""
    from taxaloom.operators import linkage, ordination as N, pairs as P

    from test_models import plain_leaf_order

    rng = np.random.default_rng(5)
    rows = [
        (code, f"s{i}", f"f{j}", float(v))
        for code, n in (("a", 23), ("b", 17), ("c", 1)) for i in range(n) for j, v in enumerate(rng.integers(0, 4, 6)) if v
    ] + [(None, "s1", "f1", 1.0), ("a", "s0", None, 2.0)]
    df = spark.createDataFrame(rows, "code string, sample_name string, feature string, value double")
    written = []
    monkeypatch.setattr(linkage, "LAST", 3)
    monkeypatch.setattr(linkage, "freeze", lambda t: written.append(made := freeze(t)) or made)
    for weighted in (True, False):
        pairs = P.bray_curtis(df, weighted, by=["code"]).filter("code IS NOT NULL").toPandas()
        for method in ("average", "complete"):
            made = N.bray_curtis_order(df, weighted, by=["code"], method=method).toPandas()
            assert set(made["code"]) == {"a", "b"}
            for code, of in pairs.groupby("code"):
                d = {(min(a, b), max(a, b)): v for a, b, v in zip(of["s1"], of["s2"], of["d"])}
                names = sorted({n for p in d for n in p})
                order = made[made["code"] == code].sort_values("position")["sample_name"].tolist()
                assert order == plain_leaf_order(names, d, method)
    assert not [t for t in written if {"s1", "s2"} & set(t.columns)]
