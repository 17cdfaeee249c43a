"""Readers on files written here."""

import gzip

import pytest

from taxaloom.functions import lineage as L
from taxaloom.operators import matrix as M
from taxaloom.sources import files, sinks


def test_profiles_skip_and_cut_comments(spark, tmp_path):
    path = tmp_path / "S1_profile.txt"
    path.write_text("#mpa\n# x\nk__B\t2\t60.5\t\nk__B|p__F\t2|1239\t39.5 # note\t\n")
    manifest = spark.createDataFrame([("S1", str(path))], "sample_name string, path string")
    rows = files.read_profiles(spark, str(path), manifest, cut_comments=True).orderBy("clade_name").collect()
    assert [(r.sample_name, r.clade_name, r.relative_abundance) for r in rows] == [("S1", "k__B", 60.5), ("S1", "k__B|p__F", 39.5)]
    plain = tmp_path / "S2_profile.txt"
    plain.write_text("#mpa\nk__B\t2\t100.0\t\n")
    manifest = spark.createDataFrame([("S2", str(plain))], "sample_name string, path string")
    assert files.read_profiles(spark, str(plain), manifest).first()["relative_abundance"] == 100.0


def test_sample_name_from_file_name(spark, tmp_path):
    for name in ("A.Pathway.txt", "B.Module.txt", "C_path.abundance.tsv", "D.path.abundance.txt"):
        (tmp_path / name).write_text("term\tx\nP1: a\t0.5\n")
    rows = files.read_terms(spark, str(tmp_path), term_type="path_abundance").collect()
    assert sorted(r["sample_name"] for r in rows) == ["A", "B", "C", "D"]


def test_order_over_many_splits(spark, tmp_path):
    names = [f"sample{i * 7919 % 1000:04d}" for i in range(1000)]
    (tmp_path / "order.txt").write_text("\n".join(names) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = files.read_order(spark, str(tmp_path / "order.txt")).orderBy("position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["sample_name"] for r in got] == names


def test_pcl_reads_compressed_files(spark, tmp_path):
    with gzip.open(tmp_path / "t.pcl.gz", "wt") as out:
        out.write("term\tS1\tS2\nage\t3\t4\ngroup\ta\tb\nP: n|g__A.s__A_b\t0.1\t0\n")
    features, meta = files.read_pcl(spark, str(tmp_path / "t.pcl.gz"), "group")
    assert sorted((r.sample_name, r.feature, r.value) for r in features.collect()) == [
        ("S1", "P: n|g__A.s__A_b", 0.1), ("S2", "P: n|g__A.s__A_b", 0.0)
    ]
    assert sorted((r.sample_name, r.name, r.level) for r in meta.collect()) == [
        ("S1", "age", "3"), ("S1", "group", "a"), ("S2", "age", "4"), ("S2", "group", "b")
    ]


def test_rank_by_prefix_and_depth_differ(spark):
    df = spark.createDataFrame([("UNCLASSIFIED",), ("k__B|p__F",)], "clade_name string")
    rows = df.select(
        "clade_name", L.rank_by_prefix(L.last_level("clade_name")).alias("a"), L.rank_by_depth("clade_name").alias("b"),
        L.clean_name(L.last_level("clade_name")).alias("n"),
    ).collect()
    assert {r.clade_name: (r.a, r.b, r.n) for r in rows} == {
        "UNCLASSIFIED": (None, "KINGDOM", None), "k__B|p__F": ("PHYLUM", "PHYLUM", "F")
    }


def test_feature_ids(spark):
    ids = ["G1: tRNA: proline|s__B_d", "G2", "G3|unclassified"]
    df = spark.createDataFrame([(i,) for i in ids], "f string").select("f", L.split_feature("f").alias("s"))
    rows = df.select("f", "s.*", L.join_feature("s.code", "s.name", "s.stratum").alias("back")).collect()
    assert {r.f: (r.code, r.name, r.stratum) for r in rows} == {
        ids[0]: ("G1", "tRNA: proline", "s__B_d"), ids[1]: ("G2", None, None), ids[2]: ("G3", None, "unclassified")
    }
    assert all(r.f == r.back for r in rows)
    with pytest.raises(Exception, match="too many parts"):
        spark.createDataFrame([("a|b|c",)], "f string").select(L.split_feature("f").alias("s")).select("s.code").collect()


def test_empty_sample_gives_zero_shares(spark):
    df = spark.createDataFrame([("a", "x", 0.0), ("b", "x", 2.0)], "sample_name string, feature string, value double")
    assert {r.sample_name: r.value for r in M.relative(df).collect()} == {"a": 0.0, "b": 100.0}


def test_code_list(spark):
    df = spark.createDataFrame([("P2: b", 0.2), ("P1: a", 0.1)], "term string, q double")
    assert sinks.code_list(df, "term", "q").first()["codes"] == "P1,P2"
