"""The end-to-end analyses run on the smallest data folder and keep their invariants."""

import pytest
from pyspark.sql import functions as F

from taxaloom.plans import analyses as A
from taxaloom.sources import tables as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def meta(spark):
    return T.metadata(spark, SF)


def test_community(spark, meta):
    out = A.community(T.profile(spark, SF, depths=[7]), meta, permutations=50)
    n = meta.count()
    sums = out["top_overall"].groupBy("sample_name").agg(F.sum("value").alias("s")).collect()
    assert len(sums) == n and all(abs(r["s"] - 100) < 1e-6 for r in sums)
    assert out["distances"].count() == n * (n - 1) // 2
    assert out["distances"].filter("d < 0 OR d > 1").isEmpty()
    assert out["diversity_tests"].count() == 5
    assert 0 < out["permanova"].first()["p"] <= 1
    assert out["ordination"].count() == n and out["ellipses"].count() == 2


def test_rank_difference(spark, meta):
    out = A.rank_difference(T.species(spark, SF), meta, sig_type="pvalue", logfc_thresh=0.0)
    result = out["result"]
    assert result.filter("padj < pvalue - 1e-12").isEmpty()
    assert sum(r["n"] for r in out["directions"].collect()) == result.count()
    assert out["heatmap"].count() == 30 * meta.count()


def test_model_difference(spark, meta):
    out = A.model_difference(T.species(spark, SF), meta)
    assert out["result"].filter("score IS NULL").isEmpty()
    assert out["best"].count() == 10


def test_expression(spark, meta):
    genes = T.profile(spark, SF, depths=[2, 3, 4, 5, 6]).select(
        "sample_name", F.col("clade_name").alias("gene_id"), F.lit("-").alias("gene_name"), F.col("cnt").alias("count")
    )
    out = A.expression(genes, meta)
    n = meta.count()
    assert out["result"].count() == genes.select("gene_id").distinct().count()
    assert out["distance_order"].count() == n
    assert out["correlation"].filter("abs(r) > 1 + 1e-9").isEmpty()
    assert sum(r["n"] for r in out["directions"].collect()) == out["classes"].count()


def test_functional_and_classification(spark, meta):
    families = T.ko_abundance(spark, SF).select("sample_name", F.col("ko").alias("term"), F.col("value").alias("abundance"))
    identity = T.module_members(spark, SF).select(F.col("ko").alias("gene_family"), F.col("ko").alias("group_id"))
    out = A.functional_tables(
        families, {"KO": identity, "GO": T.regroup_map(spark, SF)}, T.module_members(spark, SF), T.module_steps(spark, SF)
    )
    assert out["KO_stratified"].isEmpty()
    totals = out["GO_unstratified"].groupBy("sample_name").agg(F.sum("abundance").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in totals)
    # every KO belongs to one module, so the module scores of a sample add up to its whole
    scores = out["modules"].groupBy("sample_name").agg(F.sum("score").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in scores)
    pairs = T.ancestors(spark, SF).filter("taxid <> ancestor").withColumn("share", F.lit(1.0))
    tables = A.classification(T.assignments(spark, SF), T.taxonomy(spark, SF), pairs, ["D", "G", "S"])
    total = tables["counts"].agg(F.sum("reads")).first()[0]
    assert tables["report"].filter("rank_code = 'R'").first()["clade_reads"] == total
    # all reads are held at or below nations, so re-estimation at species level shares them all out
    species = tables["estimates"].filter("level = 'S'").agg(F.sum("new_est")).first()[0]
    assert species == pytest.approx(total)


def test_contributions(spark, meta):
    from taxaloom.operators.ordered import place

    samples = place(meta.select("sample_name"), [], [("sample_name", False)])
    out = A.contributions(T.functional(spark, SF), meta, samples, ["ECONOMY", "PROMO"])
    seen = out.groupBy("code").agg(F.count_distinct("position").alias("n"), F.max("position").alias("m")).collect()
    assert {r["code"] for r in seen} == {"ECONOMY", "PROMO"}
    assert all(r["n"] == r["m"] + 1 for r in seen)
