"""Analysis inputs derived from the star-schema tables of a data folder.

Sample = supplier (or the supplier's nation), feature = part lineage, value =
summed quantity; the documented mapping of ``FIXTURES.md``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from taxaloom.session import freeze

NATIONS = [f"NATION_{i}" for i in range(25)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p_partkey, leaf, leaf_ids``: seven-level clade path and tax id path of every part."""
    part = table(spark, sf_dir, "part")
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))
    size = F.col("p_size").cast("string")
    family = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    unknown = F.col("p_size") % 10 == 0
    names = [
        F.lit("k__Part"),
        _text("p__", F.col("p_type")),
        _text("c__", F.col("p_type"), "_c"),
        _text("o__", F.col("p_type"), "_o"),
        _text("f__", family),
        _text("g__", brand),
        F.when(unknown, _text("s__GGB", size, "_SGB", F.col("p_partkey").cast("string"))).otherwise(
            _text("s__", brand, "_", size)
        ),
    ]
    code = F.ascii("p_type").cast("string")
    ids = [
        F.lit("2"),
        code,
        _text(code, "1"),
        _text(code, "2"),
        F.ascii(family).cast("string"),
        F.replace(brand, F.lit("Brand"), F.lit("")),
        size,
    ]
    return part.select(
        "p_partkey", F.concat_ws("|", *names).alias("leaf"), F.concat_ws("|", *ids).alias("leaf_ids")
    )


def _observations(spark: SparkSession, sf_dir: str, sample: str) -> DataFrame:
    """One row per order line: sample, seven-level clade path and tax id path, quantity."""
    lineage = _lineages(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_quantity").alias("q"))
    if sample == "nation":
        owner = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("sample_name"))
        lines = lines.join(owner, lines.l_suppkey == owner.s_suppkey).join(
            nation, F.col("s_nationkey") == F.col("n_nationkey")
        )
    else:
        lines = lines.withColumn("sample_name", _text("S", F.col("l_suppkey").cast("string")))
    return lines.join(lineage, lines.l_partkey == lineage.p_partkey).select("sample_name", "leaf", "leaf_ids", "q")


def profile(
    spark: SparkSession,
    sf_dir: str,
    depths: Sequence[int] = (1, 2, 3, 4, 5, 6, 7),
    with_tax: bool = False,
    sample: str = "supplier",
) -> DataFrame:
    """Taxonomic profile ``(sample_name, clade_name[, ncbi_tax_id], relative_abundance, cnt)``."""
    obs = _observations(spark, sf_dir, sample)
    leaf_keys = ["leaf", "leaf_ids"] if with_tax else ["leaf"]
    keys = ["clade_name", "ncbi_tax_id"] if with_tax else ["clade_name"]
    # One row per sample: with their size known the clades needn't be exchanged for it.
    total = freeze(obs.groupBy("sample_name").agg(F.sum("q").alias("_total")))
    if list(depths) == [7]:
        leaf = obs.groupBy("sample_name", *leaf_keys).agg(F.sum("q").alias("cnt"))
        per_clade = leaf.toDF("sample_name", *keys, "cnt")
    else:
        per_clade = _clades(obs, leaf_keys, keys, depths)
    return per_clade.join(total, "sample_name").select(
        "sample_name", *keys, (F.lit(100.0) * F.col("cnt") / F.col("_total")).alias("relative_abundance"), "cnt"
    )


def clades(spark: SparkSession, sf_dir: str, with_tax: bool = False) -> DataFrame:
    """The distinct clades ``(clade_name[, ncbi_tax_id])`` of :func:`profile`, which need no sums by sample.

    They are the clades of the parts that an order line of a supplier names.
    """
    lines = table(spark, sf_dir, "lineitem").filter("l_suppkey IS NOT NULL").select("l_partkey").distinct()
    lineage = _lineages(spark, sf_dir)
    keys = {"leaf": "clade_name"} | ({"leaf_ids": "ncbi_tax_id"} if with_tax else {})
    named = lineage.join(lines, lineage.p_partkey == lines.l_partkey, "left_semi").select(*keys).distinct()
    paths = [F.struct(*[F.substring_index(c, "|", d).alias(k) for c, k in keys.items()]) for d in range(1, 8)]
    return named.select(F.inline(F.array(*paths))).distinct()


#: Depth at which the clades of a sample are dealt to tasks.
DEALT = 5


def _clades(obs: DataFrame, leaf_keys: list[str], keys: list[str], depths: Sequence[int]) -> DataFrame:
    """Sums per sample and clade of the depths.

    Order lines are exchanged once, by sample and clade of depth ``DEALT``: from
    there on all deeper clades are summed where they are, and only one sum per
    clade of that depth goes up to the levels above.
    """
    def paths(some, up: bool) -> list[Column]:
        return [
            F.struct(*[F.substring_index(c, "|", d).alias(k) for c, k in zip(leaf_keys, keys)], F.lit(up).alias("_up"))
            for d in some
        ]

    high = [d for d in depths if d < DEALT]
    levels = paths([d for d in depths if d >= DEALT], False) + (paths([DEALT], True) if high else [])
    dealt = obs.withColumn("_at", F.substring_index("leaf", "|", DEALT)).repartition("sample_name", "_at")
    leaf = dealt.groupBy("sample_name", "_at", *leaf_keys).agg(F.sum("q").alias("cnt"))
    sums = (
        leaf.select("sample_name", "_at", "cnt", F.inline(F.array(*levels)))
        .groupBy("sample_name", "_at", *keys, "_up").agg(F.sum("cnt").alias("cnt"))
    )
    # A path of fewer levels is a clade of several depths, so it is summed with those above.
    whole = ~F.col("_up") & (F.size(F.split("clade_name", r"\|")) >= DEALT)
    above = F.when(F.col("_up"), F.array(*[
        F.struct(*[F.substring_index(k, "|", d).alias(k) for k in keys]) for d in high
    ]) if high else F.array(F.struct(*keys))).otherwise(F.array(F.struct(*keys)))
    return sums.filter(whole).select("sample_name", *keys, "cnt").unionByName(
        sums.filter(~whole).select("sample_name", "cnt", F.inline(above))
        .groupBy("sample_name", *keys).agg(F.sum("cnt").alias("cnt"))
    )


def species(spark: SparkSession, sf_dir: str, value: str = "relative_abundance") -> DataFrame:
    """Species-level clades as ``(sample_name, feature, value)``."""
    return profile(spark, sf_dir, depths=[7]).select(
        "sample_name", F.col("clade_name").alias("feature"), F.col(value).alias("value")
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sample_name, group)`` of the suppliers that have order lines."""
    supplier = table(spark, sf_dir, "supplier")
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey")
    return supplier.join(lines, supplier.s_suppkey == lines.l_suppkey, "left_semi").select(
        _text("S", F.col("s_suppkey").cast("string")).alias("sample_name"),
        F.when(F.col("s_suppkey") % 2 == 1, "treatment").otherwise("control").alias("group"),
    )


def functional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Functional profile ``(sample_name, term, abundance)`` with strata and their unstratified sums."""
    part = table(spark, sf_dir, "part")
    brand = F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))
    stratum = F.when(F.col("p_size") < 3, "unclassified").otherwise(
        _text("g__", brand, ".s__", brand, "_", F.col("p_size").cast("string"))
    )
    term = _text(F.col("p_type"), ": ", F.col("p_type"), " function")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    strata = (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .select(_text("S", F.col("l_suppkey").cast("string")).alias("sample_name"), term.alias("t"),
                stratum.alias("s"), "l_quantity")
        .groupBy("sample_name", "t", "s")
        .agg(F.sum("l_quantity").alias("abundance"))
    )
    both = strata.select(
        "sample_name", "abundance", F.explode(F.array(F.col("t"), _text(F.col("t"), "|", F.col("s")))).alias("term")
    )
    return both.groupBy("sample_name", "term").agg(F.sum("abundance").alias("abundance"))


def gene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gene counts ``(sample_name, gene_id, gene_name, count)``; a tenth of the genes has no name."""
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .groupBy(
            _text("S", F.col("l_suppkey").cast("string")).alias("sample_name"),
            _text("K", F.col("l_partkey").cast("string")).alias("gene_id"),
            F.when(F.col("p_size") % 10 == 0, "-").otherwise(F.col("p_name")).alias("gene_name"),
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("count"))
    )


def ko_abundance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KO abundances ``(sample_name, ko, value)``."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        _text("S", F.col("l_suppkey").cast("string")).alias("sample_name"),
        _text("K", F.col("l_partkey").cast("string")).alias("ko"),
    ).agg(F.sum("l_quantity").alias("value"))


def module_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module membership ``(module_id, ko)``: parts of one size form a module."""
    return table(spark, sf_dir, "part").select(
        _text("M", F.col("p_size").cast("string")).alias("module_id"),
        _text("K", F.col("p_partkey").cast("string")).alias("ko"),
    )


def module_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module steps ``(module, step, alternative, ko)``: module = size, step = key mod 3, alternative = key mod 4."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        _text("M", F.col("p_size").cast("string")).alias("module"),
        (key % 3).cast("int").alias("step"),
        (key % 4).cast("int").alias("alternative"),
        _text("K", key.cast("string")).alias("ko"),
    )


def regroup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-to-many map ``(gene_family, group_id)``: part → its type and its brand."""
    return table(spark, sf_dir, "part").select(
        _text("K", F.col("p_partkey").cast("string")).alias("gene_family"),
        F.explode(F.array("p_type", F.replace(F.col("p_brand"), F.lit("#"), F.lit("")))).alias("group_id"),
    )


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequencing reads ``(file, read_id, seq, qual)``: the whole text of every document as one read."""
    text = F.lower("text")
    seq = F.translate(
        F.regexp_replace(text, r"[^a-z]", "n"), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"
    )
    # Every source character yields one base and one quality character.
    qual = F.translate(F.regexp_replace(text, r"[^a-z]", "!"), "abcdefghijklmnopqrstuvwxyz", "56789:;<=>?@ABCDEFGHI+,-./")
    return table(spark, sf_dir, "documents").select(
        _text(F.col("source"), "_", F.col("lang")).alias("file"),
        _text("r", F.col("doc_id").cast("string")).alias("read_id"),
        seq.alias("seq"),
        qual.alias("qual"),
    )


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment rows ``(qname, flag, seq, qual)``, two per pair name, flag by event type."""
    kind = F.col("event_type")
    flag = (
        F.when(kind == "view", 77).when(kind == "click", 141).when(kind == "error", 73).when(kind == "signup", 133)
    ).otherwise(333)
    return table(spark, sf_dir, "events").select(
        _text("r", F.expr("event_id div 2").cast("string")).alias("qname"),
        flag.alias("flag"),
        F.md5(F.col("event_id").cast("string")).alias("seq"),
        F.lit("I" * 32).alias("qual"),
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-read classification ``(status, read_id, taxid, length, kmers)``: reads = orders, taxon = customer.

    Customers with a negative balance hold their reads at nation level; orders
    of priority 5 are unclassified.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    unclassified = F.col("o_orderpriority").startswith("5")
    taxid = F.when(F.col("c_acctbal") < 0, 100 + F.col("c_nationkey")).otherwise(1000 + F.col("c_custkey"))
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.when(unclassified, "U").otherwise("C").alias("status"),
        _text("r", F.col("o_orderkey").cast("string")).alias("read_id"),
        F.when(unclassified, 0).otherwise(taxid).cast("bigint").alias("taxid"),
        F.lit("150").alias("length"),
        F.lit("").alias("kmers"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxonomy nodes ``(taxid, parent, rank_code, name)``: root, region, nation, customer."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")

    def node(df, taxid, parent, rank, name):
        return df.select(
            taxid.cast("bigint").alias("taxid"), parent.cast("bigint").alias("parent"),
            F.lit(rank).alias("rank_code"), name.alias("name"),
        )

    root = spark.range(1).select(
        F.lit(1).cast("bigint").alias("taxid"), F.lit(None).cast("bigint").alias("parent"),
        F.lit("R").alias("rank_code"), F.lit("root").alias("name"),
    )
    return (
        root.unionByName(node(region, 10 + F.col("r_regionkey"), F.lit(1), "D", F.col("r_name")))
        .unionByName(node(nation, 100 + F.col("n_nationkey"), 10 + F.col("n_regionkey"), "G", F.col("n_name")))
        .unionByName(node(customer, 1000 + F.col("c_custkey"), 100 + F.col("c_nationkey"), "S", F.col("c_name")))
    )


def ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ancestor-or-self pairs ``(taxid, ancestor)`` of the four-level taxonomy."""
    region = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey"), (10 + F.col("n_regionkey")).cast("bigint").alias("region")
    )
    customer = table(spark, sf_dir, "customer").join(region, F.col("c_nationkey") == F.col("n_nationkey"))
    own = (1000 + F.col("c_custkey")).cast("bigint")
    nat = (100 + F.col("c_nationkey")).cast("bigint")
    big = lambda v: F.lit(v).cast("bigint")
    leaf = customer.select(own.alias("taxid"), F.explode(F.array(own, nat, F.col("region"), big(1))).alias("ancestor"))
    self_n = (100 + F.col("n_nationkey")).cast("bigint")
    mid = region.select(self_n.alias("taxid"), F.explode(F.array(self_n, F.col("region"), big(1))).alias("ancestor"))
    return leaf.unionByName(mid)
