"""Scans and exports. Inputs are first written as the text files the readers expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.operators import matrix as M, testing as X
from taxaloom.operators.ordered import place
from taxaloom.plans.oracle import NATIONS, sql
from taxaloom.plans.register import query, r6
from taxaloom.session import freeze, staging_path
from taxaloom.sources import files, joined, params, sinks, tables as T


def _per_sample(df: DataFrame, name: str, header: bool = False) -> tuple[str, DataFrame]:
    """Write ``df`` as TSV files per sample and return the folder and their ``(sample_name, path)``."""
    path = staging_path(df.sparkSession, name)
    return path, sinks.write_files(df, path, "sample_name", header)


@query(
    "a01_profile_scan",
    sql("SELECT sample_name, clade_name, ncbi_tax_id, round(ra, 6) AS relative_abundance FROM prof", "prof"),
)
def profile_scan(spark, sf):
    prof = T.profile(spark, sf, with_tax=True).select(
        "sample_name", "clade_name", "ncbi_tax_id", "relative_abundance", F.lit("").alias("additional_species")
    )
    root, manifest = _per_sample(prof, "profiles")
    out = files.read_profiles(spark, root, manifest)
    return out.select("sample_name", "clade_name", "ncbi_tax_id", r6("relative_abundance", "relative_abundance"))


@query("a02_term_scan_by_file", sql("SELECT sample_name, term, abundance FROM func", "func"))
def term_scan_by_file(spark, sf):
    # The path carries the sample; the file-name rule itself is checked in the tests.
    root, manifest = _per_sample(T.functional(spark, sf).select("sample_name", "term", "abundance"), "terms", header=True)
    named = files.read_terms(spark, root, manifest)
    return named.select("sample_name", "term", "abundance")


@query("a02b_term_scan_by_file_name", sql("SELECT sample_name, term, abundance FROM func", "func"))
def term_scan_by_file_name(spark, sf):
    """One file per sample, named by it and the ending of its kind; the name is all that tells the sample."""
    parts, root = staging_path(spark, "parts"), staging_path(spark, "named")
    terms = T.functional(spark, sf).select("sample_name", "term", "abundance")
    written = sinks.write_files(terms, parts, "sample_name", header=True, apart=False)
    listed = written.select("sample_name", F.lit(0).alias("position"), "path")
    freeze(joined.join_files(listed, root, ending=".Pathway.txt"))
    return files.read_terms(spark, root)


@query(
    "a03_term_scan_by_manifest",
    sql("SELECT sample_name, count(*) AS n_terms, round(sum(abundance), 6) AS total FROM func GROUP BY 1", "func"),
)
def term_scan_by_manifest(spark, sf):
    root, manifest = _per_sample(T.functional(spark, sf).select("sample_name", "term", "abundance"), "terms", header=True)
    out = files.read_terms(spark, root, manifest)
    return out.groupBy("sample_name").agg(
        F.count(F.lit(1)).alias("n_terms"), r6(F.sum("abundance"), "total")
    )


@query("a04_count_scan", sql("SELECT sample_name, gene_id, gene_name, count FROM genes", "genes"))
def count_scan(spark, sf):
    genes = T.gene_counts(spark, sf).select("sample_name", "gene_id", "gene_name", "count", F.lit(0).alias("length"))
    root, manifest = _per_sample(genes, "counts", header=True)
    return files.read_counts(spark, root, manifest)


def _nation_terms(spark, sf) -> DataFrame:
    owner = T.table(spark, sf, "supplier").join(
        T.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_name"), "n_name")
    return (
        T.functional(spark, sf).join(owner, "sample_name")
        .groupBy(F.col("n_name").alias("sample_name"), "term").agg(F.sum("abundance").alias("value"))
    )


def _nation_groups(spark, sf) -> DataFrame:
    return T.table(spark, sf, "nation").select(
        F.col("n_name").alias("sample_name"),
        F.when(F.col("n_nationkey") % 2 == 1, "treatment").otherwise("control").alias("group"),
    )


@query(
    "a05_pcl_scan",
    sql(
        """SELECT sample_name, feature, value, grp AS "group" FROM
  (SELECT sample_name, term AS feature, abundance AS value FROM func_n) JOIN
  (SELECT n_name AS sample_name, CASE WHEN n_nationkey % 2 = 1 THEN 'treatment' ELSE 'control' END AS grp FROM nation)
  USING (sample_name) WHERE value <> 0""",
        "func_n",
    ),
)
def pcl_scan(spark, sf):
    wide = M.to_wide(_nation_terms(spark, sf), NATIONS, ["term"])
    path = staging_path(spark, "pcl")
    sinks.write_pcl(sinks.to_pcl(wide, _nation_groups(spark, sf), NATIONS), path)
    features, meta = files.read_pcl(spark, path, "group")
    groups = meta.filter(F.col("name") == "group").select("sample_name", F.col("level").alias("group"))
    return features.filter("value <> 0").join(groups, "sample_name")


@query(
    "a06_module_scan",
    "SELECT 'M' || p_size AS module_id, 'K' || p_partkey AS ko FROM part",
)
def module_scan(spark, sf):
    path = staging_path(spark, "modules")
    # Ids of one module are split over lines of about fifty, so that no line grows with the table.
    members = T.module_members(spark, sf)
    sizes = members.groupBy("module_id").agg(F.ceil(F.count(F.lit(1)) / 50).alias("_lines"))
    members = members.join(sizes, "module_id").withColumn("_line", F.pmod(F.xxhash64("ko"), F.col("_lines")))
    lines = members.groupBy("module_id", "_line").agg(F.array_join(F.collect_list("ko"), ",").alias("kos"))
    lines.select("module_id", F.lit("size").alias("d"), "kos").write.option("sep", "\t").csv(path)
    return files.read_modules(spark, path).select("module_id", F.explode("kos").alias("ko"))


def _params_file(spark, sf) -> str:
    """A params document: the sample lists of both groups."""
    path = staging_path(spark, "params")
    item = F.struct("sample_name", F.concat(F.lit("/data/"), "sample_name", F.lit("_profile.txt")).alias("profile"),
                    F.concat(F.lit("/data/"), "sample_name", F.lit("_counts.tsv")).alias("count"))
    doc = T.metadata(spark, sf).agg(
        F.collect_list(F.when(F.col("group") == "control", item)).alias("control"),
        F.collect_list(F.when(F.col("group") == "treatment", item)).alias("treatment"),
    ).withColumn("groups_name", F.create_map(
        F.lit("control"), F.lit("healthy"), F.lit("treatment"), F.lit("case")
    )).withColumn("top_num", F.lit(10))
    doc.write.json(path)
    return path


@query(
    "a07_params_scan",
    sql(
        """SELECT sample_name, grp AS list, CASE grp WHEN 'control' THEN 'healthy' ELSE 'case' END AS "group",
  '/data/' || sample_name || '_profile.txt' AS profile FROM meta""",
        "meta",
    ),
)
def params_scan(spark, sf):
    rows = params.sample_rows(spark, _params_file(spark, sf), ["control", "treatment"])
    return rows.select("sample_name", "list", "group", F.col("files")["profile"].alias("profile"))


@query(
    "a08_channel_rows",
    sql(
        """SELECT sample_name AS id, '/data/' || sample_name || '_profile.txt|/data/' || sample_name || '_counts.tsv'
  AS files FROM meta""",
        "meta",
    ),
)
def channel_rows(spark, sf):
    rows = params.sample_rows(spark, _params_file(spark, sf), ["control", "treatment"])
    return params.channel(rows, "profile", "count").select("id", F.array_join("files", "|").alias("files"))


@query(
    "a09_order_scan",
    sql("SELECT sample_name, row_number() OVER (ORDER BY sample_name) - 1 AS position FROM meta", "meta"),
)
def order_scan(spark, sf):
    path = staging_path(spark, "order")
    sinks.write_lines(T.metadata(spark, sf).orderBy("sample_name"), "sample_name", path)
    return files.read_order(spark, path)


_READS = """SELECT source || '_' || lang AS file, 'r' || doc_id AS read_id,
  translate(regexp_replace(lower(text), '[^a-z]', 'n', 'g'), 'abcdefghijklmnopqrstuvwxyz',
            'ACGTACGTACGTACGTACGTACGTAC') AS seq,
  translate(regexp_replace(lower(text), '[^a-z]', '!', 'g'), 'abcdefghijklmnopqrstuvwxyz',
            '56789:;<=>?@ABCDEFGHI+,-./') AS qual FROM documents"""


@query("a10_fastq_scan", f"SELECT file, read_id, length(seq)::BIGINT AS len, md5(seq) AS seq, md5(qual) AS qual FROM ({_READS})")
def fastq_scan(spark, sf):
    path = staging_path(spark, "reads")
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id", F.lit(" 1")), "seq", F.lit("+"), "qual")
    T.reads(spark, sf).select("file", record.alias("value")).write.partitionBy("file").option(
        "compression", "gzip"
    ).text(path)
    label = F.regexp_extract("path", r"file=([^/]+)/", 1)
    out = files.read_fastq(spark, path, file=label)
    return out.select("file", "read_id", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("seq"),
                      F.md5("qual").alias("qual"))


_ASSIGNMENTS = """SELECT CASE WHEN o_orderpriority LIKE '5%' THEN 'U' ELSE 'C' END AS status, 'r' || o_orderkey AS read_id,
  (CASE WHEN o_orderpriority LIKE '5%' THEN 0 WHEN c_acctbal < 0 THEN 100 + c_nationkey
        ELSE 1000 + c_custkey END)::BIGINT AS taxid, '150' AS length
FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("a11_assignment_scan", _ASSIGNMENTS)
def assignment_scan(spark, sf):
    path = staging_path(spark, "assignments")
    sinks.write_table(T.assignments(spark, sf), path, header=False)
    return files.read_assignments(spark, path).drop("kmers")


_TREE = """tree AS (SELECT 1::BIGINT AS taxid, NULL::BIGINT AS parent, 'R' AS rank_code, 'root' AS name
  UNION ALL SELECT 10 + r_regionkey, 1, 'D', r_name FROM region
  UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 'G', n_name FROM nation
  UNION ALL SELECT 1000 + c_custkey, 100 + c_nationkey, 'S', c_name FROM customer)"""
_ANCESTORS = """anc AS (SELECT taxid, taxid AS ancestor FROM tree
  UNION ALL SELECT anc.taxid, t.parent FROM anc JOIN tree t ON anc.ancestor = t.taxid WHERE t.parent IS NOT NULL)"""
_COUNTS = f"cnts AS (SELECT taxid, count(*) AS reads FROM ({_ASSIGNMENTS}) WHERE status = 'C' GROUP BY 1)"
_REPORT = """report AS (SELECT 100.0 * c.clade_reads / (SELECT sum(reads) FROM cnts) AS pct,
  c.clade_reads::BIGINT AS clade_reads, coalesce(d.reads, 0)::BIGINT AS taxon_reads, t.rank_code, t.taxid, t.name
FROM (SELECT ancestor, sum(reads) AS clade_reads FROM cnts JOIN anc USING (taxid) GROUP BY 1) c
JOIN tree t ON t.taxid = c.ancestor LEFT JOIN cnts d ON d.taxid = t.taxid)"""
REPORT_CTES = f"WITH RECURSIVE {_TREE}, {_ANCESTORS}, {_COUNTS}, {_REPORT}\n"


@query(
    "a11b_report_scan",
    REPORT_CTES + "SELECT round(pct, 6) AS pct, clade_reads, taxon_reads, rank_code, taxid, name FROM report",
)
def report_scan(spark, sf):
    from taxaloom.operators import reads, trees

    counts, tree = reads.taxon_counts(T.assignments(spark, sf)), T.taxonomy(spark, sf)
    report = reads.clade_report(counts, tree, trees.nested_sets(tree))
    path = staging_path(spark, "report")
    sinks.write_table(report.withColumn("name", F.concat(F.lit("  "), "name")), path, header=False)
    return files.read_report(spark, path).withColumn("pct", r6("pct", "pct"))


@query(
    "a12_relation_scan",
    """SELECT 'rel' || n_nationkey AS relation_id, n_name AS component_id, r_name AS parent_component_id,
  n_nationkey::BIGINT AS order_index FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def relation_scan(spark, sf):
    rel = T.table(spark, sf, "nation").join(T.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = staging_path(spark, "relations")
    rows = rel.select(
        F.concat(F.lit("rel"), F.col("n_nationkey").cast("string")).alias("relation_id"),
        F.lit("file_script").alias("relation_type"), F.col("n_name").alias("component_id"),
        F.col("r_name").alias("parent_component_id"), F.col("n_nationkey").alias("order_index"),
    )
    rows.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).write.text(path)
    return files.read_relations(spark, path).select(
        "relation_id", "component_id", "parent_component_id", "order_index"
    )


# -- exports: what was written is read back ----------------------------------

_WIDE_SUMS = ", ".join(
    f"round(coalesce(sum(v) FILTER (sample_name = '{n}'), 0), 6) + 0.0 AS \"{n}\"" for n in NATIONS
)


def _nation_profile(spark, sf, **kw):
    return T.profile(spark, sf, sample="nation", **kw)


def _rounded(df, cols):
    return df.select(*[c for c in df.columns if c not in cols], *[r6(F.col(f"`{c}`").cast("double"), c) for c in cols])


@query(
    "b01_wide_matrix",
    sql(f"SELECT clade_name, {_WIDE_SUMS} FROM (SELECT sample_name, clade_name, ra AS v FROM prof_n) GROUP BY 1", "prof_n"),
)
def wide_matrix(spark, sf):
    wide = M.to_wide(_nation_profile(spark, sf), NATIONS, ["clade_name"], "relative_abundance")
    path = staging_path(spark, "matrix")
    sinks.write_table(wide, path)
    back = spark.read.schema(wide.schema).option("sep", "\t").option("header", True).csv(path)
    return _rounded(back, NATIONS)


_RANK_OF_DEPTH = (
    "['KINGDOM', 'PHYLUM', 'CLASS', 'ORDER', 'FAMILY', 'GENUS', 'SPECIES', 'SGB'][len(string_split(clade_name, '|'))]"
)


@query(
    "b02_file_per_rank",
    sql(f"SELECT {_RANK_OF_DEPTH} AS rank, sample_name, clade_name, round(ra, 6) AS relative_abundance FROM prof", "prof"),
)
def file_per_rank(spark, sf):
    path = staging_path(spark, "by-rank")
    sinks.write_by(M.annotate(T.profile(spark, sf)).select("sample_name", "clade_name", "relative_abundance", "rank"), path, "rank")
    schema = "sample_name string, clade_name string, relative_abundance double, rank string"
    back = spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
    return back.withColumn("relative_abundance", r6("relative_abundance", "relative_abundance"))


@query(
    "b03_result_with_abundances",
    sql(
        f"""SELECT clade_name AS feature, total, {_WIDE_SUMS} FROM (SELECT sample_name, clade_name, cnt AS v,
  sum(cnt) OVER (PARTITION BY clade_name) AS total FROM prof_n) GROUP BY 1, 2""",
        "prof_n",
    ),
)
def result_with_abundances(spark, sf):
    df = _nation_profile(spark, sf).select("sample_name", F.col("clade_name").alias("feature"), F.col("cnt").alias("value"))
    result = df.groupBy("feature").agg(F.sum("value").alias("total"))
    return _rounded(sinks.attach_wide(result, M.to_wide(df, NATIONS)), NATIONS)


_ALPHA = """alpha AS (SELECT sample_name,
  -sum(p * log2(p)) AS shannon, count(*) AS species_richness, 1 - sum(p * p) AS simpson,
  count(*) + f1 * (f1 - 1) / (2.0 * (f2 + 1)) AS chao1,
  CASE WHEN count(*) > 1 THEN -sum(p * ln(p)) / ln(count(*)) END AS pielou_e
FROM (SELECT sample_name, cnt / sum(cnt) OVER (PARTITION BY sample_name) AS p,
  count(*) FILTER (cnt = 1) OVER (PARTITION BY sample_name) AS f1,
  count(*) FILTER (cnt = 2) OVER (PARTITION BY sample_name) AS f2 FROM species) GROUP BY sample_name, f1, f2)"""


@query(
    "b04_diversity_table",
    sql(
        f""", {_ALPHA} SELECT sample_name, round(shannon, 6) AS shannon, species_richness, round(simpson, 6) AS simpson,
  round(chao1, 6) AS chao1, round(pielou_e, 6) AS pielou_e, grp AS "group" FROM alpha JOIN meta USING (sample_name)""",
        "species", "meta",
    ),
)
def diversity_table(spark, sf):
    from taxaloom.operators import pairs

    table = M.with_group(pairs.alpha(T.species(spark, sf, "cnt")), T.metadata(spark, sf))
    path = staging_path(spark, "diversity")
    sinks.write_table(table, path)
    back = spark.read.schema(table.schema).option("sep", "\t").option("header", True).csv(path)
    return back.select(
        "sample_name", r6("shannon", "shannon"), "species_richness", r6("simpson", "simpson"), r6("chao1", "chao1"),
        r6("pielou_e", "pielou_e"), "group",
    )


_NATION_TEXT = ", ".join(
    f"CASE WHEN _order = 0 THEN '{'treatment' if i % 2 else 'control'}' ELSE "
    f"printf('%.3f', coalesce(sum(v) FILTER (sample_name = '{n}'), 0)) END AS \"{n}\""
    for i, n in enumerate(NATIONS)
)


@query(
    "b05_pcl_export",
    sql(
        f"""SELECT _order::INTEGER AS _order, term, {_NATION_TEXT} FROM (
  SELECT 1 AS _order, sample_name, term, abundance AS v FROM func_n UNION ALL SELECT 0, '', 'group', 0
) GROUP BY _order, term""",
        "func_n",
    ),
)
def pcl_export(spark, sf):
    wide = M.to_wide(_nation_terms(spark, sf), NATIONS, ["term"])
    text = wide.select("term", *[sinks.plain_decimal(F.col(n), 3).alias(n) for n in NATIONS])
    return sinks.to_pcl(text, _nation_groups(spark, sf), NATIONS)


@query(
    "b05b_matrix_lines",
    sql(
        """SELECT CASE name WHEN 'term' THEN 0 WHEN 'group' THEN 1 ELSE 2 END::INTEGER AS _order, name,
  name || chr(9) || string_agg(cell, chr(9) ORDER BY n) AS line FROM (
  SELECT n_nationkey AS n, 'term' AS name, n_name AS cell FROM nation UNION ALL
  SELECT n_nationkey, 'group', CASE WHEN n_nationkey % 2 = 1 THEN 'treatment' ELSE 'control' END FROM nation UNION ALL
  SELECT n_nationkey, t.term, coalesce(printf('%.3f', abundance), '0') FROM nation
    CROSS JOIN (SELECT DISTINCT term FROM func_n) t LEFT JOIN func_n f ON f.sample_name = n_name AND f.term = t.term) GROUP BY name""",
        "func_n",
    ),
)
def matrix_lines(spark, sf):
    """The stacked matrix as the lines of its file: header, group row, features."""
    nation = T.table(spark, sf, "nation").select(F.col("n_name").alias("sample_name"), F.col("n_nationkey").alias("position"))
    marks = _nation_groups(spark, sf).select("sample_name", F.lit("group").alias("name"), F.col("group").alias("level"))
    terms = _nation_terms(spark, sf).filter("value <> 0")
    return sinks.matrix_lines(terms, nation, "term", marks, digits=3)


@query("a05b_wide_round_trip", sql("SELECT sample_name, term AS feature, round(abundance, 6) AS value FROM func WHERE abundance <> 0", "func"))
def wide_round_trip(spark, sf):
    """Terms of all suppliers, written as a matrix with one cell per supplier in every line, and read back."""
    terms = freeze(T.functional(spark, sf).select("sample_name", "term", F.col("abundance").alias("value")))
    names = place(terms.select("sample_name").distinct(), [], [("sample_name", False)])
    path = staging_path(spark, "matrix")
    sinks.write_matrix(terms, names, path, key="term")
    return files.read_matrix(spark, path).withColumn("value", r6("value", "value"))


@query(
    "b06_class_matrix",
    sql(
        f"""SELECT _order::INTEGER AS _order, sample_name, {_NATION_TEXT.replace("sample_name =", "s =")} FROM (
  SELECT 1 AS _order, sample_name AS s, clade_name AS sample_name, cnt AS v FROM prof_n WHERE NOT contains(clade_name, 't__')
  UNION ALL SELECT 0, '', 'group', 0) GROUP BY _order, sample_name""",
        "prof_n",
    ),
)
def class_matrix(spark, sf):
    df = _nation_profile(spark, sf).select("sample_name", F.col("clade_name").alias("feature"), F.col("cnt").alias("value"))
    out = sinks.to_class_matrix(df, _nation_groups(spark, sf), NATIONS)
    cells = [
        F.when(F.col("_order") == 0, F.col(n)).otherwise(sinks.plain_decimal(F.col(n).cast("double"), 3)).alias(n)
        for n in NATIONS
    ]
    return out.select("_order", "sample_name", *cells)


@query(
    "b07_code_list",
    sql(
        """SELECT string_agg(code, ',' ORDER BY total, term) AS codes FROM (
  SELECT term, split_part(term, ':', 1) AS code, sum(abundance) AS total FROM func
  WHERE NOT contains(term, '|') GROUP BY 1)""",
        "func",
    ),
)
def significant_codes(spark, sf):
    totals = M.unstratified(T.functional(spark, sf)).groupBy("term").agg(F.sum("abundance").alias("total"))
    path = staging_path(spark, "codes")
    sinks.write_lines(sinks.code_list(totals, "term", "total"), "codes", path)
    return spark.read.text(path).withColumnRenamed("value", "codes")


@query(
    "b07b_significant_codes",
    sql("SELECT string_agg(split_part(feature, ':', 1), ',' ORDER BY round(p, 9), feature) AS codes FROM tested WHERE p < 0.2", "tested"),
)
def codes_of_significant(spark, sf):
    """Only the features with a small p-value, the smallest first."""
    tested = X.rank_sum(T.species(spark, sf), T.metadata(spark, sf)).filter("p < 0.2")
    return sinks.code_list(tested.select("feature", F.round("p", 9).alias("p")), "feature", "p")


@query("b08_overwrite_output", sql("SELECT sample_name, grp AS \"group\" FROM meta WHERE grp = 'control'", "meta"))
def overwrite_output(spark, sf):
    path = staging_path(spark, "overwrite")
    meta = T.metadata(spark, sf)
    sinks.write_table(meta, path)
    sinks.write_table(meta.filter(F.col("group") == "control"), path)
    return spark.read.schema("sample_name string, group string").option("sep", "\t").option("header", True).csv(path)


@query(
    "b09_write_order",
    sql("SELECT sample_name, row_number() OVER (ORDER BY total DESC, sample_name) - 1 AS position FROM "
        "(SELECT sample_name, sum(cnt) AS total FROM species GROUP BY 1)", "species"),
)
def write_sample_order(spark, sf):
    totals = T.species(spark, sf, "cnt").groupBy("sample_name").agg(F.sum("value").alias("total"))
    path = staging_path(spark, "sample-order")
    sinks.write_lines(totals.orderBy(F.desc("total"), "sample_name"), "sample_name", path)
    return files.read_order(spark, path)


@query(
    "b10_module_table",
    sql(
        """SELECT sample_name, module_id, printf('%.4f', coalesce(score, 0)) AS score FROM
  (SELECT DISTINCT sample_name FROM ko) CROSS JOIN (SELECT DISTINCT 'M' || p_size AS module_id FROM part)
  LEFT JOIN (SELECT sample_name, 'M' || p_size AS module_id, sum(value) AS score
             FROM ko JOIN part ON ko.ko = 'K' || p_partkey GROUP BY ALL) USING (sample_name, module_id)""",
        "ko",
    ),
)
def module_table(spark, sf):
    from taxaloom.operators import functional

    scores = functional.module_sum(T.ko_abundance(spark, sf), T.module_members(spark, sf))
    path = staging_path(spark, "module-scores")
    sinks.write_table(scores.select("sample_name", "module_id", sinks.plain_decimal("score", 4).alias("score")), path)
    schema = "sample_name string, module_id string, score string"
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


@query(
    "b11_output_per_sample",
    sql("SELECT sample_name, clade_name, round(ra, 6) AS relative_abundance FROM prof", "prof"),
)
def output_per_sample(spark, sf):
    path = staging_path(spark, "by-sample")
    sinks.write_by(T.profile(spark, sf).drop("cnt"), path, "sample_name")
    schema = "clade_name string, relative_abundance double, sample_name string"
    back = spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
    return back.select("sample_name", "clade_name", r6("relative_abundance", "relative_abundance"))


