"""Functional profiles, read-level tables and incremental ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F, types as Y

from taxaloom.operators import functional as K, matrix as M, ordered as O, reads as R, trees
from taxaloom.plans.oracle import sql
from taxaloom.plans.queries_composition import input_order
from taxaloom.plans.queries_io import _ASSIGNMENTS, _READS, REPORT_CTES
from taxaloom.plans.register import query, r6
from taxaloom.session import freeze, shuffle_width, staging_path
from taxaloom.sources import files, joined, sinks, tables as T
from taxaloom.sources.fastq import list_files
from taxaloom.streaming import ingest as S


_MAP = """rmap AS (SELECT 'K' || p_partkey AS ko, unnest([p_type, replace(p_brand, '#', '')]) AS group_id FROM part)"""
# Gene families with two strata: lines in odd and even orders.
_FAMILIES = """fam AS (SELECT 'S' || l_suppkey AS sample_name, 'K' || l_partkey AS ko,
  CASE WHEN l_orderkey % 2 = 0 THEN 'g__Even' ELSE 'g__Odd' END AS stratum, sum(l_quantity) AS abundance FROM lineitem GROUP BY ALL)"""


def _families(spark, sf):
    lines = T.table(spark, sf, "lineitem")
    family = F.concat(F.lit("K"), F.col("l_partkey").cast("string"))
    stratum = F.when(F.col("l_orderkey") % 2 == 0, "g__Even").otherwise("g__Odd")
    strat = lines.groupBy(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sample_name"), family.alias("f"), stratum.alias("s")
    ).agg(F.sum("l_quantity").alias("abundance"))
    terms = F.explode(F.array(F.col("f"), F.concat_ws("|", "f", "s"))).alias("term")
    return strat.select("sample_name", "abundance", terms).groupBy("sample_name", "term").agg(
        F.sum("abundance").alias("abundance")
    )


@query(
    "k01_regroup",
    f"""WITH {_MAP}, {_FAMILIES} SELECT sample_name, term, sum(abundance) AS abundance FROM (
  SELECT sample_name, unnest([group_id, group_id || '|' || stratum]) AS term, abundance FROM fam JOIN rmap USING (ko)) GROUP BY ALL""",
)
def regroup(spark, sf):
    return K.regroup(_families(spark, sf), T.regroup_map(spark, sf))


@query(
    "k02_module_sum",
    sql(
        """SELECT sample_name, module_id, coalesce(score, 0) AS score FROM
  (SELECT DISTINCT sample_name FROM ko) CROSS JOIN (SELECT DISTINCT 'M' || p_size AS module_id FROM part)
  LEFT JOIN (SELECT sample_name, 'M' || p_size AS module_id, sum(value) AS score
             FROM ko JOIN part ON ko.ko = 'K' || p_partkey GROUP BY ALL) USING (sample_name, module_id)""",
        "ko",
    ),
)
def module_sum(spark, sf):
    return K.module_sum(T.ko_abundance(spark, sf), T.module_members(spark, sf))


@query(
    "k03_module_steps",
    sql(
        """, st AS (SELECT 'M' || p_size AS module, p_partkey % 3 AS step, p_partkey % 4 AS alternative, 'K' || p_partkey AS ko FROM part),
alt AS (SELECT a.* FROM (SELECT sample_name, module, step, alternative, avg(value) AS v, count(*) AS have
  FROM ko JOIN st USING (ko) GROUP BY ALL) a JOIN (SELECT module, step, alternative, count(*) AS need FROM st GROUP BY ALL) b
  USING (module, step, alternative) WHERE have = need),
best AS (SELECT sample_name, module, step, max(v) AS v FROM alt GROUP BY ALL)
SELECT sample_name, module, round(count(*) / any_value(n), 6) AS coverage, round(avg(v), 6) AS score FROM best
JOIN (SELECT module, count(DISTINCT step) AS n FROM st GROUP BY 1) USING (module) GROUP BY ALL""",
        "ko",
    ),
)
def module_steps(spark, sf):
    out = K.module_steps(T.ko_abundance(spark, sf), T.module_steps(spark, sf))
    return out.select("sample_name", "module", r6("coverage", "coverage"), r6("score", "score"))


@query(
    "k04_concatenate_reads",
    f"SELECT split_part(file, '_', 2) AS sample_name, count(*) AS n_reads, sum(length(seq))::BIGINT AS bases FROM ({_READS}) GROUP BY 1",
)
def concatenate_reads(spark, sf):
    sample = F.split_part("file", F.lit("_"), F.lit(2)).alias("sample_name")
    return T.reads(spark, sf).groupBy(sample).agg(
        F.count(F.lit(1)).alias("n_reads"), F.sum(F.length("seq")).cast("bigint").alias("bases")
    )


@query(
    "k04b_joined_read_files",
    f"SELECT file, read_id, length(seq)::BIGINT AS len, md5(seq) AS seq, md5(qual) AS qual FROM ({_READS})",
)
def joined_read_files(spark, sf):
    """Each sample's reads in three gzip files, joined as bytes to one and read back."""
    lanes, whole = staging_path(spark, "lanes"), staging_path(spark, "joined")
    record = F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")
    lane = F.pmod(F.xxhash64("read_id"), F.lit(3)).cast("int").alias("lane")
    written = T.reads(spark, sf).select("file", lane, record).repartition("file", "lane")
    written.write.partitionBy("file", "lane").option("compression", "gzip").text(lanes)
    # The list of the files that were written, a few per sample.
    files_of = spark.createDataFrame([(p,) for p, _ in list_files(lanes, "*.gz")], "path string").select(
        F.regexp_extract("path", "file=([^/]+)/", 1).alias("sample_name"),
        F.regexp_extract("path", "lane=([^/]+)/", 1).cast("int").alias("position"), "path",
    )
    made = freeze(joined.join_files(files_of, whole))
    label = F.regexp_extract("path", r"([^/]+?)\.[^/]*$", 1)
    out = files.read_fastq(spark, [r["path"] for r in made.select("path").collect()], file=label)
    return out.select("file", "read_id", F.length("seq").cast("bigint").alias("len"), F.md5("seq").alias("seq"),
                      F.md5("qual").alias("qual"))


@query(
    "k05_stratified_contributions",
    sql(
        """, st AS (SELECT split_part(term, ': ', 1) AS code, sample_name, split_part(string_split(term, '|')[2], '.', 1) AS feature,
  sum(abundance) AS value FROM func WHERE contains(term, '|') GROUP BY ALL),
best AS (SELECT code, feature, rn FROM (SELECT code, feature, row_number() OVER (PARTITION BY code ORDER BY sum(value) DESC, feature DESC) AS rn
  FROM st WHERE feature <> 'unclassified' GROUP BY code, feature) WHERE rn <= 15),
tops AS (SELECT code, sample_name, sum(value) AS s FROM st GROUP BY ALL),
fl AS (SELECT code, floor(log10(min(s))) AS fl FROM tops GROUP BY 1),
ord AS (SELECT code, sample_name, row_number() OVER (PARTITION BY code ORDER BY s DESC, sample_name) - 1 AS position FROM tops),
bars AS (SELECT code, sample_name, CASE WHEN rn IS NOT NULL OR st.feature = 'unclassified' THEN st.feature ELSE 'other' END AS feature,
  coalesce(rn, CASE WHEN st.feature = 'unclassified' THEN 17 ELSE 16 END)::INTEGER AS place, sum(value) AS value
  FROM st LEFT JOIN best USING (code, feature) GROUP BY ALL)
SELECT code, code || ' function' AS name, sample_name, position, grp AS "group", feature, place, value,
  round(value / s * (greatest(log10(s), fl) - fl), 6) AS height,
  round(fl + coalesce(sum(value / s * (greatest(log10(s), fl) - fl)) OVER (PARTITION BY code, sample_name ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS base
FROM bars JOIN tops USING (code, sample_name) JOIN fl USING (code) JOIN ord USING (code, sample_name) JOIN meta USING (sample_name)""",
        "func", "meta",
    ),
)
def stratified_contributions(spark, sf):
    rows = T.functional(spark, sf).select(
        "sample_name", F.col("term").alias("feature"), F.col("abundance").alias("value")
    )
    out = K.stratified_contributions(rows, T.metadata(spark, sf), input_order(spark, sf), None)
    return out.withColumn("height", r6("height", "height")).withColumn("base", r6("base", "base"))


@query("k05b_contributions_by_dendrogram")
def contributions_by_dendrogram(spark, sf):
    """Samples of every focal feature in the order of its Bray–Curtis dendrogram, within the metadata's groups."""
    rows = T.functional(spark, sf).select(
        "sample_name", F.col("term").alias("feature"), F.col("abundance").alias("value")
    )
    return K.stratified_contributions(
        rows, T.metadata(spark, sf), input_order(spark, sf), None, sort=("braycurtis", "metadata"), scaling="totalsum"
    )


@query(
    "k06_term_types",
    f"""WITH {_MAP}, {_FAMILIES} SELECT 'Family' AS term_type, sample_name, count(DISTINCT ko) AS n, sum(abundance) AS total
FROM fam GROUP BY ALL UNION ALL SELECT 'Group', sample_name, count(DISTINCT group_id), sum(abundance)
FROM fam JOIN rmap USING (ko) GROUP BY sample_name""",
)
def term_types(spark, sf):
    families = M.unstratified(_families(spark, sf))
    groups = K.regroup(families, T.regroup_map(spark, sf))
    both = families.withColumn("term_type", F.lit("Family")).unionByName(groups.withColumn("term_type", F.lit("Group")))
    path = staging_path(spark, "terms")
    sinks.write_by(both, path, "term_type")
    schema = "sample_name string, term string, abundance double, term_type string"
    back = spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)
    return back.groupBy("term_type", "sample_name").agg(F.count(F.lit(1)).alias("n"), F.sum("abundance").alias("total"))


# -- reads -------------------------------------------------------------------

@query(
    "l01_read_stats",
    f"""WITH r AS (SELECT file, length(seq)::BIGINT AS len, length(seq) - length(regexp_replace(seq, '[GC]', '', 'g')) AS gc,
  length(qual) - length(regexp_replace(qual, '[5-~]', '', 'g')) AS q20, length(qual) - length(regexp_replace(qual, '[?-~]', '', 'g')) AS q30
  FROM ({_READS})),
o AS (SELECT file, len, sum(len) OVER (PARTITION BY file ORDER BY len DESC RANGE UNBOUNDED PRECEDING) AS run, sum(len) OVER (PARTITION BY file) AS total FROM r)
SELECT file, count(*) AS num_seqs, sum(len)::BIGINT AS sum_len, min(len) AS min_len, round(avg(len), 6) AS avg_len, max(len) AS max_len,
  (SELECT max(len) FROM o WHERE o.file = r.file AND 2 * run >= total) AS n50, 0::BIGINT AS sum_gap,
  round(100.0 * sum(q20) / sum(len), 6) AS q20_percent, round(100.0 * sum(q30) / sum(len), 6) AS q30_percent,
  round(100.0 * sum(gc) / sum(len), 6) AS gc_percent, round(quantile_cont(len, 0.25), 6) AS q1,
  round(quantile_cont(len, 0.5), 6) AS q2, round(quantile_cont(len, 0.75), 6) AS q3 FROM r GROUP BY file""",
)
def read_stats(spark, sf):
    out = R.read_stats(T.reads(spark, sf))
    rounded = {c: r6(F.col(c).cast("double"), c) for c in ("avg_len", "q20_percent", "q30_percent", "gc_percent", "q1", "q2", "q3")}
    return out.select(*[rounded.get(c, F.col(c)) for c in out.columns])


_ALN = """aln AS (SELECT 'r' || (event_id // 2) AS qname, CASE event_type WHEN 'view' THEN 77 WHEN 'click' THEN 141 WHEN 'error' THEN 73
  WHEN 'signup' THEN 133 ELSE 333 END AS flag, md5(event_id::VARCHAR) AS seq, repeat('I', 32) AS qual FROM events)"""


def _pairs_sql(where: str) -> str:
    return f"""WITH {_ALN}, k AS (SELECT * FROM aln WHERE {where}),
p AS (SELECT qname, min(seq) FILTER (flag & 64 <> 0) AS r1, min(seq) FILTER (flag & 128 <> 0) AS r2 FROM k GROUP BY 1)
SELECT qname, unnest([1, 2])::INTEGER AS mate, unnest([r1, r2]) AS seq FROM p WHERE r1 IS NOT NULL AND r2 IS NOT NULL"""


@query("l02_host_removed", _pairs_sql("flag & 12 = 12 AND flag & 256 = 0"))
def host_removed(spark, sf):
    return R.host_removed_pairs(T.alignments(spark, sf)).select("qname", "mate", "seq")


@query("l02b_unconcordant", _pairs_sql("flag & 2 = 0 AND flag & 256 = 0"))
def unconcordant(spark, sf):
    return R.host_removed_pairs(T.alignments(spark, sf), "unconcordant").select("qname", "mate", "seq")


@query("l03_taxon_counts", f"SELECT taxid, count(*) AS reads FROM ({_ASSIGNMENTS}) WHERE status = 'C' GROUP BY 1")
def taxon_counts(spark, sf):
    return R.taxon_counts(T.assignments(spark, sf))


@query("l03b_split_classified", f"SELECT status, count(*) AS n FROM ({_ASSIGNMENTS}) GROUP BY 1")
def split_classified(spark, sf):
    yes, no = R.split_classified(T.assignments(spark, sf))
    return yes.unionByName(no).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "l04_clade_report",
    REPORT_CTES + "SELECT round(pct, 6) AS pct, clade_reads, taxon_reads, rank_code, taxid, name FROM report",
)
def clade_report(spark, sf):
    tree = T.taxonomy(spark, sf)
    out = R.clade_report(R.taxon_counts(T.assignments(spark, sf)), tree, trees.nested_sets(tree))
    return out.withColumn("pct", r6("pct", "pct"))


_CHAIN = """WITH chain AS (SELECT c_custkey AS taxid, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY c_custkey) AS depth
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT taxid, depth AS n_ancestors, (depth * (depth + 1) / 2)::BIGINT AS depth_sum FROM chain"""


@query("l04c_deep_tree", _CHAIN)
def deep_tree(spark, sf):
    """One long path per region, every customer below the one before: each node's ancestors and their depths."""
    nation = T.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    nodes = T.table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").cast("bigint").alias("taxid"), "n_regionkey"
    )
    placed = freeze(O.place(nodes, ["n_regionkey"], [("taxid", False)]))
    above = placed.select(F.col("taxid").alias("parent"), "n_regionkey", (F.col("position") + 1).alias("position"))
    tree = freeze(placed.join(above, ["n_regionkey", "position"], "left").select("taxid", "parent"))
    depths = trees.path_sums(tree.withColumn("n_ancestors", F.lit(1).cast("bigint")), ["n_ancestors"])
    deep = tree.join(depths, "taxid").withColumn("depth_sum", F.col("n_ancestors"))
    return depths.join(trees.path_sums(deep, ["depth_sum"]), "taxid")


@query(
    "l04d_nested_sets",
    """WITH s AS (SELECT n_regionkey, n_nationkey, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL),
t AS (SELECT 1 AS taxid, NULL AS parent, 0 AS enter, 1 + (SELECT count(*) FROM region) + (SELECT sum(n + 1) FROM s) AS size, 1 AS depth
  UNION ALL SELECT 10 + r_regionkey, 1, 1 + (SELECT coalesce(sum(n + 1), 0) FROM s WHERE n_regionkey < r_regionkey) + (SELECT count(*) FROM region b WHERE b.r_regionkey < a.r_regionkey),
    1 + (SELECT coalesce(sum(n + 1), 0) FROM s WHERE n_regionkey = r_regionkey), 2 FROM region a),
g AS (SELECT 100 + s.n_nationkey AS taxid, t.enter + 1 + coalesce(sum(n + 1) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS enter,
  n + 1 AS size, 3 AS depth FROM s JOIN t ON t.taxid = 10 + n_regionkey),
c AS (SELECT 1000 + c_custkey AS taxid, g.enter + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS enter, 1 AS size, 4 AS depth
  FROM customer JOIN g ON g.taxid = 100 + c_nationkey)
SELECT taxid::BIGINT AS taxid, enter::BIGINT AS enter, (enter + size)::BIGINT AS leave, depth::BIGINT AS depth
FROM (SELECT taxid, enter, size, depth FROM t UNION ALL SELECT * FROM g UNION ALL SELECT * FROM c)""",
)
def nested_sets(spark, sf):
    return trees.nested_sets(T.taxonomy(spark, sf))


def _shares(ancestors):
    """Expected share of a taxon's reads resolved only to an ancestor: fixed by the two ids."""
    share = (1 + (F.col("taxid") * 7 + F.col("ancestor") * 3) % 10) / 10.0
    return ancestors.filter("taxid <> ancestor").withColumn("share", share)


@query(
    "l05_reestimate",
    REPORT_CTES.rstrip() + """,
lev AS (SELECT rank_code AS level, taxid, name, clade_reads FROM report WHERE rank_code IN ('D', 'G', 'S')),
w AS (SELECT level, lev.taxid, ancestor, r.taxon_reads, (1 + (lev.taxid * 7 + ancestor * 3) % 10) / 10.0 * lev.clade_reads AS w
  FROM lev JOIN anc ON anc.taxid = lev.taxid AND anc.ancestor <> lev.taxid JOIN report r ON r.taxid = ancestor AND r.taxon_reads > 0),
ad AS (SELECT level, taxid, sum(taxon_reads * w / tw) AS added FROM w JOIN (SELECT level, ancestor, sum(w) AS tw FROM w GROUP BY ALL) USING (level, ancestor) GROUP BY ALL),
est AS (SELECT level, taxid, name, clade_reads AS kraken_assigned, coalesce(added, 0) AS added FROM lev LEFT JOIN ad USING (level, taxid))
SELECT level, taxid, name, kraken_assigned, round(added, 6) AS added, round(kraken_assigned + added, 6) AS new_est,
  round((kraken_assigned + added) / sum(kraken_assigned + added) OVER (PARTITION BY level), 9) AS fraction FROM est""",
)
def reestimate(spark, sf):
    tree = T.taxonomy(spark, sf)
    sets = freeze(trees.nested_sets(tree))
    report = freeze(R.clade_report(R.taxon_counts(T.assignments(spark, sf)), tree, sets))
    out = R.reestimate(report, sets, _shares(T.ancestors(spark, sf)), ["D", "G", "S"])
    return out.select(
        "level", "taxid", "name", "kraken_assigned", r6("added", "added"), r6("new_est", "new_est"),
        r6("fraction", "fraction", 9),
    )


# -- streaming ---------------------------------------------------------------

@query("n01_incremental_ingest", sql("SELECT sample_name, clade_name, round(ra, 6) AS relative_abundance FROM prof", "prof"))
def incremental_ingest(spark, sf):
    prof = T.profile(spark, sf).drop("cnt")
    landing, target = staging_path(spark, "landing"), staging_path(spark, "ingested")
    check = staging_path(spark, "ingest-log")
    first = F.pmod(F.xxhash64("sample_name"), F.lit(2)) == 0
    for part in (first, ~first):
        # Half of the samples arrive, are taken in, then the other half.
        prof.filter(part).write.mode("append").parquet(landing)
        S.ingest(S.stream_profiles(spark, landing, prof.schema), target, check)
    out = spark.read.schema(prof.schema).parquet(target)
    return out.select("sample_name", "clade_name", r6("relative_abundance", "relative_abundance"))


@query("n01b_two_calls", sql("SELECT sample_name, clade_name, round(ra, 6) AS relative_abundance FROM prof", "prof"))
def two_calls(spark, sf):
    """The same with the default note of what was taken in, which the second call finds again."""
    prof = T.profile(spark, sf).drop("cnt")
    landing, target = staging_path(spark, "landing"), staging_path(spark, "ingested")
    first = F.pmod(F.xxhash64("sample_name"), F.lit(2)) == 0
    for part in (first, ~first):
        prof.filter(part).write.mode("append").parquet(landing)
        S.ingest(S.stream_profiles(spark, landing, prof.schema), target)
    out = spark.read.schema(prof.schema).parquet(target)
    return out.select("sample_name", "clade_name", r6("relative_abundance", "relative_abundance"))


@query(
    "n02_stream_pair",
    sql("SELECT sample_name, '/data/' || sample_name || '_R1.fq' AS reads, total FROM meta JOIN "
        "(SELECT sample_name, sum(cnt) AS total FROM species GROUP BY 1) USING (sample_name)", "species", "meta"),
)
def stream_pair(spark, sf):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("sample_name"), F.lit(600))).alias("arrival")
    reads = T.metadata(spark, sf).select(
        "sample_name", F.concat(F.lit("/data/"), "sample_name", F.lit("_R1.fq")).alias("reads"), at
    )
    totals = T.species(spark, sf, "cnt").groupBy("sample_name").agg(F.sum("value").alias("total"))
    totals = totals.select("sample_name", "total", at)
    left, right, out = (staging_path(spark, x) for x in ("reads-in", "totals-in", "paired"))
    reads.write.parquet(left)
    totals.write.parquet(right)
    a, b = (S.stream_profiles(spark, p, d.schema) for p, d in ((left, reads), (right, totals)))
    paired = S.stream_pair(a, b, "sample_name", "arrival")
    S.ingest(paired, out)
    schema = Y.StructType([reads.schema["sample_name"], reads.schema["reads"], totals.schema["total"]])
    return spark.read.schema(schema).parquet(out)


def _landed(spark, df, name, parts=3):
    """The rows of ``df`` as files that land one after another, by a hash of the sample."""
    path, files = staging_path(spark, name), shuffle_width(spark)
    df = freeze(df)
    for i in range(parts):
        landing = df.filter(F.pmod(F.xxhash64("sample_name"), F.lit(parts)) == i)
        landing.repartition(files).write.mode("append").parquet(path)
    return S.stream_profiles(spark, path, df.schema, files_per_trigger=files)


@query(
    "n01c_totals_kept",
    sql(
        """, s AS (SELECT grp, feature, sum(value) AS v FROM species JOIN meta USING (sample_name) GROUP BY ALL),
m AS (SELECT s.grp, feature, v / n AS v FROM s JOIN (SELECT grp, count(*) AS n FROM meta GROUP BY 1) g USING (grp)),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY v DESC, feature) AS k FROM m)
SELECT grp AS "group", least(k, 11)::INTEGER AS place, CASE WHEN k > 10 THEN 'Other' ELSE feature END AS feature, round(sum(v), 6) AS value
FROM r GROUP BY ALL""",
        "species", "meta",
    ),
)
def totals_kept(spark, sf):
    """Top ten features per group, kept up to date while the samples come in."""
    target = staging_path(spark, "totals")
    S.keep_totals(_landed(spark, T.species(spark, sf), "species"), T.metadata(spark, sf), target)
    return S.top_features(spark, target).withColumn("value", r6("value", "value"))


@query(
    "n02b_no_row_lost",
    sql(
        """, l AS (SELECT sample_name, grp FROM meta WHERE substr(sample_name, 2)::BIGINT % 3 > 0),
t AS (SELECT sample_name, sum(cnt) AS total FROM species WHERE substr(sample_name, 2)::BIGINT % 5 > 0 GROUP BY 1)
SELECT sample_name, CASE WHEN grp IS NULL OR total IS NULL THEN 'waiting' ELSE 'paired' END AS outcome, grp AS "group", total
FROM l FULL JOIN t USING (sample_name)""",
        "species", "meta",
    ),
)
def no_row_lost(spark, sf):
    """Both sides lack some samples; each row is paired or waiting."""
    number = F.substring("sample_name", 2, 20).cast("bigint")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("sample_name"), F.lit(600))).alias("arrival")
    groups = T.metadata(spark, sf).filter(number % 3 > 0).select("sample_name", "group", at)
    totals = T.species(spark, sf, "cnt").filter(number % 5 > 0).groupBy("sample_name").agg(F.sum("value").alias("total"))
    target = staging_path(spark, "pairs")
    S.pair_arrivals(
        _landed(spark, groups, "groups"), _landed(spark, totals.select("*", at), "sums"), "sample_name", "arrival", target
    )
    return S.paired(spark, target).select("sample_name", "outcome", "left.group", "right.total")
