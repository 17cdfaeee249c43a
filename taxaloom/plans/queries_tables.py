"""Lineage scalars, filters, joins, reshapes and normalisations."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.functions import lineage as L
from taxaloom.operators import matrix as M, testing as X
from taxaloom.plans.oracle import NATIONS, sql
from taxaloom.plans.register import query, r6
from taxaloom.operators.ordered import place
from taxaloom.session import freeze, staging_path
from taxaloom.sources import joined, params, sinks, tables as T

_CLADES = "SELECT DISTINCT clade_name, ncbi_tax_id FROM prof"
_LAST = "string_split(clade_name, '|')[-1]"
_RANK = (
    f"CASE substr({_LAST}, 1, 3) WHEN 't__' THEN 'SGB' WHEN 's__' THEN 'SPECIES' WHEN 'g__' THEN 'GENUS' "
    "WHEN 'f__' THEN 'FAMILY' WHEN 'o__' THEN 'ORDER' WHEN 'c__' THEN 'CLASS' WHEN 'p__' THEN 'PHYLUM' "
    "WHEN 'k__' THEN 'KINGDOM' END"
)
_CLEAN = f"replace(replace({_LAST}, substr({_LAST}, 1, 3), ''), '_', ' ')"


def _clades(spark, sf):
    return T.clades(spark, sf, with_tax=True)


@query(
    "c01_last_level",
    sql(f"SELECT clade_name, {_LAST} AS taxonomy, string_split(ncbi_tax_id, '|')[-1] AS tax_id FROM ({_CLADES})", "prof"),
)
def last_level(spark, sf):
    return _clades(spark, sf).select(
        "clade_name", L.last_level("clade_name").alias("taxonomy"), L.last_level("ncbi_tax_id").alias("tax_id")
    )


@query(
    "c02_level_from_end",
    sql(
        "SELECT clade_name, string_split(clade_name, '|')[-2] AS parent, string_split(clade_name, '|')[-3] AS third "
        f"FROM ({_CLADES})",
        "prof",
    ),
)
def level_from_end(spark, sf):
    return _clades(spark, sf).select(
        "clade_name", L.level_from_end("clade_name", 2).alias("parent"), L.level_from_end("clade_name", 3).alias("third")
    )


@query("c03_rank_by_prefix", sql(f"SELECT clade_name, {_RANK} AS rank FROM ({_CLADES})", "prof"))
def rank_by_prefix(spark, sf):
    return _clades(spark, sf).select("clade_name", L.rank_by_prefix(L.last_level("clade_name")).alias("rank"))


@query("c04_clean_name", sql(f"SELECT clade_name, {_CLEAN} AS name FROM ({_CLADES})", "prof"))
def clean_name(spark, sf):
    return _clades(spark, sf).select("clade_name", L.clean_name(L.last_level("clade_name")).alias("name"))


@query(
    "c05_level_columns",
    sql(
        "SELECT clade_name, "
        + ", ".join(f"string_split(clade_name, '|')[{i + 1}] AS \"{r}\"" for i, r in enumerate(L.RANKS))
        + f" FROM ({_CLADES})",
        "prof",
    ),
)
def level_columns(spark, sf):
    return _clades(spark, sf).select("clade_name", *L.level_columns("clade_name"))


@query(
    "c06_rank_by_depth",
    sql(
        "SELECT clade_name, CASE WHEN len(s) = 8 THEN 'SGB' WHEN len(s) = 7 THEN 'SPECIES' WHEN len(s) = 6 THEN 'GENUS' "
        "WHEN len(s) = 5 THEN 'FAMILY' WHEN len(s) = 4 THEN 'ORDER' WHEN len(s) = 3 THEN 'CLASS' "
        "WHEN len(s) = 2 THEN 'PHYLUM' ELSE 'KINGDOM' END AS rank "
        f"FROM (SELECT clade_name, string_split(clade_name, '|') AS s FROM ({_CLADES}))",
        "prof",
    ),
)
def rank_by_depth(spark, sf):
    return _clades(spark, sf).select("clade_name", L.rank_by_depth("clade_name").alias("rank"))


_SELECTED = f"SELECT sample_name, {_CLEAN} AS taxonomy, sum(ra) AS value FROM prof WHERE {_RANK} = 'SPECIES' GROUP BY ALL"


@query("c07_select_rank", sql(f"SELECT sample_name, taxonomy AS feature, round(value, 6) AS value FROM ({_SELECTED})", "prof"))
def select_rank(spark, sf):
    out = M.select_rank(T.profile(spark, sf), "SPECIES")
    return out.select("sample_name", "feature", r6("value", "value"))


@query(
    "c08_drop_unknown",
    sql(
        f"SELECT sample_name, taxonomy AS feature, round(value, 6) AS value FROM ({_SELECTED}) "
        "WHERE NOT regexp_matches(taxonomy, 'GGB|SGB')",
        "prof",
    ),
)
def drop_unknown(spark, sf):
    out = M.drop_unknown(M.select_rank(T.profile(spark, sf, depths=[7]), "SPECIES"))
    return out.select("sample_name", "feature", r6("value", "value"))


@query("c09_drop_strains", sql("SELECT sample_name, clade_name, cnt FROM prof WHERE NOT contains(clade_name, 't__')", "prof"))
def drop_strains(spark, sf):
    return M.drop_strains(T.profile(spark, sf)).select("sample_name", "clade_name", "cnt")


@query("c10_unstratified", sql("SELECT * FROM func WHERE NOT contains(term, '|')", "func"))
def unstratified(spark, sf):
    return M.unstratified(T.functional(spark, sf))


_PARTS = """SELECT sample_name, term, abundance, split_part(term, ': ', 1) AS code,
  CASE WHEN contains(split_part(term, '|', 1), ': ') THEN substr(split_part(term, '|', 1),
    instr(split_part(term, '|', 1), ': ') + 2) END AS name,
  string_split(term, '|')[2] AS stratum FROM func"""


@query("c11_split_feature", sql(f"SELECT DISTINCT term, code, name, stratum FROM ({_PARTS})", "func"))
def split_feature(spark, sf):
    return T.functional(spark, sf).select("term").distinct().select("term", L.split_feature("term").alias("s")).select(
        "term", "s.code", "s.name", "s.stratum"
    )


@query("c12_join_feature", sql("SELECT DISTINCT term AS feature FROM func", "func"))
def join_feature(spark, sf):
    parts = T.functional(spark, sf).select(L.split_feature("term").alias("s")).distinct()
    return parts.select(L.join_feature("s.code", "s.name", "s.stratum").alias("feature"))


@query(
    "c13_taxon_label",
    sql(
        f"""SELECT DISTINCT stratum, CASE WHEN contains(stratum, 's__')
  THEN replace(replace(split_part(stratum, '.', 2), 's__', ''), '_', ' ')
  WHEN contains(stratum, 'g__') THEN replace(replace(stratum, 'g__', ''), '_', ' ') ELSE stratum END AS label
FROM ({_PARTS}) WHERE stratum IS NOT NULL""",
        "func",
    ),
)
def taxon_label(spark, sf):
    strata = T.functional(spark, sf).select(L.split_feature("term")["stratum"].alias("stratum")).distinct()
    return strata.filter("stratum IS NOT NULL").select("stratum", L.taxon_label("stratum").alias("label"))


def _features(spark, sf):
    return T.functional(spark, sf).select("sample_name", F.col("term").alias("feature"), F.col("abundance").alias("value"))


@query(
    "c14_focal_rows",
    sql(
        f"""SELECT code, name, sample_name, stratum, abundance AS value FROM ({_PARTS})
WHERE code IN ('ECONOMY', 'PROMO') AND stratum IS NOT NULL AND stratum <> 'unclassified'""",
        "func",
    ),
)
def focal_rows(spark, sf):
    return M.focal_rows(_features(spark, sf), ["ECONOMY", "PROMO"], exclude_unclassified=True)


@query("c15_drop_columns", sql("SELECT sample_name, gene_id, count FROM genes", "genes"))
def drop_columns(spark, sf):
    return T.gene_counts(spark, sf).drop("gene_name")


_WIDE_CNT = ", ".join(f"coalesce(sum(cnt) FILTER (sample_name = '{n}'), 0)::DOUBLE AS \"{n}\"" for n in NATIONS[::-1])


@query("c16_column_order", sql(f"SELECT clade_name, {_WIDE_CNT} FROM prof_n GROUP BY 1", "prof_n"))
def column_order(spark, sf):
    return M.to_wide(T.profile(spark, sf, sample="nation"), NATIONS[::-1], ["clade_name"], "cnt")


@query(
    "c17_drop_zero_features",
    sql(
        """SELECT feature, count(*) AS n FROM (SELECT sample_name, gene_id AS feature,
  greatest(count - 40, 0) AS value FROM genes) GROUP BY 1 HAVING sum(value) > 0""",
        "genes",
    ),
)
def drop_zero_features(spark, sf):
    shifted = T.gene_counts(spark, sf).select(
        "sample_name", F.col("gene_id").alias("feature"), F.greatest(F.col("count") - 40, F.lit(0)).alias("value")
    )
    return M.drop_zero_features(shifted).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


@query("c18_drop_placeholders", sql("SELECT * FROM genes WHERE gene_name <> '-'", "genes"))
def drop_placeholders(spark, sf):
    return T.gene_counts(spark, sf).filter(F.col("gene_name") != "-")


_UNIQUE = """SELECT gene_id, gene_name, CASE WHEN rn = 0 THEN gene_name ELSE gene_name || '.' || rn END AS unique_name
FROM (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY gene_id) - 1 AS rn
      FROM (SELECT DISTINCT gene_id, gene_name FROM genes WHERE gene_name <> '-'))"""


@query(
    "c19_feature_key",
    sql(
        f"SELECT sample_name, unique_name AS feature, count AS value FROM genes JOIN ({_UNIQUE}) USING (gene_id, gene_name)",
        "genes",
    ),
)
def feature_key(spark, sf):
    return M.feature_key(T.gene_counts(spark, sf), "gene_name")


@query("c20_make_unique", sql(_UNIQUE, "genes"))
def make_unique(spark, sf):
    return M.make_unique(T.gene_counts(spark, sf).filter("gene_name <> '-'").select("gene_id", "gene_name").distinct())


@query(
    "c21_string_pieces",
    sql(
        """SELECT sample_name, replace(grp || ' vs rest', ' ', '_') AS title,
  (SELECT string_agg(DISTINCT grp, '_vs_' ORDER BY grp) FROM meta) AS contrast,
  regexp_extract('/data/' || sample_name || '.Pathway.txt', '[^/]+$') AS base,
  replace(sample_name || '.Pathway.txt', '.Pathway.txt', '') AS stem FROM meta""",
        "meta",
    ),
)
def string_pieces(spark, sf):
    meta = T.metadata(spark, sf)
    contrast = meta.select("group").distinct().agg(F.array_join(F.array_sort(F.collect_list("group")), "_vs_")).scalar()
    path = F.concat(F.lit("/data/"), "sample_name", F.lit(".Pathway.txt"))
    base = F.regexp_extract(path, "[^/]+$", 0)
    return meta.select(
        "sample_name", F.replace(F.concat_ws(" vs ", "group", F.lit("rest")), F.lit(" "), F.lit("_")).alias("title"),
        contrast.alias("contrast"), base.alias("base"), F.replace(base, F.lit(".Pathway.txt"), F.lit("")).alias("stem"),
    )


@query(
    "c22_numeric_pieces",
    sql(
        """SELECT sample_name, feature, round(log2(value + 1), 6) + 0.0 AS log2p, round(-log10(value), 6) + 0.0 AS nlog,
  round(abs(value - 1), 6) + 0.0 AS gap, round(value, 4) AS short, try_cast(feature AS DOUBLE) AS coerced FROM species""",
        "species",
    ),
)
def numeric_pieces(spark, sf):
    return T.species(spark, sf).select(
        "sample_name", "feature", r6(M.log2_pseudo("value", 1.0), "log2p"), r6(-F.log10("value"), "nlog"),
        r6(F.abs(F.col("value") - 1), "gap"), F.round("value", 4).alias("short"),
        F.col("feature").try_cast("double").alias("coerced"),
    )


@query(
    "c23_merge_settings",
    """SELECT s_suppkey::BIGINT AS s_suppkey, 'x' || s_suppkey AS a, 'd' || s_nationkey AS b, s_name AS c,
  3::INTEGER AS n FROM supplier""",
)
def merge_settings(spark, sf):
    key, nat = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    maps = T.table(spark, sf, "supplier").select(
        "s_suppkey",
        F.create_map(F.lit("a"), key, F.lit("b"), key).alias("analysis"),
        F.create_map(F.lit("b"), F.concat(F.lit("d"), nat), F.lit("c"), F.lit("old")).alias("database"),
        F.create_map(F.lit("a"), F.concat(F.lit("x"), key), F.lit("c"), F.col("s_name")).alias("extra"),
    )
    merged = maps.select("s_suppkey", params.merge_settings("analysis", "database", "extra").alias("m"))
    return merged.select("s_suppkey", *[F.col("m")[k].alias(k) for k in "abc"], F.size("m").alias("n"))


@query(
    "c24_drop_undefined",
    sql("SELECT sample_name, gene_id, count FROM genes WHERE gene_name <> '-'", "genes"),
)
def drop_undefined(spark, sf):
    genes = T.gene_counts(spark, sf).withColumn("gene_name", F.nullif("gene_name", F.lit("-")))
    return M.drop_undefined(genes, "gene_name").drop("gene_name")


@query(
    "c25_validate_samples",
    sql(
        """SELECT sample_name, 'data' AS missing_in, n FROM (SELECT sample_name, 1::BIGINT AS n FROM meta
  WHERE sample_name NOT IN (SELECT sample_name FROM species WHERE value > 0.5))
UNION ALL SELECT 'N' || s_nationkey, 'duplicate', count(*) FROM supplier GROUP BY s_nationkey HAVING count(*) > 1""",
        "species", "meta",
    ),
)
def validate_samples(spark, sf):
    loud = T.species(spark, sf).filter("value > 0.5")
    split = M.sample_agreement(loud, T.metadata(spark, sf)).withColumn("n", F.lit(1).cast("bigint"))
    ids = T.table(spark, sf, "supplier").select(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("sample_name"))
    twice = M.duplicate_samples(ids).select("sample_name", F.lit("duplicate").alias("missing_in"), "n")
    return split.unionByName(twice)


# -- joins -------------------------------------------------------------------

@query("d01_outer_merge", sql(f"SELECT clade_name, ncbi_tax_id, {_WIDE_CNT} FROM prof_n GROUP BY 1, 2", "prof_n"))
def outer_merge(spark, sf):
    prof = T.profile(spark, sf, sample="nation", with_tax=True)
    keys = ["clade_name", "ncbi_tax_id"]
    return M.to_wide(M.merge_samples(prof, keys, "cnt"), NATIONS[::-1], keys, "cnt")


@query(
    "d02_union_samples",
    sql("SELECT sample_name, feature, round(value, 6) AS value, grp AS \"group\" FROM species JOIN meta USING (sample_name)",
        "species", "meta"),
)
def union_samples(spark, sf):
    """The samples of both groups: one look-up names a row's group, so the table is read once."""
    both = T.metadata(spark, sf).filter(F.col("group").isin(X.CONTROL, X.TREATMENT))
    return M.with_group(T.species(spark, sf), both).select("sample_name", "feature", r6("value", "value"), "group")


@query(
    "d03_join_metadata",
    sql("SELECT grp AS \"group\", count(*) AS n, sum(cnt) AS total FROM species JOIN meta USING (sample_name) GROUP BY 1",
        "species", "meta"),
)
def join_metadata(spark, sf):
    joined = M.with_group(T.species(spark, sf, "cnt"), T.metadata(spark, sf))
    return joined.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "d04_left_join_annotation",
    sql(
        """SELECT f.feature, f.total, a.n_names FROM (SELECT gene_id AS feature, sum(count)::BIGINT AS total FROM genes GROUP BY 1) f
LEFT JOIN (SELECT gene_id AS feature, count(DISTINCT gene_name) AS n_names FROM genes WHERE gene_name <> '-' GROUP BY 1) a
USING (feature)""",
        "genes",
    ),
)
def left_join_annotation(spark, sf):
    genes = T.gene_counts(spark, sf)
    totals = genes.groupBy(F.col("gene_id").alias("feature")).agg(F.sum("count").alias("total"))
    notes = genes.filter("gene_name <> '-'").groupBy(F.col("gene_id").alias("feature")).agg(
        F.count_distinct("gene_name").alias("n_names")
    )
    return totals.join(notes, "feature", "left")


@query(
    "d05_semi_filter",
    sql(
        """SELECT sample_name, feature, cnt AS value FROM species
WHERE feature IN (SELECT feature FROM species GROUP BY 1 ORDER BY sum(cnt) DESC, feature LIMIT 25)""",
        "species",
    ),
)
def semi_filter(spark, sf):
    df = T.species(spark, sf, "cnt")
    best = _top25(df)
    return df.join(best, "feature", "left_semi").select("sample_name", "feature", "value")


def _top25(df):
    totals = df.groupBy("feature").agg(F.sum("value").alias("total"))
    return totals.orderBy(F.desc("total"), "feature").limit(25).select("feature")


@query(
    "d06_channel_join",
    sql("SELECT sample_name AS id, '/data/' || sample_name || '_profile.txt' AS profile, sum(cnt) AS reads "
        "FROM meta JOIN species USING (sample_name) GROUP BY ALL", "species", "meta"),
)
def channel_join(spark, sf):
    reads = T.species(spark, sf, "cnt").groupBy(F.col("sample_name").alias("id")).agg(F.sum("value").alias("reads"))
    profiles = T.metadata(spark, sf).select(
        F.col("sample_name").alias("id"), F.concat(F.lit("/data/"), "sample_name", F.lit("_profile.txt")).alias("profile")
    )
    return reads.join(profiles, "id")


@query(
    "d07_channel_gather",
    sql(
        """SELECT sample_name, string_agg(path, ';' ORDER BY path) AS path FROM
  (SELECT sample_name, unnest(['/r/' || sample_name || '_R1.fq', '/r/' || sample_name || '_R2.fq']) AS path FROM meta) GROUP BY 1""",
        "meta",
    ),
)
def channel_gather(spark, sf):
    paths = T.metadata(spark, sf).select("sample_name", F.explode(F.array(*[
        F.concat(F.lit("/r/"), "sample_name", F.lit(f"_R{i}.fq")) for i in (1, 2)
    ])).alias("path"))
    return M.gather(paths, "sample_name", "path").select("sample_name", F.array_join("path", ";").alias("path"))


@query(
    "d08_lookup_zero",
    sql(
        """SELECT p_partkey::BIGINT AS p_partkey, coalesce(v.value, 0)::DOUBLE AS value FROM part
LEFT JOIN (SELECT ko, sum(value) AS value FROM ko GROUP BY 1 HAVING sum(value) > 700) v ON v.ko = 'K' || p_partkey""",
        "ko",
    ),
)
def lookup_zero(spark, sf):
    known = T.ko_abundance(spark, sf).groupBy("ko").agg(F.sum("value").alias("value")).filter("value > 700")
    parts = T.table(spark, sf, "part").select("p_partkey", F.concat(F.lit("K"), F.col("p_partkey").cast("string")).alias("ko"))
    return M.lookup_zero(parts, known, ["ko"], "value").drop("ko")


@query("d09_distinct", sql(f"SELECT DISTINCT {_RANK} AS rank FROM prof", "prof"))
def distinct(spark, sf):
    return M.annotate(T.clades(spark, sf)).select("rank").distinct()


# -- reshape -----------------------------------------------------------------

@query("e01_long_to_wide", sql(f"SELECT term, {_WIDE_CNT.replace('cnt', 'abundance')} FROM func_n GROUP BY 1", "func_n"))
def long_to_wide(spark, sf):
    from taxaloom.plans.queries_io import _nation_terms

    return M.to_wide(_nation_terms(spark, sf), NATIONS[::-1], ["term"])


@query("e02_wide_to_long", sql("SELECT clade_name, sample_name, cnt AS value FROM prof_n WHERE cnt <> 0", "prof_n"))
def wide_to_long(spark, sf):
    wide = M.to_wide(T.profile(spark, sf, sample="nation"), NATIONS, ["clade_name"], "cnt")
    return M.to_long(wide, ["clade_name"])


# Part types of the table, the phylum names of the adapter.
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "e03_transpose",
    sql(
        "SELECT sample_name, "
        + ", ".join(f"coalesce(sum(cnt) FILTER (clade_name = 'k__Part|p__{t}'), 0)::DOUBLE AS \"p__{t}\"" for t in _TYPES)
        + " FROM prof WHERE len(string_split(clade_name, '|')) = 2 GROUP BY 1",
        "prof",
    ),
)
def transpose(spark, sf):
    phyla = T.profile(spark, sf, depths=[2]).select(
        "sample_name", L.last_level("clade_name").alias("feature"), F.col("cnt").alias("value")
    )
    return M.transpose(phyla, [f"p__{t}" for t in _TYPES])


@query(
    "e03b_transpose_lines",
    sql(
        """SELECT name, name || chr(9) || string_agg(cell, chr(9) ORDER BY k, feature) AS line FROM (
  SELECT s.sample_name AS name, 0 AS k, f.feature, coalesce(printf('%.3f', cnt), '0') AS cell FROM (SELECT DISTINCT sample_name FROM prof_n) s
    CROSS JOIN (SELECT DISTINCT clade_name AS feature FROM prof_n) f LEFT JOIN prof_n p ON p.sample_name = s.sample_name AND p.clade_name = f.feature)
GROUP BY name""",
        "prof_n",
    ),
)
def transpose_lines(spark, sf):
    """Samples as lines, one cell per feature of every rank: as wide as the features are many."""
    cells = T.profile(spark, sf, sample="nation").select(
        F.col("clade_name").alias("sample_name"), F.col("sample_name").alias("sample"), F.col("cnt").alias("value")
    )
    features = place(cells.select("sample_name").distinct(), [], [("sample_name", False)])
    return sinks.matrix_lines(cells, features, "sample", digits=3).filter("_order = 2").select("name", "line")


@query("e04_densify", sql("SELECT feature, sample_name, cnt AS value FROM dense", "dense"))
def densify(spark, sf):
    return M.densify(T.species(spark, sf, "cnt"), T.metadata(spark, sf))


# -- normalisation -----------------------------------------------------------

_KNOWN = f"SELECT * FROM ({_SELECTED}) WHERE NOT regexp_matches(taxonomy, 'GGB|SGB')"


@query(
    "f01_percent",
    sql(
        f"""SELECT sample_name, taxonomy AS feature,
  round(value / sum(value) OVER (PARTITION BY sample_name) * 100, 10) AS value FROM ({_KNOWN})""",
        "prof",
    ),
)
def percent(spark, sf):
    known = M.drop_unknown(M.select_rank(T.profile(spark, sf, depths=[7]), "SPECIES"))
    return M.relative(known).select("sample_name", "feature", r6("value", "value", 10))


def _bucketed(spark, df, name):
    """``df`` as a bucketed table of its own."""
    path = staging_path(spark, name)
    return joined.write_bucketed(df, f"{name}_{path.rpartition('-')[2]}", path)


@query(
    "d03b_join_bucketed",
    sql("SELECT grp AS \"group\", count(*) AS n, sum(cnt) AS total FROM species JOIN meta USING (sample_name) GROUP BY 1",
        "species", "meta"),
)
def join_bucketed(spark, sf):
    """Values and metadata bucketed by sample: their join exchanges neither."""
    values, meta = _bucketed(spark, T.species(spark, sf, "cnt"), "values"), _bucketed(spark, T.metadata(spark, sf), "meta")
    joined_rows = M.with_group(values, meta)
    return joined_rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    "d06b_totals_bucketed",
    sql("SELECT sample_name, grp AS \"group\", sum(cnt) AS reads FROM meta JOIN species USING (sample_name) GROUP BY ALL", "species", "meta"),
)
def totals_bucketed(spark, sf):
    """Totals by sample of a bucketed table, joined with another one."""
    values, meta = _bucketed(spark, T.species(spark, sf, "cnt"), "values"), _bucketed(spark, T.metadata(spark, sf), "meta")
    return values.groupBy("sample_name").agg(F.sum("value").alias("reads")).join(meta, "sample_name")


@query(
    "f01b_percent_bucketed",
    sql(
        f"""SELECT sample_name, taxonomy AS feature,
  round(value / sum(value) OVER (PARTITION BY sample_name) * 100, 10) AS value FROM ({_KNOWN})""",
        "prof",
    ),
)
def percent_bucketed(spark, sf):
    """Shares by sample of a bucketed table: sums and their look-up stay in the buckets."""
    known = M.drop_unknown(M.select_rank(T.profile(spark, sf, depths=[7]), "SPECIES"))
    return M.relative(_bucketed(spark, known, "known"), bucketed=True).select("sample_name", "feature", r6("value", "value", 10))


@query(
    "f02_per_million",
    sql("SELECT sample_name, feature, round(cnt / sum(cnt) OVER (PARTITION BY sample_name) * 1000000, 6) AS value FROM species",
        "species"),
)
def per_million(spark, sf):
    return M.relative(T.species(spark, sf, "cnt"), 1e6).select("sample_name", "feature", r6("value", "value"))


@query(
    "f03_renorm_community",
    sql(
        """SELECT sample_name, term, round(abundance /
  sum(abundance) FILTER (NOT contains(term, '|')) OVER (PARTITION BY sample_name), 6) AS abundance FROM func""",
        "func",
    ),
)
def renorm_community(spark, sf):
    terms = T.functional(spark, sf)
    special = terms.groupBy("sample_name").agg(F.sum("abundance").alias("abundance")).select(
        "sample_name", F.lit("UNMAPPED").alias("term"), "abundance"
    )
    out = M.renorm_community(terms.select("sample_name", "term", "abundance").unionByName(special))
    return out.select("sample_name", "term", r6("abundance", "abundance"))


@query(
    "f04_split_stratified",
    sql("SELECT contains(term, '|') AS is_stratified, sample_name, term, abundance FROM func", "func"),
)
def split_stratified(spark, sf):
    with_strata, without = M.split_stratified(T.functional(spark, sf))
    return with_strata.withColumn("is_stratified", F.lit(True)).unionByName(without.withColumn("is_stratified", F.lit(False)))


@query("f05_log2_pseudo", sql("SELECT sample_name, feature, round(log2(value + 0.5), 6) + 0.0 AS value FROM species", "species"))
def log2_pseudo(spark, sf):
    return T.species(spark, sf).withColumn("value", r6(M.log2_pseudo("value", 0.5), "value"))


@query(
    "f06_log_half_min",
    sql(
        """SELECT sample_name, feature, round(log2(value), 6) + 0.0 AS log_value,
  round(log2(min(value) OVER (PARTITION BY feature) / 2), 6) + 0.0 AS log_zero FROM species""",
        "species",
    ),
)
def log_half_min(spark, sf):
    return M.log_half_min(T.species(spark, sf)).select(
        "sample_name", "feature", r6("log_value", "log_value"), r6("log_zero", "log_zero")
    )


_TOP30 = "(SELECT feature FROM species GROUP BY 1 ORDER BY sum(cnt) DESC, feature LIMIT 30)"


@query(
    "f07_row_zscore",
    sql(
        f"""SELECT sample_name, feature, round((x - avg(x) OVER w) / nullif(stddev_samp(x) OVER w, 0), 6) + 0.0 AS value
FROM (SELECT sample_name, feature, log2(cnt + 1) AS x FROM dense WHERE feature IN {_TOP30}) WINDOW w AS (PARTITION BY feature)""",
        "dense",
    ),
)
def row_zscore(spark, sf):
    df = T.species(spark, sf, "cnt")
    totals = df.groupBy("feature").agg(F.sum("value").alias("total"))
    best = totals.orderBy(F.desc("total"), "feature").limit(30).select("feature")
    rows = M.densify(df.join(best, "feature", "left_semi"), T.metadata(spark, sf))
    scored = M.row_zscore(rows.withColumn("value", M.log2_pseudo("value", 1.0)))
    return scored.select("sample_name", "feature", r6("value", "value"))


def gene_counts(spark, sf):
    return T.gene_counts(spark, sf).groupBy("sample_name", F.col("gene_id").alias("feature")).agg(F.sum("count").alias("value"))


def _factors(spark, sf, counts):
    """No gene is counted in every sample here, so positive counts are used."""
    return M.size_factors(counts, X.group_size(T.metadata(spark, sf)), "poscounts")


_SF = """cc AS (SELECT sample_name, gene_id AS feature, sum(count)::DOUBLE AS value FROM genes GROUP BY ALL),
lgm AS (SELECT feature, sum(ln(value)) / (SELECT count(*) FROM meta) AS lgm FROM cc WHERE value > 0 GROUP BY 1),
meds AS (SELECT sample_name, median(ln(value) - lgm) AS m FROM cc JOIN lgm USING (feature) WHERE value > 0 GROUP BY 1),
sizef AS (SELECT sample_name, exp(m - (SELECT avg(m) FROM meds)) AS size_factor FROM meds)"""


@query("f08_size_factors", sql(f", {_SF} SELECT sample_name, round(size_factor, 6) AS size_factor FROM sizef", "genes", "meta"))
def size_factors(spark, sf):
    return _factors(spark, sf, gene_counts(spark, sf)).select("sample_name", r6("size_factor", "size_factor"))


_RATIO = """cc AS (SELECT sample_name, clade_name AS feature, cnt AS value FROM prof),
sizef AS (SELECT sample_name, exp(median(ln(value) - lgm)) AS size_factor FROM cc JOIN
  (SELECT feature, avg(ln(value)) AS lgm FROM cc GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM meta)) USING (feature)
  GROUP BY 1)"""


@query("f08b_median_of_ratios", sql(f", {_RATIO} SELECT sample_name, round(size_factor, 6) AS size_factor FROM sizef", "prof", "meta"))
def median_of_ratios(spark, sf):
    """By the clades that every sample has."""
    counts = T.profile(spark, sf).select("sample_name", F.col("clade_name").alias("feature"), F.col("cnt").alias("value"))
    out = M.size_factors(counts, X.group_size(T.metadata(spark, sf)))
    return out.select("sample_name", r6("size_factor", "size_factor"))


@query(
    "f09_norm_transform",
    sql(f", {_SF} SELECT sample_name, feature, round(log2(value / size_factor + 1), 6) AS value FROM cc JOIN sizef USING (sample_name)",
        "genes", "meta"),
)
def norm_transform(spark, sf):
    counts = gene_counts(spark, sf)
    out = M.norm_transform(counts, _factors(spark, sf, counts))
    return out.select("sample_name", "feature", r6("value", "value"))


@query(
    "f10_vst",
    sql(
        f""", {_SF} SELECT sample_name, feature, round(log2((1 + 2.5 + 2 * 0.05 * x
  + 2 * sqrt(0.05 * x * (1 + 2.5 + 0.05 * x))) / (4 * 0.05)), 6) AS value
FROM (SELECT sample_name, feature, value / size_factor AS x FROM cc JOIN sizef USING (sample_name))""",
        "genes", "meta",
    ),
)
def vst(spark, sf):
    """For a given trend; the fitted one is used where the expression analysis transforms counts."""
    counts = freeze(gene_counts(spark, sf))
    level = M.normalised(counts, _factors(spark, sf, counts))
    return level.select("sample_name", "feature", r6(M.vst("value", 0.05, 2.5), "value"))


_STACK = """st AS (SELECT split_part(term, ': ', 1) AS code, sample_name, string_split(term, '|')[2] AS feature, abundance AS value
  FROM func WHERE contains(term, '|')),
tops AS (SELECT code, sample_name, sum(value) AS s FROM st GROUP BY ALL),
floors AS (SELECT code, floor(log10(min(s))) AS fl FROM tops GROUP BY 1)"""


@query(
    "f11_stack_scale",
    sql(
        f""", {_STACK} SELECT code, sample_name, feature, round(value / s, 6) AS share,
  round(value / s * (greatest(log10(s), fl) - fl), 6) AS height
FROM st JOIN tops USING (code, sample_name) JOIN floors USING (code)""",
        "func",
    ),
)
def stack_scale(spark, sf):
    rows = M.focal_rows(_features(spark, sf), None).select("code", "sample_name", F.col("stratum").alias("feature"), "value")
    out = M.stack_scale(rows, "logstack", ["code"], share_column="share")
    return out.select("code", "sample_name", "feature", r6("share", "share"), r6("height", "height"))
