"""Totals, top-k, orders, box statistics, prevalence, and the window effects."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import composition as C, matrix as M, ordered as O, testing as X
from taxaloom.plans.oracle import sql
from taxaloom.plans.register import query, r6
from taxaloom.session import freeze
from taxaloom.sources import tables as T

_PICK = """tot AS (SELECT sample_name, feature, cnt AS value, grp FROM species JOIN meta USING (sample_name))"""


def _cnt(spark, sf):
    return T.species(spark, sf, "cnt")


@query(
    "g01_group_totals",
    sql(f", {_PICK} SELECT grp AS \"group\", feature, sum(value) AS total FROM tot GROUP BY ALL", "species", "meta"),
)
def group_totals(spark, sf):
    return C.group_totals(_cnt(spark, sf), T.metadata(spark, sf))


_KNOWN = """known AS (SELECT sample_name, replace(replace(string_split(feature, '|')[-1], 's__', ''), '_', ' ') AS feature,
  sum(value) AS value FROM species GROUP BY ALL),
pct AS (SELECT sample_name, feature, value / sum(value) OVER (PARTITION BY sample_name) * 100 AS value
  FROM known WHERE NOT regexp_matches(feature, 'GGB|SGB'))"""


def percent_species(spark, sf):
    """Known species in percent of the sample: the table the community analysis works on."""
    species = M.select_rank(T.profile(spark, sf, depths=[7]), "SPECIES")
    return M.relative(freeze(M.drop_unknown(species)))


@query(
    "g02_top_by_group",
    sql(
        f""", {_KNOWN}, g AS (SELECT pct.*, grp FROM pct JOIN meta USING (sample_name)),
best AS (SELECT grp, feature FROM (SELECT grp, feature, row_number() OVER (PARTITION BY grp ORDER BY round(sum(value), 9) DESC, feature) AS rn
  FROM g GROUP BY grp, feature) WHERE rn <= 10)
SELECT g.grp AS "group", sample_name, coalesce(best.feature, 'Other') AS feature, round(sum(value), 8) AS value
FROM g LEFT JOIN best ON best.grp = g.grp AND best.feature = g.feature GROUP BY ALL""",
        "species", "meta",
    ),
)
def top_by_group(spark, sf):
    out = C.top_n_by_group(percent_species(spark, sf), T.metadata(spark, sf), 10)
    return out.select("group", "sample_name", "feature", r6("value", "value", 8))


_TOP_ALL = f"""{_KNOWN}, best AS (SELECT feature FROM (SELECT feature, round(sum(value), 9) AS total FROM pct GROUP BY 1)
  ORDER BY total DESC, feature LIMIT 10),
topped AS (SELECT sample_name, coalesce(best.feature, 'Other') AS feature, sum(value) AS value
  FROM pct LEFT JOIN best USING (feature) GROUP BY ALL)"""


@query(
    "g03_top_overall",
    sql(f", {_TOP_ALL} SELECT sample_name, feature, round(value, 8) AS value FROM topped", "species"),
)
def top_overall(spark, sf):
    return C.top_n(percent_species(spark, sf), 10).select("sample_name", "feature", r6("value", "value", 8))


@query(
    "g04_order_by_total",
    sql(
        f""", {_TOP_ALL} SELECT feature, total, row_number() OVER (ORDER BY total DESC, feature) - 1 AS position
FROM (SELECT feature, round(sum(value), 6) AS total FROM topped GROUP BY 1)""",
        "species",
    ),
)
def order_by_total(spark, sf):
    return C.order_by_total(C.top_n(percent_species(spark, sf), 10))


_STRATA = """st AS (SELECT split_part(term, ': ', 1) AS code, sample_name, string_split(term, '|')[2] AS feature, abundance AS value
  FROM func WHERE contains(term, '|'))"""


def strata(spark, sf):
    """Stratified rows as ``(code, sample_name, feature, value)``."""
    terms = T.functional(spark, sf).select(
        "sample_name", F.col("term").alias("feature"), F.col("abundance").alias("value")
    )
    return M.focal_rows(terms, None).select("code", "sample_name", F.col("stratum").alias("feature"), "value")


@query(
    "g05_top_by_mean",
    sql(
        f""", {_STRATA}, best AS (SELECT code, feature, rn FROM (SELECT code, feature, row_number() OVER
  (PARTITION BY code ORDER BY sum(value) DESC, feature DESC) AS rn FROM st WHERE feature <> 'unclassified' GROUP BY code, feature) WHERE rn <= 15)
SELECT code, sample_name, CASE WHEN rn IS NOT NULL OR st.feature = 'unclassified' THEN st.feature ELSE 'other' END AS feature,
  coalesce(rn, CASE WHEN st.feature = 'unclassified' THEN 17 ELSE 16 END)::INTEGER AS place, sum(value) AS value
FROM st LEFT JOIN best USING (code, feature) GROUP BY ALL""",
        "func",
    ),
)
def top_by_mean(spark, sf):
    n = T.metadata(spark, sf).select(F.count(F.lit(1))).scalar()
    return C.top_by_mean(strata(spark, sf), n, 15, ["code"])


@query(
    "g06_as_genera",
    sql(f", {_STRATA} SELECT code, sample_name, split_part(feature, '.', 1) AS feature, sum(value) AS value FROM st GROUP BY ALL", "func"),
)
def as_genera(spark, sf):
    return C.as_genera(strata(spark, sf), ["code"])


@query(
    "g07_zero_samples",
    sql(
        """SELECT feature, (SELECT count(*) FROM meta) AS n_total, count(DISTINCT sample_name) AS n_kept,
  (SELECT count(*) FROM meta) - count(DISTINCT sample_name) AS n_lost FROM species WHERE cnt > 0 GROUP BY 1""",
        "species", "meta",
    ),
)
def zero_samples(spark, sf):
    return C.zero_samples(_cnt(spark, sf), T.metadata(spark, sf), ["feature"])


_LEVELS = """lv AS (SELECT 'S' || s_suppkey AS sample_name, 'N' || s_nationkey AS lev FROM supplier
  WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem))"""


def _nation_levels(spark, sf):
    supplier = T.table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_name"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("group"),
    )
    return supplier.join(T.metadata(spark, sf).select("sample_name"), "sample_name", "left_semi")


@query(
    "g08_collapse_levels",
    sql(
        f"""WITH {_LEVELS} SELECT sample_name, CASE WHEN lev IN (SELECT lev FROM lv GROUP BY 1 ORDER BY count(*) DESC, lev LIMIT 5)
  THEN lev ELSE 'other' END AS "group" FROM lv"""
    ),
)
def collapse_levels(spark, sf):
    return C.collapse_levels(_nation_levels(spark, sf), 5)


def input_order(spark, sf):
    """Input position of every sample: by name."""
    names = T.metadata(spark, sf).select("sample_name")
    return O.place(names, [], [("sample_name", False)])


@query(
    "g09_sample_order",
    sql(
        """SELECT sample_name, row_number() OVER (ORDER BY grp, total DESC, sample_name) - 1 AS position
FROM (SELECT sample_name, sum(cnt) AS total FROM species GROUP BY 1) JOIN meta USING (sample_name)""",
        "species", "meta",
    ),
)
def sample_order(spark, sf):
    return C.sample_order(_cnt(spark, sf), input_order(spark, sf), ["sum", "metadata"], T.metadata(spark, sf))


@query(
    "g10_dominant_order",
    sql(
        f""", {_STRATA}, peak AS (SELECT code, feature, max(value) AS k1 FROM st GROUP BY ALL),
top AS (SELECT code, sample_name, feature, value AS k3 FROM (SELECT *, row_number() OVER
  (PARTITION BY code, sample_name ORDER BY value DESC, feature DESC) AS rn FROM st) WHERE rn = 1)
SELECT code, sample_name, row_number() OVER (PARTITION BY code ORDER BY k1 DESC, feature DESC, k3 DESC, sample_name) - 1 AS position
FROM top JOIN peak USING (code, feature)""",
        "func",
    ),
)
def dominant_order(spark, sf):
    return C.sample_order(strata(spark, sf), input_order(spark, sf), ["dominant"], by=["code"])


@query(
    "g11_mean_variance",
    sql("SELECT feature, round(avg(cnt), 6) AS mean, round(var_samp(cnt), 6) AS variance FROM dense GROUP BY 1", "dense"),
)
def mean_variance(spark, sf):
    out = C.mean_variance(_cnt(spark, sf), X.group_size(T.metadata(spark, sf)))
    return out.select("feature", r6("mean", "mean"), r6("variance", "variance"))


@query(
    "g12_box_stats",
    sql(
        """, b AS (SELECT feature, grp, log2(cnt + 1) AS x FROM species JOIN meta USING (sample_name)),
q AS (SELECT feature, grp, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM b GROUP BY ALL)
SELECT feature, grp AS "group", count(*) AS n, round(min(x), 6) AS least, round(max(x), 6) AS most, round(any_value(q1), 6) AS q1,
  round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(x) FILTER (x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high FROM b JOIN q USING (feature, grp) GROUP BY ALL""",
        "species", "meta",
    ),
)
def box_stats(spark, sf):
    rows = _cnt(spark, sf).withColumn("value", M.log2_pseudo("value", 1.0)).join(T.metadata(spark, sf), "sample_name")
    out = C.box_stats(rows, ["feature", "group"])
    cols = ["least", "most", "q1", "median", "q3", "whisker_low", "whisker_high"]
    return out.select("feature", "group", "n", *[r6(c, c) for c in cols])


def tested(spark, sf):
    """Rank test, fold change and adjusted p of every species: the two-group analysis."""
    df, meta = freeze(T.species(spark, sf)), T.metadata(spark, sf)
    p = X.rank_sum(df, meta)
    return X.bh(p, "p", out="padj").join(X.log2fc(df, meta), "feature")


TESTED = """fc AS (SELECT feature, log2((avg(value) FILTER (grp = 'treatment') + 1) / (avg(value) FILTER (grp = 'control') + 1)) AS log2fc
  FROM dense GROUP BY 1),
bhr AS (SELECT feature, u, z, p, p * count(*) OVER () / rank() OVER (ORDER BY p) AS x,
  count(*) OVER () AS m, count(*) OVER (ORDER BY p) AS upto FROM tested),
res AS (SELECT feature, u, z, p, least(1.0, min(p * m / upto) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS padj, log2fc
  FROM bhr JOIN fc USING (feature))"""


@query(
    "g13_top_significant",
    sql(
        f""", {TESTED} SELECT feature, round(p, 6) AS p, round(log2fc, 6) + 0.0 AS log2fc FROM res
ORDER BY round(p, 9), feature LIMIT 30""",
        "tested",
    ),
)
def top_significant(spark, sf):
    best = C.top_significant(tested(spark, sf), [F.round("p", 9), "feature"], 30)
    return best.select("feature", r6("p", "p"), r6("log2fc", "log2fc"))


_CLASSED = """cl AS (SELECT *, CASE WHEN p < 0.05 AND abs(log2fc) > 0.01 THEN CASE WHEN log2fc > 0 THEN 'Up' ELSE 'Down' END
  ELSE 'NS' END AS direction FROM res)"""


@query(
    "g14_direction_counts",
    sql(
        f""", {TESTED}, {_CLASSED} SELECT d.direction, count(cl.feature) AS n
FROM (SELECT unnest(['Up', 'Down', 'NS']) AS direction) d LEFT JOIN cl USING (direction) GROUP BY 1""",
        "tested",
    ),
)
def direction_counts(spark, sf):
    return C.direction_counts(X.classify(tested(spark, sf), "log2fc", "p", 0.05, 0.01))


@query(
    "g15_top_variable",
    sql(
        """SELECT sample_name, feature, cnt AS value FROM species WHERE feature IN
  (SELECT feature FROM dense GROUP BY 1 ORDER BY round(var_samp(cnt), 9) DESC, feature LIMIT 1000)""",
        "dense",
    ),
)
def top_variable(spark, sf):
    out = C.top_variable(_cnt(spark, sf), X.group_size(T.metadata(spark, sf)))
    return out.select("sample_name", "feature", "value")


@query(
    "g16_prevalence",
    sql(
        """SELECT feature, grp AS "group", count(*) AS n_present, round(count(*) / any_value(n), 6) AS prevalence FROM species
JOIN meta USING (sample_name) JOIN (SELECT grp, count(*) AS n FROM meta GROUP BY 1) USING (grp) GROUP BY ALL""",
        "species", "meta",
    ),
)
def prevalence(spark, sf):
    out = C.prevalence(_cnt(spark, sf), T.metadata(spark, sf), by_group=True)
    return out.select("feature", "group", "n_present", r6("prevalence", "prevalence"))


@query(
    "g17_cumulative_abundance",
    sql(
        """, m AS (SELECT feature, round(sum(cnt) / (SELECT count(*) FROM meta), 9) AS mean FROM species GROUP BY 1)
SELECT feature, round(mean, 6) AS mean, row_number() OVER (ORDER BY mean DESC, feature) - 1 AS position,
  round(sum(mean) OVER (ORDER BY mean DESC, feature ROWS UNBOUNDED PRECEDING), 6) AS cumulative FROM m""",
        "species", "meta",
    ),
)
def cumulative_abundance(spark, sf):
    out = C.cumulative_abundance(_cnt(spark, sf), X.group_size(T.metadata(spark, sf)))
    return out.select("feature", r6("mean", "mean"), "position", r6("cumulative", "cumulative"))


# -- window effects ----------------------------------------------------------

@query(
    "w01_average_rank",
    sql(
        """SELECT sample_name, feature, rank() OVER (PARTITION BY sample_name ORDER BY cnt) +
  (count(*) OVER (PARTITION BY sample_name, cnt) - 1) / 2.0 AS rank FROM species""",
        "species",
    ),
)
def average_rank(spark, sf):
    df = _cnt(spark, sf)
    ranks = O.average_rank(df, ["sample_name"], "value")
    return df.join(ranks, ["sample_name", "value"]).select("sample_name", "feature", "rank")


@query("w02_reverse_minimum", sql(f", {TESTED} SELECT feature, round(padj, 6) AS padj FROM res", "tested"))
def reverse_minimum(spark, sf):
    return tested(spark, sf).select("feature", r6("padj", "padj"))


@query(
    "w03_row_number",
    sql(
        """SELECT sample_name, feature, row_number() OVER (PARTITION BY sample_name ORDER BY cnt DESC, feature) - 1 AS position
FROM species""",
        "species",
    ),
)
def row_number(spark, sf):
    return O.place(_cnt(spark, sf), ["sample_name"], [("value", True), ("feature", False)]).drop("value")


@query(
    "w04_share_of_total",
    sql("SELECT sample_name, feature, cnt / sum(cnt) OVER (PARTITION BY sample_name) AS value FROM species", "species"),
)
def share_of_total(spark, sf):
    return M.relative(_cnt(spark, sf), 1.0).select("sample_name", "feature", "value")


@query(
    "w05_level_separators",
    sql(
        f"""WITH {_LEVELS}, o AS (SELECT lev, row_number() OVER (ORDER BY lev, sample_name) - 1 AS position,
  lag(lev) OVER (ORDER BY lev, sample_name) AS prev FROM lv) SELECT position, lev AS "group" FROM o WHERE lev <> prev"""
    ),
)
def level_separators(spark, sf):
    levels = _nation_levels(spark, sf)
    order = C.sample_order(_cnt(spark, sf), input_order(spark, sf), ["metadata"], levels)
    return C.level_separators(order.join(levels, "sample_name"))


@query(
    "w06_stack_bases",
    sql(
        """, best AS (SELECT feature FROM species GROUP BY 1 ORDER BY sum(cnt) DESC, feature LIMIT 10),
topped AS (SELECT sample_name, coalesce(best.feature, 'Other') AS feature, sum(cnt) AS value
  FROM species LEFT JOIN best USING (feature) GROUP BY ALL),
sums AS (SELECT sample_name, sum(value) AS s FROM topped GROUP BY 1),
bars AS (SELECT *, value / s * (greatest(log10(s), fl) - fl) AS height FROM topped JOIN sums USING (sample_name),
  (SELECT floor(log10(min(s))) AS fl FROM sums))
SELECT sample_name, feature, round(height, 8) AS height, round(fl + coalesce(sum(height) OVER
  (PARTITION BY sample_name ORDER BY feature ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 8) AS base FROM bars""",
        "species",
    ),
)
def stack_bases(spark, sf):
    bars = M.stack_scale(C.top_n(T.species(spark, sf, "cnt"), 10), "logstack", floor_column="floor")
    based = M.stack_bases(bars, "feature", floor_column="floor")
    return based.select("sample_name", "feature", r6("height", "height", 8), r6("base", "base", 8))
