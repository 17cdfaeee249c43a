"""Two-group tests, multiple testing, differential analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import composition as C, discriminant as D, matrix as M, negbinom as B, outliers as O, testing as X
from taxaloom.plans.oracle import NATIONS, erfc, sql
from taxaloom.plans.queries_composition import TESTED, _CLASSED, tested
from taxaloom.plans.queries_tables import _SF
from taxaloom.plans.register import query, r6
from taxaloom.session import freeze
from taxaloom.sources import sinks, tables as T


@query(
    "i01_rank_sum",
    sql("SELECT feature, u, round(z, 6) AS z, round(p, 6) AS p FROM tested", "tested"),
)
def rank_sum(spark, sf):
    out = X.rank_sum(T.species(spark, sf), T.metadata(spark, sf))
    return out.select("feature", "u", r6("z", "z"), r6("p", "p"))


@query("i02_fold_change_means", sql(f", {TESTED} SELECT feature, round(log2fc, 6) + 0.0 AS log2fc FROM fc", "tested"))
def fold_change_means(spark, sf):
    return X.log2fc(T.species(spark, sf), T.metadata(spark, sf)).select("feature", r6("log2fc", "log2fc"))


@query(
    "i03_fold_change_logs",
    sql(
        """SELECT feature, round(avg(log2(value + 1e-9)) FILTER (grp = 'treatment') -
  avg(log2(value + 1e-9)) FILTER (grp = 'control'), 6) + 0.0 AS log2fc FROM dense GROUP BY 1""",
        "dense",
    ),
)
def fold_change_logs(spark, sf):
    return X.log2fc(T.species(spark, sf), T.metadata(spark, sf), "logs").select("feature", r6("log2fc", "log2fc"))


@query("i04_bh", sql(f", {TESTED} SELECT feature, round(p, 6) AS p, round(padj, 6) AS q FROM res", "tested"))
def bh(spark, sf):
    p = X.rank_sum(T.species(spark, sf), T.metadata(spark, sf))
    return X.bh(p, "p").select("feature", r6("p", "p"), r6("q", "q"))


@query("i05_bonferroni", sql("SELECT feature, round(p * count(*) OVER (), 4) AS adjusted FROM tested", "tested"))
def bonferroni(spark, sf):
    p = X.rank_sum(T.species(spark, sf), T.metadata(spark, sf))
    return X.bonferroni(p).select("feature", r6("adjusted", "adjusted", 4))


@query(
    "i06_classify",
    sql(f", {TESTED}, {_CLASSED} SELECT feature, direction, round(-log10(p), 5) + 0.0 AS neg_log10 FROM cl", "tested"),
)
def classify(spark, sf):
    out = X.classify(tested(spark, sf), "log2fc", "p", 0.05, 0.01)
    return out.select("feature", "direction", r6("neg_log10", "neg_log10", 5))


@query(
    "i07_labels",
    sql(f", {TESTED}, {_CLASSED} SELECT feature, direction FROM cl WHERE direction <> 'NS' ORDER BY round(p, 9), feature LIMIT 20", "tested"),
)
def labels(spark, sf):
    out = X.classify(tested(spark, sf), "log2fc", "p", 0.05, 0.01)
    return X.labels(out, 20, [F.round("p", 9), "feature"]).select("feature", "direction")


_STARS = "CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END"


@query("i08_stars", sql(f"SELECT feature, {_STARS} AS label FROM tested", "tested"))
def stars(spark, sf):
    p = X.rank_sum(T.species(spark, sf), T.metadata(spark, sf))
    return p.select("feature", X.stars("p").alias("label"))


@query("i09_group_labels", sql(f"SELECT * FROM (SELECT feature, round(p, 6) AS p, {_STARS} AS label FROM tested) WHERE label <> 'ns'", "tested"))
def group_labels(spark, sf):
    out = X.group_labels(T.species(spark, sf), T.metadata(spark, sf))
    return out.select("feature", r6("p", "p"), "label")


# Two-sided Student p by the series of the incomplete beta function, for N − 2 degrees of freedom.
_LM = """lg AS (SELECT d.feature, grp, CASE WHEN value > 0 THEN log2(value) ELSE log2(mn / 2) END AS x, value FROM dense d
  JOIN (SELECT feature, min(value) AS mn FROM species GROUP BY 1) USING (feature)),
lm0 AS (SELECT feature, avg(x) FILTER (grp = 'treatment') - avg(x) FILTER (grp = 'control') AS coef,
  var_samp(x) FILTER (grp = 'treatment') AS v1, var_samp(x) FILTER (grp = 'control') AS v2,
  count(*) FILTER (grp = 'treatment') AS n1, count(*) FILTER (grp = 'control') AS n2, count(*) FILTER (value > 0) AS nz FROM lg GROUP BY 1
  HAVING max(x) > min(x)),
lm AS (SELECT *, coef / stderr AS t, (n1 + n2 - 2) / (n1 + n2 - 2 + (coef / stderr) ^ 2) AS y FROM (SELECT *,
  sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS stderr FROM lm0)),
lp AS (SELECT *, a, CASE WHEN y < 0.9 THEN exp(a * ln(y) + 0.5 * ln(1 - y) - ln(a) - lb) * (1 + list_sum(list_transform(range(0, 400),
    lambda n: exp(lgamma(a + 1) + lgamma(n + 1) - lgamma(a + n + 2) - lgamma(a + 0.5) - lgamma(n + 1) + lgamma(a + n + 1.5) + (n + 1) * ln(y)))))
  ELSE 1 - CASE WHEN y >= 1 THEN 0 ELSE exp(0.5 * ln(1 - y) + a * ln(y) - ln(0.5) - lb) * (1 + list_sum(list_transform(range(0, 400),
    lambda n: exp(lgamma(1.5) + lgamma(n + 1) - lgamma(n + 2.5) - lgamma(a + 0.5) - lgamma(n + 1) + lgamma(a + n + 1.5) + (n + 1) * ln(1 - y))))) END END AS pval
  FROM (SELECT *, (n1 + n2 - 2) / 2.0 AS a, lgamma((n1 + n2 - 2) / 2.0) + lgamma(0.5) - lgamma((n1 + n2 - 1) / 2.0) AS lb FROM lm)),
lq AS (SELECT *, least(1.0, min(pval * m / upto) OVER (ORDER BY pval DESC RANGE UNBOUNDED PRECEDING)) AS qval
  FROM (SELECT *, count(*) OVER () AS m, count(*) OVER (ORDER BY pval) AS upto FROM lp))"""


@query(
    "j01_linear_model",
    sql(
        f""", {_LM} SELECT feature, round(coef, 6) + 0.0 AS coef, round(stderr, 6) AS stderr, n1 + n2 AS n, nz AS n_not_0,
  round(t, 5) + 0.0 AS t, round(pval, 6) AS pval, round(qval, 6) AS qval FROM lq""",
        "dense",
    ),
)
def linear_model(spark, sf):
    out = X.linear_model(T.species(spark, sf), T.metadata(spark, sf))
    return out.select(
        "feature", r6("coef", "coef"), r6("stderr", "stderr"), "n", "n_not_0", r6("t", "t", 5), r6("pval", "pval"),
        r6("qval", "qval"),
    )


@query(
    "j02_lm_prefilter",
    sql(
        """SELECT feature, count(*) AS n FROM species GROUP BY 1 HAVING count(*) > 0.2 * (SELECT count(*) FROM meta)
  AND (min(value) < max(value) OR count(*) < (SELECT count(*) FROM meta))""",
        "species", "meta",
    ),
)
def lm_prefilter(spark, sf):
    kept = X.lm_prefilter(T.species(spark, sf), X.group_size(T.metadata(spark, sf)), 0.2)
    return kept.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


_KW = """kw AS (SELECT feature, (12 / (n * (n + 1.0)) * s - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h FROM (
  SELECT feature, sum(r * r / k) AS s, sum(k)::DOUBLE AS n, any_value(ties) AS ties FROM (
    SELECT feature, grp, sum(rk) AS r, count(*) AS k FROM ranked GROUP BY ALL)
  JOIN (SELECT feature, sum(t * t - 1.0) AS ties FROM ranked GROUP BY 1) USING (feature) GROUP BY 1))"""


@query(
    "j03_kruskal",
    sql(f", {_KW} SELECT feature, round(h, 6) + 0.0 AS h, 1.0::DOUBLE AS df, round({erfc('sqrt(greatest(h, 0) / 2)')}, 6) AS p FROM kw", "ranked"),
)
def kruskal(spark, sf):
    out = X.kruskal(T.species(spark, sf), T.metadata(spark, sf))
    return out.select("feature", r6("h", "h"), "df", r6("p", "p"))


@query("j04_lda_effect")
def lda_effect(spark, sf):
    return D.lda_effect(T.species(spark, sf), T.metadata(spark, sf), kw=0.05, threshold=0.0)


_NSUM = ", ".join(f"coalesce(sum(v) FILTER (sample_name = '{n}'), 0)::DOUBLE AS \"{n}\"" for n in NATIONS)


@query(
    "j05_top_scores_with_matrix",
    sql(
        f""", sc AS (SELECT feature, coef FROM (
  SELECT clade_name AS feature, round(sum(CASE WHEN CAST(substr(sample_name, 8) AS INTEGER) % 2 = 1 THEN cnt ELSE -cnt END), 6) AS coef
  FROM prof_n GROUP BY 1) ORDER BY abs(coef) DESC, feature LIMIT 50)
SELECT sc.feature, coef, {_NSUM} FROM sc JOIN (SELECT sample_name, clade_name AS feature, cnt AS v FROM prof_n) USING (feature) GROUP BY 1, 2""",
        "prof_n",
    ),
)
def top_scores_with_matrix(spark, sf):
    df = T.profile(spark, sf, sample="nation").select(
        "sample_name", F.col("clade_name").alias("feature"), F.col("cnt").alias("value")
    )
    odd = F.substring("sample_name", 8, 8).cast("int") % 2 == 1
    scores = df.groupBy("feature").agg(
        F.round(F.sum(F.when(odd, F.col("value")).otherwise(-F.col("value"))), 6).alias("coef")
    )
    best = C.top_significant(scores, [F.abs("coef").desc(), "feature"], 50)
    return sinks.attach_wide(best, M.to_wide(df.join(best.select("feature"), "feature", "left_semi"), NATIONS), how="inner")


@query(
    "j06_merge_results",
    sql(
        f""", {_LM}, {_KW} SELECT lm.feature, round(coef, 6) + 0.0 AS coef, round(h, 6) + 0.0 AS h FROM lm
LEFT JOIN (SELECT * FROM kw WHERE h > 2) USING (feature)""",
        "ranked",
    ),
)
def merge_results(spark, sf):
    df, meta = T.species(spark, sf), T.metadata(spark, sf)
    second = X.kruskal(df, meta).filter("h > 2").select("feature", r6("h", "h"))
    return X.linear_model(df, meta).select("feature", r6("coef", "coef")).join(second, "feature", "left")


def _counts(spark, sf):
    return T.gene_counts(spark, sf).groupBy("sample_name", F.col("gene_id").alias("feature")).agg(F.sum("count").alias("value"))


@query("j07_nb_dispersion")
def nb_dispersion(spark, sf):
    fitted, _, _ = B.dispersions(_counts(spark, sf), T.metadata(spark, sf), factors="poscounts")
    return fitted.select("feature", "base_mean", "disp_gene")


def _modes_sql(rounds: int = 9) -> str:
    """``md(feature, x)``: log dispersion of the highest adjusted likelihood, by nested grids of 24 points."""
    out = """nm AS (SELECT count(*) AS n FROM meta),
dn AS (SELECT f.feature, grp, size_factor AS s, coalesce(value, 0)::DOUBLE AS k FROM (SELECT DISTINCT feature FROM cc WHERE value > 0) f
  CROSS JOIN meta JOIN sizef USING (sample_name) LEFT JOIN cc ON cc.feature = f.feature AND cc.sample_name = meta.sample_name),
qs AS (SELECT feature, grp, avg(k / s) AS q FROM dn GROUP BY ALL),
ms AS (SELECT dn.feature, dn.grp, k, greatest(s * q, 0.5) AS mu FROM dn JOIN qs USING (feature, grp)),
g0 AS (SELECT DISTINCT feature, ln(1e-8) AS lo, ln(greatest(10, n)) AS hi FROM dn, nm)"""
    for r in range(rounds):
        out += f""",
e{r} AS (SELECT feature, x, sum(l) - 0.5 * ln(sum(w) FILTER (grp = 'treatment') * sum(w) FILTER (grp = 'control')) AS v FROM (
  SELECT feature, x, grp, mu / (1 + exp(x) * mu) AS w, k * ln(mu) - (k + exp(-x)) * ln(1 + exp(x) * mu)
    + CASE WHEN k > 0 THEN list_sum(list_transform(range(0, k::BIGINT), lambda j: ln(1 + exp(x) * j))) ELSE 0 END AS l
  FROM ms JOIN (SELECT feature, lo + (hi - lo) * i / 23 AS x FROM g{r}, range(0, 24) t(i)) USING (feature)) GROUP BY feature, x),
b{r} AS (SELECT feature, arg_max(x, v) AS x FROM e{r} GROUP BY 1),
g{r + 1} AS (SELECT feature, greatest(x - (hi - lo) / 23, ln(1e-8)) AS lo,
  least(x + (hi - lo) / 23, (SELECT ln(greatest(10, n)) FROM nm)) AS hi FROM g{r} JOIN b{r} USING (feature))"""
    return out + f", md AS (SELECT feature, x FROM b{rounds - 1})"


@query(
    "j07b_dispersion_modes",
    sql(
        f""", {_SF}, {_modes_sql()}, bm AS (SELECT feature, avg(k / s) AS base_mean FROM dn GROUP BY 1)
SELECT feature, round(base_mean, 6) AS base_mean, round(greatest(x, -9.0), 2) AS log_dispersion FROM md JOIN bm USING (feature)""",
        "genes", "meta",
    ),
)
def dispersion_modes(spark, sf):
    """Gene-wise dispersions as logarithms; below exp(-9) a likelihood is flat and only that is told."""
    fitted, _, _ = B.dispersions(_counts(spark, sf), T.metadata(spark, sf), factors="poscounts")
    log = F.greatest(F.ln("disp_gene"), F.lit(-9.0))
    return fitted.select("feature", r6("base_mean", "base_mean"), r6(log, "log_dispersion", 2))


@query("j08_dispersion_trend")
def dispersion_trend(spark, sf):
    """Trend and shrunken dispersions; the coefficients are null where the trend is the local one."""
    fitted, trend, _ = B.dispersions(_counts(spark, sf), T.metadata(spark, sf), factors="poscounts")
    a0, a1 = trend if isinstance(trend, tuple) else (None, None)
    coefficient = lambda v: F.lit(v).cast("double")
    return fitted.select("feature", "disp_fit", "dispersion", coefficient(a0).alias("a0"), coefficient(a1).alias("a1"))


@query("j09_nb_glm")
def nb_glm(spark, sf):
    return B.nb_glm(_counts(spark, sf), T.metadata(spark, sf), factors="poscounts")


_TRIM = "CASE WHEN n <= 3 THEN 1.0 / 3 WHEN n <= 23 THEN 0.25 ELSE 0.125 END"
_SCALE = "CASE WHEN n <= 3 THEN 2.04 WHEN n <= 23 THEN 1.86 ELSE 1.51 END"
# Gene counts with planted outliers: about one count in a hundred is a thousand larger.
_PLANTED = """pc AS (SELECT sample_name, gene_id AS feature, sum(count) + max(CASE WHEN (substr(sample_name, 2)::BIGINT * 7
  + substr(gene_id, 2)::BIGINT * 3) % 101 = 0 THEN 1000 ELSE 0 END) AS value FROM genes GROUP BY ALL),
pd AS (SELECT f.feature, meta.sample_name, grp, coalesce(value, 0)::DOUBLE AS x, count(*) OVER (PARTITION BY f.feature, grp) AS n
  FROM (SELECT DISTINCT feature FROM pc) f CROSS JOIN meta LEFT JOIN pc ON pc.feature = f.feature AND pc.sample_name = meta.sample_name),"""
_COOKS = f"""{_PLANTED}
pm AS (SELECT *, floor(n * ({_TRIM}) + 1e-9) AS cut, row_number() OVER (PARTITION BY feature, grp ORDER BY x) - 1 AS rk,
  greatest(avg(x) OVER (PARTITION BY feature, grp), 0.5) AS mu, avg(x) OVER (PARTITION BY feature) AS m FROM pd),
ps AS (SELECT *, avg(x) FILTER (rk >= cut AND rk < n - cut) OVER (PARTITION BY feature, grp) AS centre FROM pm),
pe AS (SELECT *, (x - centre) ^ 2 AS e, row_number() OVER (PARTITION BY feature, grp ORDER BY (x - centre) ^ 2) - 1 AS at_e FROM ps),
pv AS (SELECT feature, max(v) AS v FROM (SELECT feature, grp, avg(e) FILTER (at_e >= cut AND at_e < n - cut) * ({_SCALE}) AS v
  FROM pe GROUP BY feature, grp, n HAVING n >= 3) GROUP BY 1),
pk AS (SELECT feature, sample_name, grp, n, x, (x - mu) ^ 2 / (mu + greatest((v - m) / m ^ 2, 0.04) * mu ^ 2) / 2
  * (1.0 / n) / (1 - 1.0 / n) ^ 2 AS cooks FROM ps JOIN pv USING (feature) WHERE n >= 3),
pl AS (SELECT (count(*) - 2) / 2.0 * ((1 - 0.99) ^ (-2.0 / (count(*) - 2)) - 1) AS lim FROM meta),
pf AS (SELECT pk.* FROM pk, pl WHERE cooks > lim),
pt AS (SELECT feature, avg(x) FILTER (rk >= floor(n * 0.2 + 1e-9) AND rk < n - floor(n * 0.2 + 1e-9)) AS t FROM (
  SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS rk, count(*) OVER (PARTITION BY feature) AS n FROM pd) GROUP BY 1),
pr AS (SELECT feature, sample_name, cooks, CASE WHEN n >= 7 THEN floor(t + 1e-9) END AS new_value FROM pf JOIN pt USING (feature)),"""


def _planted(spark, sf):
    counts = _counts(spark, sf)
    number = lambda c: F.substring(F.col(c), 2, 20).cast("bigint")
    far = (number("sample_name") * 7 + number("feature") * 3) % 101 == 0
    return counts.withColumn("value", (F.col("value") + F.when(far, 1000).otherwise(0)).cast("double"))


def _unit_cells(spark, sf):
    """Cells without size factors and the group means: leverages are one over the group's size."""
    samples = T.metadata(spark, sf).select(
        "sample_name", "group", F.lit(1.0).alias("size_factor"),
        F.when(F.col("group") == X.TREATMENT, 1.0).otherwise(0.0).alias("treated"),
    )
    cells = B._Cells(freeze(_planted(spark, sf)), freeze(samples))
    return cells, freeze(B.group_means(cells.counts, cells.samples).withColumn("alpha", F.lit(0.1)))


@query(
    "j09b_cooks_outliers",
    sql(f", {_COOKS.rstrip(',')} SELECT feature, sample_name, round(cooks, 6) AS cooks, new_value FROM pr", "genes", "meta"),
)
def cooks_outliers(spark, sf):
    """Counts with a large Cook's distance, and what replaces them in groups of seven or more."""
    cells, state = _unit_cells(spark, sf)
    flags = B.cooks_outliers(cells, state)
    new = O.replaced(cells.counts, flags, cells.samples).withColumnRenamed("value", "new_value")
    return flags.join(new, ["feature", "sample_name"], "left").select(
        "feature", "sample_name", r6("cooks", "cooks"), "new_value"
    )


@query(
    "j09c_refitted_means",
    sql(
        f""", {_COOKS} pn AS (SELECT pd.feature, grp, coalesce(new_value, x) AS x FROM pd LEFT JOIN pr
  ON pr.feature = pd.feature AND pr.sample_name = pd.sample_name WHERE pd.feature IN (SELECT feature FROM pr WHERE new_value IS NOT NULL))
SELECT feature, round(avg(x), 6) AS base_mean, round(avg(x) FILTER (grp = 'treatment'), 6) AS q_t,
  round(avg(x) FILTER (grp = 'control'), 6) AS q_c FROM pn GROUP BY 1 HAVING sum(x) > 0""",
        "genes", "meta",
    ),
)
def refitted_means(spark, sf):
    """Group means of the features that had counts replaced, by the model's own Newton steps."""
    cells, state = _unit_cells(spark, sf)
    new = freeze(O.replaced(cells.counts, B.cooks_outliers(cells, state), cells.samples))
    counts = freeze(O.with_replacements(cells.counts, new))
    level = B.group_means(counts, cells.samples).withColumn("alpha", F.lit(0.1))
    out = B.settled_means(B._Cells(counts, cells.samples), freeze(level))
    # A mean of zero stays on the floor of the steps, a millionth of the feature's.
    mean = lambda c: F.when(F.col(c) > F.col("base_mean") * 2e-6, F.col(c)).otherwise(0.0)
    return out.select("feature", r6("base_mean", "base_mean"), r6(mean("q_t"), "q_t"), r6(mean("q_c"), "q_c"))


_MOMENTS = """mo AS (SELECT feature, avg(x) AS mean, greatest((var_samp(x) - avg(x)) / avg(x) ^ 2, 1e-8) AS alpha FROM pd GROUP BY 1),
us AS (SELECT ln(mean) AS lx, ln(alpha) AS ly, mean AS w FROM mo WHERE alpha > 1e-6),
bo AS (SELECT min(lx) AS lo, (max(lx) - min(lx)) / 64 AS width FROM us),
pa AS (SELECT least(floor((lx - lo) / width), 63)::INTEGER AS bin, sum(w) AS mass, sum(w * lx) / sum(w) AS x, sum(w * ly) / sum(w) AS y FROM us, bo GROUP BY 1),
ev AS (SELECT a.bin AS pt, lo + (a.bin + 0.5) * width AS x0, b.bin, b.mass, b.x, b.y, abs(b.x - (lo + (a.bin + 0.5) * width)) AS gap FROM pa a CROSS JOIN pa b, bo),
he AS (SELECT *, coalesce(sum(mass) OVER (PARTITION BY pt ORDER BY gap, bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  < 0.7 * sum(mass) OVER (PARTITION BY pt) AS inside FROM ev),
re AS (SELECT *, max(gap) FILTER (inside) OVER (PARTITION BY pt) AS reach FROM he),
wt AS (SELECT pt, x0, bin, mass * (1 - (gap / (reach * 1.0001 + 1e-12)) ^ 3) ^ 3 AS weight, x, y FROM re WHERE inside)"""


def _moments(spark, sf):
    """Mean and moment dispersion per feature, for the trend alone."""
    n = X.group_size(T.metadata(spark, sf))
    stats = C.mean_variance(_planted(spark, sf), n)
    return stats.select(
        "mean", F.greatest((F.col("variance") - F.col("mean")) / F.pow("mean", 2), F.lit(1e-8)).alias("alpha")
    )


@query(
    "j08b_local_weights",
    sql(f", {_PLANTED} {_MOMENTS} SELECT pt AS point, bin, round(weight, 6) AS weight, round(x, 6) AS x, round(y, 6) AS y FROM wt", "genes", "meta"),
)
def local_weights(spark, sf):
    """What each point of the local trend leans on, by how much."""
    out = B.local_weights(freeze(_moments(spark, sf)))
    return out.select(F.col("at").alias("point"), "bin", r6("weight", "weight"), r6("x", "x"), r6("y", "y"))


@query(
    "j08c_local_trend",
    sql(
        f""", {_PLANTED} {_MOMENTS}, su AS (SELECT pt, x0, sum(weight) AS sw, sum(weight * (x - x0)) AS sx, sum(weight * (x - x0) ^ 2) AS sxx,
  sum(weight * y) AS sy, sum(weight * (x - x0) * y) AS sxy FROM wt GROUP BY ALL)
SELECT round(x0, 6) AS log_mean, round(CASE WHEN sw * sxx - sx ^ 2 > 1e-9 * sw * sxx THEN (sxx * sy - sx * sxy) / (sw * sxx - sx ^ 2)
  ELSE sy / sw END, 6) AS log_dispersion FROM su""",
        "genes", "meta",
    ),
)
def local_trend(spark, sf):
    points = B.local_trend(freeze(_moments(spark, sf)))
    return spark.createDataFrame([(round(x, 6), round(y, 6)) for x, y in points], "log_mean double, log_dispersion double")


_IF = """base AS (SELECT feature, avg(cnt) AS m FROM dense GROUP BY 1),
inp AS (SELECT feature, p, m FROM tested JOIN base USING (feature)),
lo AS (SELECT count(*) FILTER (m = 0) / count(*) AS lo FROM inp),
srt AS (SELECT m, row_number() OVER (ORDER BY m) - 1 AS pos, count(*) OVER () AS n FROM inp),
cut AS (SELECT i, (SELECT m FROM srt WHERE pos = floor(h)) AS a, (SELECT m FROM srt WHERE pos = ceil(h)) AS b, h FROM
  (SELECT i, ((SELECT count(*) FROM inp) - 1) * (lo + (0.95 - lo) * i / 49) AS h FROM lo, range(0, 50) r(i))),
cutv AS (SELECT i, a + (h - floor(h)) * (b - a) AS c FROM cut),
rej AS (SELECT i, c, count(*) OVER (PARTITION BY i) AS m, p, count(*) OVER (PARTITION BY i ORDER BY p) AS upto FROM inp, cutv WHERE inp.m >= cutv.c),
best AS (SELECT c FROM (SELECT i, c, coalesce(max(upto) FILTER (p * m / upto < 0.9), 0) AS r FROM rej GROUP BY ALL) ORDER BY r DESC, i LIMIT 1),
kept AS (SELECT feature, p, count(*) OVER () AS k, count(*) OVER (ORDER BY p) AS upto FROM inp WHERE m >= (SELECT c FROM best))"""


@query(
    "j10_independent_filter",
    sql(
        f""", {_IF} SELECT feature, round(inp.p, 6) AS pvalue, round(a.padj, 6) AS padj FROM inp LEFT JOIN
  (SELECT feature, least(1.0, min(p * k / upto) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS padj FROM kept) a USING (feature)""",
        "tested",
    ),
)
def independent_filter(spark, sf):
    df, meta = T.species(spark, sf, "cnt"), T.metadata(spark, sf)
    p = X.rank_sum(T.species(spark, sf), meta).select("feature", F.col("p").alias("pvalue"))
    mean = C.mean_variance(df, X.group_size(meta)).select("feature", F.col("mean").alias("base_mean"))
    out = X.independent_filter(p.join(mean, "feature"), alpha=0.9)
    return out.select("feature", r6("pvalue", "pvalue"), r6("padj", "padj"))


def _lowess_sql(points: str, rounds: int = 3) -> str:
    """``fit(i, y, f)``: the robust local lines through ``points(i, x, y)``, one more set of expressions per round."""
    out = f"""ng AS (SELECT a.i, a.x AS xi, b.i AS j, b.x, b.y, abs(a.x - b.x) AS gap FROM {points} a CROSS JOIN {points} b),
rc AS (SELECT i, max(gap) AS reach FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY gap) AS k FROM ng) WHERE k <= 10 GROUP BY 1),
tr AS (SELECT ng.*, CASE WHEN gap <= 0.001 * reach THEN 1 WHEN gap > 0.999 * reach THEN 0 ELSE (1 - (gap / reach) ^ 3) ^ 3 END AS t
  FROM ng JOIN rc USING (i)), rw0 AS (SELECT i AS j, 1.0::DOUBLE AS r FROM {points})"""
    for k in range(rounds + 1):
        out += f""", ce{k} AS (SELECT i, xi, sum(t * r) AS tot, sum(t * r * x) / sum(t * r) AS c, sum(t * r * y) / sum(t * r) AS m FROM tr JOIN rw{k} USING (j) GROUP BY i, xi),
sl{k} AS (SELECT i, sum(t * r * (x - c) ^ 2) / any_value(tot) AS v, sum(t * r * (x - c) * y) / any_value(tot) AS q FROM tr JOIN rw{k} USING (j) JOIN ce{k} USING (i, xi) GROUP BY i),
fi{k} AS (SELECT i, p.y, CASE WHEN sqrt(v) > 0.001 * (SELECT max(x) - min(x) FROM {points}) THEN m + q / v * (xi - c) ELSE m END AS f
  FROM ce{k} JOIN sl{k} USING (i) JOIN {points} p USING (i)),
sc{k} AS (SELECT 6 * median(abs(y - f)) AS s, avg(abs(y - f)) AS a FROM fi{k}),
rw{k + 1} AS (SELECT i AS j, CASE WHEN s < 1e-7 * a THEN r WHEN abs(y - f) <= 0.001 * s THEN 1 WHEN abs(y - f) <= 0.999 * s
  THEN (1 - ((y - f) / s) ^ 2) ^ 2 ELSE 0 END AS r FROM fi{k}, sc{k}, rw{k} WHERE rw{k}.j = fi{k}.i)"""
    return out + f", fit AS (SELECT i, y, f FROM fi{rounds})"


_PLANTED_P = ("ra AS value, cnt FROM prof", "ra * CASE WHEN length(clade_name) % 3 = 0 AND substr(sample_name, 2)::BIGINT % 2 = 1 "
              "THEN 3 ELSE 1 END AS value, cnt FROM prof")  # fmt: skip
_SMOOTHED = f"""{_IF[: _IF.index("best AS")].rstrip().rstrip(",")},
pt AS (SELECT i, lo + (0.95 - lo) * i / 49 AS x, coalesce(r, 0)::DOUBLE AS y FROM lo, range(0, 50) g(i)
  LEFT JOIN (SELECT i AS h, max(upto) FILTER (p * m / upto < 0.1) AS r FROM rej GROUP BY 1) ON h = i), {_lowess_sql("pt")},
ch AS (SELECT CASE WHEN max(y) <= 10 THEN 0 ELSE coalesce(min(i) FILTER (y > lim), 0) END AS i FROM fit,
  (SELECT max(f) - sqrt(avg((y - f) ^ 2) FILTER (y > 0)) AS lim FROM fit)),
best AS (SELECT c FROM cutv WHERE i = (SELECT i FROM ch)),
{_IF[_IF.index("kept AS"):]}"""


@query(
    "j10b_smoothed_filter",
    sql(
        f""", {_SMOOTHED} SELECT feature, round(inp.p, 6) AS pvalue, round(a.padj, 6) AS padj FROM inp LEFT JOIN
  (SELECT feature, least(1.0, min(p * k / upto) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS padj FROM kept) a USING (feature)""",
        "tested",
    ).replace(*_PLANTED_P),
)
def smoothed_filter(spark, sf):
    """The smoothed rule at level 0.1; a third of the species are three times as common in the treatment."""
    meta = T.metadata(spark, sf)
    more = (F.length("feature") % 3 == 0) & (F.substring("sample_name", 2, 20).cast("bigint") % 2 == 1)
    planted = T.species(spark, sf).withColumn("value", F.col("value") * F.when(more, 3).otherwise(1))
    p = X.rank_sum(planted, meta).select("feature", F.col("p").alias("pvalue"))
    mean = C.mean_variance(T.species(spark, sf, "cnt"), X.group_size(meta)).select("feature", F.col("mean").alias("base_mean"))
    out = X.independent_filter(p.join(mean, "feature"), alpha=0.1, rule="smoothed")
    return out.select("feature", r6("pvalue", "pvalue"), r6("padj", "padj"))


@query("j11_ma_table")
def ma_table(spark, sf):
    return B.nb_glm(_counts(spark, sf), T.metadata(spark, sf), factors="poscounts").select("base_mean", "log2_fold_change", "padj")


@query(
    "j12_roc",
    sql(
        """, n AS (SELECT count(*) FILTER (grp = 'treatment') AS nt, count(*) FILTER (grp = 'control') AS nc FROM meta)
SELECT DISTINCT feature, value AS threshold, round(count(*) FILTER (grp = 'treatment') OVER w / nt, 6) AS tpr,
  round(count(*) FILTER (grp = 'control') OVER w / nc, 6) AS fpr FROM dense, n
WINDOW w AS (PARTITION BY feature ORDER BY value DESC RANGE UNBOUNDED PRECEDING)""",
        "dense",
    ),
)
def roc(spark, sf):
    out = X.roc(T.species(spark, sf), T.metadata(spark, sf))
    return out.select("feature", "threshold", r6("tpr", "tpr"), r6("fpr", "fpr"))


@query("j12b_auc", sql("SELECT feature, round(u / (n_t * n_c), 6) AS auc FROM ranksum", "ranksum"))
def auc(spark, sf):
    return X.auc(T.species(spark, sf), T.metadata(spark, sf)).select("feature", r6("auc", "auc"))
