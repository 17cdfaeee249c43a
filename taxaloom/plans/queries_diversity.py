"""Alpha and beta diversity, ordination, clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxaloom.operators import composition as C, matrix as M, ordination as N, pairs as P, testing as X
from taxaloom.plans.oracle import dealt, exact_p, sql
from taxaloom.plans.queries_io import _ALPHA
from taxaloom.plans.queries_tables import _SF, _factors, gene_counts
from taxaloom.plans.register import query, r6
from taxaloom.session import freeze
from taxaloom.sources import tables as T


def _cnt(spark, sf):
    return T.species(spark, sf, "cnt")


def _alpha_query(name, column):
    @query(name, sql(f", {_ALPHA} SELECT sample_name, round({column}, 6) AS {column} FROM alpha", "species"))
    def run(spark, sf):
        return P.alpha(_cnt(spark, sf)).select("sample_name", r6(F.col(column).cast("double"), column))

    return run


_alpha_query("h01_shannon", "shannon")
_alpha_query("h02_simpson", "simpson")
_alpha_query("h03_chao1", "chao1")
_alpha_query("h05_pielou", "pielou_e")


@query("h04_richness", sql(f", {_ALPHA} SELECT sample_name, species_richness FROM alpha", "species"))
def richness(spark, sf):
    return P.alpha(_cnt(spark, sf)).select("sample_name", "species_richness")


@query(
    "h06_alpha_table",
    sql(
        f""", {_ALPHA} SELECT sample_name, round(shannon, 6) AS shannon, species_richness, round(simpson, 6) AS simpson,
  round(chao1, 6) AS chao1, round(pielou_e, 6) AS pielou_e, grp AS "group" FROM alpha JOIN meta USING (sample_name)""",
        "species", "meta",
    ),
)
def alpha_table(spark, sf):
    return M.with_group(P.alpha(_cnt(spark, sf)), T.metadata(spark, sf)).select(
        "sample_name", r6("shannon", "shannon"), "species_richness", r6("simpson", "simpson"), r6("chao1", "chao1"),
        r6("pielou_e", "pielou_e"), "group",
    )


@query(
    "h07_alpha_test",
    sql(
        f""", {_ALPHA}, lg AS (SELECT grp, unnest(['shannon', 'simpson', 'chao1', 'species_richness', 'pielou_e']) AS feature,
  round(unnest([shannon, simpson, chao1, species_richness, pielou_e]), 9) AS value FROM alpha JOIN meta USING (sample_name)),
lgn AS (SELECT * FROM lg WHERE value IS NOT NULL),
rk AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rk,
  count(*) OVER (PARTITION BY feature, value) AS t FROM lgn WINDOW w AS (PARTITION BY feature ORDER BY value)),
us AS (SELECT feature, count(*) FILTER (grp = 'treatment')::DOUBLE AS n_t, count(*) FILTER (grp = 'control')::DOUBLE AS n_c,
  sum(rk) FILTER (grp = 'treatment') - n_t * (n_t + 1) / 2 AS u, sum(t * t - 1.0) AS ties FROM rk GROUP BY 1),
zs AS (SELECT *, greatest((abs(u - n_t * n_c / 2) - 0.5) / sqrt(n_t * n_c / 12 * ((n_t + n_c + 1) - ties / ((n_t + n_c) * (n_t + n_c - 1)))), 0) AS z FROM us)
, dealt AS ({dealt("zs")}) SELECT feature AS metric, u, round(p, 6) AS p FROM {exact_p("zs", "least(n_t, n_c) <= 8")}""",
        "species", "meta",
    ),
)
def alpha_test(spark, sf):
    out = P.alpha_test(_cnt(spark, sf), T.metadata(spark, sf))
    return out.select(F.col("feature").alias("metric"), "u", r6("p", "p"))


_BC = """tt AS (SELECT sample_name, sum(cnt) AS t FROM species GROUP BY 1),
bc AS (SELECT a.sample_name AS s1, b.sample_name AS s2, 1 - 2 * coalesce(acc, 0) / (a.t + b.t) AS d
  FROM tt a JOIN tt b ON a.sample_name < b.sample_name LEFT JOIN
  (SELECT x.sample_name AS s1, y.sample_name AS s2, sum(least(x.cnt, y.cnt)) AS acc FROM species x JOIN species y
   ON x.feature = y.feature AND x.sample_name < y.sample_name GROUP BY ALL) m ON m.s1 = a.sample_name AND m.s2 = b.sample_name)"""


@query("h08_bray_curtis", sql(f", {_BC} SELECT s1, s2, round(d, 6) AS d FROM bc", "species"))
def bray_curtis(spark, sf):
    return P.bray_curtis(_cnt(spark, sf)).select("s1", "s2", r6("d", "d"))


@query(
    "h08b_bray_curtis_shares",
    sql(
        """, sh AS (SELECT sample_name, feature, cnt / sum(cnt) OVER (PARTITION BY sample_name) AS v FROM species)
SELECT x.sample_name AS s1, y.sample_name AS s2, round(1 - sum(least(x.v, y.v)), 6) AS d FROM sh x JOIN sh y
  ON x.feature = y.feature AND x.sample_name < y.sample_name GROUP BY ALL""",
        "species",
    ),
)
def bray_curtis_shares(spark, sf):
    return P.bray_curtis(_cnt(spark, sf), weighted=False).select("s1", "s2", r6("d", "d"))


_EMPTY = """, m2 AS (SELECT sample_name FROM meta UNION ALL SELECT unnest(['Empty1', 'Empty2'])),
tt AS (SELECT m2.sample_name, coalesce(sum(cnt), 0) AS t FROM m2 LEFT JOIN species USING (sample_name) GROUP BY 1)
SELECT a.sample_name AS s1, b.sample_name AS s2, round(CASE WHEN a.t + b.t = 0 THEN 0 ELSE 1 - 2 * coalesce(acc, 0) / (a.t + b.t) END, 6) AS d
  FROM tt a JOIN tt b ON a.sample_name < b.sample_name LEFT JOIN
  (SELECT x.sample_name AS s1, y.sample_name AS s2, sum(least(x.cnt, y.cnt)) AS acc FROM species x JOIN species y
   ON x.feature = y.feature AND x.sample_name < y.sample_name GROUP BY ALL) m ON m.s1 = a.sample_name AND m.s2 = b.sample_name"""


@query("h08c_empty_sample", sql(_EMPTY, "species", "meta"))
def empty_sample(spark, sf):
    """Two samples of the metadata have no rows."""
    names = T.metadata(spark, sf).select("sample_name")
    names = names.unionByName(spark.range(1, 3).select(F.concat(F.lit("Empty"), "id").alias("sample_name")))
    return P.bray_curtis(_cnt(spark, sf), samples=names).select("s1", "s2", r6("d", "d"))


@query("h09_pcoa")
def pcoa(spark, sf):
    return N.pcoa(P.bray_curtis(_cnt(spark, sf)), 2)


_LABELS = """lab AS (SELECT sample_name, 0 AS perm, grp FROM meta UNION ALL
  SELECT d.sample_name, d.perm, n.grp FROM (SELECT sample_name, perm, row_number() OVER (PARTITION BY perm
    ORDER BY md5('42:' || perm || ':' || sample_name), sample_name) AS pos FROM meta, range(1, 501) r(perm)) d
  JOIN (SELECT grp, row_number() OVER (ORDER BY sample_name) AS pos FROM meta) n USING (pos)),
sst AS (SELECT sum(d * d) / (SELECT count(*) FROM meta) AS sst FROM bc),
ssw AS (SELECT perm, sum(ss / n) AS ssw FROM (SELECT a.perm, a.grp, sum(d * d) AS ss FROM bc
  JOIN lab a ON a.sample_name = s1 JOIN lab b ON b.sample_name = s2 AND b.perm = a.perm AND b.grp = a.grp GROUP BY ALL)
  JOIN (SELECT grp, count(*) AS n FROM meta GROUP BY 1) USING (grp) GROUP BY 1),
fs AS (SELECT perm, sst, ssw, (sst - ssw) / 1.0 / (ssw / ((SELECT count(*) FROM meta) - 2.0)) AS f FROM ssw, sst)"""


@query(
    "h10_permanova",
    sql(
        f""", {_BC}, {_LABELS} SELECT round(a.sst, 6) AS sst, round(a.ssw, 6) AS ssw, round(a.f, 6) AS f,
  round((1 + (SELECT count(*) FROM fs WHERE perm > 0 AND fs.f >= a.f * (1 - 1e-9))) / 501.0, 6) AS p FROM fs a WHERE perm = 0""",
        "species", "meta",
    ),
)
def permanova(spark, sf):
    out = P.permanova(P.bray_curtis(_cnt(spark, sf), packed=True), T.metadata(spark, sf), 500, 42)
    return out.select(*[r6(c, c) for c in ("sst", "ssw", "f", "p")])


_SOME = "(SELECT meta.* FROM meta JOIN supplier ON sample_name = 'S' || s_suppkey WHERE s_acctbal >= 0)"


@query(
    "h10b_unmatched_sample",
    sql(
        f""", {_BC.replace("FROM species GROUP", "FROM species WHERE sample_name IN (SELECT sample_name FROM meta5) GROUP")},
{_LABELS.replace("FROM meta", "FROM meta5")} SELECT round(a.sst, 6) AS sst, round(a.ssw, 6) AS ssw, round(a.f, 6) AS f,
  round((1 + (SELECT count(*) FROM fs WHERE perm > 0 AND fs.f >= a.f * (1 - 1e-9))) / 501.0, 6) AS p FROM fs a WHERE perm = 0""".replace(
            ", tt AS", f", meta5 AS {_SOME}, tt AS"
        ),
        "species", "meta",
    ),
)
def unmatched_sample(spark, sf):
    """Suppliers in debt have no metadata here; their distances are left out."""
    name = F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_name")
    solvent = T.table(spark, sf, "supplier").filter("s_acctbal >= 0").select(name)
    meta = T.metadata(spark, sf).join(solvent, "sample_name", "left_semi")
    out = P.permanova(P.bray_curtis(_cnt(spark, sf), packed=True), meta, 500, 42, unmatched="drop")
    return out.select(*[r6(c, c) for c in ("sst", "ssw", "f", "p")])


_POINTS = """pts AS (SELECT grp, sum(CASE WHEN contains(feature, 'p__ECONOMY') THEN value ELSE 0 END) AS x,
  sum(CASE WHEN contains(feature, 'p__PROMO') THEN value ELSE 0 END) AS y FROM species JOIN meta USING (sample_name) GROUP BY sample_name, grp),
mo AS (SELECT grp, count(*) AS n, avg(x) AS cx, avg(y) AS cy, var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM pts GROUP BY 1),
ev AS (SELECT *, (a + b) / 2 + sqrt(((a - b) / 2) ^ 2 + c * c) AS major, (a + b) / 2 - sqrt(((a - b) / 2) ^ 2 + c * c) AS minor FROM mo)"""


def _points(spark, sf):
    """Two coordinates per sample: the shares of two phyla."""
    def share(p):
        return F.sum(F.when(F.col("feature").contains(p), F.col("value")).otherwise(0.0))

    pts = T.species(spark, sf).groupBy("sample_name").agg(
        share("p__ECONOMY").alias("pc1"), share("p__PROMO").alias("pc2")
    )
    return pts.join(T.metadata(spark, sf), "sample_name")


def _ellipse_sql(radius: str) -> str:
    return sql(
        f""", {_POINTS} SELECT grp AS "group", n, round(cx, 6) AS cx, round(cy, 6) AS cy, round(2 * {radius} * sqrt(major), 5) AS width,
  round(2 * {radius} * sqrt(minor), 5) AS height, round(degrees(atan2(major - a, c)), 4) AS angle FROM ev""",
        "species", "meta",
    )


def _rounded_ellipse(out):
    return out.select("group", "n", r6("cx", "cx"), r6("cy", "cy"), r6("width", "width", 5), r6("height", "height", 5),
                      r6("angle", "angle", 4))


@query("h11_covariance_ellipse", _ellipse_sql("2"))
def covariance_ellipse(spark, sf):
    return _rounded_ellipse(N.ellipse(_points(spark, sf)))


@query("h12_level_ellipse", _ellipse_sql("sqrt((n - 1) * (0.05 ^ (-2.0 / (n - 1)) - 1))"))
def level_ellipse(spark, sf):
    return _rounded_ellipse(N.ellipse(_points(spark, sf), kind="level"))


@query(
    "h12c_robust_ellipse",
    sql(
        f""", {_POINTS}, al AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, var_samp(y) AS b, covar_samp(x, y) AS c FROM pts),
th AS (SELECT mx, my, 0.5 * atan2(2 * c, a - b) AS t FROM al),
pc AS (SELECT grp, (x - mx) * cos(t) + (y - my) * sin(t) AS x, (y - my) * cos(t) - (x - mx) * sin(t) AS y FROM pts, th),
r0 AS (SELECT grp, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS a, var_pop(y) AS b, covar_pop(x, y) AS c FROM pc GROUP BY grp
  HAVING count(*) >= 3),
it AS (SELECT 0 AS i, * FROM r0 UNION ALL
  SELECT i + 1, grp, n, wx, wy, a, b, c FROM (
    SELECT i, grp, n, sum(w * x) / sum(w) AS wx, sum(w * y) / sum(w) AS wy,
      sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) ^ 2 AS a, sum(w * y * y) / sum(w) - (sum(w * y) / sum(w)) ^ 2 AS b,
      sum(w * x * y) / sum(w) - sum(w * x) / sum(w) * (sum(w * y) / sum(w)) AS c
    FROM (SELECT it.i, it.grp, it.n, pc.x, pc.y,
      7 / (5 + (b * (x - mx) ^ 2 - 2 * c * (x - mx) * (y - my) + a * (y - my) ^ 2) / (a * b - c * c)) AS w
      FROM it JOIN pc ON pc.grp = it.grp WHERE i < 150) GROUP BY i, grp, n)),
en AS (SELECT *, (a + b) / 2 + sqrt(((a - b) / 2) ^ 2 + c * c) AS major, (a + b) / 2 - sqrt(((a - b) / 2) ^ 2 + c * c) AS minor,
  sqrt((n - 1) * (0.05 ^ (-2.0 / (n - 1)) - 1)) AS r FROM it WHERE i = 150)
SELECT grp AS "group", n, round(abs(mx), 5) AS cx, round(abs(my), 5) AS cy, round(2 * r * sqrt(major), 4) AS width,
  round(2 * r * sqrt(greatest(minor, 0)), 4) AS height FROM en""",
        "species", "meta",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def robust_ellipse(spark, sf):
    """About the principal components of two phyla; an axis may point either way, so centres come without sign."""
    long = _points(spark, sf).select("sample_name", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in ("pc1", "pc2")
    ])))
    points = M.with_group(N.axes_wide(N.pca(long)), T.metadata(spark, sf))
    out = N.ellipse(points, kind="robust")
    return out.select("group", "n", r6(F.abs("cx"), "cx", 5), r6(F.abs("cy"), "cy", 5), r6("width", "width", 4), r6("height", "height", 4))


def _transformed(spark, sf):
    counts = gene_counts(spark, sf)
    return M.norm_transform(counts, _factors(spark, sf, counts))


@query("h13_pca")
def pca(spark, sf):
    return N.pca(_transformed(spark, sf), 2)


def _rebuilt(spark, sf, scores):
    """Distances of the samples in the space of all axes."""
    points = scores.select("sample_name", F.col("axis").cast("string").alias("feature"), F.col("score").alias("value"))
    return P.euclidean(points, samples=T.metadata(spark, sf)).select("s1", "s2", r6("d", "d", 4))


_NTD = f"{_SF}, ntd AS (SELECT sample_name, feature, log2(value / size_factor + 1) AS v FROM cc JOIN sizef USING (sample_name))"
_DENSE_NTD = """full_ntd AS (SELECT m.sample_name, f.feature, coalesce(n.v, 0) AS v FROM meta m
  CROSS JOIN (SELECT DISTINCT feature FROM ntd) f LEFT JOIN ntd n USING (sample_name, feature))"""


@query(
    "h14_euclidean",
    sql(
        f""", {_NTD}, {_DENSE_NTD}, keep AS (SELECT feature FROM full_ntd GROUP BY 1 ORDER BY round(var_samp(v), 9) DESC, feature LIMIT 1000)
SELECT x.sample_name AS s1, y.sample_name AS s2, round(sqrt(sum((x.v - y.v) ^ 2)), 6) AS d
FROM full_ntd x JOIN full_ntd y ON x.feature = y.feature AND x.sample_name < y.sample_name
WHERE x.feature IN (SELECT feature FROM keep) GROUP BY ALL""",
        "genes", "meta",
    ),
)
def euclidean(spark, sf):
    meta = T.metadata(spark, sf)
    top = C.top_variable(_transformed(spark, sf), X.group_size(meta), 1000)
    return P.euclidean(top, samples=meta).select("s1", "s2", r6("d", "d"))


@query(
    "h15_spearman",
    sql(
        f""", {_NTD}, {_DENSE_NTD}, rk AS (SELECT sample_name, feature, rank() OVER (PARTITION BY sample_name ORDER BY round(v, 9)) +
  (count(*) OVER (PARTITION BY sample_name, round(v, 9)) - 1) / 2.0 AS r FROM full_ntd)
SELECT x.sample_name AS s1, y.sample_name AS s2, round(corr(x.r, y.r), 6) AS r
FROM rk x JOIN rk y ON x.feature = y.feature AND x.sample_name < y.sample_name GROUP BY ALL""",
        "genes", "meta",
    ),
)
def spearman(spark, sf):
    ntd = _transformed(spark, sf).withColumn("value", F.round("value", 9))
    return P.spearman(ntd).select("s1", "s2", r6("r", "r"))


_ALL_AXES = sql(
    f""", {_NTD}, {_DENSE_NTD} SELECT x.sample_name AS s1, y.sample_name AS s2, round(sqrt(sum((x.v - y.v) ^ 2)), 4) AS d
FROM full_ntd x JOIN full_ntd y ON x.feature = y.feature AND x.sample_name < y.sample_name GROUP BY ALL""",
    "genes", "meta",
)


@query("h13b_pca_all_axes", _ALL_AXES)
def pca_all_axes(spark, sf):
    """All components together keep the distances of the table."""
    return _rebuilt(spark, sf, N.pca(_transformed(spark, sf), T.metadata(spark, sf).count()))


@query(
    "h13c_pca_variable",
    sql(
        f""", {_NTD}, {_DENSE_NTD}, keep AS (SELECT feature FROM full_ntd GROUP BY 1 ORDER BY round(var_samp(v), 9) DESC, feature LIMIT 500)
SELECT x.sample_name AS s1, y.sample_name AS s2, round(sqrt(sum((x.v - y.v) ^ 2)), 4) AS d
FROM full_ntd x JOIN full_ntd y ON x.feature = y.feature AND x.sample_name < y.sample_name
WHERE x.feature IN (SELECT feature FROM keep) GROUP BY ALL""",
        "genes", "meta",
    ),
)
def pca_variable(spark, sf):
    """Components of the 500 most variable features."""
    meta = T.metadata(spark, sf)
    kept = C.top_variable(_transformed(spark, sf), X.group_size(meta), 500)
    return _rebuilt(spark, sf, N.pca(freeze(kept), meta.count()))


@query("h09b_pcoa_all_axes", _ALL_AXES)
def pcoa_all_axes(spark, sf):
    """All coordinates of Euclidean distances together keep them."""
    distances = P.euclidean(_transformed(spark, sf), samples=T.metadata(spark, sf))
    return _rebuilt(spark, sf, N.pcoa(distances, T.metadata(spark, sf).count()))


@query("h16_leaf_order")
def leaf_order(spark, sf):
    return N.bray_curtis_order(_cnt(spark, sf), weighted=False)
