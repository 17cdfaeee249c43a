"""Common table expressions of the DuckDB checks: the same inputs, in SQL."""

from __future__ import annotations

NATIONS = [f"NATION_{i}" for i in range(25)]

_LEVELS = """SELECT {sample} AS sample_name,
  ['k__Part', 'p__' || p.p_type, 'c__' || p.p_type || '_c', 'o__' || p.p_type || '_o',
   'f__' || split_part(p.p_name, ' ', 2), 'g__' || replace(p.p_brand, '#', ''),
   CASE WHEN p.p_size % 10 = 0 THEN 's__GGB' || p.p_size || '_SGB' || p.p_partkey
        ELSE 's__' || replace(p.p_brand, '#', '') || '_' || p.p_size END] AS names,
  ['2', ascii(p.p_type)::VARCHAR, ascii(p.p_type) || '1', ascii(p.p_type) || '2',
   ascii(split_part(p.p_name, ' ', 2))::VARCHAR, replace(replace(p.p_brand, '#', ''), 'Brand', ''),
   p.p_size::VARCHAR] AS ids,
  l.l_quantity AS q
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey {join}"""

_PROFILE = """SELECT sample_name, clade_name, ncbi_tax_id, 100.0 * cnt / total AS ra, cnt FROM (
  SELECT sample_name, array_to_string(names[1:d], '|') AS clade_name, array_to_string(ids[1:d], '|') AS ncbi_tax_id,
         sum(q) AS cnt
  FROM {obs}, (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS d) GROUP BY ALL
) JOIN (SELECT sample_name, sum(q) AS total FROM {obs} GROUP BY 1) USING (sample_name)"""

_FUNCTIONAL = """SELECT sample_name, term, sum(q) AS abundance FROM (
  SELECT {sample} AS sample_name, l.l_quantity AS q,
    unnest([p_type || ': ' || p_type || ' function',
            p_type || ': ' || p_type || ' function|' ||
            CASE WHEN p_size < 3 THEN 'unclassified'
                 ELSE 'g__' || replace(p_brand, '#', '') || '.s__' || replace(p_brand, '#', '') || '_' || p_size END
    ]) AS term
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey {join}) GROUP BY ALL"""

_SUPPLIER = {"sample": "'S' || l.l_suppkey", "join": ""}
_NATION = {
    "sample": "n.n_name",
    "join": "JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey",
}

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "obs": ((), _LEVELS.format(**_SUPPLIER)),
    "prof": (("obs",), _PROFILE.format(obs="obs")),
    "obs_n": ((), _LEVELS.format(**_NATION)),
    "prof_n": (("obs_n",), _PROFILE.format(obs="obs_n")),
    "func": ((), _FUNCTIONAL.format(**_SUPPLIER)),
    "func_n": ((), _FUNCTIONAL.format(**_NATION)),
    "meta": (
        (),
        """SELECT 'S' || s_suppkey AS sample_name,
  CASE WHEN s_suppkey % 2 = 1 THEN 'treatment' ELSE 'control' END AS grp
FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
    ),
    "species": (
        ("prof",),
        "SELECT sample_name, clade_name AS feature, ra AS value, cnt FROM prof "
        "WHERE len(string_split(clade_name, '|')) = 7",
    ),
    "dense": (
        ("species", "meta"),
        """SELECT f.feature, m.sample_name, m.grp, coalesce(s.value, 0) AS value, coalesce(s.cnt, 0) AS cnt
FROM (SELECT DISTINCT feature FROM species) f CROSS JOIN meta m
LEFT JOIN species s ON s.feature = f.feature AND s.sample_name = m.sample_name""",
    ),
    "genes": (
        (),
        """SELECT 'S' || l_suppkey AS sample_name, 'K' || l_partkey AS gene_id,
  CASE WHEN p_size % 10 = 0 THEN '-' ELSE p_name END AS gene_name, sum(l_quantity)::BIGINT AS count
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    ),
    "ko": (
        (),
        "SELECT 'S' || l_suppkey AS sample_name, 'K' || l_partkey AS ko, sum(l_quantity) AS value "
        "FROM lineitem GROUP BY ALL",
    ),
    "ranked": (
        ("dense",),
        """SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) +
  (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rk,
  count(*) OVER (PARTITION BY feature, value) AS t FROM dense""",
    ),
    "ranksum": (
        ("ranked",),
        """SELECT *, greatest((abs(u - n_t * n_c / 2.0) - 0.5) /
  sqrt(n_t * n_c / 12.0 * ((n_t + n_c + 1) - ties / ((n_t + n_c) * (n_t + n_c - 1.0)))), 0) AS z
FROM (SELECT feature, count(*) FILTER (grp = 'treatment')::DOUBLE AS n_t,
  count(*) FILTER (grp = 'control')::DOUBLE AS n_c,
  sum(rk) FILTER (grp = 'treatment') - n_t * (n_t + 1) / 2 AS u,
  sum(t * t - 1.0) AS ties FROM ranked GROUP BY feature)""",
    ),
    "tested": (
        ("ranksum",),
        "SELECT *, " + "{erfc_z}" + " AS p FROM ranksum",
    ),
}


def erfc(x: str) -> str:
    """erfc by the all-positive series erf(x) = Σ x^(2n+1)·exp(−x²)/Γ(n + 3/2)."""
    return (
        f"CASE WHEN ({x}) <= 0 THEN 1.0 WHEN ({x}) > 6 THEN 0.0 ELSE 1 - list_sum(list_transform(range(0, 160), "
        f"lambda n: exp(-({x}) * ({x}) + (2 * n + 1) * ln({x}) - lgamma(n + 1.5)))) END"
    )


def exact_p(rows: str, rule: str) -> str:
    """Rows with ``p``: by counting all choices of places where ``rule`` holds, without ties, else normal.

    ``rows`` has ``u, z, ties, n_t, n_c``. Up to 16 samples are counted; the rule
    holds for no larger ones in the data folders.
    """
    return f"""(SELECT r.*, CASE WHEN ({rule}) AND ties = 0 THEN
  least(1.0, 2.0 * least((SELECT sum(c) FROM dealt d WHERE d.n_t = r.n_t AND d.n_c = r.n_c AND d.u <= r.u),
                         (SELECT sum(c) FROM dealt d WHERE d.n_t = r.n_t AND d.n_c = r.n_c AND d.u >= r.u))
            / (SELECT sum(c) FROM dealt d WHERE d.n_t = r.n_t AND d.n_c = r.n_c))
  ELSE least(1.0, {erfc("z / sqrt(2.0)")}) END AS p FROM {rows} r)"""


def dealt(rows: str) -> str:
    """``n_t, n_c, u, c``: number of choices of the treatment's places that give each u."""
    return f"""SELECT n_t, n_c, list_sum(list_filter(range(1, (n_t + n_c)::BIGINT + 1), lambda i: (m >> (i - 1)) & 1 = 1)) - n_t * (n_t + 1) / 2 AS u,
  count(*) AS c FROM (SELECT n_t, n_c, unnest(range(0, CASE WHEN n_t + n_c <= 16 THEN (1::BIGINT << (n_t + n_c)::INTEGER) ELSE 0 END)) AS m
  FROM (SELECT DISTINCT n_t, n_c FROM {rows})) WHERE bit_count(m) = n_t GROUP BY ALL"""


CTES["dealt"] = (("ranksum",), dealt("ranksum"))
CTES["tested"] = (("ranksum", "dealt"), "SELECT * FROM " + exact_p("ranksum", "n_t < 50 AND n_c < 50"))


def sql(body: str, *ctes: str) -> str:
    """``body`` behind the named expressions and everything they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for dep in CTES[name][0]:
            need(dep)
        if name not in order:
            order.append(name)

    for name in ctes:
        need(name)
    if not order:
        return body
    head = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    return f"WITH {head}{',' if body.lstrip().startswith(',') else ''}\n{body.lstrip().lstrip(',')}"
