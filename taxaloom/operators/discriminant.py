"""LDA effect size: bootstrap linear discriminants on sparse abundances.

The discriminant direction of a replicate solves (S_w + λD)·w = gap, D being the
feature variances. Neither the feature × feature scatter matrix nor a replicate's
table is ever gathered: conjugate gradients need only passes over the sparse rows,
for all replicates at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from taxaloom.operators.matrix import relative
from taxaloom.operators.ordered import place
from taxaloom.operators.testing import CONTROL, TREATMENT, kruskal
from taxaloom.session import freeze


def draw_samples(meta: DataFrame, boots: int, seed: int, share: float = 2 / 3) -> DataFrame:
    """``(sample_name, group, picks)``: 1.0 where a replicate holds the sample.

    Each replicate takes ⌊share·n⌋ samples of every group, in the order of a hash
    of (seed, replicate, sample).
    """
    sizes = meta.groupBy("group").agg(F.floor(F.count(F.lit(1)) * F.lit(share) + 1e-9).alias("_take"))
    draws = meta.select(
        "sample_name", "group", F.explode(F.sequence(F.lit(0), F.lit(boots - 1))).alias("boot")
    ).withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("boot"), F.col("sample_name"))))
    placed = place(draws, ["boot", "group"], [("_h", False), ("sample_name", False)], whole=True).join(sizes, "group")
    pick = F.when(F.col("position") < F.col("_take"), 1.0).otherwise(0.0)
    return placed.groupBy("sample_name", "group").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("boot", pick.alias("pick")))), lambda e: e["pick"]
        ).alias("picks")
    )


def _times(a, b):
    return F.zip_with(a, b, lambda x, y: x * y)


def lda_effect(
    df: DataFrame,
    meta: DataFrame,
    kw: float = 0.05,
    threshold: float = 2.0,
    boots: int = 30,
    seed: int = 1234,
    ridge: float = 0.05,
    max_rounds: int = 500,
    treatment: str = TREATMENT,
    control: str = CONTROL,
) -> DataFrame:
    """Signed LDA scores ``(feature, score)`` of the features passing the Kruskal–Wallis filter.

    Per replicate a feature scores half the sum of its raw class-mean gap and its
    gap along the unit discriminant; the mean over replicates is reported as
    sign·log10(1 + mean), positive where the treatment is higher.
    """
    two = meta.filter(F.col("group").isin(treatment, control))
    x = relative(df.filter("value <> 0").join(two.select("sample_name"), "sample_name", "left_semi"), 1e6)
    passed = kruskal(x, two).filter(F.col("p") <= kw).select("feature")
    x = freeze(x.join(passed, "feature", "left_semi").select("sample_name", "feature", F.col("value").alias("x")))
    picks = freeze(draw_samples(two, boots, seed))

    # group sizes of a replicate are the same in all replicates
    size = {r["group"]: float(r["n"]) for r in picks.groupBy("group").agg(F.sum(F.col("picks")[0]).alias("n")).collect()}
    n_t, n_c = size[treatment], size[control]
    is_t = F.col("group") == treatment
    n_all = {g: two.filter(F.col("group") == g).count() for g in (treatment, control)}
    # Features are scaled by their within-group deviation over the whole cohort,
    # so the ridge is a share of every feature's own variance.
    overall = x.join(two, "sample_name").groupBy("feature").agg(
        F.sum(F.when(is_t, F.col("x")).otherwise(0.0)).alias("t"),
        F.sum(F.when(~is_t, F.col("x")).otherwise(0.0)).alias("c"),
        F.sum(F.col("x") * F.col("x")).alias("q"),
    )
    within = F.col("q") - F.col("t") * F.col("t") / n_all[treatment] - F.col("c") * F.col("c") / n_all[control]
    spread = F.sqrt(F.greatest(within, F.col("q") * 1e-12) / (n_all[treatment] + n_all[control] - 2))
    sign = F.when(F.col("t") / n_all[treatment] >= F.col("c") / n_all[control], 1.0).otherwise(-1.0)
    features = freeze(overall.select("feature", spread.alias("sd"), sign.alias("sign")))
    x = freeze(x.join(features, "feature").select("sample_name", "feature", (F.col("x") / F.col("sd")).alias("x")))
    if features.isEmpty():
        return features.select("feature", F.lit(0.0).alias("score"))
    mean = _solve(x, features, picks, boots, n_t, n_c, ridge, max_rounds, treatment)
    return (
        mean.join(features, "feature")
        .select("feature", (F.col("sign") * F.log10(1 + F.col("mean"))).alias("score"))
        .filter(F.abs("score") >= threshold)
    )


def _solve(x, features, picks, boots, n_t, n_c, ridge, max_rounds, treatment) -> DataFrame:
    """Mean replicate scores by conjugate gradients for all replicates at once, on a cohort of any size.

    One product S_w·r is two passes over the sparse rows. The variant used needs
    a single reduction per round: residual norms, curvature and the products of
    the class means with the new vector come from one aggregate.
    """
    free = n_t + n_c - 2
    is_t = F.col("group") == treatment
    joined = x.join(picks, "sample_name")

    def held(cond, n):
        return F.array(*[F.sum(F.when(cond, F.col("x") * F.col("picks")[i]).otherwise(0.0)) / n for i in range(boots)])

    means = freeze(
        joined.groupBy("feature").agg(held(is_t, n_t).alias("m_t"), held(~is_t, n_c).alias("m_c"))
        .withColumn("gap", F.zip_with("m_t", "m_c", lambda a, b: a - b))
    )

    def lit(values):
        return F.array(*[F.lit(float(v)) for v in values])

    def plus(a, b):
        return F.zip_with(a, b, lambda u, v: u + v)

    def product(state: DataFrame, dots_t: list[float], dots_c: list[float]) -> DataFrame:
        """``w`` = (S_w + ridge)·r; ``dots`` are the class means times r."""
        t = x.join(state.select("feature", "r"), "feature").groupBy("sample_name").agg(
            F.array(*[F.sum(F.col("x") * F.col("r")[i]) for i in range(boots)]).alias("t")
        )
        t = t.join(picks, "sample_name").select("sample_name", _times("t", "picks").alias("t"))
        q = x.join(t, "sample_name").groupBy("feature").agg(
            F.array(*[F.sum(F.col("x") * F.col("t")[i]) for i in range(boots)]).alias("q")
        )
        away = plus(_times("m_t", lit([n_t * d for d in dots_t])), _times("m_c", lit([n_c * d for d in dots_c])))
        w = F.zip_with(F.zip_with("q", away, lambda a, b: (a - b) / free), "r", lambda a, b: a + ridge * b)
        return state.join(q, "feature").join(means.select("feature", "m_t", "m_c"), "feature").withColumn("w", w).drop("q")

    def reduce_all(state: DataFrame) -> list[list[float]]:
        pairs = [("r", "r"), ("w", "r"), ("m_t", "w"), ("m_c", "w")]
        row = state.agg(*[F.sum(F.col(a)[i] * F.col(b)[i]) for a, b in pairs for i in range(boots)]).first()
        return [list(row[k * boots:(k + 1) * boots]) for k in range(len(pairs))]

    first = means.agg(
        *[F.sum(F.col("m_t")[i] * F.col("gap")[i]) for i in range(boots)],
        *[F.sum(F.col("m_c")[i] * F.col("gap")[i]) for i in range(boots)],
    ).first()
    dot_t, dot_c = list(first[:boots]), list(first[boots:])
    zero = F.transform("gap", lambda v: v * 0.0)
    start = means.select("feature", "gap", zero.alias("y"), zero.alias("p"), zero.alias("s"), F.col("gap").alias("r"))
    state = freeze(product(start, dot_t, dot_c))
    gamma, delta, w_t, w_c = reduce_all(state)
    goal = [1e-12 * g for g in gamma]
    s_t = s_c = [0.0] * boots
    alpha = [g / d if d > 0 else 0.0 for g, d in zip(gamma, delta)]
    beta = [0.0] * boots
    for _ in range(max_rounds):
        # A replicate that has arrived stands still.
        alpha = [a if g > e else 0.0 for a, g, e in zip(alpha, gamma, goal)]
        moved = state.withColumn("p", plus("r", _times(lit(beta), "p"))).withColumn("s", plus("w", _times(lit(beta), "s")))
        moved = moved.withColumn("y", plus("y", _times(lit(alpha), "p"))).withColumn(
            "r", F.zip_with("r", _times(lit(alpha), "s"), lambda a, b: a - b)
        )
        s_t = [w + b * s for w, b, s in zip(w_t, beta, s_t)]
        s_c = [w + b * s for w, b, s in zip(w_c, beta, s_c)]
        dot_t = [d - a * s for d, a, s in zip(dot_t, alpha, s_t)]
        dot_c = [d - a * s for d, a, s in zip(dot_c, alpha, s_c)]
        state = freeze(product(moved.drop("w", "m_t", "m_c"), dot_t, dot_c))
        new, delta, w_t, w_c = reduce_all(state)
        if all(g <= e for g, e in zip(new, goal)):
            break
        beta = [n / g if g > 0 else 0.0 for n, g in zip(new, gamma)]
        curve = [d - b * n / a if a > 0 else 0.0 for d, b, n, a in zip(delta, beta, new, alpha)]
        alpha = [n / c if c > 0 else 0.0 for n, c in zip(new, curve)]
        gamma = new
    else:
        raise RuntimeError(f"the discriminants have not settled in {max_rounds} rounds")
    raw = state.join(features, "feature").select(
        "feature", F.transform("y", lambda v: v / F.col("sd")).alias("w"),
        F.transform("gap", lambda v: v * F.col("sd")).alias("gap"),
    )
    raw = freeze(raw)
    sums = raw.agg(
        *[F.sum(F.col("w")[i] * F.col("w")[i]) for i in range(boots)],
        *[F.sum(F.col("w")[i] * F.col("gap")[i]) for i in range(boots)],
    ).first()
    weight = lit([abs(a) / max(n, 1e-300) for n, a in zip(sums[:boots], sums[boots:])])
    per_boot = F.zip_with(
        "gap", _times(F.transform("w", lambda v: F.abs(v)), weight), lambda g, along: (F.abs(g) + along) / 2
    )
    return raw.select("feature", (F.aggregate(per_boot, F.lit(0.0), lambda a, v: a + v) / boots).alias("mean"))
