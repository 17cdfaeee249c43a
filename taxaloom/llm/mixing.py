"""Mixing sources to target sizes by balanced sampling with the cube method."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from taxaloom.session import broadcast_rows, freeze

from .common import WORD, text_of, unused

#: Units that one flight takes at most on average.
GROUP = 4096
#: Probabilities this close to 0 or 1 are 0 or 1.
EPS = 1e-9
#: Takings that are joined through a broadcast; more are joined by an exchange.
BROADCAST_UNITS = 1_000_000
#: Units kept for the landing, of which all subsets are compared.
LANDING = 12
#: Units above so many mean sizes of their source, and above this share of its words, are drawn before the flights.
OUTSIZED_MEANS, OUTSIZED_SHARE = 6, 0.001
_SEED = 20


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source, source_size, n_units, target`` from ``source, source_size, n_units``.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` times all sizes. No target exceeds ``most`` times its source's
    size; what is above is shared anew by weight, which ends at one level per
    weight for all sources below their limit. The table has one row per source.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    s = (
        sizes.withColumn("weight", F.element_at(cycle, (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1)))
        .withColumn("limit", most * F.col("source_size"))
        .withColumn("total", share * F.sum("source_size").over(every))
    )
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    s = s.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(every)
    )
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return s.select("source", "source_size", "n_units", target.alias("target"))


def flight(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Move ``p`` through the null space of (number, size) until at most two are between 0 and 1.

    Three open units have one direction that changes neither the number of
    units nor their size; a step along it, forward or back with the odds that
    keep every expectation, closes at least one of them.
    """
    p = list(p)
    open_: list[int] = []
    for i, v in enumerate(p):
        if EPS <= v <= 1 - EPS:
            open_.append(i)
        else:
            p[i] = float(round(v))
        if len(open_) == 3:
            a, b, c = (size[k] for k in open_)
            u = (b - c, c - a, a - b)
            scale = max(map(abs, u))
            u = tuple(x / scale for x in u) if scale else (1.0, -1.0, 0.0)
            forward = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(open_, u, strict=True) if x)
            back = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(open_, u, strict=True) if x)
            move = forward if rng.random() * (forward + back) < back else -back
            for k, x in zip(open_, u, strict=True):
                v = p[k] + move * x
                p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v
            open_ = [k for k in open_ if 0 < p[k] < 1]
    return p


def land(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Fly all but ``LANDING`` units and choose the best subset of those and the ones left open.

    The units kept for the landing are spread over the sizes, so that between
    them they can make up for a large unit that stays open. Every subset of the
    few is compared: nearest in size first, then in number.
    """
    order = sorted(range(len(p)), key=lambda k: size[k])
    kept = sorted({order[round(k * (len(p) - 1) / max(LANDING - 1, 1))] for k in range(min(LANDING, len(p)))})
    rest = [k for k in range(len(p)) if k not in set(kept)]
    out = list(p)
    for k, v in zip(rest, flight([p[k] for k in rest], [size[k] for k in rest], rng), strict=True):
        out[k] = v
    few = [k for k in range(len(p)) if 0 < out[k] < 1]
    subsets = (np.arange(1 << len(few))[:, None] >> np.arange(len(few))) & 1
    sizes = np.array([size[k] for k in few])
    off = np.abs(subsets @ sizes - sum(out[k] * size[k] for k in few))
    number = np.abs(subsets.sum(1) - sum(out[k] for k in few))
    best = np.lexsort((number, np.round(off + 0.25 * number * (sizes.mean() if few else 0), 6)))[0]
    for k, x in zip(few, subsets[best], strict=True):
        out[k] = float(x)
    return out


def _flown(level: int):
    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="__g").sort_values(["size", "__h"], ascending=[False, True])
        rng = random.Random(f"{_SEED}/{level}/{key[0]}/{key[1]}")
        # A source whose open units all fit in this group lands now.
        last = pdf["__groups"].iloc[0] <= 1
        p = (land if last else flight)(pdf["__p"].tolist(), pdf["size"].astype(float).tolist(), rng)
        return pdf.assign(__p=p, __groups=-(-2 * pdf["__groups"] // GROUP))

    return fly


def draw_outsized(
    sizes: list[float], words: float, target: float, most: float, rng: random.Random
) -> tuple[list[int], float]:
    """Takings of the units in ``sizes``, largest first, and the factor that is left for the source's other units.

    Each unit is taken floor(f) times and once more with the odds that are
    left, f being target over words of all units not drawn yet; what it takes
    or leaves goes to those, so that the expectation of their f stays as it is.
    Where a taking would push f below 0 or above ``most``, the one that comes
    nearest to the target is made instead.
    """
    takings = []
    for size in sizes:
        f = min(max(target / words, 0.0), most) if words > 0 else 0.0
        least = math.floor(f + EPS)
        rest = words - size

        def off(k: int, size=size, rest=rest) -> float:
            left = target - k * size
            return round(max(-left, left - most * rest, 0.0), 6)

        k = least + (rng.random() < f - least - EPS)
        if off(k) > 0:
            k = min(range(math.floor(most + EPS) + 1), key=lambda x: (off(x), abs(x - f)))
        takings.append(k)
        target, words = target - k * size, rest
    return takings, min(max(target / words, 0.0), most) if words > 0 else 0.0


def _drawn(most: float):
    def draw(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "__h"], ascending=[False, True])
        words, target = float(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        rng = random.Random(f"{_SEED}/outsized/{key[0]}")
        takings, left = draw_outsized(pdf["size"].astype(float).tolist(), words, target, most, rng)
        return pdf.assign(__base=takings, __p=0.0, __f=left)

    return draw


def word_sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """``id, source, size`` per row."""
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """``id, source, size, source_size, target, copies`` per row of ``docs``; ``copies`` is 0 to ``most``.

    With f = target / source size, each document is taken floor(f) times and
    once more with the probability that is left. Documents above
    ``OUTSIZED_MEANS`` mean sizes and ``OUTSIZED_SHARE`` of their source's words,
    fewer than 1 / ``OUTSIZED_SHARE`` of a source, are drawn first, since a
    flight hardly moves them and no few other units could make up for them; the
    words they take or leave change f for the source's other documents, and the
    number of documents with it. The probabilities of those go through
    flights of about ``GROUP`` units of one source, larger units first, each of
    which leaves at most two units open; these meet in further flights until
    each source has one, which lands. An open unit has no more than
    ``OUTSIZED_MEANS`` mean sizes, for which the landing's units make up, or
    ``OUTSIZED_SHARE`` of the words; that bounds how far a source's words are
    off wherever its target can be met, whatever its share of the rows: no task
    sees more than a group. Draws depend on hashes of id
    and size alone, so reruns and other partitionings agree; rows that repeat
    an id and size can stand for each other. Null ids are units like any
    other, a null text has size 0 and source null is a source. Empty sources
    have target 0 and an empty table gives an empty result.
    """
    units = freeze(word_sizes(docs, id_col, source_col, text_col))
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_units"))
    targets = freeze(source_targets(sizes, weights, share, most))
    most_units = targets.agg(F.max("n_units")).first()[0] or 0
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(F.col("__f") + EPS)
    state = (
        units.join(targets.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of")), "left")
        .withColumn("__f", factor)
        .withColumn("__base", base.cast("long"))
        .withColumn("__p", F.greatest(F.col("__f") - F.col("__base"), F.lit(0.0)))
        .withColumn("__h", F.xxhash64(F.lit(_SEED), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size")))
        .withColumn("__groups", F.ceil(F.col("n_units") / F.lit(GROUP)).cast("long"))
    )
    outsized = (F.col("size") * F.col("n_units") > OUTSIZED_MEANS * F.col("source_size")) & (
        F.col("size") > OUTSIZED_SHARE * F.col("source_size")
    )
    big = state.where(outsized).drop("__of", "n_units")
    drawn = freeze(big.groupBy("source").applyInPandas(_drawn(most), big.schema))
    left = drawn.groupBy(F.col("source").alias("__from")).agg(F.first("__f").alias("__left"))
    state = (
        state.where(~outsized)
        .join(left, F.col("source").eqNullSafe(F.col("__from")), "left")
        .withColumn("__f", F.coalesce("__left", "__f"))
        .withColumn("__base", base.cast("long"))
        .withColumn("__p", F.greatest(F.col("__f") - F.col("__base"), F.lit(0.0)))
    )
    is_open = (F.col("__p") >= EPS) & (F.col("__p") <= 1 - EPS)
    columns = ["id", "source", "size", "source_size", "target", "__base", "__p", "__h", "__groups"]
    state = state.select(*columns)
    done = state.where(~is_open).unionByName(drawn.select(*columns))
    state = state.where(is_open)
    groups, level = math.ceil(most_units / GROUP), 0
    schema = StructType([StructField(f.name, f.dataType) for f in state.schema])
    while True:
        last = groups <= 1

        grouped = state.withColumn("__g", F.pmod(F.xxhash64("__h", F.lit(level)), F.greatest("__groups", F.lit(1))))
        flown = grouped.groupBy("source", "__g").applyInPandas(_flown(level), schema)
        if last:
            done = done.unionByName(flown)
            break
        flown = freeze(flown)
        done = done.unionByName(flown.where(~is_open))
        state = flown.where(is_open)
        groups, level = math.ceil(2 * groups / GROUP), level + 1
    return done.select(
        F.col("id").alias(id_col),
        F.col("source").alias("source"),
        "size",
        "source_size",
        "target",
        (F.col("__base") + F.round("__p").cast("long")).alias("copies"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every row as often as :func:`mix` takes it; rows taken 0 times go.

    Rows that agree in id, source and size share their takings evenly; what is
    left over goes to those whose texts have the smallest hashes.
    """
    own = unused(docs, "__id", "__source", "__size", "__sum", "__n", "__words", "__place", "__copy")
    of_id, of_source, of_size, total, n, words, place, copy = own
    taken = (
        mix(docs, id_col, source_col, text_col, **how)
        .groupBy(F.col(f"`{id_col}`").alias(of_id), F.col("source").alias(of_source), F.col("size").alias(of_size))
        .agg(F.sum("copies").alias(total), F.count("*").alias(n))
    )
    text = text_of(text_col)
    same = (
        F.col(f"`{id_col}`").eqNullSafe(F.col(of_id))
        & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(of_source))
        & (F.col(words) == F.col(of_size))
    )
    taken = freeze(taken)
    taking = taken.where(F.col(total) > 0)
    sized = docs.withColumn(words, F.regexp_count(text, F.lit(WORD)).cast("long"))
    joined = sized.join(broadcast_rows(taking, taking.count(), BROADCAST_UNITS), same)
    times = F.col(total)
    if not taken.where(F.col(n) > 1).isEmpty():
        # Their texts may differ, so a hash of the text says which of them are taken once more.
        by_text = Window.partitionBy(of_id, of_source, of_size).orderBy(F.xxhash64(text), text)
        joined = joined.withColumn(place, F.row_number().over(by_text))
        times = F.floor(times / F.col(n)) + (F.col(place) <= times % F.col(n)).cast("long")
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
