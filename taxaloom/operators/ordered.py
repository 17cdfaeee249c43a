"""Running totals, ranks and quantiles over orderings of any size.

A window ordered over one huge key would sort the whole key in a single task.
Here the ordering is cut into value buckets: every (key, bucket) is windowed
alone, and the totals of the earlier (or later) buckets - one row per bucket -
are added afterwards. Equal values are merged before the cut, so a value shared
by a third of the rows is one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from taxaloom.session import freeze, shuffle_width

# Buckets per shuffle partition.
SPREAD = 4


def value_bucket(df: DataFrame, order: str) -> DataFrame:
    """Add ``_bucket``: the number of approximate quantile cuts below ``order``.

    There are several buckets per shuffle partition, so a bucket is sorted by one
    task as a partition is. A value is placed in two steps, among every ``step``-th
    cut and then among the cuts between, which keeps the search short.
    """
    wanted = SPREAD * shuffle_width(df.sparkSession)
    if isinstance(df.schema[order].dataType, T.StringType):
        # Texts have no approximate quantiles: cuts are taken from a hash-picked set of about 16 values per cut.
        step = min(64, max(2, math.isqrt(wanted)))
        n = step * step
        picked = df.select(order).distinct().orderBy(F.xxhash64(order)).limit(16 * n)
        values = picked.agg(F.array_sort(F.collect_list(order)).alias("_v"))
        nth = F.transform(
            F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("_v", F.floor(i * F.size("_v") / n).cast("int"))
        )
        cuts = values.select(nth.alias("_c")).scalar()
    else:
        step = min(256, max(2, math.isqrt(wanted)))
        n = step * step
        probs = [i / n for i in range(1, n)]
        cuts = df.select(F.percentile_approx(order, probs, max(10_000, 20 * n))).scalar()

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda c: c < F.col(order)))

    coarse = F.transform(F.sequence(F.lit(step), F.lit(n - step), F.lit(step)), lambda i: F.get("_cuts", i - 1))
    return (
        df.withColumn("_cuts", cuts)
        .withColumn("_coarse", below(coarse))
        .withColumn("_bucket", F.col("_coarse") * step + below(F.slice("_cuts", F.col("_coarse") * step + 1, F.lit(step - 1))))
        .drop("_cuts", "_coarse")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str] = (),
    later_min: Sequence[str] = (),
    whole: bool = False,
    bucket: Column | None = None,
) -> DataFrame:
    """Per key, in the order of ``order`` (distinct within the key), add

    - ``<c>_before`` and ``<c>_total`` for each ``c`` in ``sums``;
    - ``<c>_floor``, the least value from this row on, for each ``c`` in ``later_min``.

    ``whole`` says that a key has at most one row per sample, as a feature has: a
    task sorts such a key, spilling where it must. Else the ordering is cut into
    buckets. ``bucket`` may give a known order-preserving bucketing in place of the
    quantile cuts.
    """
    keys = list(keys)
    if whole and keys:
        part = W.partitionBy(*keys)
        up = part.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        on = part.orderBy(order).rowsBetween(0, W.unboundedFollowing)
        cols = []
        for c in sums:
            zero = F.lit(0).cast(df.schema[c].dataType)
            cols += [F.coalesce(F.sum(c).over(up), zero).alias(f"{c}_before"), F.sum(c).over(part).alias(f"{c}_total")]
        cols += [F.min(c).over(on).alias(f"{c}_floor") for c in later_min]
        return df.select("*", *cols)

    if bucket is None:
        # Read several times below, and every reading must hold the same numbers.
        df = freeze(df)
    cut = value_bucket(df, order) if bucket is None else df.withColumn("_bucket", bucket)
    group = [*keys, "_bucket"]
    per_bucket = cut.groupBy(*group).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in sums], *[F.min(c).alias(f"_m_{c}") for c in later_min]
    )
    part = W.partitionBy(*keys)
    up = part.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    on = part.orderBy("_bucket").rowsBetween(1, W.unboundedFollowing)
    offsets = per_bucket.select(
        *group,
        *[F.coalesce(F.sum(f"_s_{c}").over(up), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(part).alias(f"{c}_total") for c in sums],
        *[F.min(f"_m_{c}").over(on).alias(f"_l_{c}") for c in later_min],
    )
    inner = W.partitionBy(*group).orderBy(order)
    in_up = inner.rowsBetween(W.unboundedPreceding, -1)
    in_on = inner.rowsBetween(0, W.unboundedFollowing)
    ranked = cut.select(
        "*",
        *[F.coalesce(F.sum(c).over(in_up), F.lit(0)).alias(f"_i_{c}") for c in sums],
        *[F.min(c).over(in_on).alias(f"_j_{c}") for c in later_min],
    ).join(offsets, group)
    return ranked.select(
        *df.columns,
        *[(F.col(f"_i_{c}") + F.col(f"_o_{c}")).alias(f"{c}_before") for c in sums],
        *[f"{c}_total" for c in sums],
        *[F.least(F.col(f"_j_{c}"), F.col(f"_l_{c}")).alias(f"{c}_floor") for c in later_min],
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str, whole: bool = False) -> DataFrame:
    """Distinct values per key with ``n``, ``n_before`` and ``n_total``."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return running(counts, keys, value, sums=["n"], whole=whole)


def average_rank(df: DataFrame, keys: Sequence[str], value: str, whole: bool = False) -> DataFrame:
    """Distinct values per key with their mid-rank ``rank`` and multiplicity ``n``."""
    return value_counts(df, keys, value, whole).withColumn("rank", F.col("n_before") + (F.col("n") + 1) / 2)


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    whole: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, one column per entry of ``probs``."""
    return quantiles_of_counts(value_counts(df, keys, value, whole), keys, value, probs)


def quantiles_of_counts(counted: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """The same from ``(value, n, n_before, n_total)`` rows."""
    first, last = F.col("n_before"), F.col("n_before") + F.col("n")

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position < last), F.col(value)))

    picks, finals = [], []
    for name, p in probs.items():
        where = (F.col("n_total") - 1) * F.lit(p)
        picks += [at(F.floor(where)).alias(f"_lo_{name}"), at(F.ceil(where)).alias(f"_hi_{name}")]
        at_n = (F.col("_n") - 1) * F.lit(p)
        frac = at_n - F.floor(at_n)
        finals.append((F.col(f"_lo_{name}") + frac * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name))
    grouped = counted.groupBy(*keys).agg(F.max("n_total").alias("_n"), *picks)
    return grouped.select(*keys, *finals)


def place(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]], whole: bool = False) -> DataFrame:
    """Add ``position`` (from 0) of each row within its key, for ``order`` = (column, descending) pairs.

    The order must be total; rows that are equal in it share a position, and rows
    without a key or a value to order by have none and go. With ``whole`` a key has
    at most one row per sample and is sorted by one task. Else all rows are cut into
    ranges of keys and order, placed within each, and moved on by their key's rows
    in earlier ranges.
    """
    keys = list(keys)
    by = [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order]
    if whole and keys:
        return df.withColumn("position", F.row_number().over(W.partitionBy(*keys).orderBy(*by)).cast("bigint") - 1)
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, *(c for c, _ in order)]])
    # The cuts are taken from a first reading, which must hold the same rows as the second.
    ranges = freeze(df.filter(known)).repartitionByRange(shuffle_width(df.sparkSession), *keys, *by)
    cut = freeze(ranges.withColumn("_range", F.spark_partition_id()))
    group = [*keys, "_range"]
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    start = (
        cut.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = F.rank().over(W.partitionBy(*group).orderBy(*by)) - 1
    placed = cut.withColumn("_inside", inside).join(start, group)
    return placed.select(*df.columns, (F.col("_start") + F.col("_inside")).alias("position"))
