"""How text filters interact in every order, counted incrementally with retractions."""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from taxaloom.session import staging_path

from .common import parts, release

#: One bit per filter; a document's mask has the bits of the filters that it fails.
FILTERS = {letter: 1 << i for i, letter in enumerate("ABCDE")}
REPEATED = FILTERS["E"]
#: Micro-batches that the files are dealt to, and groups of equal texts that a task folds before it passes them on.
BATCHES, FOLD = 4, 50_000

_UPPER, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
_TAILS = bytes(range(0x80, 0xC0))

_FACTS = "id long, part string, digest binary, mask int"
_FOLDED = "digest binary, part string, mask int, good int, toxic int, n long, least long, n_least long"
_STATE = f"{_FOLDED}, repeated long, holds boolean"
_COUNTS = "part string, mask int, good int, toxic int, n long"


def mask_of(text: bytes) -> int:
    """Bits of the filters A to D, which a text fails or passes by itself."""
    words = text.split()
    points = len(text.translate(None, _TAILS))
    capitals = len(text) - len(text.translate(None, _UPPER))
    return (
        FILTERS["A"] * (len(words) < 100)
        | FILTERS["B"] * (100 * len(set(words)) < 80 * len(words))
        | FILTERS["C"] * (100 * capitals > 10 * points)
        | FILTERS["D"] * (len(text.translate(None, _SIGNS)) < len(text))
    )


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in parts(whole, 2):
            texts = batch.column(2).to_pylist()
            digests = pa.array([blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            masks = pa.array([mask_of(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), digests, masks], names=["id", "part", "digest", "mask"]
            )
    release()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per equal text, part and label of a task, so that a text with many copies doesn't travel copy by copy."""
    names = ["digest", "part", "mask", "good", "toxic", "n", "least", "n_least"]
    types = [pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    held: dict[tuple, list] = {}

    def take() -> pa.RecordBatch:
        rows = [(*key[:5], *value) for key, value in held.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
        )

    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)
        for i, part, digest, mask, good, toxic in rows:
            key = (digest, part, mask, good, toxic, i is None)
            seen = held.get(key)
            if seen is None:
                held[key] = [1, i, 1]
                continue
            seen[0] += 1
            if i is not None:
                if i < seen[1]:
                    seen[1:] = i, 1
                elif i == seen[1]:
                    seen[2] += 1
        if len(held) > FOLD:
            yield take()
    yield take()


def marked(rows: DataFrame, state: DataFrame) -> DataFrame:
    """What one micro-batch's folded ``rows`` do to the counters and to the ``state`` of their texts.

    State rows hold, per text, part and labels, how many documents were counted
    under the text's smallest id at the time. Result: rows like the state's,
    where ``n`` documents are counted under the mask itself and ``repeated``
    under the mask with filter E, both negative where they are taken back;
    ``holds`` marks the state's new rows. A text with a smaller id than before
    has its old rows taken back, and counted again as repeated. Rows without an
    id are never repeated. One exchange by text; a text has a row per task, part
    and label at most.
    """
    text = Window.partitionBy("digest")
    old = F.col("old")
    both = rows.select("*", F.lit(False).alias("old")).unionByName(
        state.where("holds").select(*rows.columns, F.lit(True).alias("old"))
    )
    first = F.col("least") == F.col("now")
    back = old & (F.col("least") == F.col("before")) & (F.col("now") < F.col("before"))
    single = F.when(F.col("least").isNull(), F.col("n")).when(first, F.col("n_least")).otherwise(F.lit(0))
    return (
        both.withColumn("now", F.min("least").over(text))
        .withColumn("before", F.min(F.when(old, F.col("least"))).over(text))
        .where(~old | back)
        .select(
            "digest", "part", "mask", "good", "toxic",
            F.when(old, -F.col("n_least")).otherwise(single).cast("long").alias("n"),
            "least", "n_least",
            F.when(old, F.col("n_least")).otherwise(F.col("n") - single).cast("long").alias("repeated"),
            (~old & F.coalesce(first, F.lit(False))).alias("holds"),
        )
    )


def deltas(marks: DataFrame) -> DataFrame:
    """Sums by part, mask and labels of what :func:`marked` counts and takes back."""
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("n").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), F.col("repeated").alias("n")),
    )
    return _sums(marks.select("part", "good", "toxic", F.explode(both).alias("d")).select("part", "d.mask", "good", "toxic", "d.n"))


def label_bits(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, good, toxic`` of the ids that any of their rows labels so; other ids have neither."""
    bit = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    return (
        labels.where(f"`{id_col}` IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
        .agg(bit("quality").alias("good"), bit("toxic").alias("toxic"))
    )


def mask_counts(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    batches: int = BATCHES,
) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by part, failed filters and labels.

    The Parquet files below ``path`` arrive as ``batches`` micro-batches of an
    available-now stream, in any order. The state, keyed by text, is a written
    log: every micro-batch adds the texts that it found new or with a smaller id
    and reads what earlier ones added, so the whole log is read ``batches`` / 2
    times. State and counters of a micro-batch are written under its number, so
    a repeated micro-batch replaces its own; counters are summed at the end.

    Filter E counts a document whose text a smaller id has. Rows of one id and
    text are equally small; a row without an id is neither smaller nor larger
    than others. Null texts are empty ones, null parts the empty string. Texts
    are told apart by 128 bits of BLAKE2. An empty table gives no rows. Ids are
    whole numbers. Labels are joined once per micro-batch, to rows without text.
    """
    known = spark.read.parquet(path)
    files = len(known.inputFiles())
    work = staging_path(spark, "audit")
    label_bits(labels, id_col).write.parquet(f"{work}/labels")
    spark.createDataFrame([], _STATE).write.parquet(f"{work}/state/batch=-1")
    spark.createDataFrame([], _COUNTS).write.parquet(f"{work}/counts/batch=-1")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)

    def count(texts: DataFrame, batch: int) -> None:
        read = texts.sparkSession.read
        rows = (
            texts.mapInArrow(_facts, _FACTS)
            .join(read.parquet(f"{work}/labels"), "id", "left")
            .select("id", "part", "digest", "mask", zero("good"), zero("toxic"))
            .mapInArrow(_fold, _FOLDED)
        )
        state = read.schema(f"{_STATE}, batch int").parquet(f"{work}/state").where(F.col("batch") < batch).drop("batch")
        here = f"{work}/state/batch={batch}"
        marked(rows, state).write.mode("overwrite").parquet(here)
        deltas(read.schema(_STATE).parquet(here)).write.mode("overwrite").parquet(f"{work}/counts/batch={batch}")

    # As a pattern the path may name a folder or one file; a plain one must be a folder.
    path = path.rstrip("/")
    texts = (
        spark.readStream.schema(known.schema)
        .option("maxFilesPerTrigger", max(1, -(-files // batches)))
        .parquet(f"{path[:-1]}[{path[-1]}]")
        .select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
            F.to_binary(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit("utf-8")).alias("text"),
        )
    )
    stream = texts.writeStream.foreachBatch(count).trigger(availableNow=True)
    stream.option("checkpointLocation", f"{work}/offsets").start().awaitTermination()
    return _sums(spark.read.schema(_COUNTS).parquet(f"{work}/counts")).where("n <> 0")


def _sums(changes: DataFrame) -> DataFrame:
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def steps() -> list[dict]:
    """Every order of the filters and every step in it: the filter's bit and the bits of those before."""
    made = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            made.append({"order": "".join(order), "step": step, "bit": FILTERS[letter], "before": before})
            before |= FILTERS[letter]
    return made


def interactions(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`mask_counts`.

    ``kept`` after the step, ``removed`` in it, ``redundant`` (fails the filter,
    removed before), ``unique_fails`` (fails this one only), ``good_lost`` and
    ``toxic_lost`` among the removed, ``shapley`` (what the filter removes,
    summed over all orders). A part's at most 32 masks are one short list.
    """
    orders = len(steps()) // len(FILTERS)
    plan = F.from_json(F.lit(json.dumps(steps())), "array<struct<order string, step int, bit int, before int>>")
    bit, before, mask = F.col("s.bit"), F.col("s.before"), lambda m: m["mask"]
    here = lambda m: (mask(m).bitwiseAND(bit) != 0) & (mask(m).bitwiseAND(before) == 0)

    def total(keep, column="n"):
        return _total(F.filter("masks", keep), lambda m: m[column])

    return (
        counts.groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.expr("n * good")).alias("good"), F.sum(F.expr("n * toxic")).alias("toxic"))
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
        .withColumn("s", F.explode(plan))
        .select(
            "part",
            F.col("s.order").alias("filter_order"),
            "s.step",
            total(lambda m: mask(m).bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
            total(here).alias("removed"),
            total(lambda m: (mask(m).bitwiseAND(bit) != 0) & (mask(m).bitwiseAND(before) != 0)).alias("redundant"),
            total(lambda m: mask(m) == bit).alias("unique_fails"),
            total(here, "good").alias("good_lost"),
            total(here, "toxic").alias("toxic_lost"),
            _total(
                F.filter("masks", lambda m: mask(m).bitwiseAND(bit) != 0),
                lambda m: m["n"] * F.floor(F.lit(orders) / F.bit_count(mask(m))),
            ).alias("shapley"),
        )
    )


def _total(masks, value):
    return F.aggregate(masks, F.lit(0).cast("long"), lambda a, m: a + value(m).cast("long"))
