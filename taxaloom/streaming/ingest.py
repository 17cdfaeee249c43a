"""Profiles taken in as samples finish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from taxaloom.session import freeze


def stream_profiles(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Streaming scan of a folder in which one profile file (Parquet) per sample appears."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def ingest(stream: DataFrame, target: str, checkpoint: str | None = None, partition: str | None = None) -> None:
    """Append all files present now to ``target`` and stop; a later call takes only new files.

    What has been taken in is noted in ``checkpoint``, by default a folder beside the target.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    writer = writer.option("checkpointLocation", checkpoint or f"{target.rstrip('/')}.checkpoint")
    if partition:
        writer = writer.partitionBy(partition)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def stream_pair(
    left: DataFrame, right: DataFrame, key: str, arrival: str, delay: str = "1 day", keep_unpaired: bool = False
) -> DataFrame:
    """Join of two streams by sample; the watermark on arrival bounds the state.

    Each side carries ``arrival``. A partner that comes later than ``delay`` isn't
    waited for, which keeps the state to one window of samples; with
    ``keep_unpaired`` a left row without a partner comes out with nulls once the
    watermark has passed, so nothing goes unnoticed.
    """
    a = left.withWatermark(arrival, delay).withColumnRenamed(arrival, "_left_at").alias("a")
    b = right.withWatermark(arrival, delay).withColumnRenamed(arrival, "_right_at").alias("b")
    same = F.col(f"a.{key}") == F.col(f"b.{key}")
    near = F.col("_right_at").between(
        F.col("_left_at") - F.expr(f"INTERVAL {delay}"), F.col("_left_at") + F.expr(f"INTERVAL {delay}")
    )
    joined = a.join(b, same & near, "left_outer" if keep_unpaired else "inner")
    keep = [F.col(f"a.{c}") for c in left.columns if c != arrival]
    keep += [F.col(f"b.{c}") for c in right.columns if c not in (arrival, key)]
    return joined.select(*keep)


# -- state as written versions -------------------------------------------------


def _write(df: DataFrame, target: str, name: str, batch: int) -> None:
    """The version of micro-batch ``batch``; a repeated micro-batch replaces its own."""
    df.write.mode("overwrite").parquet(f"{target}/{name}/batch={batch}")


def _versions(spark: SparkSession, target: str, name: str, schema: T.StructType) -> DataFrame:
    """All versions, told apart by ``batch``. The folder exists once the first one is written."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{target}/{name}")


def _version(spark: SparkSession, target: str, name: str, schema: T.StructType, batch: int) -> DataFrame:
    """One version; micro-batches are numbered from 0 without gaps, and -1 is the start."""
    return spark.read.schema(schema).parquet(f"{target}/{name}/batch={batch}")


def _run(stream: DataFrame, work, checkpoint: str) -> None:
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


#: Totals of the samples taken in so far.
TOTALS = T.StructType(
    [
        T.StructField("group", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("present", T.LongType()),
    ]
)
#: One row per group and sample taken in.
TAKEN = T.StructType([T.StructField("group", T.StringType()), T.StructField("sample_name", T.StringType())])


def keep_totals(stream: DataFrame, meta: DataFrame, target: str, checkpoint: str | None = None) -> None:
    """Fold the samples that are present now into group totals below ``target``, and stop.

    ``stream``: (sample_name, feature, value); ``meta``: (sample_name, group).
    Every micro-batch writes the totals of all samples so far as a version of its
    own, made from the version before it, so a repeated micro-batch replaces what
    it wrote. A sample that was taken in by an earlier micro-batch isn't counted
    again. Totals have a row per group and feature, whatever the number of samples.
    """
    spark = stream.sparkSession

    def fold(rows: DataFrame, batch: int) -> None:
        own = rows.sparkSession
        known = _versions(own, target, "taken", TAKEN).where(F.col("batch") < batch)
        new = rows.join(known.select("sample_name"), "sample_name", "left_anti").join(meta_of(own), "sample_name")
        new = freeze(new.select("group", "sample_name", "feature", F.col("value").cast("double").alias("value")))
        fresh = new.groupBy("group", "feature").agg(
            F.sum("value").alias("value"), F.count_if(F.col("value") != 0).alias("present")
        )
        both = _version(own, target, "totals", TOTALS, batch - 1).unionByName(fresh)
        sums = both.groupBy("group", "feature").agg(F.sum("value").alias("value"), F.sum("present").alias("present"))
        _write(new.select("group", "sample_name").distinct(), target, "taken", batch)
        _write(sums, target, "totals", batch)

    marks = freeze(meta.select("sample_name", "group"))
    path, schema = marks.inputFiles(), marks.schema
    meta_of = lambda own: own.read.schema(schema).parquet(*path)
    for name, kind in (("totals", TOTALS), ("taken", TAKEN)):
        spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{target}/{name}/batch=-1")
    _run(stream, fold, checkpoint or f"{target.rstrip('/')}.checkpoint")


def group_means(spark: SparkSession, target: str) -> DataFrame:
    """``group, feature, value``: means over the samples taken in so far, absent cells being 0."""
    taken = _versions(spark, target, "taken", TAKEN).groupBy("group").agg(F.count_distinct("sample_name").alias("_n"))
    totals = _versions(spark, target, "totals", TOTALS)
    # Totals only grow, so the last version has rows if any has.
    totals = totals.where(F.col("batch") == totals.select(F.max("batch")).scalar())
    return totals.join(F.broadcast(taken), "group").select("group", "feature", (F.col("value") / F.col("_n")).alias("value"))


def top_features(spark: SparkSession, target: str, top: int = 10) -> DataFrame:
    """``group, place, feature, value``: the ``top`` means of each group, the rest of it as ``Other``."""
    means = group_means(spark, target)
    order = W.partitionBy("group").orderBy(F.col("value").desc(), "feature")
    ranked = means.withColumn("place", F.row_number().over(order).cast("int"))
    other = F.col("place") > top
    return ranked.groupBy(
        "group", F.when(other, top + 1).otherwise(F.col("place")).alias("place"),
        F.when(other, F.lit("Other")).otherwise(F.col("feature")).alias("feature"),
    ).agg(F.sum("value").alias("value"))


def pair_arrivals(
    left: DataFrame, right: DataFrame, key: str, arrival: str, target: str, delay: str = "1 day",
    checkpoint: str | None = None,
) -> None:
    """Pair the rows of two streams by ``key`` as they arrive, and lose none of them.

    Of each key, the first rows of both sides by arrival are a pair, then the
    second ones, and so on. A row without a partner waits until rows are seen that
    arrived more than ``delay`` after it; then it is late. Every row is in exactly
    one of the tables that :func:`paired` reads: paired, waiting or late, in
    whatever order the rows come. Keys are sample ids, with few rows each; rows
    without a key have no partner. The waiting rows are the state: each
    micro-batch writes them, its pairs and its late rows under its number, so a
    repeated micro-batch replaces what it wrote.
    """
    spark = left.sparkSession
    sides = {"left": left, "right": right}
    kinds = {s: T.StructType([f for f in df.schema.fields if f.name != key]) for s, df in sides.items()}
    state = T.StructType(
        [left.schema[key], T.StructField("at", T.TimestampType()), T.StructField("left", kinds["left"]), T.StructField("right", kinds["right"])]
    )

    def as_state(side: str) -> DataFrame:
        df = sides[side]
        values = {s: F.lit(None).cast(k) for s, k in kinds.items()}
        values[side] = F.struct(*[F.col(f"`{f.name}`") for f in kinds[side].fields])
        return df.select(F.col(f"`{key}`").alias(key), F.col(f"`{arrival}`").cast("timestamp").alias("at"),
                         *[v.alias(s) for s, v in values.items()])

    def pair(rows: DataFrame, batch: int) -> None:
        own = rows.sparkSession
        here = freeze(rows.unionByName(_version(own, target, "waiting", state, batch - 1)))
        seen = _versions(own, target, "mark", MARK).where(F.col("batch") < batch).select("mark").unionByName(
            here.select(F.col("at").alias("mark"))
        )
        mark = freeze(seen.agg(F.max("mark").alias("mark")))
        is_left = F.col("left").isNotNull()
        nth = F.row_number().over(
            W.partitionBy(key, is_left).orderBy("at", F.xxhash64(F.to_json("left"), F.to_json("right")))
        )
        # Rows without a key are no pairs: each is a group of its own.
        alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        met = freeze(
            here.withColumn("_n", nth).withColumn("_alone", alone).groupBy(key, "_n", "_alone").agg(
                F.max("at").alias("at"), F.first("left", ignorenulls=True).alias("left"),
                F.first("right", ignorenulls=True).alias("right"),
            ).select(*state.names)
        )
        whole = F.col("left").isNotNull() & F.col("right").isNotNull()
        old = F.coalesce(F.col("at") < F.lit(mark.first()["mark"]) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        _write(mark, target, "mark", batch)
        _write(met.where(whole), target, "paired", batch)
        _write(met.where(~whole & old), target, "late", batch)
        _write(met.where(~whole & ~old), target, "waiting", batch)

    for name, kind in (("paired", state), ("late", state), ("waiting", state), ("mark", MARK)):
        spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{target}/{name}/batch=-1")
    _run(as_state("left").unionByName(as_state("right")), pair, checkpoint or f"{target.rstrip('/')}.checkpoint")


MARK = T.StructType([T.StructField("mark", T.TimestampType())])


def paired(spark: SparkSession, target: str) -> DataFrame:
    """``outcome`` (``paired``, ``late`` or ``waiting``) and the rows: key, arrival, ``left`` and ``right`` structs."""
    # Every micro-batch writes one mark; its waiting rows may be none.
    last = _versions(spark, target, "mark", MARK).select(F.max("batch")).scalar()

    def read(name: str) -> DataFrame:
        found = spark.read.parquet(f"{target}/{name}")
        if name == "waiting":
            found = found.where(F.col("batch") == last)
        return found.drop("batch").select(F.lit(name).alias("outcome"), "*")

    return read("paired").unionByName(read("late")).unionByName(read("waiting"))
