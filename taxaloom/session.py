"""Session settings and the shared folder used for cut lineage and staging."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Where a single machine keeps written tables; a cluster names a shared folder of its own.
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints/taxaloom"


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "taxaloom") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", LOCAL_CHECKPOINTS)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local master may go without one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(LOCAL_CHECKPOINTS)
    return sc.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def staging_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/staging-{spark.sparkContext.applicationId}"


def clear_staging(spark: SparkSession) -> None:
    """Drop this application's staged tables; call it when all results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and cut its lineage.

    Used where one result is read by several branches that must see the very
    same floating-point values, and between the rounds of iterative operators.
    The written table survives lost executors and tells the planner its size.
    """
    spark = df.sparkSession
    path = staging_path(spark, "frozen")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def thaw(df: DataFrame) -> None:
    """Drop the table of a frozen frame that nothing reads any more; rounds that write much call it."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("frozen-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def broadcast_rows(df: DataFrame, rows: int, limit: int = 10_000) -> DataFrame:
    """``df``, of at most ``rows`` rows, marked for broadcast when that bound is small enough."""
    return F.broadcast(df) if rows <= limit else df
