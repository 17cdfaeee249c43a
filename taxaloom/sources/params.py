"""Run parameters: nested JSON documents with the sample lists of an analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_SAMPLE = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def read_params(spark: SparkSession, path: str) -> DataFrame:
    """The document as one row; scalar settings keep their inferred types."""
    return spark.read.option("multiLine", True).json(path)


def sample_rows(spark: SparkSession, path: str, lists: list[str], group_names: bool = True) -> DataFrame:
    """Sample structs of the named lists as rows ``(list, sample_name, group, files)``.

    ``files`` maps every other field of a sample to its text. With
    ``group_names`` the group is ``groups_name[list]``, else the sample's own.
    """
    schema = T.StructType(
        [T.StructField(n, _SAMPLE) for n in lists]
        + [T.StructField("groups_name", T.MapType(T.StringType(), T.StringType()))]
    )
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    tagged = F.array(*[F.struct(F.lit(n).alias("list"), F.col(n).alias("samples")) for n in lists])
    rows = doc.select("groups_name", F.inline(tagged)).select(
        "list", "groups_name", F.explode("samples").alias("files")
    )
    group = F.col("groups_name")[F.col("list")] if group_names else F.col("files")["group"]
    return rows.select(
        "list",
        F.col("files")["sample_name"].alias("sample_name"),
        group.alias("group"),
        F.map_filter("files", lambda k, _: ~k.isin("sample_name", "group")).alias("files"),
    )


def manifest(rows: DataFrame, *kinds: str) -> DataFrame:
    """``(sample_name, kind, path)``: the listed files of every sample."""
    return rows.select(
        "sample_name",
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col("files")[k].alias("path")) for k in kinds])),
    ).filter(F.col("path").isNotNull())


def channel(rows: DataFrame, *kinds: str) -> DataFrame:
    """Workflow tuples ``(id, files)``: sample id and its file list in the given order."""
    return rows.select(
        F.col("sample_name").alias("id"), F.array(*[F.col("files")[k] for k in kinds]).alias("files")
    )


def merge_settings(*maps: str) -> Column:
    """One map of the named map columns; a later column wins on equal keys."""

    def merge(left: Column, right: Column) -> Column:
        return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)

    return reduce(merge, [F.col(m) for m in maps])
