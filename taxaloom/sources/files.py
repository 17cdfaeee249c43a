"""Readers of the per-sample text files, all with fixed schemas and one multi-path scan."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from taxaloom.operators.ordered import running
from taxaloom.session import broadcast_rows, freeze
from taxaloom.sources.fastq import FastqSource

PROFILE = T.StructType(
    [
        T.StructField("clade_name", T.StringType()),
        T.StructField("ncbi_tax_id", T.StringType()),
        T.StructField("relative_abundance", T.DoubleType()),
        T.StructField("additional_species", T.StringType()),
    ]
)
TERMS = T.StructType([T.StructField("term", T.StringType()), T.StructField("abundance", T.DoubleType())])
COUNTS = T.StructType(
    [
        T.StructField("gene_id", T.StringType()),
        T.StructField("gene_name", T.StringType()),
        T.StructField("count", T.LongType()),
    ]
)
ASSIGNMENT = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("read_id", T.StringType()),
        T.StructField("taxid", T.LongType()),
        T.StructField("length", T.StringType()),
        T.StructField("kmers", T.StringType()),
    ]
)
REPORT = T.StructType(
    [
        T.StructField("pct", T.DoubleType()),
        T.StructField("clade_reads", T.LongType()),
        T.StructField("taxon_reads", T.LongType()),
        T.StructField("rank_code", T.StringType()),
        T.StructField("taxid", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)
RELATION = T.StructType(
    [
        T.StructField(n, T.LongType() if n == "order_index" else T.StringType())
        for n in ["relation_id", "relation_type", "install_key", "component_id", "parent_component_id",
                  "order_index", "namespace"]
    ]
)

# File-name endings that are not part of the sample name.
TERM_SUFFIXES = [".Pathway.txt", ".Module.txt"]


def _tsv(spark: SparkSession, header: bool = False):
    return spark.read.option("sep", "\t").option("header", header).option("quote", "")


def _file_key(path: Column) -> Column:
    """Path without its scheme, so that manifest paths and scan paths compare equal."""
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/+", "/")


def _named(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Attach ``sample_name`` from ``manifest(sample_name, path)``; an unlisted file is dropped."""
    names = manifest.select("sample_name", _file_key(F.col("path")).alias("_file"))
    return df.withColumn("_file", _file_key(F.col("_file"))).join(names, "_file").drop("_file")


def read_profiles(
    spark: SparkSession, paths: str | Sequence[str], manifest: DataFrame, cut_comments: bool = False
) -> DataFrame:
    """Headerless taxonomic profiles → ``(sample_name, clade_name, ncbi_tax_id, relative_abundance)``.

    Lines starting with ``#`` are skipped. ``cut_comments`` also cuts the rest of
    a line at any later ``#``.
    """
    if cut_comments:
        lines = spark.read.text(paths).select(
            F.regexp_replace("value", "#.*$", "").alias("value"), F.col("_metadata.file_path").alias("_file")
        )
        part = F.split("value", "\t")
        df = lines.filter(F.length("value") > 0).select(
            F.get(part, F.lit(0)).alias("clade_name"),
            F.get(part, F.lit(1)).alias("ncbi_tax_id"),
            F.get(part, F.lit(2)).try_cast("double").alias("relative_abundance"),
            "_file",
        )
    else:
        df = (
            _tsv(spark).schema(PROFILE).option("comment", "#").csv(paths)
            .select("clade_name", "ncbi_tax_id", "relative_abundance", F.col("_metadata.file_path").alias("_file"))
        )
    return _named(df, manifest).select("sample_name", "clade_name", "ncbi_tax_id", "relative_abundance")


def read_terms(
    spark: SparkSession,
    paths: str | Sequence[str],
    manifest: DataFrame | None = None,
    term_type: str | None = None,
) -> DataFrame:
    """Two-column functional profiles → ``(sample_name, term, abundance)``.

    Without a manifest the sample is the file name less the known endings and
    the endings of ``term_type`` (``_<type>.tsv``, ``.<type with dots>.txt``).
    """
    raw = _tsv(spark, header=True).schema(TERMS).csv(paths)
    if manifest is not None:
        named = _named(raw.select("term", "abundance", F.col("_metadata.file_path").alias("_file")), manifest)
        return named.select("sample_name", "term", "abundance")
    dotted = (term_type or "").replace("_", ".")
    endings = ([f"_{dotted}.tsv"] if term_type else []) + TERM_SUFFIXES + ([f".{dotted}.txt"] if term_type else [])
    name = F.col("_metadata.file_name")
    for ending in endings:
        name = F.replace(name, F.lit(ending), F.lit(""))
    return raw.select(name.alias("sample_name"), "term", "abundance")


def read_counts(spark: SparkSession, paths: str | Sequence[str], manifest: DataFrame) -> DataFrame:
    """Gene counts → ``(sample_name, gene_id, gene_name, count)``; further columns of the files are not read."""
    raw = _tsv(spark, header=True).schema(COUNTS).option("enforceSchema", True).csv(paths)
    return _named(raw.select("*", F.col("_metadata.file_path").alias("_file")), manifest).select(
        "sample_name", "gene_id", "gene_name", "count"
    )


def _matrix_lines(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Lines of a matrix less its header, as ``(_row, cells array<string>)``; and its ``(position, sample_name)``."""
    # Splits are not scanned in file order; the block offset puts them back.
    row = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).select(row.alias("_row"), "value").filter("value <> ''")
    head = freeze(lines.agg(F.min_by("value", "_row").alias("value")))
    names = head.select(F.posexplode(F.split("value", "\t")).alias("position", "sample_name")).filter("position > 0")
    # Every part of a matrix may bring the header again.
    body = lines.filter(F.col("value") != head.scalar()).select("_row", F.split("value", "\t").alias("cells"))
    return body, names


def _cells(lines: DataFrame, names: DataFrame, name: str, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """``sample_name, <name>, cell`` by position against the header; only ``wanted`` cells leave their line."""
    rows = lines.select(F.get("cells", F.lit(0)).alias(name), F.posexplode("cells").alias("position", "cell")).filter("position > 0")
    if wanted is not None:
        rows = rows.filter(wanted(F.col("cell")))
    return rows.join(broadcast_rows(names, names.count(), 200_000), "position").select("sample_name", name, "cell")


def read_matrix(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A matrix of any width → its non-zero cells ``(sample_name, feature, value)``.

    The header is data: cells meet it by their position, so the plan has no column
    per sample. Cells that are no numbers are left out.
    """
    lines, names = _matrix_lines(spark, path)
    # Most cells are a plain zero, which needn't be read as a number.
    cells = _cells(lines, names, "feature", lambda c: (c != "0") & F.coalesce(c.try_cast("double") != 0, F.lit(False)))
    return cells.select("sample_name", "feature", F.col("cell").cast("double").alias("value"))


def read_pcl(spark: SparkSession, path: str | Sequence[str], last_metadata: str) -> tuple[DataFrame, DataFrame]:
    """A matrix of any width with metadata rows on top → ``(features, metadata)``, both long.

    ``features`` is ``(sample_name, feature, value)``; ``metadata`` is
    ``(sample_name, name, level)``. ``last_metadata`` names the last metadata row.
    """
    lines, names = _matrix_lines(spark, path)
    cut = lines.filter(F.get("cells", F.lit(0)) == last_metadata).select(F.min("_row").alias("r")).scalar()
    marked = lines.withColumn("_is_meta", F.col("_row") <= cut)
    features = _cells(marked.filter(~F.col("_is_meta")), names, "feature").select(
        "sample_name", "feature", F.col("cell").try_cast("double").alias("value")
    )
    return features, _cells(marked.filter("_is_meta"), names, "name").withColumnRenamed("cell", "level")


def read_modules(spark: SparkSession, path: str) -> DataFrame:
    """Module definitions → ``(module_id, kos array<string>)`` from columns 0 and 2."""
    schema = "module_id string, description string, kos string"
    return _tsv(spark).schema(schema).csv(path).select("module_id", F.split("kos", ",").alias("kos"))


def read_order(spark: SparkSession, path: str) -> DataFrame:
    """One sample id per line → ``(sample_name, position)``.

    The list is as long as the cohort, so lines are numbered block by block.
    """
    lines = spark.read.text(path).select(
        F.trim("value").alias("sample_name"),
        F.monotonically_increasing_id().alias("_line"),
        F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("_block"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = running(lines, [], "_line", sums=["one"], bucket=F.col("_block"))
    return placed.select("sample_name", F.col("one_before").alias("position"))


def read_assignments(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return _tsv(spark).schema(ASSIGNMENT).csv(path)


def read_report(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Clade report; the indentation of the name column is its depth."""
    raw = _tsv(spark).schema(REPORT).option("ignoreLeadingWhiteSpace", False).csv(path)
    return raw.withColumn("rank_code", F.trim("rank_code")).withColumn("name", F.trim("name"))


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RELATION).option("multiLine", True).json(path)


def read_fastq(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, file: Column | None = None
) -> DataFrame:
    """FASTQ files → ``(file, read_id, seq, qual)``; compressed files are recognised by their ending.

    ``file`` may derive the label of a file from the column ``path``; it is the
    file name otherwise. Plain files are read by byte ranges, each of which finds
    its first record by itself, so reads are never exchanged (:mod:`taxaloom.sources.fastq`).
    """
    spark.dataSource.register(FastqSource)
    reader = spark.read.format("fastq").option("tasks", spark.sparkContext.defaultParallelism)
    if glob:
        reader = reader.option("glob", glob)
    rows = reader.option("paths", json.dumps([path] if isinstance(path, str) else list(path))).load()
    name = F.element_at(F.split("path", "/"), -1) if file is None else file
    return rows.select(name.alias("file"), "read_id", "seq", "qual")
