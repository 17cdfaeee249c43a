"""Writers. Long data stays partitioned files; wide matrices exist only here."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from taxaloom.functions.lineage import NAME_MARK
from taxaloom.session import freeze, shuffle_width
from taxaloom.sources.fastq import _system

#: Cells of a matrix, empty ones too, that a task writes.
PART_CELLS = 16_000_000


def _tsv(df: DataFrame, header: bool = True):
    return df.write.mode("overwrite").option("sep", "\t").option("header", header)


def write_table(df: DataFrame, path: str, header: bool = True) -> None:
    """Any flat table as TSV; the target folder is replaced."""
    _tsv(df, header).csv(path)


def write_by(df: DataFrame, path: str, key: str) -> None:
    """One sub-folder per value of ``key`` (rank, sample, term type) in a single pass.

    Rows are rebalanced by key first: few files per folder, and a folder holding
    a large part of the rows is still written by several tasks.
    """
    _tsv(df.hint("rebalance", key)).partitionBy(key).csv(path)


#: What a folder of rows without a key is called by Spark's own writers.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def write_files(df: DataFrame, folder: str, key: str, header: bool = False, apart: bool = True) -> DataFrame:
    """One TSV file per value of ``key``, all in ``folder``; returns their ``(key, path)``, written.

    Lines are those of Spark's own writer, without the key. There is no folder per
    key, which each would have to be made, committed and listed again. With ``apart`` a key that
    holds a large part of the rows is written by several tasks, a file each.
    """
    named = F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY))
    fields = [c for c in df.columns if c != key]
    line = F.concat(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in fields]), {"sep": "\t"}), F.lit("\n"))
    rows = df.select(named.alias("_key"), line.alias("_line"))
    dealt = rows.hint("rebalance", "_key") if apart else rows.repartition("_key")
    head = ("\t".join(fields) + "\n").encode() if header else b""
    system, base = _system(folder.rstrip("/"))
    system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A repeated task writes the same files under the same names.
        part = f"{TaskContext.get().partitionId():05d}"
        system, base = _system(folder.rstrip("/"))
        made: list[tuple[str, str]] = []
        now = stream = hidden = None

        def close() -> None:
            if stream is not None:
                stream.close()
                # Neither a percent nor a plus sign, which a path could be read as escapes by.
                name = f"of={quote(now, safe='').replace('%', '=')}.{part}.csv"
                system.move(hidden, f"{base}/{name}")
                made.append((now, f"{folder.rstrip('/')}/{name}"))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, lines = batch.column(0), batch.column(1).cast(pa.large_binary())
            new = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1
            at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
            data = memoryview(lines.buffers()[2])
            for first, end in zip([0, *new.tolist()], [*new.tolist(), len(keys)], strict=True):
                if keys[first].as_py() != now:
                    close()
                    now, hidden = keys[first].as_py(), f"{base}/_{uuid.uuid4().hex}"
                    stream = system.open_output_stream(hidden)
                    stream.write(head)
                stream.write(data[at[first] : at[end]])
        close()
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.string()) for i in (0, 1)], names=[key, "path"])

    return freeze(dealt.sortWithinPartitions("_key").mapInArrow(run, f"`{key}` string, path string"))


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(column).write.mode("overwrite").text(path)


def attach_wide(result: DataFrame, wide: DataFrame, key: str = "feature", how: str = "left") -> DataFrame:
    """Result rows with the wide abundances of their feature."""
    return result.join(wide, key, how)


def to_pcl(wide: DataFrame, meta: DataFrame, samples: Sequence[str], key: str = "term") -> DataFrame:
    """Metadata row on top of the feature rows; ``_order`` is 0 for the former, 1 for the latter."""
    text = [F.col(f"`{s}`").cast("string").alias(s) for s in samples]
    features = wide.select(F.lit(1).alias("_order"), key, *text)
    head = (
        meta.groupBy(F.lit(0).alias("_order"), F.lit("group").alias(key))
        .pivot("sample_name", list(samples))
        .agg(F.first("group"))
    )
    return head.select("_order", key, *samples).unionByName(features)


def write_pcl(stacked: DataFrame, path: str, key: str = "term") -> None:
    """A stacked table as TSV parts whose name order is the row order."""
    _tsv(stacked.repartitionByRange("_order", key).sortWithinPartitions("_order", key).drop("_order")).csv(path)


def matrix_lines(
    df: DataFrame, samples: DataFrame, key: str = "feature", metadata: DataFrame | None = None, digits: int | None = None
) -> DataFrame:
    """``(_order, name, line)``: a matrix of any width as text lines, header first, then metadata, then features.

    ``df``: (sample_name, ``key``, value), one row per cell; ``samples``:
    (sample_name, position from 0 without gaps); ``metadata``: (sample_name, name,
    level). A line has as many cells as there are samples, absent ones ``0`` (empty
    in metadata rows); it is laid out from the feature's own cells and the gaps
    between them, so no plan has a column per sample. ``digits`` writes plain
    decimals. Line breaks and tabs in names become spaces.
    """
    lists = _matrix_lists(df, samples, key, metadata, digits)
    return lists.select("_order", "name", _line(samples.count()).alias("line"))


def _line(width: int) -> Column:
    """The line of a row of :func:`_matrix_lists`: its own cells and the empty ones between them."""
    empty = F.when(F.col("_order") == 2, "\t0").otherwise("\t")
    before = F.transform("c", lambda e, i: e["position"] - F.when(i > 0, F.get("c", i - 1)["position"]).otherwise(F.lit(-1)) - 1)
    cells = F.zip_with(before, F.col("c"), lambda gap, e: F.concat(F.repeat(empty, gap), F.lit("\t"), e["cell"]))
    tail = F.repeat(empty, (width - 1 - F.element_at("c", -1)["position"]).cast("int"))
    return F.concat("name", F.array_join(cells, ""), tail)


def _matrix_lists(
    df: DataFrame, samples: DataFrame, key: str, metadata: DataFrame | None, digits: int | None
) -> DataFrame:
    """``(_order, name, c)``: the cells that the lines of a matrix have, by position."""
    safe = lambda c: F.translate(F.coalesce(F.col(c).cast("string"), F.lit("")), "\t\n\r", "   ")

    def listed(rows: DataFrame, order: int) -> DataFrame:
        lists = rows.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("position", "cell"))).alias("c"))
        return lists.select(F.lit(order).alias("_order"), "name", "c")

    placed = samples.select("sample_name", F.col("position").cast("int").alias("position"))
    text = F.col("value").cast("string") if digits is None else plain_decimal("value", digits)
    features = df.join(placed, "sample_name").select(safe(key).alias("name"), "position", text.alias("cell"))
    head = placed.select(F.lit(key).alias("name"), "position", safe("sample_name").alias("cell"))
    lists = listed(head, 0).unionByName(listed(features, 2))
    if metadata is not None:
        marks = metadata.join(placed, "sample_name").select(safe("name").alias("name"), "position", safe("level").alias("cell"))
        lists = lists.unionByName(listed(marks, 1))
    return lists


def write_matrix(
    df: DataFrame, samples: DataFrame, path: str, key: str = "feature", metadata: DataFrame | None = None,
    digits: int | None = None, compression: str = "none",
) -> None:
    """:func:`matrix_lines` as text parts whose name order is the line order.

    Only the cells that a line has are exchanged; the empty ones are made by the task that writes them.
    """
    samples = freeze(samples.select("sample_name", "position"))
    lists, width = freeze(_matrix_lists(df, samples, key, metadata, digits)), samples.count()
    parts = max(shuffle_width(df.sparkSession), -(-lists.count() * width // PART_CELLS))
    ordered = lists.repartitionByRange(parts, "_order", "name").sortWithinPartitions("_order", "name")
    ordered.select(_line(width).alias("value")).write.mode("overwrite").option("compression", compression).text(path)


def to_class_matrix(df: DataFrame, meta: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Group row first, then one row per clade without strain levels; samples are columns."""
    kept = df.join(meta.select("sample_name"), "sample_name", "left_semi").filter(
        ~F.col("feature").contains("t__")
    )
    wide = (
        kept.groupBy("feature").pivot("sample_name", list(samples)).agg(F.sum("value")).na.fill(0.0, list(samples))
    )
    return to_pcl(wide.withColumnRenamed("feature", "sample_name"), meta, samples, key="sample_name")


def code_list(df: DataFrame, term: str, order: str) -> DataFrame:
    """Codes of the given (significant) terms as one comma list in ascending ``order``.

    The list is one text line by definition; its length is that of the report.
    """
    code = F.split_part(F.col(term), F.lit(NAME_MARK.strip()), F.lit(1))
    entries = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(term), code.alias("code"))))
    return df.agg(F.array_join(F.transform(entries, lambda e: e["code"]), ",").alias("codes"))


def plain_decimal(c: Column | str, digits: int = 6) -> Column:
    """Number as text without an exponent."""
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string(f"%.{digits}f", c)
