"""Read files of a sample joined end to end as bytes, and tables laid out by sample."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from taxaloom.sources.fastq import _system

#: Bytes copied at once.
BLOCK_BYTES = 8 << 20


def _ending(path: str) -> str:
    """What follows the first dot of a file's name."""
    return "".join(path.rpartition("/")[2].partition(".")[1:])


def _join(paths: list[str], place: str) -> int:
    """The bytes of ``paths`` one after another at ``place``, which appears whole or not at all."""
    system, target = _system(place)
    system.create_dir(target.rpartition("/")[0], recursive=True)
    # Attempts of one task don't meet, and the last one to end replaces the others' equal file.
    part = f"{target.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    done = 0
    with system.open_output_stream(part) as out:
        for path in paths:
            source, where = _system(path)
            with source.open_input_stream(where, compression=None) as stream:
                while data := stream.read(BLOCK_BYTES):
                    out.write(data)
                    done += len(data)
    system.move(part, target)
    return done


def join_files(files: DataFrame, folder: str, ending: str | None = None) -> DataFrame:
    """One file per sample: its ``files`` (sample_name, position, path), joined as bytes in the order of ``position``.

    Returns ``(sample_name, path, bytes, members)``. Nothing is decoded: members of
    gzip or bzip2 files joined end to end are one file of that kind again. A sample
    is one task by the format of its result; its bytes pass through in blocks. The
    names are the samples' with ``ending``, or that of their files, which must be one
    then; a sample's list of files is short. Samples without a name and rows without a
    path are an error. Rows are joined when the result is read, and a repeated
    reading writes the same files again.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    bad = F.raise_error(F.lit("a read file has no sample name or no path"))
    named = files.select(
        F.coalesce(F.col("sample_name").cast("string"), bad.cast("string")).alias("sample_name"),
        F.struct(F.col("position"), F.coalesce(F.col("path"), bad.cast("string")).alias("path")).alias("file"),
    )
    lists = named.groupBy("sample_name").agg(F.array_sort(F.collect_list("file")).alias("files"))
    lists = lists.select("sample_name", F.col("files.path").alias("paths"))
    schema = "sample_name string, path string, bytes long, members long"
    arrow = to_arrow_schema(lists.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sample, paths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                endings = {_ending(p) for p in paths} if ending is None else {ending}
                if len(endings) > 1:
                    raise ValueError(f"the files of sample {sample} end in {sorted(endings)}")
                place = f"{folder.rstrip('/')}/{quote(sample, safe='')}{endings.pop()}"
                made = [sample, place, _join(paths, place), len(paths)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made, arrow, strict=True)], schema=arrow)

    return lists.mapInArrow(run, schema)


def write_bucketed(df: DataFrame, name: str, path: str, key: str = "sample_name", buckets: int | None = None) -> DataFrame:
    """``df`` as table ``name`` below ``path``, bucketed and sorted by ``key``; returns the table.

    Tables of as many buckets join by the key, and are summed by it, without an
    exchange. ``buckets`` is the number of shuffle partitions by default. An
    earlier table of the name is replaced.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by the key first, so that a bucket is one file.
    dealt = df.repartition(n, key)
    dealt.write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)

