"""What several operators of the subpackage share.

Conventions of all operators: a null text is an empty one; input columns
other than the named ones are never read, so extra columns with any name do
no harm; results carry the id column and the operator's own columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z on UTF-8 bytes, everything else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name with as many underscores before it as the columns of ``df``, in any case, leave free."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        made.append(name)
    return made


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; ``bytes.split`` parts at exactly the six characters."""
    return text.translate(LOWER).split()


def schema_of(df: DataFrame, id_col: str, **columns: DataType) -> StructType:
    """The id column as ``df`` has it, and new columns."""
    return StructType(
        [StructField(id_col, df.schema[id_col].dataType)]
        + [StructField(name, kind) for name, kind in columns.items()]
    )


#: Bytes of text that a task has in hand at once, or one text if that is longer.
PART_BYTES = 2 << 20


def parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Stretches of ``batch`` of up to ``PART_BYTES`` of the text column each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > PART_BYTES:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def release() -> None:
    """Give back the memory that a task of this worker no longer needs; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()


def per_text(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    work: Callable[[list], dict],
    as_bytes: bool = True,
    **columns: DataType,
) -> DataFrame:
    """One row per row of ``docs``: its id and what ``work`` makes of each Arrow batch of texts.

    ``work`` gets a list of texts (UTF-8 bytes or str) and returns a list or
    array per column. Rows never leave their task, so there is no shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = schema_of(docs, id_col, **columns)
    arrow = to_arrow_schema(schema)
    text = text_of(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, 1):
                made = work(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(arrow.field(0).type)]
                    + [pa.array(made[f.name], f.type) for f in list(arrow)[1:]],
                    schema=arrow,
                )
        release()

    return docs.select(
        F.col(f"`{id_col}`").alias(id_col), (F.to_binary(text, F.lit("utf-8")) if as_bytes else text).alias("__text")
    ).mapInArrow(run, schema)
