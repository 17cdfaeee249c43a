"""Exact deduplication as a Grace hash join with itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import per_text, text_of

#: A table is emptied when its texts reach this many bytes; the hash bits that follow part the bucket further.
TABLE_BYTES = 32 << 20


def normalised(text: bytes) -> bytes:
    """Each run of the six ASCII white-space characters as one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    head = b" " if text[0] in b" \t\n\x0b\x0c\r" else b""
    tail = b" " if text[-1] in b" \t\n\x0b\x0c\r" else b""
    return head + b" ".join(words) + tail


def hash_of(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


class Table:
    """Open addressing with linear probing; equal hashes are told apart by the complete content."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.least: list = []
        self.rows: list[int] = []
        self.bytes = 0

    def add(self, h: int, text: bytes, least, rows: int) -> None:
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.texts[k] == text:
                self.rows[k] += rows
                if least is not None and (self.least[k] is None or least < self.least[k]):
                    self.least[k] = least
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.least.append(least)
        self.rows.append(rows)
        self.bytes += len(text) + 200
        if 2 * len(self.texts) > mask:
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``text_sha256, keep_id, group_size``: one row per different text of ``docs``.

    1. Every task puts its rows in a table and passes on each different text
       once, with its smallest id and number of rows: a group of copies, however
       large, leaves a task as one row per table.
    2. The exchange parts the texts by hash into buckets; inside a bucket Spark's
       external sort by hash writes and reads the spill files. In that order each
       further hash bit is a further level of partitioning: the reader fills a
       table until it holds ``TABLE_BYTES`` and ends it at the next change of the
       hash, so each part fits, at whatever depth that takes.
    3. Equal hashes are compared by complete content.
    """
    id_type = docs.schema[id_col].dataType
    spilled = StructType(
        [
            StructField("h", LongType()),
            StructField("content", BinaryType()),
            StructField("least", id_type),
            StructField("n_rows", LongType()),
        ]
    )
    found = StructType(
        [
            StructField("text_sha256", StringType()),
            StructField("keep_id", id_type),
            StructField("group_size", LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    spilled_arrow, found_arrow = to_arrow_schema(spilled), to_arrow_schema(found)

    def flush(table: Table) -> Iterator[pa.RecordBatch]:
        if table.texts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip((table.hashes, table.texts, table.least, table.rows), spilled_arrow, strict=True)],
                schema=spilled_arrow,
            )

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = normalised(text)
                table.add(hash_of(text), text, key, 1)
                if table.bytes >= TABLE_BYTES:
                    yield from flush(table)
                    table = Table()
        yield from flush(table)

    def groups(table: Table) -> Iterator[pa.RecordBatch]:
        if table.texts:
            digests = [hashlib.sha256(t).hexdigest() for t in table.texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip((digests, table.least, table.rows), found_arrow, strict=True)],
                schema=found_arrow,
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last = Table(), None
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(4))
            for h, text, least, rows in zip(*columns, strict=True):
                if table.bytes >= TABLE_BYTES and h != last:
                    yield from groups(table)
                    table = Table()
                table.add(h, text, least, rows)
                last = h
        yield from groups(table)

    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.to_binary(text_of(text_col), F.lit("utf-8")).alias("t"))
    return texts.mapInArrow(part, spilled).repartition("h").sortWithinPartitions("h").mapInArrow(fill, found)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Of equal normalised texts the smallest id is kept; null ids count in the
    group but are kept only where the group has no other id. Rows that repeat
    the kept id are that document, so they are kept too. A null text equals an
    empty one. An empty table gives an empty result.
    """

    def work(texts: list[bytes]) -> dict:
        return {"text_sha256": [hashlib.sha256(normalised(t)).hexdigest() for t in texts]}

    members = per_text(docs, id_col, text_col, work, text_sha256=StringType())
    return members.join(exact_groups(docs, id_col, text_col), "text_sha256").select(
        F.col(f"`{id_col}`"),
        "keep_id",
        "group_size",
        F.col(f"`{id_col}`").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
