"""Packing of token sequences into windows by bounded-space best fit."""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from taxaloom.session import freeze

from .common import parts, release, schema_of, text_of

#: Windows that a partition keeps open, and partitions whose leftovers one task merges.
OPEN, FAN_IN = 64, 32
#: Sequences that a partition may number.
NUMBERS = 1 << 40
#: Pattern by which a byte-level pre-tokenizer parts texts (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def shown_bytes() -> dict[str, int]:
    """Byte by the character that stands for it in a byte-level vocabulary: itself if printable, else 256 and up in turn."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Ids:
    """Token ids of texts as little-endian unsigned 32-bit numbers, by a file of the library tokenizers.

    A plain byte-level vocabulary is handed to tiktoken as ranks, which gives the
    same ids in a quarter of the time; any other file, and a text on which its
    regular expressions give up (a million spaces), is left to the library.
    Strings of added tokens inside a text become those tokens, its default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        spec = json.loads(self.model.to_str())
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        cut, bpe = spec["pre_tokenizer"] or {}, spec["model"]
        self.ranks = None
        if (
            (spec["normalizer"], cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex"), bpe["type"])
            == (None, "ByteLevel", False, True, "BPE")
            and not (bpe["dropout"] or bpe["ignore_merges"] or bpe["end_of_word_suffix"] or bpe["continuing_subword_prefix"])
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            import tiktoken

            byte = shown_bytes()
            ranks = {bytes(map(byte.__getitem__, k)): i for k, i in bpe["vocab"].items() if k not in added}
            self.ranks = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def of(self, text: str) -> bytes:
        if self.ranks is not None:
            try:
                return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except ValueError:
                pass
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _ids(path: str) -> Ids:
    return Ids(path)


class Windows:
    """At most ``limit`` open windows of ``size`` tokens; full ones leave at once.

    A piece goes where the least room is left after it. Where none has the
    room, a new window is opened, and if that is one too many, the fullest is
    emitted: with ``cut`` it is topped up by the piece's first tokens before,
    else padded. A piece is a tuple (document fields, start, ids).
    """

    def __init__(self, size: int, limit: int, cut: bool):
        self.size, self.limit, self.cut = size, limit, cut
        self.rooms: list[tuple[int, int]] = []  # (room, window), least room first
        self.held: dict[int, list[tuple]] = {}

    def add(self, doc: tuple, start: int, ids: bytes, fresh: Iterator[int]) -> Iterator[tuple[int, list[tuple]]]:
        """Place one piece of less than ``size`` tokens; yields the windows that leave."""
        n = len(ids) // 4
        while n:
            at = bisect_left(self.rooms, (n, -1))
            if at < len(self.rooms):
                room, window = self.rooms.pop(at)
                self.held[window].append((doc, start, ids))
                if room > n:
                    insort(self.rooms, (room - n, window))
                else:
                    yield window, self.held.pop(window)
                return
            if len(self.rooms) < self.limit:
                window = next(fresh)
                self.held[window] = [(doc, start, ids)]
                insort(self.rooms, (self.size - n, window))
                return
            room, window = self.rooms.pop(0)
            if self.cut:
                self.held[window].append((doc, start, ids[: 4 * room]))
                start, ids, n = start + room, ids[4 * room :], n - room
            yield window, self.held.pop(window)


def _piece_fields(docs: DataFrame, id_col: str) -> StructType:
    fields = schema_of(docs, id_col, start=LongType(), length=LongType(), ids=BinaryType(), doc_tokens=LongType())
    return StructType([*fields, StructField("sequence_id", LongType()), StructField("offset", LongType()),
                       StructField("group", LongType()), StructField("open", BooleanType())])


class _Rows:
    """Rows of the pieces, gathered into Arrow batches."""

    def __init__(self, schema: pa.Schema, group: int):
        self.schema, self.group, self.rows, self.bytes = schema, group, [], 0

    def put(self, window: int, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for (doc, tokens), start, ids in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, ids, tokens, window, offset, self.group, is_open))
            offset += n
            self.bytes += len(ids)

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.schema)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema
        )
        self.rows, self.bytes = [], 0
        return batch


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 0,
    limit: int = OPEN,
    cut: bool = True,
) -> DataFrame:
    """Pieces of all documents, laid gapless into sequences of at most ``size`` tokens.

    One row per piece: id, ``start`` (tokens of the document before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``
    (the document's tokens with ``end_id``), ``sequence_id`` and ``offset``.

    Documents are cut every ``size`` tokens; what is left over goes best-fit
    into one of ``limit`` windows that the partition holds open. The windows
    open at the end are leftovers: ``FAN_IN`` partitions' are packed again by
    one task, in rounds, until one group is left. With ``cut`` all sequences but
    one are full; else only documents longer than ``size`` are cut.

    Null and empty texts are the end id alone; null ids and repeated rows are
    documents of their own, row by row; an empty table gives no rows. Sequence
    numbers are unique, not gapless, and depend on the partitioning. The packed
    table is written once, so that all branches see the same sequences.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = _piece_fields(docs, id_col)
    arrow = to_arrow_schema(fields)
    end = end_id.to_bytes(4, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids_of, windows, rows = _ids(tokenizer), Windows(size, limit, cut), _Rows(arrow, part)
        fresh = iter(range(part * NUMBERS, (part + 1) * NUMBERS))
        for whole in batches:
            for batch in parts(whole, 1):
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = ids_of.of(text) + end
                    key, edge = (doc, len(ids) // 4), len(ids) // 4 // size * size
                    for at in range(0, edge, size):
                        rows.put(next(fresh), [(key, at, ids[4 * at : 4 * (at + size)])])
                    for window, pieces in windows.add(key, edge, ids[4 * edge :], fresh):
                        rows.put(window, pieces)
                    if rows.bytes > 8 << 20:
                        yield rows.take()
        for window, pieces in windows.held.items():
            rows.put(window, pieces, is_open=True)
        yield rows.take()
        release()

    def merge(level: int, keep: int):
        def run(table: pa.Table) -> pa.Table:
            group = table.column("group")[0].as_py()
            windows, rows = Windows(size, keep, cut), _Rows(arrow, group)
            at = group * NUMBERS + (level << 32)
            fresh = iter(range(at, at + (1 << 32)))
            ordered = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
            doc, start, _, ids, tokens = (ordered.column(i).to_pylist() for i in range(5))
            for d, s, i, t in zip(doc, start, ids, tokens, strict=True):
                for window, pieces in windows.add((d, t), s, i, fresh):
                    rows.put(window, pieces)
            for window, pieces in windows.held.items():
                rows.put(window, pieces, is_open=True)
            return pa.Table.from_batches([rows.take()])

        return run

    packed = freeze(
        docs.select(F.col(f"`{id_col}`").alias(id_col), text_of(text_col).alias("__text")).mapInArrow(first, fields)
    )
    groups = (packed.where("open").agg(F.max("group")).first()[0] or 0) + 1
    done, level = packed.where("not open"), 0
    while packed is not None:
        level, groups = level + 1, -(-groups // FAN_IN)
        last = groups == 1
        packed = freeze(
            packed.where("open")
            .withColumn("group", F.floor(F.col("group") / FAN_IN))
            .groupBy("group")
            .applyInArrow(merge(level, 1 if cut and last else limit), fields)
        )
        done = done.unionByName(packed if last else packed.where("not open"))
        if last:
            break
    return done.drop("group", "open")
