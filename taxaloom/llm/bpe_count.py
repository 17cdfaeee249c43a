"""Token counts by byte-pair merging over a heap and a linked list."""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType

from .common import per_text
from .pieces import Memo, Pieces, chunks, load


def merged_count(chunk: str, pieces: Pieces) -> int:
    """Tokens of ``chunk``: initial symbols minus merges, no token is ever named.

    The heap holds adjacent pairs by rank, then by place; the symbols are a
    doubly linked list over their first characters. A pair whose ends have
    changed since it was pushed has another length and is skipped. A character
    that is no piece falls back to its UTF-8 bytes.
    """
    score = pieces.score
    symbols = list(chunk)
    n = len(symbols)
    heap = []
    for i in range(n - 1):
        s = score.get(symbols[i] + symbols[i + 1])
        if s is not None:
            heap.append((-s, i, i + 1, 2))
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    merges = 0
    while heap:
        _, i, j, size = heappop(heap)
        left, right = symbols[i], symbols[j]
        if not left or not right or after[i] != j or len(left) + len(right) != size:
            continue
        merges += 1
        left = symbols[i] = left + right
        symbols[j] = ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            s = score.get(left + symbols[k])
            if s is not None:
                heappush(heap, (-s, i, k, len(left) + len(symbols[k])))
        h = before[i]
        if h >= 0:
            s = score.get(symbols[h] + left)
            if s is not None:
                heappush(heap, (-s, h, i, len(symbols[h]) + len(left)))
    extra = sum(len(s.encode()) - 1 for s in symbols if s and s not in score)
    return n - merges + extra


@lru_cache(maxsize=4)
def _memo(path: str, remember: int = 100_000) -> Memo:
    pieces = load(path)
    return Memo(lambda chunk: merged_count(chunk, pieces), pieces, remember)


def token_counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", remember: int = 100_000
) -> DataFrame:
    """``id, n_bytes, n_tokens`` per row of ``docs``.

    Nulls and empty texts have 0 bytes and 0 tokens; repeated rows and null
    ids are rows like any other; an empty table gives an empty result. Texts
    of any length are merged whole, chunk by chunk (see :mod:`pieces`), with
    the counts of ``remember`` chunks held per worker in each of two generations.
    """

    def work(texts: list[str]) -> dict:
        memo = _memo(model, remember)
        count = memo.__getitem__
        return {
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": [sum(map(count, chunks(t))) for t in texts],
        }

    return per_text(docs, id_col, text_col, work, as_bytes=False, n_bytes=LongType(), n_tokens=LongType())
