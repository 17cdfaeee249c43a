"""SentencePiece encoding by a streaming Viterbi search, and decoding."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from math import inf

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType

from .common import per_text
from .pieces import Memo, Pieces, chunks, load

#: Penalty of a character without a piece, below the worst score of the vocabulary (fixed value of the format).
UNKNOWN_PENALTY = 10.0
_NOTHING = (None, None)


def stream_ids(blocks: Iterable[str], pieces: Pieces) -> Iterator[int]:
    """Ids of the best segmentation of the joined ``blocks``, committed while these come in.

    The window holds the characters since the last commit and at most a block
    and a piece more. A boundary is committed as soon as every surviving path
    runs through it: at once where no piece reaches beyond it, else when the
    back pointers of all boundaries that later pieces can still start from meet.
    The commit resets scores to zero, so rounding doesn't grow with the text.
    Of equal scores the path whose last piece is longest wins.
    """
    ids, longest = pieces.id, pieces.longest
    first = pieces.tree.get
    unknown, none = pieces.worst - UNKNOWN_PENALTY, -inf
    window, best, back = "", [0.0], [0]
    # Boundaries: of the last commit, the next one to start from, the furthest one reached; and when to look for a meeting.
    done, at, reach, check = 0, 0, 0, 8 * longest
    for block in chain(blocks, ("",)):
        if done:
            window, best, back = window[done:], best[done:], [max(0, b - done) for b in back[done:]]
            done, at, reach = 0, at - done, reach - done
        window += block
        size = len(window)
        best += [none] * (size + 1 - len(best))
        back += [0] * (size + 1 - len(back))
        until = size - longest if block else size
        while at < until:
            here, end = best[at], at + 1
            s, onward = first(window[at], _NOTHING)
            # A character that is no piece of its own may still start longer ones.
            x = here + (s or unknown)
            if x > best[end]:
                best[end], back[end] = x, at
            if end > reach:
                reach = end
            while onward and end < size:
                node = onward.get(window[end])
                if node is None:
                    break
                end += 1
                s, onward = node
                if s:
                    x = here + s
                    if x > best[end]:
                        best[end], back[end] = x, at
                    if end > reach:
                        reach = end
            at += 1
            if reach == at:
                meet = at
            elif at - done < check:
                continue
            else:
                live = {k for k in range(at, reach + 1) if best[k] > none}
                while len(live) > 1:
                    last = max(live)
                    live.remove(last)
                    live.add(back[last])
                meet = live.pop()
                check = at - meet + 8 * longest
                if meet == done:
                    continue
            cuts = [meet]
            while cuts[-1] != done:
                cuts.append(back[cuts[-1]])
            for k in range(len(cuts) - 1, 0, -1):
                piece = window[cuts[k] : cuts[k - 1]]
                if piece in ids:
                    yield ids[piece]
                else:
                    for x in piece.encode():
                        yield pieces.byte_id[x]
            floor, done = best[meet], meet
            for k in range(meet, reach + 1):
                best[k] -= floor


@lru_cache(maxsize=4)
def _memo(path: str, remember: int = 100_000) -> Memo:
    pieces = load(path)
    return Memo(lambda chunk: tuple(stream_ids((chunk,), pieces)), pieces, remember)


def ids_of(text: str, memo: Memo) -> list[int]:
    """Ids of a whole text. Paths always meet where a word starts, so each word's ids are found once per worker."""
    return list(chain.from_iterable(map(memo.__getitem__, chunks(text))))


def text_of_ids(ids: Iterable[int], pieces: Pieces) -> str:
    text = b"".join(map(pieces.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", remember: int = 100_000
) -> DataFrame:
    """``id, n_pieces, ids, round_trip`` per row; ``round_trip``: decoding gives the text back exactly.

    Nulls and empty texts have no ids. Repeated rows and null ids are rows like
    any other; an empty table gives an empty result. The format itself writes a
    space mark like a space, so a text that has the mark U+2581 doesn't come
    back exactly, and says so. ``remember``: chunks whose ids a worker holds in
    each of two generations, memory against time.
    """

    def work(texts: list[str]) -> dict:
        memo, pieces = _memo(model, remember), load(model)
        ids = [ids_of(t, memo) for t in texts]
        return {
            "n_pieces": [len(x) for x in ids],
            "ids": ids,
            "round_trip": [text_of_ids(x, pieces) == t for x, t in zip(ids, texts, strict=True)],
        }

    return per_text(
        docs, id_col, text_col, work, as_bytes=False,
        n_pieces=LongType(), ids=ArrayType(IntegerType()), round_trip=BooleanType(),
    )


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give an empty text."""

    @F.pandas_udf(StringType())
    def text(ids: pd.Series) -> pd.Series:
        pieces = load(model)
        return pd.Series([text_of_ids(() if x is None else x, pieces) for x in ids])

    return encoded.withColumn(out, text(F.col(f"`{ids_col}`")))


