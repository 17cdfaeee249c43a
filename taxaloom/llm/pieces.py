"""A SentencePiece vocabulary as plain tables, and the cut of a text into independent chunks."""

from __future__ import annotations

import re
from functools import cached_property, lru_cache

SPACE = "▁"
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")


class Pieces:
    """Pieces, scores and byte pieces of a model with the identity normaliser and byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                self.score[piece], self.id[piece] = model.get_score(i), i
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.score))
        self.worst = min(self.score.values())
        #: Score by piece, and None by each start of a piece that is none itself; a score of 0 would read as an end.
        self.onward: dict[str, float | None] = {p[:n]: None for p in self.score for n in range(1, len(p))}
        self.onward |= {p: s or -1e-300 for p, s in self.score.items()}
        # No piece has a space after another character, so nothing spans the start of a word.
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("pieces with inner spaces are not supported")
        self.newline_is_apart = not any("\n" in p for p in self.score)

    @cached_property
    def tree(self) -> dict[str, tuple[float | None, dict | None]]:
        """Character to (score of the piece that ends there or None, what may follow or None)."""
        below: dict[str, dict] = {}
        for start in sorted(self.onward, key=len, reverse=True):
            node = (self.onward[start], below.pop(start, None))
            below.setdefault(start[:-1], {})[start[-1]] = node
        return below[""]


@lru_cache(maxsize=4)
def load(path: str) -> Pieces:
    """Read once per Python worker."""
    return Pieces(path)


def chunks(text: str) -> list[str]:
    """Chunks that no piece crosses: each is one word with the spaces before it.

    The first space mark of each chunk, the added one of the text included, is
    left out: the chunk ``""`` stands for a lone space.
    """
    if not text:
        return []
    if SPACE in text or "  " in text or text[0] == " ":
        return [c[1:] for c in _RUNS.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


class Memo(dict):
    """Results of ``work(chunk)`` by chunk, the last ``size`` to twice as many that were asked for.

    Chunks are as :func:`chunks` gives them. A newline that no piece contains
    parts a chunk once more, so the lines' ends are kept apart. When ``size``
    results are held they become the old generation, from which those asked for
    again move back: common chunks are never worked out anew.
    """

    def __init__(self, work, pieces: Pieces, size: int = 100_000):
        super().__init__()
        self.work, self.size, self.apart = work, size, pieces.newline_is_apart
        self.old: dict = {}
        self.tails: Memo | None = None

    def keep(self, chunk: str, value):
        if len(chunk) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[chunk] = value
        return value

    def __missing__(self, chunk: str):
        value = self.old.get(chunk)
        if value is not None:
            return self.keep(chunk, value)
        if self.apart and "\n" in chunk:
            if self.tails is None:
                self.tails = _Tails(self.work, self.size)
            at = chunk.index("\n")
            value = self[chunk[:at]]
            for part in re.findall("\n[^\n]*", chunk[at:]):
                value = value + self.tails[part]
            return value
        return self.keep(chunk, self.work(SPACE + chunk))


class _Tails(Memo):
    """Results of a newline and what follows it."""

    def __init__(self, work, size: int):
        dict.__init__(self)
        self.work, self.size, self.old = work, size, {}

    def __missing__(self, chunk: str):
        value = self.old.get(chunk)
        return self.keep(chunk, self.work(chunk) if value is None else value)
