"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, DoubleType

from .common import LOWER, parts, per_text, release

#: Hash space of the terms, factors per term, and the labelled rows a model is fitted on.
BITS, FACTORS, MAX_ROWS = 20, 4, 20_000
#: Fitted texts that a term is in at least.
MIN_TEXTS = 2
STEPS, EPOCHS, BATCH, RATE = 1500, 12, 256, 0.05
#: Decay of weights (over the root of the fitted rows) and of factors (over the rows of a batch) towards zero, chosen by
#: three folds inside the rows that labels are learnt from.
DECAY_WEIGHT, DECAY_FACTOR = 0.1, 1.0
#: Standard errors between a term's share of label 1 and that of all texts from which on its weight decays less.
ERRORS = 2.0

_EDGE = b"".join(bytes([b]) for b in range(128) if not chr(b).isalnum())


def terms_of(text: bytes) -> set[int]:
    """Hashes of the distinct words of a text, lower-cased (A-Z) and without ASCII signs at their ends."""
    mask = (1 << BITS) - 1
    return {zlib.crc32(w) & mask for word in set(text.translate(LOWER).split()) if (w := word.strip(_EDGE))}


class Machine:
    """sigmoid(bias + sum of weights + sum over pairs of terms of the product of their factors)."""

    def __init__(self, bias: float, terms: np.ndarray, weight: np.ndarray, factor: np.ndarray):
        self.bias, self.terms, self.weight, self.factor = bias, terms, weight, factor

    @lru_cache(maxsize=1)  # noqa: B019  one model per worker
    def place(self) -> dict[int, int]:
        return {int(t): i for i, t in enumerate(self.terms)}

    def score(self, text: bytes, memo: dict[bytes, int | None]) -> float:
        """Probability of label 1. ``memo``: place of a word's term, None without one."""
        place, found = self.place(), set()
        mask = (1 << BITS) - 1
        for word in set(text.translate(LOWER).split()):
            k = memo.get(word, -1)
            if k == -1:
                w = word.strip(_EDGE)
                k = place.get(zlib.crc32(w) & mask) if w else None
                if len(memo) >= 300_000:
                    memo.clear()
                memo[word] = k
            if k is not None:
                found.add(k)
        at = np.fromiter(sorted(found), np.int64, len(found))
        v = self.factor[at]
        total = v.sum(0)
        z = self.bias + self.weight[at].sum() + 0.5 * (total @ total - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _shrunk(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0)


def fit(rows: list[tuple[np.ndarray, int]], seed: int = 6) -> Machine:
    """A machine for (terms, label) rows by AdaGrad on the log loss, with absolute decay of weights and factors.

    Every term of ``MIN_TEXTS`` rows takes part, whatever its share of label 1:
    each step moves its weight and factors towards zero by a constant, so that
    only what lessens the loss stays off zero. Weights of terms whose share is
    more than ``ERRORS`` standard errors off decay less, by the square of it;
    factors all decay alike, so that terms without an effect of their own can
    still count in pairs. Terms that end at zero are left out of the machine.
    """
    if not rows:
        return Machine(-np.inf, np.zeros(0, int), np.zeros(0), np.zeros((0, FACTORS)))
    y = np.array([label for _, label in rows], float)
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    counts, ones = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for t, label in rows:
        counts[t] += 1
        if label:
            ones[t] += 1
    p = (y.sum() + 1) / (len(y) + 2)
    terms = np.flatnonzero(counts >= MIN_TEXTS)
    off = np.abs(ones - p * counts)[terms] / np.sqrt(p * (1 - p) * counts[terms])
    decay = DECAY_WEIGHT / np.sqrt(max(len(rows), 1)) / np.maximum(off / ERRORS, 1) ** 2
    decay_factor = DECAY_FACTOR / max(min(len(rows), BATCH), 1)
    place = np.full(1 << BITS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    where = [p[p >= 0] for p in (place[np.asarray(t, np.int32)] for t, _ in rows)]
    rng = np.random.default_rng(seed)
    weight, factor = np.zeros(len(terms)), rng.normal(0, 0.1, (len(terms), FACTORS))
    sum_w, sum_f, sum_b = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
    for _ in range(max(EPOCHS, STEPS * BATCH // max(len(rows), BATCH))):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            batch = order[start : start + BATCH]
            size = np.array([len(where[i]) for i in batch])
            at = np.concatenate([where[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), size)
            v = factor[at]
            total = np.stack([np.bincount(row, v[:, k], len(batch)) for k in range(FACTORS)], 1)
            square = np.bincount(row, (v * v).sum(1), len(batch))
            z = bias + np.bincount(row, weight[at], len(batch)) + 0.5 * ((total * total).sum(1) - square)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]
            seen, inverse = np.unique(at, return_inverse=True)
            g = np.bincount(inverse, error[row], len(seen)) / len(batch)
            sum_w[seen] += g * g
            step = RATE / np.sqrt(sum_w[seen])
            weight[seen] = _shrunk(weight[seen] - step * g, step * decay[seen])
            pull = error[row][:, None] * (total[row] - v)
            for k in range(FACTORS):
                g = np.bincount(inverse, pull[:, k], len(seen)) / len(batch)
                sum_f[seen, k] += g * g
                step = 0.3 * RATE / np.sqrt(sum_f[seen, k])
                factor[seen, k] = _shrunk(factor[seen, k] - step * g, step * decay_factor)
            g = error.mean()
            sum_b += g * g
            bias -= RATE * g / np.sqrt(sum_b)
    kept = (weight != 0) | factor.any(1)
    return Machine(float(bias), terms[kept], weight[kept], factor[kept])


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.to_binary(F.col(f"`{id_col}`").cast("string"), F.lit("utf-8"))), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Machine:
    """A machine fitted on at most ``max_rows`` labelled rows, those with the smallest hash of their id.

    Held-out rows, null labels and null ids are left out. The chosen ids, at most
    ``max_rows``, are broadcast; the hashed terms of their texts come to the
    driver, which fits the model. Rows that repeat an id are rows of their own,
    whatever their labels. Without rows nothing is known of label 1, and every
    text scores next to zero.
    """
    chosen = (
        labels.where(~held_out(id_col) & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull())
        .select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__y"))
        .orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "__y")
        .limit(max_rows)
    )
    texts = docs.join(F.broadcast(chosen), F.col(f"`{id_col}`") == F.col("__id")).select(
        F.col("__y"), F.col("__id"), F.col(f"`{text_col}`").alias("__t")
    )
    keyed = texts.select(F.struct("__id", "__y").alias("k"), "__t").select(
        F.concat_ws("/", F.col("k.__id").cast("string"), F.col("k.__y").cast("string")).alias("k"), F.col("__t")
    )
    packed = lambda t: np.array(sorted(terms_of(t)), np.int32).tobytes()
    hashed = per_text(keyed, "k", "__t", lambda ts: {"terms": list(map(packed, ts))}, terms=BinaryType())
    found = sorted((r.k, bytes(r.terms)) for r in hashed.toLocalIterator())
    return fit([(np.frombuffer(terms, np.int32), int(k.rpartition("/")[2])) for k, terms in found])


def toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` per row of ``docs``; nulls count as empty texts, whose score is the bias.

    Whole texts are scored. The model, of at most 2^``BITS`` terms, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    memo: dict = {}

    def work(texts: list[bytes]) -> dict:
        model = shared.value
        return {"score": [model.score(t, memo) for t in texts]}

    return per_text(docs, id_col, text_col, work, score=DoubleType())


def without_toxic(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are; there is no exchange."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    place = docs.columns.index(text_col)
    memo: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in parts(whole, place):
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                keep = pa.array([model.score(t or b"", memo) < threshold for t in texts], pa.bool_())
                yield batch.filter(keep)
        release()

    return docs.mapInArrow(run, docs.schema)
