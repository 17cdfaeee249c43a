"""Language-model scores of texts: the likelihood of a subword lattice, summed over all segmentations."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from taxaloom.session import freeze

from .common import text_of, words_of
from .pieces import SPACE, Pieces, load
from .shingles import U, mix

#: Passes of expectation maximisation over the words of the corpus.
ROUNDS = 3
#: Added to the expected count of every piece.
SMOOTH = 0.01
#: Values of the class column with a model of their own; all others share one more.
CLASSES = 7
#: Share of a class's unseen words that the whole corpus's words get, the lattice of the class the rest.
SHARED = 0.1
#: Words of most occurrences that every task holds at most; the others are joined. Bounds the broadcast.
FREQUENT = 250_000
#: A task passes its word counts on when it holds so many words.
HELD = 1_000_000
#: Words that a task works on together at least.
TOGETHER = 50_000
#: Words up to this length are taken many at once.
SHORT = 24

_LN10 = math.log(10)
_BASE = U(0x9E3779B97F4A7C15)


class Lattice:
    """Pieces that words can be made of.

    A word is its characters after one space mark. A character without a piece
    is the product of its bytes' pieces. Place 0 is no piece.
    """

    def __init__(self, pieces: Pieces):
        names = [p for p in pieces.score if p.rfind(SPACE) <= 0]
        self.place = {p: i + 1 for i, p in enumerate(names)}
        self.byte = len(names) + 1
        self.size = self.byte + 256
        self.longest = max(map(len, names))
        #: The vocabulary's scores are ranks; at first a piece weighs the inverse of its rank.
        self.start = np.zeros(self.size)
        self.start[1 : self.byte] = [1 / (100 - pieces.score[p]) for p in names]
        self.start[self.byte :] = self.start[1 : self.byte].min()
        self._index(names)

    def _index(self, names: list[str]) -> None:
        """Places by hash of the characters: a table, and a second one for what finds its slot taken."""
        hashes = np.zeros(len(names), U)
        for i, name in enumerate(names):
            h = np.zeros(1, U)
            for c in name:
                h = h * _BASE + U(ord(c) + 1)
            hashes[i] = mix(h)[0]
        #: Few of all spans are pieces: most are sorted out by a small table of flags.
        self.flags = np.zeros(1 << 18, bool)
        self.flags[(hashes >> U(46)).astype(np.int64)] = True
        order = np.argsort(hashes)
        self.hashes, self.order = hashes[order], (order + 1).astype(np.int32)

    def places(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each piece length less one: place of the piece that starts at each character, 0 for none."""
        n, length = codes.shape
        out, h = [], np.zeros((n, length), U)
        for size in range(1, min(self.longest, length) + 1):
            h = h[:, : length - size + 1] * _BASE + codes[:, size - 1 :]
            full = mix(h)
            found = np.zeros(h.shape, np.int32)
            at = np.nonzero(self.flags[(full >> U(46)).astype(np.int64)])
            key = full[at]
            slot = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
            found[at] = np.where(self.hashes[slot] == key, self.order[slot], 0)
            out.append(found)
        return out

    def logs(self, counts: np.ndarray) -> np.ndarray:
        """Logarithms of smoothed probabilities, by class and place."""
        smoothed = counts + SMOOTH
        smoothed[..., 0] = 0
        with np.errstate(divide="ignore"):
            return np.log(smoothed / smoothed.sum(-1, keepdims=True))

    def edges(self, word: str) -> list[list[tuple[int, tuple[int, ...]]]]:
        """For each boundary, (earlier boundary, places) of the pieces that end there."""
        ending: list[list] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                k = self.place.get(word[i:j])
                if k:
                    ending[j].append((i, (k,)))
                elif j == i + 1:
                    ending[j].append((i, tuple(self.byte + b for b in word[i].encode())))
        return ending

    def forward(self, word: str, logs: np.ndarray) -> list[float]:
        """Log probability of each prefix, all its segmentations summed."""
        alpha = [0.0]
        for ending in self.edges(word)[1:]:
            terms = [alpha[i] + sum(logs[k] for k in places) for i, places in ending]
            most = max(terms)
            alpha.append(most + math.log(sum(math.exp(t - most) for t in terms)))
        return alpha

    def _expected_one(self, word: str, logs: np.ndarray, out: np.ndarray) -> None:
        edges, alpha = self.edges(word), self.forward(word, logs)
        beta = [-math.inf] * len(word) + [0.0]
        for j in range(len(word), 0, -1):
            for i, places in edges[j]:
                t = sum(logs[k] for k in places) + beta[j]
                beta[i] = float(np.logaddexp(beta[i], t))
                share = math.exp(alpha[i] + t - alpha[-1])
                for k in places:
                    out[k] += share

    def _by_length(self, words: list[str]) -> Iterator[tuple[np.ndarray, list[np.ndarray] | None]]:
        """Numbers of words of one length with their places; None for words that are long or have characters without a piece."""
        groups: dict[int, list[int]] = defaultdict(list)
        for n, w in enumerate(words):
            groups[len(w) if len(w) <= SHORT else 0].append(n)
        single = [np.array(groups.pop(0, []), np.int64)]
        for length, numbers in groups.items():
            for at in range(0, len(numbers), 4096):
                part = np.array(numbers[at : at + 4096])
                codes = np.array([words[n] for n in part], f"U{length}").view(np.uint32).reshape(len(part), length).astype(U) + U(1)
                places = self.places(codes)
                whole = (places[0] > 0).all(1)
                single.append(part[~whole])
                if whole.any():
                    yield part[whole], [p[whole] for p in places]
        yield np.concatenate(single), None

    def scores(self, words: list[str], logs: np.ndarray) -> np.ndarray:
        """Log probability of each word for each class of ``logs``, by a forward recursion in logarithms."""
        out = np.zeros((len(words), len(logs)))
        for numbers, places in self._by_length(words):
            if places is None:
                for n in numbers:
                    out[n] = [self.forward(words[n], own)[-1] for own in logs]
                continue
            alpha = [np.zeros((len(logs), len(numbers)))]
            for j in range(1, places[0].shape[1] + 1):
                total = alpha[j - 1] + logs[:, places[0][:, j - 1]]
                for size in range(2, min(j, len(places)) + 1):
                    ending = places[size - 1][:, j - size]
                    at = np.flatnonzero(ending)
                    if len(at):
                        total[:, at] = np.logaddexp(total[:, at], alpha[j - size][:, at] + logs[:, ending[at]])
                alpha.append(total)
            out[numbers] = alpha[-1].T
        return out

    def expected(self, words: list[str], classes: np.ndarray, logs: np.ndarray, out: np.ndarray) -> None:
        """Add each piece's expected number over all segmentations to ``out``, by the class of the word.

        Short words have probabilities far from underflow, so their sums aren't in logarithms.
        """
        chance = np.exp(logs)
        keys, shares = [], []
        for numbers, places in self._by_length(words):
            if places is None:
                for n in numbers:
                    self._expected_one(words[n], logs[classes[n]], out[classes[n]])
                continue
            own = classes[numbers]
            weight = [chance[own[:, None], p] for p in places]
            length = weight[0].shape[1]
            alpha, beta = np.zeros((length + 1, len(numbers))), np.zeros((length + 1, len(numbers)))
            alpha[0] = beta[length] = 1
            for j in range(1, length + 1):
                for size in range(1, min(j, len(weight)) + 1):
                    alpha[j] += alpha[j - size] * weight[size - 1][:, j - size]
            for i in range(length - 1, -1, -1):
                for size in range(1, min(length - i, len(weight)) + 1):
                    beta[i] += beta[i + size] * weight[size - 1][:, i]
            for size, w in enumerate(weight, 1):
                share = alpha[: length - size + 1].T * w * beta[size:].T / alpha[length][:, None]
                at = np.flatnonzero(places[size - 1])
                keys.append((own[:, None] * out.shape[1] + places[size - 1]).ravel()[at])
                shares.append(share.ravel()[at])
        if keys:
            out += np.bincount(np.concatenate(keys), np.concatenate(shares), out.size).reshape(out.shape)


@lru_cache(maxsize=2)
def _lattice(model: str) -> Lattice:
    return Lattice(load(model))


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _schema(**columns) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``TOGETHER``: words of one length are worked on together."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _as_texts(column: pa.Array) -> list[str]:
    return [SPACE + w.decode("utf-8", "replace") for w in column.to_pylist()]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.to_binary(F.col(f"`{id_col}`").cast("string"), F.lit("utf-8"))), F.lit(7)) == 2, F.lit(False))


def _count_words(docs: DataFrame, text_col: str, group: Column, classes: int) -> DataFrame:
    """``word, n, c0, c1, ...``: occurrences of all words of all texts, and those of each class's training texts.

    ``group``: the class of a training text, -1 for a held-out one.
    """
    schema = _schema(word=BinaryType(), group=IntegerType(), n=LongType())
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for g, counter in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counter.keys(), pa.binary()), pa.array([g] * len(counter), pa.int32()), pa.array(counter.values(), pa.int64())],
                    schema=arrow,
                )
            counts.clear()

        for batch in batches:
            for text, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[g].update(words_of(text))
                if sum(map(len, counts.values())) >= HELD:
                    yield from flush()
        yield from flush()

    rows = docs.select(F.to_binary(text_of(text_col), F.lit("utf-8")).alias("t"), group.cast("int").alias("g"))
    sums = [F.sum(F.when(F.col("group") == g, F.col("n")).otherwise(F.lit(0))).alias(f"c{g}") for g in range(classes)]
    return rows.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"), *sums)


def _fit(words: DataFrame, model: str, classes: int, apart: bool) -> np.ndarray:
    """Log probabilities of the pieces after ``ROUNDS`` passes over the training words, by class if ``apart``."""
    lattice = _lattice(model)
    logs = lattice.logs(np.repeat(lattice.start[None], classes if apart else 1, 0) * 1e6)
    schema = _schema(key=LongType(), count=DoubleType())
    arrow = _arrow(schema)
    spark = words.sparkSession
    seen = F.filter(F.array(*[F.when(F.col(f"c{g}") > 0, F.lit(g)) for g in range(classes)]), lambda g: g.isNotNull())
    if apart:
        rows = words.select("word", F.explode(seen).alias("g"))
    else:
        rows = words.where(F.size(seen) > 0).select("word", F.lit(0).alias("g"))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(logs)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            out = np.zeros(shared.value.shape)
            for batch in _gathered(batches):
                _lattice(model).expected(_as_texts(batch.column(0)), batch.column(1).to_numpy().astype(np.int64), shared.value, out)
            at = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.ravel()[at])], schema=arrow)

        counts = np.zeros(logs.size)
        # At most one row per class and piece of the vocabulary.
        for row in rows.mapInArrow(run, schema).groupBy("key").agg(F.sum("count")).collect():
            counts[row[0]] = row[1]
        logs = lattice.logs(counts.reshape(logs.shape))
    return logs


class _Model:
    """Counts, discounts and lattices of the classes, and of the whole corpus in the last place."""

    def __init__(self, words: DataFrame, model: str, texts: list[int], apart: bool):
        self.texts = np.array(texts, float)
        k = len(texts)
        total = sum((F.col(f"c{g}") for g in range(k)), F.lit(0)).alias("c")
        sums = [f(c) for c in [*(F.col(f"c{g}") for g in range(k)), total]
                for f in (F.sum, lambda x: F.count_if(x > 0), lambda x: F.count_if(x == 1), lambda x: F.count_if(x == 2))]
        found = np.array([x or 0 for x in words.agg(*sums).first()], float).reshape(k + 1, 4)
        ends = np.append(self.texts, self.texts.sum())
        self.n, self.v = found[:, 0] + ends, found[:, 1] + (ends > 0)
        once, twice = found[:, 2] + (ends == 1), found[:, 3] + (ends == 2)
        self.discount = np.where(once * twice > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        self.prior = self.texts / max(self.texts.sum(), 1) if self.texts.sum() else np.full(k, 1 / k)
        #: Chance of a word that the class, or the corpus, hasn't seen.
        self.unseen = np.where(self.n > 0, self.discount * self.v / np.maximum(self.n, 1), 1.0)
        self.model, self.logs = model, _fit(words, model, k, apart)

    def chances(self, counts: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Log probability by class of words with the given counts by class and lattice log probabilities."""
        n = np.maximum(self.n, 1)
        made = np.exp(lattice)
        whole = np.maximum(counts.sum(1) - self.discount[-1], 0) / n[-1] + self.unseen[-1] * (made @ self.prior)
        own = np.maximum(counts - self.discount[:-1], 0) / n[:-1]
        with np.errstate(divide="ignore"):
            plain = np.log(self.unseen[:-1] * (1 - SHARED)) + lattice
            return np.logaddexp(plain, np.log(own + self.unseen[:-1] * SHARED * whole[:, None]))

    def words(self, column: pa.Array, counts: np.ndarray) -> np.ndarray:
        lattice = _lattice(self.model).scores(_as_texts(column), self.logs)
        return self.chances(counts, np.broadcast_to(lattice, (len(lattice), len(self.prior))))

    def end(self) -> np.ndarray:
        """Log probability of the end, a token that only counts make likely."""
        return self.chances(self.texts[None], np.full((1, len(self.texts)), -50.0))[0]


def text_scores(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", class_col: str | None = "lang", apart: bool = False
) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    The tokens of a text are its lower-cased words and one end. ``base_score``
    is the add-one unigram score of the tokens; ``score`` is the log10
    probability of the text, its likelihood summed over all segmentations and
    classes:

    - A lattice has the vocabulary's pieces as edges, weighed by their ranks at
      first and then by their expected numbers over all segmentations of the
      training words, each different word once. Since no piece has an inner space mark, all paths of a text
      meet where a word starts: its probability is the product of its words'.
    - One more edge spans a word: the word itself, as often as the training texts
      have it less a discount (the share of words seen once); what the discounts leave goes to the lattice, and
      ``SHARED`` of it to the words of all classes.
    - Training texts are classed by ``class_col``: its ``CLASSES`` commonest values,
      and all other values, null or a missing column as one more. Each class has
      counts of its own, and piece weights if ``apart``. A scored text's own
      value isn't looked at: its probability is the sum over the classes.

    Words are counted in the tasks and summed by one exchange. Each different
    word is scored once, by a forward recursion in logarithms; the ``FREQUENT``
    commonest are held by every task, the others are joined by word, so a hot word
    costs one lookup. Nulls are empty texts (one token, the end); null ids are
    learnt from; rows that repeat an id and text all get their scores. Without
    training rows counts are 0 and the lattice keeps its smoothed start. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    out = held_out(id_col)
    value = F.col(f"`{class_col}`").cast("string") if class_col in docs.columns else F.lit(None).cast("string")
    train = docs.where(~out).groupBy(value.alias("value")).agg(F.count("*").alias("texts"))
    commonest = train.where("value IS NOT NULL").orderBy(F.desc("texts"), "value").limit(CLASSES).collect()
    names = [r.value for r in commonest]
    others = (train.agg(F.sum("texts")).first()[0] or 0) - sum(r.texts for r in commonest)
    texts = [r.texts for r in commonest] + ([others] if others or not names else [])
    group = F.lit(len(names))
    for g, name in enumerate(names):
        group = F.when(value == name, F.lit(g)).otherwise(group)
    group = F.when(out, F.lit(-1)).otherwise(F.coalesce(group, F.lit(len(names))))

    k, trained = len(texts), sum(texts)
    words = freeze(_count_words(docs, text_col, group, k))
    fitted = _Model(words, model, texts, apart)
    total, known = int(fitted.n[-1]), int(fitted.v[-1])
    shared = spark.sparkContext.broadcast(fitted)
    end = fitted.end()

    scored_schema = StructType(
        [StructField("word", BinaryType()), StructField("n", LongType()), StructField("c", LongType())]
        + [StructField(f"s{g}", DoubleType()) for g in range(k)]
    )
    scored_arrow = _arrow(scored_schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            counts = np.stack([batch.column(2 + g).to_numpy() for g in range(k)], 1)
            made = shared.value.words(batch.column(0), counts.astype(float))
            columns = [batch.column(0), batch.column(1), pa.array(counts.sum(1)), *(pa.array(made[:, g]) for g in range(k))]
            yield pa.RecordBatch.from_arrays(columns, schema=scored_arrow)

    scored = freeze(words.mapInArrow(score, scored_schema))
    # Occurrences in steps of a sixteenth of a power of two, so that few rows tell where the commonest words begin.
    step = F.floor(16 * F.log2(F.col("n"))).cast("int")
    held, cut = 0, 0
    for r in sorted(scored.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True):
        if held + r.words > FREQUENT:
            cut = r.step + 1
            break
        held += r.words
    top = scored.where(step >= cut).toArrow()
    common = spark.sparkContext.broadcast(
        (
            {w: i for i, w in enumerate(top["word"].to_pylist())},
            np.stack(
                [np.log10(top["c"].to_numpy() + 1.0), (top["c"].to_numpy() > 0).astype(float)]
                + [top[f"s{g}"].to_numpy() for g in range(k)],
                1,
            ),
        )
    )

    key = F.struct(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), text_of(text_col)).alias("key"),
    )
    part = StructType(
        [StructField("row", docs.select(key.alias("row")).schema["row"].dataType)]
        + [StructField(c, LongType()) for c in ("n_tokens", "n_known")]
        + [StructField(c, DoubleType()) for c in ("base", *(f"p{g}" for g in range(k)))]
        + [StructField("words", ArrayType(BinaryType())), StructField("times", ArrayType(IntegerType()))]
    )
    part_arrow = _arrow(part)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = common.value
        get = place.get
        for batch in batches:
            counts, sums, words, times = [], [], [], []
            for text in batch.column(1).to_pylist():
                tokens = words_of(text)
                found = np.array([get(w, -1) for w in tokens], np.int64)
                made = values[found[found >= 0]].sum(0) if len(values) else np.zeros(2 + k)
                rare = Counter(tokens[i] for i in np.flatnonzero(found < 0).tolist())
                counts.append((len(tokens) + 1, int(made[1]) + (trained > 0)))
                sums.append((made[0] + math.log10(trained + 1), *(made[2:] + end)))
                words.append(list(rare.keys()))
                times.append(list(rare.values()))
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(part_arrow.field(0).type)]
                    + [
                        pa.array(x, f.type)
                        for x, f in zip([*zip(*counts, strict=True), *zip(*sums, strict=True), words, times], list(part_arrow)[1:], strict=True)
                    ],
                    schema=part_arrow,
                )

    looked = docs.select(key.alias("row"), F.to_binary(text_of(text_col), F.lit("utf-8")).alias("t")).mapInArrow(look_up, part)
    looked = freeze(looked)
    rest = scored.where(step < cut)
    tf = F.col("each.times")
    rare = (
        looked.select("row", F.explode(F.arrays_zip("words", "times")).alias("each"))
        .join(rest, F.col("each.words") == F.col("word"))
        .select(
            "row", F.lit(0).alias("rows"), F.lit(0).alias("n_tokens"), F.when(F.col("c") > 0, tf).otherwise(F.lit(0)).alias("n_known"),
            (tf * F.log10(F.col("c") + 1)).alias("base"), *[(tf * F.col(f"s{g}")).alias(f"p{g}") for g in range(k)],
        )
    )
    whole = looked.select("row", F.lit(1).alias("rows"), "n_tokens", "n_known", "base", *[f"p{g}" for g in range(k)])
    names = [c for c in whole.columns if c != "row"]
    summed = whole.unionByName(rare).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    # Rows that repeat an id and text were summed together.
    n = F.col("rows")
    by_class = [F.col(f"p{g}") / n + math.log(p) for g, p in enumerate(fitted.prior) if p > 0]
    most = F.greatest(*by_class) if len(by_class) > 1 else by_class[0]
    tokens = F.floor(F.col("n_tokens") / n)
    return (
        summed.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
        .withColumn(id_col, F.col("row.id"))
        .select(
            F.col(f"`{id_col}`"),
            held_out(id_col).alias("held_out"),
            tokens.cast("long").alias("n_tokens"),
            F.floor(F.col("n_known") / n).cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") / n - tokens * math.log10(total + known + 1)).alias("base_score"),
            ((most + F.log(sum((F.exp(p - most) for p in by_class), F.lit(0.0)))) / _LN10).alias("score"),
        )
    )
