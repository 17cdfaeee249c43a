"""Language-model scores and search against brute force."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import lattice, search
from taxaloom.llm.common import words_of
from taxaloom.llm.pieces import load
from taxaloom.llm.queries import QUERIES, piece_model

from .conftest import same

MODEL = piece_model()
SF = "/root/testdata/sf0.001"


def segmentations(word, place):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in place:
            for rest in segmentations(word[n:], place):
                yield [place[word[:n]], *rest]


@pytest.fixture(scope="module")
def grid():
    made = lattice.Lattice(load(MODEL))
    rng = np.random.default_rng(1)
    return made, made.logs(rng.random((2, made.size)))


def test_forward_sums_all_segmentations(grid):
    made, logs = grid
    words = ["▁the", "▁thention", "▁a", "▁erering", "▁straße", "▁ouou,", "▁"]
    want = [[math.log(sum(math.exp(sum(own[k] for k in s)) for s in segmentations(w, made.place))) for own in logs] for w in words]
    assert made.scores(words, logs) == pytest.approx(np.array(want))
    for w, row in zip(words, want, strict=True):
        assert made.forward(w, logs[0])[-1] == pytest.approx(row[0])


def test_expected_numbers_of_pieces(grid):
    made, logs = grid
    words, classes = ["▁the", "▁thention", "▁erering", "▁the"], np.array([0, 1, 0, 1])
    want = np.zeros(logs.shape)
    for w, c in zip(words, classes, strict=True):
        paths = list(segmentations(w, made.place))
        chance = np.array([math.exp(sum(logs[c][k] for k in s)) for s in paths])
        for s, x in zip(paths, chance / chance.sum(), strict=True):
            for k in s:
                want[c, k] += x
    out = np.zeros(logs.shape)
    made.expected(words, classes, logs, out)
    assert out == pytest.approx(want)
    single = np.zeros(logs.shape)
    for w, c in zip(words, classes, strict=True):
        made._expected_one(w, logs[c], single[c])
    assert single == pytest.approx(want)


def test_words_of_any_length_and_character(grid):
    made, logs = grid
    odd = ["▁" + "th" * 3000, "▁\U0010fffd", "▁" + "x" * 23, "▁" + "x" * 24]
    scores = made.scores(odd, logs)
    assert np.isfinite(scores).all() and (scores < 0).all()
    for w, s in zip(odd, scores, strict=True):
        assert s[0] == pytest.approx(made.forward(w, logs[0])[-1])


def test_a_class_s_words_add_up_to_less_than_one():
    """Known words, and all strings of one to three of the pieces, in a tiny vocabulary."""

    class Tiny:
        score = {"▁": -1.0, "a": -2.0, "b": -3.0, "▁a": -4.0, "ab": -5.0}

    made = lattice.Lattice(Tiny)
    model = object.__new__(lattice._Model)
    model.n, model.v = np.array([10.0, 6.0, 16.0]), np.array([3.0, 2.0, 4.0])
    model.discount = np.array([0.4, 0.5, 0.3])
    model.prior = np.array([0.6, 0.4])
    model.unseen = model.discount * model.v / model.n
    counts = {"▁a": [6.0, 0.0], "▁ab": [3.0, 1.0], "▁bb": [0.0, 5.0], "": [1.0, 0.0]}
    logs = made.logs(np.repeat(made.start[None], 2, 0))
    words = ["▁" + "".join(w) for n in range(9) for w in itertools.product("ab", repeat=n)]
    chance = model.chances(np.array([counts.get(w, [0.0, 0.0]) for w in words]), made.scores(words, logs))
    assert (np.exp(chance).sum(0) <= 1).all()


def base_scores(rows):
    tokens = [[*words_of((t or "").encode()), None] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = collections.Counter(w for ws, o in zip(tokens, out, strict=True) if not o for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, o, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (i, _), o, ws in zip(rows, out, tokens, strict=True)
    ]


def plain_rows(made):
    return sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in made.collect())


@pytest.mark.parametrize("frequent", [250_000, 40])
def test_base_scores(spark, texts, monkeypatch, frequent):
    """Also where nearly all words are joined."""
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    made = QUERIES["op5_lm_scores"](spark, SF).cache()
    assert plain_rows(made) == sorted(map(str, base_scores(list(texts.items()))))
    assert made.where("NOT score < 0").isEmpty()


def test_rare_and_frequent_words_score_alike(spark, docs, monkeypatch):
    a = {r.doc_id: r.score for r in lattice.text_scores(docs, MODEL).collect()}
    monkeypatch.setattr(lattice, "FREQUENT", 40)
    b = {r.doc_id: r.score for r in lattice.text_scores(docs, MODEL).collect()}
    assert a == pytest.approx(b)


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    made = lattice.text_scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), MODEL)
    base, score = made.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_scores_of_odd_rows(odd, none, clashing, rows):
    made = lattice.text_scores(odd, MODEL)
    assert plain_rows(made) == sorted(map(str, base_scores([(r[0], r[1]) for r in rows])))
    first = {str((r.doc_id, r.n_tokens)): r.score for r in made.collect()}
    again = {str((r.doc_id, r.n_tokens)): r.score for r in lattice.text_scores(clashing, MODEL).collect()}
    assert first == pytest.approx(again)
    assert lattice.text_scores(none, MODEL).collect() == []
    assert lattice.text_scores(odd.drop("lang"), MODEL).count() == len(rows)
    held = odd.where(lattice.held_out())
    assert lattice.text_scores(held, MODEL).where("train_tokens > 0 OR n_known > 0 OR score IS NULL").isEmpty()


def brute_search(rows, queries, k):
    docs = [collections.Counter(words_of((t or "").encode())) for _, t in rows]
    length = [sum(d.values()) for d in docs]
    mean = sum(length) / len(rows)
    df = collections.Counter(w for d in docs for w in d)
    idf = {w: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    out = []
    for q, text in queries:
        words = collections.Counter(words_of((text or "").encode()))
        scored = []
        for (i, _), d, n in zip(rows, docs, length, strict=True):
            s = sum(t * idf[w] * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w, t in words.items() if w in d)
            if s > 0:
                scored.append((-round(s, 6), i is None, i or 0))
        out += [(q, r, None if null else i, round(-s, 4)) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("shard, dense, queries", [(8192, 1 / 32, 2048), (16, 0.5, 3), (50, 0.0, 2048)])
def test_search_is_exact(spark, docs, texts, monkeypatch, shard, dense, queries):
    """For any size of shards and blocks of queries, and any division of the lists."""
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "DENSE", dense)
    monkeypatch.setattr(search, "QUERIES", queries)
    rows = list(texts.items())
    found = search.search(docs, docs.where("doc_id % 20 = 0"), k=7).collect()
    made = sorted((r.query_id, r.rank, r.doc_id, round(r.score, 4)) for r in found)
    want = sorted(brute_search(rows, [(i, t) for i, t in rows if i % 20 == 0], 7))
    assert [x[:3] for x in made] == [x[:3] for x in want]
    assert [x[3] for x in made] == pytest.approx([x[3] for x in want], abs=2e-4)


def test_search_of_odd_rows(spark, odd, none, clashing, rows):
    made = search.search(odd, odd, k=20)
    want = brute_search([(r[0], r[1]) for r in rows], [(r[0], r[1]) for r in rows], 20)
    assert sorted(str((r.query_id, r.doc_id, round(r.score, 3))) for r in made.collect()) == sorted(
        str((q, i, round(s, 3))) for q, _, i, s in want
    )
    same(made, search.search(clashing, clashing, k=20))
    assert search.search(none, odd).collect() == [] and search.search(odd, none).collect() == []
    assert search.search(odd, odd.where("text IS NULL")).collect() == []


def test_random_texts_with_ties(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 12)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = search.search(docs, docs.where("doc_id < 40"), k=5).collect()
    want = brute_search(rows, rows[:40], 5)
    assert sorted((r.query_id, r.rank, r.doc_id) for r in made) == sorted(x[:3] for x in want)


def test_whole_scores_by_enumeration(spark, monkeypatch):
    """Texts' log10 probabilities: classes, discounts, segmentations one by one and the end, from the definition."""
    monkeypatch.setattr(lattice, "ROUNDS", 0)
    rng = random.Random(8)
    words = ["the", "then", "a", "in", "ein", "der", "theta", "rein"]
    rows = [(i, " ".join(rng.choice(words[:5] if i % 2 else words[2:]) for _ in range(rng.randrange(7))), "en" if i % 2 else "de") for i in range(30)]
    rows += [(31, None, "en"), (35, "THE the unseen Der", None)]
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows}
    made = lattice.Lattice(load(MODEL))
    logs = made.logs(made.start * 1e6)
    tokens = {i: [w.decode() for w in words_of((t or "").encode())] for i, t, _ in rows}
    sums = collections.Counter(c for i, _, c in rows if not out[i] and c)
    classes = [c for c, _ in sorted(sums.items(), key=lambda x: (-x[1], x[0]))]
    classes += [None] if any(c is None and not out[i] for i, _, c in rows) else []
    counts, ends = [], []
    for c in classes:
        own = [i for i, _, d in rows if d == c and not out[i]]
        counts.append(collections.Counter(w for i in own for w in tokens[i]))
        ends.append(len(own))
    counts.append(sum(counts, collections.Counter()))
    ends.append(sum(ends))
    n = [sum(c.values()) + e for c, e in zip(counts, ends, strict=True)]
    v = [len(c) + (e > 0) for c, e in zip(counts, ends, strict=True)]
    once, twice = ([sum(x == k for x in c.values()) + (e == k) for c, e in zip(counts, ends, strict=True)] for k in (1, 2))
    off = [a / (a + 2 * b) if a * b else 0.5 for a, b in zip(once, twice, strict=True)]
    unseen = [d * x / m for d, x, m in zip(off, v, n, strict=True)]

    def chance(g, count, every, spelt):
        whole = max(every - off[-1], 0) / n[-1] + unseen[-1] * spelt
        return max(count - off[g], 0) / n[g] + unseen[g] * (lattice.SHARED * whole + (1 - lattice.SHARED) * spelt)

    def word(g, w):
        spelt = sum(math.exp(sum(logs[k] for k in s)) for s in segmentations("▁" + w, made.place))
        return chance(g, counts[g][w], counts[-1][w], spelt)

    want = {}
    for i, *_ in rows:
        by_class = [
            e / ends[-1] * math.prod([word(g, w) for w in tokens[i]]) * chance(g, e, ends[-1], math.exp(-50))
            for g, e in enumerate(ends[:-1])
        ]
        want[i] = math.log10(sum(by_class))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert {r.doc_id: r.score for r in lattice.text_scores(df, MODEL).collect()} == pytest.approx(want)
    apart = {r.doc_id: r.score for r in lattice.text_scores(df, MODEL, apart=True).collect()}
    assert apart == pytest.approx(want)


def test_search_finds_a_bounded_number_of_rows_per_query(spark, monkeypatch):
    """However many shards there are, what is found before the merge grows with the queries and the tasks alone."""
    from taxaloom.session import freeze

    texts = [" ".join(f"w{(i * j) % 23}" for j in range(1, 9)) + " all" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    written = []
    monkeypatch.setattr(search, "freeze", lambda df: written.append(made := freeze(df)) or made)
    few, many = [], []
    for shard, found in ((400, few), (4, many)):
        monkeypatch.setattr(search, "SHARD_DOCS", shard)
        found += sorted(map(tuple, search.search(docs, docs.where("doc_id % 50 = 0"), k=10).collect()))
    assert few == many and len(many) == 80
    rows = max(df.count() for df in written if "query_id" in df.columns)
    assert rows <= 8 * 10 * spark.sparkContext.defaultParallelism
