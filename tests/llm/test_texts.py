"""Operators that take each text by itself: token counts, ids, toxicity."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from .conftest import same
from pyspark.sql import functions as F

from taxaloom.llm import bpe_count, toxicity, viterbi
from taxaloom.llm.pieces import chunks, load
from taxaloom.llm.queries import QUERIES, piece_model

MODEL = piece_model()
ODD = ["", " ", "  ", "\n", "a  b", " a", "a ", "a\n\nb", "x▁y", "<s>x</s> <unk> <0x41>", "日本\u0000☃ é́", "th" * 700, "\t\ta   b\r\n c", "🙂🙂 ok"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_are_the_library_s(library, texts):
    pieces = load(MODEL)
    memo = bpe_count._memo(MODEL)
    for text in [*ODD, *texts.values()]:
        assert sum(memo[c] for c in chunks(text)) == len(library.encode(text)), text[:50]
    assert bpe_count.merged_count("▁" + "th" * 700, pieces) == len(library.encode("th" * 700))


def test_count_query(spark, texts, library):
    rows = QUERIES["op8_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in texts.items()
    }


def test_counts_of_odd_rows(odd, none, clashing, rows, library):
    made = bpe_count.token_counts(odd, MODEL)
    assert sorted(map(str, ((r.doc_id, r.n_tokens) for r in made.collect()))) == sorted(
        map(str, ((i, len(library.encode(t or ""))) for i, t, *_ in rows))
    )
    same(made, bpe_count.token_counts(clashing, MODEL))
    assert bpe_count.token_counts(none, MODEL).collect() == []


@pytest.fixture(scope="module")
def unigram():
    """The library's own search over the same scores; the two vast ones are brought near, for its single precision."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        p.score = max(p.score, -40000.0)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_best_path_has_the_library_s_score(unigram, texts):
    pieces = load(MODEL)
    score = lambda ids: sum(unigram.get_score(i) for i in ids if not unigram.is_byte(i))
    words = sorted({w for t in texts.values() for w in t.split()})[::7]
    for w in words:
        assert score(list(viterbi.stream_ids(("▁" + w,), pieces))) == score(unigram.nbest_encode_as_ids(w, 1)[0]), w


def brute_score(text, pieces):
    best = [0.0] + [None] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(max(0, j - pieces.longest), j):
            s = pieces.score.get(text[i:j], pieces.worst - viterbi.UNKNOWN_PENALTY if j == i + 1 else None)
            if s is not None and best[i] is not None and (best[j] is None or best[i] + s > best[j]):
                best[j] = best[i] + s
    return best[-1]


def test_stream_doesn_t_depend_on_blocks():
    pieces = load(MODEL)
    rng = random.Random(5)
    missing = next(c for c in map(chr, range(0x1200, 0x3000)) if c not in pieces.score)
    for _ in range(40):
        text = "▁" + "".join(rng.choice(["the", "th", "er", "▁", "ing", "tion", "s", "☃", missing, "e", "re"]) for _ in range(300))
        whole = list(viterbi.stream_ids((text,), pieces))
        assert whole == list(viterbi.stream_ids(text, pieces))
        k = rng.randint(2, 90)
        assert whole == list(viterbi.stream_ids((text[i : i + k] for i in range(0, len(text), k)), pieces))
        unknown = text.count(missing)
        assert sum(i in pieces.byte_id for i in whole) == 3 * unknown
        known = sum(pieces.score[pieces.bytes_of[i].decode().replace(" ", "▁")] for i in whole if i not in pieces.byte_id)
        assert known + unknown * (pieces.worst - viterbi.UNKNOWN_PENALTY) == pytest.approx(brute_score(text, pieces))


def test_round_trip(odd, none, clashing, rows):
    made = viterbi.encode(odd, MODEL)
    assert made.where("NOT round_trip").isEmpty()
    back = viterbi.decode(made, MODEL)
    assert sorted(map(str, ((r.doc_id, r.text) for r in back.collect()))) == sorted(map(str, ((i, t or "") for i, t, *_ in rows)))
    same(made, viterbi.encode(clashing, MODEL))
    assert viterbi.encode(none, MODEL).collect() == []
    pieces, memo = load(MODEL), viterbi._memo(MODEL)
    for text in ODD:
        assert viterbi.text_of_ids(viterbi.ids_of(text, memo), pieces) == text.replace("▁", " ")


def test_pairs_of_terms_are_learnt():
    """Label 1 only where both words meet: no additive weights separate it."""
    rng = random.Random(1)
    texts = []
    for _ in range(600):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randint(0, 30)}" for _ in range(5)] + ["insult"] * a + ["group"] * b
        texts.append((" ".join(words).encode(), int(a and b)))
    machine = toxicity.fit([(sorted(toxicity.terms_of(t)), y) for t, y in texts])
    memo = {}
    wrong = sum((machine.score(t, memo) >= 0.5) != y for t, y in texts)
    assert wrong < 12
    v = machine.factor[[machine.place()[next(iter(toxicity.terms_of(w)))] for w in (b"insult", b"group")]]
    assert v[0] @ v[1] > 0


def test_terms_without_an_effect_of_their_own_are_learnt():
    """Label 1 where just one of both words is: either alone is on as many texts of both labels."""
    rng = random.Random(1)
    texts = []
    for _ in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randint(0, 30)}" for _ in range(5)] + ["insult"] * a + ["group"] * b
        texts.append((" ".join(words).encode(), int(a != b)))
    machine = toxicity.fit([(sorted(toxicity.terms_of(t)), y) for t, y in texts[:600]])
    memo = {}
    assert sum((machine.score(t, memo) >= 0.5) != y for t, y in texts[600:]) < 30


def test_few_labels_are_learnt_from(spark):
    """64 fitted rows, of which each insult is on four at most."""
    made = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.001").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = {r.doc_id: (r.predicted, r.toxic) for r in made.join(labels, "doc_id").collect()}
    assert rows[81] == (1, 1)
    assert sum(p == 1 and y == 0 for p, y in rows.values()) <= 1


def test_toxicity_holds_out(spark):
    made = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = made.where("held_out").join(labels, "doc_id").toPandas()
    assert made.count() == 1000 and made.where("score < 0 OR score > 1 OR (predicted = 1) <> (score >= 0.3)").isEmpty()
    insults = made.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id").where(
        F.lower("text").rlike(r"\b(idiot|moron|scum|loser|clown|stupid|worthless|pathetic|disgusting|trash)\b")
    )
    assert insults.where("predicted = 0").count() <= 0.1 * insults.count()
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.02 * len(held)


def test_toxicity_of_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (7, None), (9, 0), (9, 1)], "doc_id long, toxic int")
    machine = toxicity.train(odd, labels)
    made = toxicity.toxicity(odd, machine)
    assert made.count() == 13 and made.where("score IS NULL").isEmpty()
    same(made, toxicity.toxicity(clashing, machine))
    same(toxicity.without_toxic(clashing, machine, threshold=2.0), clashing)
    assert toxicity.without_toxic(odd, machine, threshold=0.0).isEmpty()
    assert toxicity.toxicity(none, toxicity.train(none, labels.limit(0))).collect() == []
    empty = toxicity.train(none, labels.limit(0))
    # Nothing is known of label 1 then, and no document goes.
    assert toxicity.toxicity(odd, empty).agg(F.max("score")).first()[0] < 1e-9
    same(toxicity.without_toxic(odd, empty), odd)


def test_labels_of_held_out_rows_don_t_count(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert a.bias == b.bias and (a.weight == b.weight).all()


def test_scores_are_sums_over_all_pairs_of_terms():
    """sigmoid(bias + weights + products of factors, pair by pair), as the machine is defined."""
    rng = np.random.default_rng(5)
    texts = [b"", b"one", b"One two, two THREE", b"four five six one", b"unseen words only", " \u00e9t\u00e9 one".encode()]
    terms = sorted({t for x in texts[:4] for t in toxicity.terms_of(x)})
    machine = toxicity.Machine(-0.7, np.array(terms), rng.normal(size=len(terms)), rng.normal(size=(len(terms), 4)))
    for text in texts:
        at = [terms.index(t) for t in sorted(toxicity.terms_of(text)) if t in terms]
        z = -0.7 + sum(machine.weight[i] for i in at)
        z += sum(machine.factor[i] @ machine.factor[j] for k, i in enumerate(at) for j in at[k + 1 :])
        assert machine.score(text, {}) == pytest.approx(1 / (1 + np.exp(-z)))


def test_a_second_fit_gives_the_same_machine(docs, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a, b = (toxicity.train(d, labels) for d in (docs, docs.repartition(5)))
    assert a.bias == b.bias and (a.terms == b.terms).all() and (a.weight == b.weight).all() and (a.factor == b.factor).all()
