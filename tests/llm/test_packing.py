"""Packing: every id in one piece, sequences gapless, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taxaloom.llm import packing
from taxaloom.llm.queries import QUERIES, byte_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(byte_model())
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def check(pieces, documents, library, size=1024, full=True):
    """``documents``: (id, text) rows. Pieces rebuild each row's ids once and lie gapless in their sequences."""
    windows, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert p.length == len(ids) > 0
        windows[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append((p.start, ids, p.doc_tokens))
    for laid in windows.values():
        at = 0
        for offset, length in sorted(laid):
            assert offset == at
            at += length
        assert at <= size
    want = defaultdict(list)
    for i, text in documents:
        want[i].append(library(text) + [0])
    assert by_doc.keys() == want.keys()
    for i, rows in want.items():
        if len(rows) == 1:
            made = sorted(by_doc[i])
            assert [x for _, ids, _ in made for x in ids] == rows[0]
            assert {t for *_, t in made} == {len(rows[0])}
            starts = np.cumsum([0] + [len(ids) for _, ids, _ in made])
            assert [s for s, *_ in made] == starts[:-1].tolist()
        else:
            assert sorted(x for _, ids, _ in by_doc[i] for x in ids) == sorted(x for r in rows for x in r)
    if full:
        assert sum(sum(n for _, n in laid) < size for laid in windows.values()) <= 1


def test_pieces_of_the_documents(spark, docs, texts, library):
    pieces = packing.pack(docs.repartition(7), byte_model()).collect()
    check(pieces, texts.items(), library)


def test_odd_rows(odd, none, clashing, rows, library):
    documents = [(r[0], r[1]) for r in rows]
    check(packing.pack(odd, byte_model()).collect(), documents, library)
    check(packing.pack(clashing, byte_model()).collect(), documents, library)
    assert packing.pack(none, byte_model()).collect() == []


def test_many_partitions_are_merged_in_rounds(spark, library):
    """More partitions than one task merges, each with leftovers."""
    spread = random.Random(5)
    documents = [(i, " ".join("abcdefg"[spread.randrange(7)] for _ in range(spread.randrange(90)))) for i in range(400)]
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(packing.FAN_IN + 9)
    check(packing.pack(df, byte_model(), size=64, limit=3).collect(), documents, library, size=64)


@pytest.mark.parametrize("limit", [1, 8])
def test_without_cuts(spark, library, limit):
    documents = [(i, "word " * (i * 37 % 101)) for i in range(120)]
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    pieces = packing.pack(df, byte_model(), size=128, limit=limit, cut=False).collect()
    check(pieces, documents, library, size=128, full=False)
    assert len(pieces) == sum(-(-p.doc_tokens // 128) for p in pieces if not p.start)


def test_emptied_windows_leave_fullest_first():
    windows, fresh = packing.Windows(10, 2, cut=False), iter(range(9))
    left = [w for n in (6, 8, 3, 5) for w, _ in windows.add(("d", n), 0, b"\0\0\0\0" * n, fresh)]
    assert left == [0]
    assert {w: sum(len(i) for *_, i in p) // 4 for w, p in windows.held.items()} == {1: 8, 2: 5}


def test_ids_of_tricky_texts(library):
    """The ranks and the library part texts alike."""
    ids, spread = packing.Ids(byte_model()), random.Random(3)
    alphabet = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ᠎ ​ 　ab'sé1٣½☃日,.!-", "  ", "\n\n",
                "<|endoftext|>", "'s", "'ll", "hello", " world", "́", "\U0001f600", "\x00"]
    texts = ["".join(spread.choice(alphabet) for _ in range(spread.randrange(15))) for _ in range(3000)]
    for text in [*texts, " " * 1_000_000 + "x", "a" * 50_000]:
        assert np.frombuffer(ids.of(text), "<u4").tolist() == library(text)
    assert ids.ranks is not None


def test_query_columns(spark, texts, library):
    rows = QUERIES["op13_packing"](spark, SF).collect()
    for r in rows:
        ids = (library(texts[r.doc_id]) + [0])[r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(r.length for r in rows) == sum(tokens.values())
    assert len({r.sequence_id for r in rows}) == -(-sum(tokens.values()) // 1024)
