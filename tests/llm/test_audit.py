"""The filter audit: any order of arrival gives the same counters."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from taxaloom.llm import audit
from taxaloom.session import staging_path

from .conftest import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def plain_masks(rows):
    """(part, mask) per row, by the definition."""
    made = []
    for i, text, lang, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        mask = len(words) < 100
        mask += 2 * (100 * len(set(words)) < 80 * len(words))
        mask += 4 * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text))
        mask += 8 * any(c in "#$%&*|" for c in text)
        mask += 16 * (i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows))
        made.append((lang or "", int(mask)))
    return made


def plain_report(rows, labels):
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    docs = [(p, m, r[0]) for (p, m), r in zip(plain_masks(rows), rows, strict=True)]
    made = {}
    for part in {p for p, *_ in docs}:
        mine = [(m, i) for p, m, i in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, before = mine, 0
            for step, letter in enumerate(order, 1):
                bit = audit.FILTERS[letter]
                gone = [(m, i) for m, i in left if m & bit]
                left = [(m, i) for m, i in left if not m & bit]
                shapley[letter] += len(gone)
                made[part, "".join(order), step] = [
                    len(left), len(gone), sum(bool(m & bit and m & before) for m, _ in mine), sum(m == bit for m, _ in mine),
                    sum(i in good for _, i in gone), sum(i in toxic for _, i in gone), letter,
                ]
                before |= bit
        for key, value in made.items():
            if key[0] == part:
                value[-1] = shapley[value[-1]]
    return {k: tuple(v) for k, v in made.items()}


def report(spark, path, labels, **how):
    made = audit.interactions(audit.mask_counts(spark, path, spark.createDataFrame(labels, LABELS), **how)).collect()
    assert len(made) == len({(r.part, r.filter_order, r.step) for r in made})
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in made}


def write_files(spark, rows, name, schema=SCHEMA):
    """One file per row list, so that they arrive in different micro-batches."""
    path = staging_path(spark, name)
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return path


#: Repeated and null labels, and labels of documents that aren't there.
MARKS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (9, None, 1), (9, 1, None), (5, 0, 0), (99, 1, 1), (None, 1, 1), (7, 1, 0)]


@pytest.mark.parametrize("reverse", [False, True])
def test_smaller_ids_take_back_what_was_counted(spark, rows, reverse):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=reverse)
    path = write_files(spark, [order[k : k + 3] for k in range(0, len(order), 3)], "arrivals")
    assert report(spark, path, MARKS, batches=5) == plain_report(rows, MARKS)


def test_random_texts(spark):
    spread = random.Random(11)
    texts = ["", None, "A B C", "a b", "$ " * 120, *(" ".join(f"w{spread.randrange(n)}" for _ in range(150)) for n in (40, 400, 9000))]
    rows = [(spread.randrange(90), spread.choice(texts), spread.choice(["de", "en", None, ""]), None, None) for _ in range(300)]
    rows.append((None, "a b", "en", None, None))
    labels = [(i, spread.randrange(2), spread.randrange(2)) for i in range(0, 90, 2)]
    path = write_files(spark, [rows[k : k + 60] for k in range(0, len(rows), 60)], "arrivals")
    assert report(spark, path, labels, batches=3) == plain_report(rows, labels)


def test_empty_table_and_other_columns(spark, none, clashing, rows):
    path = staging_path(spark, "empty")
    none.write.parquet(path)
    assert report(spark, path, MARKS) == {}
    path = staging_path(spark, "clashing")
    clashing.withColumn("mask", F.lit(1)).withColumn("part", F.lit("x")).withColumn("digest", F.lit(b"1")).write.parquet(path)
    assert report(spark, path, MARKS) == plain_report(rows, MARKS)


@pytest.mark.parametrize("seed", range(3))
def test_marks_add_up(spark, seed):
    """Any split of the rows into micro-batches ends in the same counters."""
    spread = random.Random(seed)
    rows = []
    for _ in range(60):
        i = spread.choice([None, *range(8)])
        rows.append((spread.choice([b"s", b"t"]), spread.choice("xy"), 1, spread.randrange(2), 0, 1, i, 1))
    least = {d: min(r[6] for r in rows if r[0] == d and r[6] is not None) for d in (b"s", b"t")}
    want = {}
    for digest, part, mask, good, toxic, n, i, _ in rows:
        key = (part, mask | (audit.REPEATED if i is not None and i > least[digest] else 0), good, toxic)
        want[key] = want.get(key, 0) + n
    sums, state = {}, spark.createDataFrame([], audit._STATE)
    while rows:
        k = spread.randint(1, len(rows))
        marks = audit.marked(spark.createDataFrame(rows[:k], audit._FOLDED), state)
        marks = spark.createDataFrame(marks.collect(), audit._STATE)
        rows, state = rows[k:], state.unionByName(marks)
        for r in audit.deltas(marks).collect():
            key = (r.part, r.mask, r.good, r.toxic)
            sums[key] = sums.get(key, 0) + r.n
    assert {k: n for k, n in sums.items() if n} == want


def test_a_repeated_micro_batch_replaces_its_own(spark, rows, monkeypatch):
    """Counters and state are the same when a micro-batch is handled twice."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    path = write_files(spark, [order[k : k + 4] for k in range(0, len(order), 4)], "arrivals")
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    once = DataStreamWriter.foreachBatch

    def twice(self, work):
        return once(self, lambda df, batch: (work(df, batch), work(df, batch)) and None)

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", twice)
    assert report(spark, path, MARKS, batches=4) == plain_report(rows, MARKS)
