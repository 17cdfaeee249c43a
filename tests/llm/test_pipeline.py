"""Stages of the corpus pipeline, each against what its operator says of its own input."""

import re

import pytest

import corpus_pipeline
from taxaloom.llm import mixing, toxicity
from taxaloom.session import freeze

from .test_groups import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    made = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        made.append(freeze(stage(spark, made[-1], SF)))
    return made


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.schema == stages[0].schema


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.toxicity(stages[0], toxicity.train(stages[0], labels)).collect()
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in scores if r.score < 0.3}


def test_lines_go_and_documents_stay(stages):
    docs = stages[1].collect()
    pages, on = {}, {}
    for r in docs:
        pages[r.source] = pages.get(r.source, 0) + 1
        for line in {x.strip(" \t\r\x0b\x0c") for x in r.text.split("\n")}:
            on[r.source, line] = on.get((r.source, line), 0) + 1
    drop = {key for key, n in on.items() if n >= 5 and n > 0.05 * pages[key[0]] and key[1]}
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r\x0b\x0c")) not in drop) for r in docs}
    assert {r.doc_id: (r.text, r.n_chars) for r in stages[2].collect()} == {i: (t, len(t)) for i, t in want.items()}


def test_one_document_of_each_group_stays(stages):
    docs = stages[2].collect()
    groups = brute_components([r.doc_id for r in docs], [r.text for r in docs], 5, 80)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(i for i, _, least in groups if i == least)


def test_documents_are_taken_as_mixed(stages):
    want = {r.doc_id: r.copies for r in mixing.mix(stages[3]).collect() if r.copies}
    got = {}
    for r in stages[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == want


def test_ids_give_the_texts_back(spark, stages):
    assert stages[5].count() == stages[4].count() and stages[5].where("NOT round_trip").isEmpty()
    run = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.ids) for r in run.collect()) == sorted((r.doc_id, r.ids) for r in stages[5].collect())


def test_stages_take_odd_rows(spark, odd, none, clashing):
    for first in (odd, none, clashing):
        docs = first
        for name, stage in corpus_pipeline.STAGES:
            made = freeze(stage(spark, docs, SF))
            if name != "sentencepiece":
                assert made.columns == docs.columns
            docs = made
        assert docs.count() == 0 if first is none else docs.count() > 0


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1 for n in range(1, 11))
