"""Operators that compare documents: exact and near duplicates, lines, archive, mixing."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaloom.llm import archive, chosen_path, components, grace, lines, mixing, shingles
from taxaloom.llm.queries import ORACLE, QUERIES
from taxaloom.session import staging_path

from .conftest import SCHEMA, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(v):
    return f"{v:.3f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    rel = duck.sql(ORACLE[name])
    names = sorted(rel.columns)
    assert sorted(df.columns) == names
    at = [rel.columns.index(c) for c in names]
    rows = sorted(tuple(plain(r[c]) for c in names) for r in df.collect())
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


# --- exact duplicates


def test_exact_dedup_of_odd_rows(odd, none, clashing, rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = []
    for i, t, *_ in rows:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        keep = min(x for x in groups[t] if x is not None)
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    made = grace.exact_dedup(odd)
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, want))
    same(made, grace.exact_dedup(clashing))
    assert grace.exact_dedup(none).collect() == []


def test_small_tables_are_ended_between_hashes(odd, monkeypatch):
    """Any bound on a table gives the same groups."""
    want = grace.exact_dedup(odd)
    rows = sorted(map(str, want.collect()))
    monkeypatch.setattr(grace, "TABLE_BYTES", 1)
    assert sorted(map(str, grace.exact_dedup(odd).collect())) == rows


def test_equal_hashes_are_told_apart():
    table = grace.Table()
    for n in range(3000):
        table.add(7, b"%d" % (n % 1500), n, 1)
    assert len(table.texts) == 1500 and set(table.rows) == {2} and table.least == list(range(1500))


# --- components and shingles


def test_components_of_a_long_chain_and_a_star(spark):
    rng = random.Random(3)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order, order[1:], strict=False)) + [(1000, i) for i in range(1001, 1100)] + [(5000, 5001), (None, 5002), (5003, 5003)]
    made = components.components(spark.createDataFrame(links, "a long, b long"))
    want = {i: 0 for i in range(1, 300)} | {i: 1000 for i in range(1001, 1100)} | {5001: 5000}
    assert {r.node: r.label for r in made.collect()} == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def word_sets(texts, k):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def test_shingle_hashes_tell_the_sets(texts):
    sample = [*texts.values(), "", " ", "One", "one two", "one\x0btwo", "ÄÖ äö", "a " * 50, "\x1c x\x85y"]
    for k in (1, 4, 5):
        made, want = shingles.sets_of([t.encode() for t in sample], k), word_sets(sample, k)
        assert [len(x) for x in made] == [len(x) for x in want]
        for i in range(0, len(sample), 3):
            for j in range(0, len(sample), 5):
                assert len(np.intersect1d(made[i], made[j])) == len(want[i] & want[j])


def brute_components(ids, texts, k, percent):
    sets = word_sets(texts, k)
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(i)
    out = [None] * len(ids)
    for members in groups.values():
        known = [ids[m] for m in members if ids[m] is not None]
        for m in members:
            out[m] = (ids[m], len(sets[m]), min(known) if known else None)
    return out


def near_rows(made):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in made.collect())


def test_near_duplicates_are_those_of_all_pairs(spark):
    made = QUERIES["op1_near_duplicates"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert near_rows(made) == sorted(map(str, brute_components([r.doc_id for r in docs], [r.text for r in docs], 4, 80)))
    assert made.where("kept <> (doc_id = component_id)").isEmpty()


def test_near_duplicates_of_odd_rows(odd, none, clashing, rows):
    made = chosen_path.near_duplicates(odd, words=4)
    assert near_rows(made) == sorted(map(str, brute_components([r[0] for r in rows], [r[1] for r in rows], 4, 80)))
    same(made, chosen_path.near_duplicates(clashing, words=4))
    assert chosen_path.near_duplicates(none).collect() == []


def planted(seed=11):
    """A large group of near copies, chains at the threshold, a passage that all share, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 4000)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(150):  # near copies of one text, few of them of each other at 0.95
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = word()
        texts.append(t)
    chain = [word() for _ in range(100)]
    for _ in range(40):  # each like the one before
        chain = list(chain)
        chain[rng.randrange(len(chain))] = word()
        texts.append(chain)
    for _ in range(150):
        texts.append([word() for _ in range(rng.randint(20, 200))] + passage)
    for _ in range(100):
        texts.append([word() for _ in range(rng.randint(1, 8))])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("small", [2, 32])
def test_planted_groups(spark, monkeypatch, small):
    """Also with leaves so small that the recursion goes deep."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    texts = planted()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = chosen_path.near_duplicates(docs, words=4)
    assert near_rows(made) == sorted(map(str, brute_components(list(range(len(texts))), texts, 4, 80)))


def test_nodes_that_stay_large_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "SMALL", 2)
    monkeypatch.setattr(chosen_path, "DEPTH", 1)
    texts = planted(5)[150:]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    made = chosen_path.near_duplicates(docs, words=4)
    assert near_rows(made) == sorted(map(str, brute_components(list(range(len(texts))), texts, 4, 80)))


def test_one_row_of_each_group_stays(odd, clashing, none):
    left = chosen_path.without_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, [1, 4, 5, 6, 7, 10, -11]))
    assert chosen_path.without_near_duplicates(clashing).columns == clashing.columns
    assert chosen_path.without_near_duplicates(none).collect() == []


# --- lines


def test_lines_by_host(spark):
    line = "menu of the site"
    rows = [(i, f"{line}\nbody {i}\n\n{line} \nend", "en", "big", 1) for i in range(20)]
    rows += [(100 + i, f"{line}\nbody {i}", "en", "small", 1) for i in range(4)]
    rows += [(200 + i, f"{line if i < 6 else i}\nbody {i}", "en", None, 1) for i in range(200)]
    made = {r.doc_id: (r.text, r.n, r.d) for r in lines.line_dedup(spark.createDataFrame(rows, SCHEMA), n_lines="n", n_dropped="d").collect()}
    assert made[3] == ("body 3\n", 5, 3)  # "end" too is on all pages
    assert made[101] == (f"{line}\nbody 1", 2, 0)  # too few pages
    assert made[200] == (f"{line}\nbody 0", 2, 0)  # 3 % of the pages without a host
    only = lines.line_dedup(spark.createDataFrame([(i, line, "en", "h", 1) for i in range(9)], SCHEMA))
    assert only.count() == 9 and only.select("text").distinct().collect()[0].text == ""


def test_lines_of_odd_rows(odd, none, clashing, rows):
    made = lines.line_dedup(odd)
    assert made.columns == odd.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in made.collect()))) == sorted(map(str, ((i, t or "") for i, t, *_ in rows)))
    assert lines.line_dedup(clashing).columns == clashing.columns
    assert lines.line_dedup(none, n_lines="a", n_dropped="b").collect() == []


# --- archive


def test_archive_of_odd_rows(spark):
    big, other = "x" * 1000, "é" * 500
    pages = [
        (1, "http://a/1", big), (2, "http://a/\r\nX-Evil: 1", big), (2, "http://a/2", big), (None, None, big), (3, "u", "x" * 999),
        (4, "u", "x" * 999), (5, None, None), (6, "", ""), (7, "u", other), (8, "u", other), (None, "u", "y" * 1500), (9, "u", "\r\n\r\nWARC/1.1\r\n"),
    ]
    path = staging_path(spark, "test")
    archive.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 6
    records = archive.read_records(spark, path)
    made = archive.record_facts(records)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        same_ = [p for p, _, x in pages if x == h and p is not None]
        target = max(same_) if len(raw) >= 1000 and same_ and max(same_) != i else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if target else "response", target))
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, want))
    names, responses = set(), {}
    found = [bytes(r.record).partition(b"\r\n\r\n") for r in records.collect()]
    for head, _, rest in found:
        lines = head.split(b"\r\n")
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert lines[0] == b"WARC/1.1" and b"X-Evil" not in fields and len(fields) == len(lines) - 1
        assert re.fullmatch(rb"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields[b"WARC-Date"])
        names.add(fields[b"WARC-Record-ID"])
        body = rest.removesuffix(b"\r\n\r\n")
        assert len(body) == int(fields[b"Content-Length"]) == len(rest) - 4
        if fields[b"WARC-Type"] == b"response":
            responses[fields[b"WARC-Record-ID"]] = body
    assert len(names) == len(pages)
    assert sorted(responses.values()) == sorted((h or "").encode() for (_, _, h), w in zip(pages, want, strict=True) if w[3] == "response")
    for head, _, _ in found:
        if b"WARC-Type: revisit" in head:
            refers = re.search(rb"WARC-Refers-To: (\S+)", head)[1]
            assert hashlib.sha1(responses[refers]).hexdigest().encode() in head
    empty = staging_path(spark, "test")
    archive.write_archive(spark.createDataFrame([], "page_id long, url string, html string, header string, sha256 int"), empty)
    assert archive.record_facts(archive.read_records(spark, empty)).collect() == []


def test_a_changed_payload_is_found(spark):
    path = staging_path(spark, "test")
    archive.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), path)
    changed = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.to_binary(F.lit("abd"), F.lit("utf-8")))
    changed.write.parquet(f"{path}/new/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/new/records")
    with pytest.raises(Exception, match="doesn't match its digest"):
        archive.record_facts(archive.read_records(spark, f"{path}/new")).collect()


def test_broken_records_are_found(spark):
    head = b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:1:a:1>\r\n%sContent-Length: %d\r\n\r\n"
    digest = b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"abc").hexdigest().encode() + b"\r\n"
    sound = head % (b"response", digest, 3) + b"abc\r\n\r\n"
    facts = lambda *rows: archive.record_facts(spark.createDataFrame([(bytearray(r),) for r in rows], "record binary")).collect()
    assert facts(sound)[0].payload_bytes == 3
    for bad in (sound[:-1], sound.replace(b"abc", b"abcd"), sound.replace(b"\r\n\r\n", b"\r\n"), b"", sound.replace(b"Length: 3", b"Length: x")):
        with pytest.raises(Exception, match="no WARC record"):
            facts(bad)
    with pytest.raises(Exception, match="match its payload"):
        facts(sound.replace(b"abc", b"abd"))
    lost = head % (b"revisit", b"WARC-Refers-To: <urn:page:9:a:1>\r\n" + digest, 0) + b"\r\n\r\n"
    with pytest.raises(Exception, match="isn't there"):
        facts(sound, lost)
    there = lost.replace(b"page:9", b"page:1")
    assert sorted((r.record_type, r.payload_bytes, r.refers_to) for r in facts(sound, there)) == [("response", 3, None), ("revisit", 3, 1)]


# --- mixing


def level_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * unit > most * sizes[s]}
        if not full:
            return target | {s: w[s] * unit for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check_mix(rows):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 2
    want = level_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    return {s: (taken[s], want[s], largest[s]) for s in sizes}


def test_mixing_meets_the_targets(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect()
    for taken, target, _ in check_mix(rows).values():
        assert abs(taken - target) <= 0.002 * target
    again = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("shares", [(0.1,), (0.3,), (0.2, 0.05), (0.6,)])
def test_mixing_with_outsized_documents(spark, shares):
    """Documents of 5 to 60 % of their source's words."""
    rng = random.Random(8)
    rows = []
    for source in "abcd":
        sizes = [rng.randint(20, 60) for _ in range(1000)]
        words = sum(sizes) / (1 - sum(shares))
        rows += [(len(rows) + i, "w " * n, "en", source, 0) for i, n in enumerate([*sizes, *(int(words * x) for x in shares)])]
    docs = spark.createDataFrame(rows, SCHEMA)
    made = mixing.mix(docs, weights=(1,)).collect()
    assert len(made) == len(rows) and {r.copies for r in made} <= {0, 1, 2}
    taken = {}
    for r in made:
        taken[r.source, r.target] = taken.get((r.source, r.target), 0) + r.size * r.copies
    assert len(taken) == 4
    for (_, target), n in taken.items():
        assert abs(n - target) <= 0.002 * target


def test_outsized_draws_keep_expectations_and_the_target():
    takings = np.zeros(2)
    for seed in range(4000):
        made, left = mixing.draw_outsized([200.0, 100.0], 1000.0, 1400.0, 2.0, random.Random(seed))
        assert np.dot(made, [200, 100]) + left * 700 == pytest.approx(1400) and 0 <= left <= 2
        takings += made
    assert np.abs(takings / 4000 - 1.4).max() < 0.04
    assert mixing.draw_outsized([900.0], 1000.0, 1900.0, 2.0, random.Random(1)) == ([2], 1.0)
    assert mixing.draw_outsized([10.0], 10.0, 20.0, 2.0, random.Random(1)) == ([2], 0.0)


def test_flights_of_many_groups_keep_the_totals(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 40, 200]), "en", rng.choice("aaaaab"), 0) for i in range(3000)]
    want = mixing.mix(spark.createDataFrame(rows, SCHEMA)).count()
    monkeypatch.setattr(mixing, "GROUP", 60)
    made = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(made) == want == 3000
    for taken, target, largest in check_mix(made).values():
        assert abs(taken - target) <= largest


def test_flight_keeps_totals_and_expectations():
    sizes = [float(x) for x in (5, 9, 1, 30, 7, 7, 2, 11, 4, 4)]
    p = [0.3] * len(sizes)
    total = np.zeros(len(sizes))
    for seed in range(4000):
        out = mixing.flight(p, sizes, random.Random(seed))
        assert sum(0 < x < 1 for x in out) <= 2
        assert sum(out) == pytest.approx(sum(p)) and np.dot(out, sizes) == pytest.approx(np.dot(p, sizes))
        total += out
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_mixing_of_odd_rows(spark, odd, none, clashing, rows):
    made = mixing.mix(odd).collect()
    assert len(made) == len(rows)
    check_mix(made)
    same(mixing.mix(odd), mixing.mix(clashing))
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []
    out = mixing.mixed_documents(clashing)
    assert out.columns == clashing.columns
    taken = {}
    for r in made:
        taken[str((r.doc_id, r.source, r.size))] = taken.get(str((r.doc_id, r.source, r.size)), 0) + r.copies
    got = {}
    for r in out.collect():
        key = str((r.doc_id, r.source, len(WORD.findall(r.text or ""))))
        got[key] = got.get(key, 0) + 1
    assert got == {k: v for k, v in taken.items() if v}


INTERNAL = ("__host", "__common", "__kept", "__key", "__id", "__source", "__size", "__sum", "__n", "__words", "__place", "__copy", "__KEPT")


def test_stages_leave_columns_with_internal_names_alone(spark, odd, rows):
    named = odd.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in INTERNAL if c != "__KEPT"])
    for stage in (lines.line_dedup, chosen_path.without_near_duplicates, mixing.mixed_documents):
        made = stage(named)
        assert made.columns == named.columns
        got = made.collect()
        assert all(r[c] == c + ("-" if r.doc_id is None else str(r.doc_id)) for r in got for c in made.columns[5:])
        same(made.select(*odd.columns), stage(odd))


def test_units_that_agree_but_for_their_text_are_drawn_alike(spark):
    """Other partitionings and orders take the same texts."""
    texts = [f"word{i} and more" for i in range(40)] + ["a b c"] * 3
    df = spark.createDataFrame([(1, t, "s") for t in texts] + [(2, "x y z", "t")], "doc_id long, text string, source string")
    takes = [
        sorted(r.text for r in mixing.mixed_documents(d, weights=(1, 3), share=0.5).collect())
        for d in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("text")), df.repartition(3, "text"))
    ]
    assert takes[0] and all(t == takes[0] for t in takes)
