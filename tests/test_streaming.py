"""State kept by streams: any order of arrival and any repeated micro-batch ends in the same tables."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from taxaloom.session import staging_path
from taxaloom.streaming import ingest as S

VALUES = "sample_name string, feature string, value double"
GROUPS = "sample_name string, group string"


def land(spark, parts, schema, name):
    path = staging_path(spark, name)
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def twice(monkeypatch):
    """Every micro-batch is handled twice."""
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    once = DataStreamWriter.foreachBatch

    def again(self, work):
        def both(df, batch):
            work(df, batch)
            work(df, batch)

        return once(self, both)

    monkeypatch.setattr(DataStreamWriter, "foreachBatch", again)


def totals_of(spark, seed):
    spread = random.Random(seed)
    rows = [(f"s{i}", f"f{spread.randrange(9)}{j}", float(spread.randrange(5))) for i in range(12) for j in range(3)]
    rows.append(("stray", "f1", 9.0))
    meta = [(f"s{i}", "ab"[i % 2]) for i in range(12)]
    sums = defaultdict(float)
    for s, f, v in rows:
        if s != "stray":
            sums["ab"[int(s[1:]) % 2], f] += v / 6
    samples = sorted({r[0] for r in rows})
    spread.shuffle(samples)
    parts = [[r for r in rows if r[0] in samples[k : k + 5]] for k in range(0, len(samples), 5)]
    return parts, spark.createDataFrame(meta, GROUPS), sums


def check_totals(spark, target, sums):
    made = {(r.group, r.feature): r.value for r in S.group_means(spark, target).collect()}
    assert made == pytest.approx(dict(sums))
    for g in "ab":
        ranked = sorted(((-v, f) for (h, f), v in sums.items() if h == g))
        top = {r.place: (r.feature, r.value) for r in S.top_features(spark, target, 3).collect() if r.group == g}
        assert [top[k][0] for k in (1, 2, 3)] == [f for _, f in ranked[:3]]
        assert top[4] == ("Other", pytest.approx(-sum(v for v, _ in ranked[3:])))


@pytest.mark.parametrize("seed", [1, 2])
def test_totals_after_any_batches(spark, seed):
    parts, meta, sums = totals_of(spark, seed)
    target = staging_path(spark, "totals")
    path = land(spark, parts[:2], VALUES, "landing")
    S.keep_totals(S.stream_profiles(spark, path, spark.createDataFrame([], VALUES).schema, 1), meta, target)
    # A second call takes the new file only; a sample that comes again is not counted again.
    spark.createDataFrame(parts[2] + parts[0][:4], VALUES).coalesce(1).write.mode("append").parquet(path)
    S.keep_totals(S.stream_profiles(spark, path, spark.createDataFrame([], VALUES).schema, 1), meta, target)
    check_totals(spark, target, sums)


def test_totals_after_a_repeated_batch(spark, twice):
    parts, meta, sums = totals_of(spark, 3)
    target = staging_path(spark, "totals")
    path = land(spark, parts, VALUES, "landing")
    S.keep_totals(S.stream_profiles(spark, path, spark.createDataFrame([], VALUES).schema, 1), meta, target)
    check_totals(spark, target, sums)


LEFT = "id string, arrival timestamp, reads string"
RIGHT = "id string, arrival timestamp, total long"
START = datetime(2024, 1, 1)


def arrivals(seed):
    """Ids on both sides, on one, twice on one, and null ids; any order of arrival."""
    spread = random.Random(seed)
    at = lambda: START + timedelta(hours=spread.randrange(100))
    left = [(f"k{i}", at(), f"r{i}") for i in range(20) if i % 3] + [("k1", at(), "again"), (None, at(), "none"), (None, at(), "none")]
    right = [(f"k{i}", at(), i) for i in range(20) if i % 4] + [("k9", at(), 99), (None, at(), 7)]
    spread.shuffle(left)
    spread.shuffle(right)
    return left, right


def pair(spark, left, right, delay, size=6):
    paths = [land(spark, [rows[k : k + size] for k in range(0, len(rows), size)], schema, "side")
             for rows, schema in ((left, LEFT), (right, RIGHT))]
    a, b = (S.stream_profiles(spark, p, spark.createDataFrame([], s).schema, 1) for p, s in zip(paths, (LEFT, RIGHT), strict=True))
    target = staging_path(spark, "pairs")
    S.pair_arrivals(a, b, "id", "arrival", target, delay)
    return S.paired(spark, target).collect()


def check_pairs(made, left, right):
    """Every input row is in exactly one output row; no pair is left apart."""
    lefts = Counter((r.id, r.left.arrival, r.left.reads) for r in made if r.left)
    rights = Counter((r.id, r.right.arrival, r.right.total) for r in made if r.right)
    assert lefts == Counter(left) and rights == Counter(right)
    for r in made:
        assert (r.outcome == "paired") == bool(r.left and r.right)
        assert r.id is not None or r.outcome != "paired"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_row_is_lost(spark, seed):
    left, right = arrivals(seed)
    made = pair(spark, left, right, "1000 days")
    check_pairs(made, left, right)
    assert {r.outcome for r in made} == {"paired", "waiting"}
    both = Counter(min(a, b) for k in {f"k{i}" for i in range(20)} for a, b in [(sum(x[0] == k for x in left), sum(x[0] == k for x in right))])
    assert sum(r.outcome == "paired" for r in made) == sum(n * c for n, c in both.items())


@pytest.mark.parametrize("delay", ["1 hour", "20 hours"])
def test_late_rows_are_kept_apart(spark, delay, twice):
    left, right = arrivals(4)
    made = pair(spark, left, right, delay)
    check_pairs(made, left, right)
    newest = max(x[1] for x in left + right)
    hours = int(delay.split()[0])
    for r in made:
        if r.outcome == "waiting":
            assert r.at >= newest - timedelta(hours=hours)
        if r.outcome == "late":
            assert r.at < newest - timedelta(hours=hours)
    assert any(r.outcome == "late" for r in made)
