"""Files joined as bytes, and tables bucketed by sample."""

import bz2
import gzip
import re
import uuid

import pytest
from pyspark.sql import functions as F

from taxaloom.operators import matrix as M
from taxaloom.session import staging_path
from taxaloom.sources import files, joined, sinks

FILES = "sample_name string, position int, path string"


def reads(start, n):
    return "".join(f"@r{i}\nACGT\n+\nII@I\n" for i in range(start, start + n)).encode()


def test_members_are_joined_in_order(spark, tmp_path):
    parts = [(s, p, tmp_path / f"{s}_{p}.fq.gz") for s in ("a", "b c/d") for p in (2, 10, 1)]
    for k, (s, p, path) in enumerate(parts):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(reads(100 * k, 5)))
    df = spark.createDataFrame([(s, p, str(path)) for s, p, path in parts], FILES).repartition(5)
    made = {r.sample_name: r for r in joined.join_files(df, f"file://{tmp_path}/out").collect()}
    assert {s: r.members for s, r in made.items()} == {"a": 3, "b c/d": 3}
    for s, r in made.items():
        order = [path for x, p, path in sorted((x, p, path) for x, p, path in parts) if x == s]
        whole = b"".join(path.read_bytes() for path in order)
        written = r.path.removeprefix("file://")
        assert open(written, "rb").read() == whole and r.bytes == len(whole)
        ids = [x.read_id for x in files.read_fastq(spark, r.path).collect()]
        assert ids == re.findall(r"@(r\d+)\n", b"".join(gzip.decompress(p.read_bytes()) for p in order).decode())
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]


def test_other_kinds_and_faults(spark, tmp_path):
    (tmp_path / "x.fq").write_bytes(reads(0, 2))
    (tmp_path / "y.fq").write_bytes(reads(2, 2))
    (tmp_path / "z.fq.bz2").write_bytes(bz2.compress(reads(4, 2)))
    out = str(tmp_path / "out")
    one = spark.createDataFrame([("s", 1, str(tmp_path / "x.fq")), ("s", 2, str(tmp_path / "y.fq"))], FILES)
    assert [r.bytes for r in joined.join_files(one, out).collect()] == [len(reads(0, 4))]
    mixed = spark.createDataFrame([("s", 1, str(tmp_path / "x.fq")), ("s", 2, str(tmp_path / "z.fq.bz2"))], FILES)
    with pytest.raises(Exception, match="end in"):
        joined.join_files(mixed, out).collect()
    for row in [(None, 1, str(tmp_path / "x.fq")), ("s", 1, None)]:
        with pytest.raises(Exception, match="no sample name or no path"):
            joined.join_files(spark.createDataFrame([row], FILES), out).collect()
    assert joined.join_files(spark.createDataFrame([], FILES), out).collect() == []


def plan(df):
    """The plan without broadcasts of small sides."""
    before = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_tables_are_not_exchanged(spark):
    rows = [(f"s{i % 40}", f"f{i % 7}", float(i % 11)) for i in range(900)]
    values = spark.createDataFrame(rows, "sample_name string, feature string, value double")
    meta = spark.createDataFrame([(f"s{i}", "ab"[i % 2]) for i in range(40)], "sample_name string, group string")

    def table(df):
        name = f"t_{uuid.uuid4().hex}"
        return joined.write_bucketed(df, name, staging_path(spark, name))

    v, m = table(values), table(meta)
    by_sample = "hashpartitioning(sample_name"
    assert by_sample in plan(M.with_group(values, meta)) and by_sample not in plan(M.with_group(v, m))
    totals = v.groupBy("sample_name").agg(F.sum("value").alias("t")).join(m, "sample_name")
    assert "Exchange" not in plan(totals)
    assert "Exchange" not in plan(M.relative(v, bucketed=True))
    key = ["sample_name", "feature", "value"]
    same = lambda a, b: sorted(map(tuple, a.select(*key).collect())) == sorted(map(tuple, b.select(*key).collect()))
    assert same(M.relative(v, bucketed=True), M.relative(values))


@pytest.mark.parametrize("width", [3, 50_000])
def test_matrices_of_any_width(spark, width):
    """The plan has no column per sample; absent and zero cells don't come back."""
    names = spark.range(width).select(F.concat(F.lit("s"), F.col("id")).alias("sample_name"), F.col("id").alias("position"))
    cells = spark.range(4 * min(width, 2000)).select(
        F.concat(F.lit("s"), F.pmod(F.col("id") * 7919, F.lit(width))).alias("sample_name"),
        F.concat(F.lit("f "), F.col("id") % 5).alias("feature"), (F.col("id") % 13).cast("double").alias("value"),
    ).groupBy("sample_name", "feature").agg(F.sum("value").alias("value"))
    marks = names.select("sample_name", F.lit("group").alias("name"), F.concat(F.lit("g"), F.col("position") % 3).alias("level"))
    path = staging_path(spark, "matrix")
    sinks.write_matrix(cells, names, path, metadata=marks)
    back = files.read_matrix(spark, path)
    assert back.count() == cells.filter("value <> 0").count()
    assert back.exceptAll(cells.select("sample_name", "feature", "value")).isEmpty()
    features, meta = files.read_pcl(spark, path, "group")
    assert features.count() == 5 * width if width > 10 else features.count() > 0
    assert meta.filter("name = 'group'").exceptAll(marks.select("sample_name", "name", "level")).isEmpty()
    assert meta.count() == width
    lines = sorted(r.value.count("\t") for r in spark.read.text(path).collect())
    assert set(lines) == {width}


def test_matrix_of_odd_cells(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("x\ta\tb\tc\nf1\t1.5\t0\t\nf2\tNA\t-2\t3\n\nx\ta\tb\tc\nf3\t0\t0\t1e-3\n")
    made = {(r.sample_name, r.feature, r.value) for r in files.read_matrix(spark, str(tmp_path / "m.tsv")).collect()}
    assert made == {("a", "f1", 1.5), ("b", "f2", -2.0), ("c", "f2", 3.0), ("c", "f3", 0.001)}
