import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, a long one, ties, and rows that repeat.
LONG = "\n".join(" ".join(f"w{(i * 7 + j * 13) % 997}" for j in range(40)) for i in range(600))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 69),
    (2, "the  quick brown fox jumps over the lazy dog near the river\tbank today", "en", "a", 70),
    (3, "The quick brown fox jumps over the lazy dog near the river bank today", None, None, None),
    (None, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "b", 69),
    (4, None, "de", "b", None),
    (5, "", "de", "b", 0),
    (6, " \t\n", None, "b", 3),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG + " tail", "en", "a", len(LONG) + 5),
    (9, "short one", "en", "c", 9),
    (9, "short one", "en", "c", 9),
    (10, "übermäßig große Straße ☃ 日本語 é", "de", "c", 30),
    (-11, "short one", "en", "c", 9),
]


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Columns named like those the operators make."""
    for name in (
        "size", "kept", "keep_id", "n_tokens", "score", "ids", "key", "cls", "label", "word", "row", "id", "t", "n_rows",
        "group_size", "target", "copies", "component_id", "held_out", "node", "payload", "h", "c", "n", "rows", "value",
    ):
        odd = odd.withColumn(name, F.lit("x"))
    return odd


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def same(df, other):
    """Both frames have the same rows."""
    names = sorted(df.columns)
    assert names == sorted(other.columns)
    a, b = (sorted(map(str, (tuple(r[c] for c in names) for r in x.collect()))) for x in (df, other))
    assert a == b
