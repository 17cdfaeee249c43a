"""Queries of the subpackage by name, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.session import staging_path

from . import archive, audit, bpe_count, chosen_path, gnat, grace, lattice, lines, mixing, packing, search, toxicity, viterbi
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

#: Rows of whole texts that go to a Python worker at once; the setting's default of 10,000 is meant for short rows.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def query(name: str, sql: str | None = None):
    def add(fn):
        assert name not in QUERIES, name

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query(
    "op11_hard_negatives",
    """
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM e AS a JOIN e AS b ON b.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return gnat.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


@query(
    "op12_filter_audit",
    r"""
    WITH l AS (
        SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
        FROM labels GROUP BY doc_id
    ), t AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), m AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               (len(w) < 100)::INT
               + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
               + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
               + 8 * regexp_matches(t, '[#$%&*|]')::INT
               + 16 * coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY t), false)::INT AS mask
        FROM t LEFT JOIN l ON t.doc_id = l.doc_id
    ), n AS (
        SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL
    ), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    o AS (
        SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
               [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM f AS a JOIN f AS b ON b.bit <> a.bit JOIN f AS c ON c.bit NOT IN (a.bit, b.bit)
        JOIN f AS d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f AS e ON e.bit = 31 - a.bit - b.bit - c.bit - d.bit
    ), s AS (
        SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
        FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
    )
    SELECT part, filter_order, step,
           sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
           sum(CASE WHEN mask & bit <> 0 THEN n * 120 // bit_count(mask) ELSE 0 END)::BIGINT AS shapley
    FROM n, s GROUP BY ALL
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = audit.mask_counts(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))
    return audit.interactions(counts)


@query("op13_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), byte_model())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = bpe_count.token_counts(table(spark, sf_dir, "documents"), piece_model(), remember=250_000)
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.encode(table(spark, sf_dir, "documents"), piece_model(), remember=400_000)


@query(
    "op10_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
    ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM n JOIN g USING (t)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.exact_dedup(table(spark, sf_dir, "documents"))


@query("op1_near_duplicates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


@query("op2_source_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query(
    "op3_top_k_search",
    r"""
    WITH w AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+')) AS word
        FROM documents
    ), p AS (SELECT doc_id, word, count(*) AS tf FROM w GROUP BY ALL),
    l AS (SELECT doc_id, sum(tf) AS len FROM p GROUP BY doc_id),
    n AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT sum(len) FROM l) / (SELECT count(*) FROM documents) AS mean),
    f AS (SELECT word, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, n GROUP BY word, docs),
    s AS (
        SELECT q.doc_id AS query_id, p.doc_id,
               round(sum(q.tf * idf * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
        FROM p AS q JOIN p USING (word) JOIN f USING (word) JOIN l ON l.doc_id = p.doc_id, n
        WHERE q.doc_id % 50 = 0 GROUP BY ALL
    ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT query_id, rank, doc_id, round(score, 4) AS score FROM r WHERE rank <= 10
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = search.search(docs, docs.where("doc_id % 50 = 0"), k=10)
    return found.withColumn("score", F.round("score", 4))


@query(
    "op4_line_dedup",
    r"""
    WITH l AS (
        SELECT doc_id, source, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
               unnest(string_split(coalesce(text, ''), chr(10))) AS line
        FROM documents
    ), k AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM l),
    h AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
    c AS (
        SELECT source, key FROM (SELECT DISTINCT source, doc_id, key FROM k) JOIN h USING (source)
        WHERE key <> '' GROUP BY source, key, pages HAVING count(*) >= 5 AND count(*) > 0.05 * pages
    )
    SELECT k.doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
           coalesce(string_agg(CASE WHEN c.key IS NULL THEN k.line END, chr(10) ORDER BY k.pos), '') AS text
    FROM k LEFT JOIN c ON k.source = c.source AND k.key = c.key
    GROUP BY k.doc_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.line_dedup(docs, n_lines="n_lines", n_dropped="n_dropped").drop("source")


@query("op5_lm_scores")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.text_scores(table(spark, sf_dir, "documents"), piece_model())


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, machine).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query(
    "op7_warc_archive",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    g AS (SELECT h, max(page_id) AS target FROM p WHERE strlen(h) >= 1000 GROUP BY h)
    SELECT page_id, strlen(p.h) AS payload_bytes, sha1(p.h) AS payload_digest,
           CASE WHEN target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN target <> page_id THEN target END AS refers_to
    FROM p LEFT JOIN g ON p.h = g.h
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    archive.write_archive(table(spark, sf_dir, "pages"), path)
    return archive.record_facts(archive.read_records(spark, path))
