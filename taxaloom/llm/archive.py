"""Content-addressed WARC archive: each payload once, record headers apart, records restored by joins."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from taxaloom.session import broadcast_rows, freeze

#: Payloads of fewer bytes are never replaced by a revisit record.
REVISIT_BYTES = 1000

_CRLF = "\r\n"
#: Profile of a revisit with the same payload (fixed value of the format).
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


#: Target rows of revisits that are joined by a broadcast; more are joined by an exchange.
BROADCAST_TARGETS = 100_000


def _urn(page_id: Column, mark: Column, copy: Column) -> Column:
    """A record's name: the page, a digest of its URL and payload, and a number among rows that agree in all of them."""
    page = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(F.lit("<urn:page:"), page, F.lit(":"), mark, F.lit(":"), copy.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line breaks in a value are percent-coded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_CRLF)), F.lit(""))


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    date: str | None = None,
) -> None:
    """Write ``path/payloads`` (``sha256, payload``) and ``path/records`` (``sha256, kind, header``).

    Payloads are stored once by SHA-256, after the copies of a digest have been
    compared whole. Of equal payloads of at least ``revisit_bytes`` bytes the one
    with the largest id is the response and the others refer to it; rows that
    repeat that id are responses, and so are rows without an id where no copy
    has one. Null payloads are empty, null URLs leave their line out; ids that are
    no whole numbers count as null. Copies are merged before the exchange, so a
    large group is one row per task. ``date``: the records' date (W3C, UTC), by
    default the time of the call. No two records have one name.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").try_cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.to_binary(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")), F.lit("utf-8")).alias("payload"),
    ).withColumn("sha256", F.unhex(F.sha2("payload", 256)))

    same = F.min("payload") == F.max("payload")
    rows.groupBy("sha256").agg(
        F.when(same, F.min("payload")).otherwise(F.raise_error(F.lit("two payloads have one digest"))).alias("payload")
    ).write.parquet(f"{path}/payloads")

    light = (
        rows.groupBy(
            "page_id", "url", "sha256", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1")
        )
        .agg(F.count("*").alias("n"))
        .withColumn("mark", F.md5(F.concat("sha256", F.coalesce(F.concat(F.lit("+"), "url"), F.lit("-")).cast("binary"))))
    )
    first = light.where((F.col("size") >= revisit_bytes) & F.col("page_id").isNotNull()).groupBy("sha256").agg(
        F.max(F.struct("page_id", "mark")).alias("target")
    )
    target = F.col("target.page_id")
    revisit = target.isNotNull() & ~F.col("page_id").eqNullSafe(target)
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _line("WARC-Type", F.col("kind")),
        _line("WARC-Record-ID", _urn(F.col("page_id"), F.col("mark"), F.col("copy"))),
        _line("WARC-Date", F.lit(date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _urn(target, F.col("target.mark"), F.lit(1)))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(_CRLF),
    )
    light.join(first, "sha256", "left").withColumn("kind", kind).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))
    ).select("sha256", "kind", F.to_binary(header, F.lit("utf-8")).alias("header")).write.parquet(f"{path}/records")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record`` per archived record: the bytes of the original WARC record, header, body and end.

    The body is the stored payload, none for a revisit; a payload that doesn't
    match its digest any more ends the job with an error.
    """
    payloads = spark.read.parquet(f"{path}/payloads").withColumn(
        "payload",
        F.when(F.unhex(F.sha2("payload", 256)) == F.col("sha256"), F.col("payload")).otherwise(
            F.raise_error(F.lit("a stored payload doesn't match its digest"))
        ),
    )
    end = F.lit((_CRLF * 2).encode())
    records = spark.read.parquet(f"{path}/records")
    whole = records.where("kind = 'response'").join(payloads, "sha256")
    bare = records.where("kind = 'revisit'")
    return whole.select(F.concat("header", "payload", end).alias("record")).unionByName(
        bare.select(F.concat("header", end).alias("record"))
    )


def parsed(records: DataFrame) -> DataFrame:
    """``header, body`` of each ``record``: the header up to the empty line, and as many bytes as its length says.

    A record that has no empty line, no length, or another end than the format's
    ends the job with an error.
    """
    # One character per byte, so that places in it are places in the record.
    at = F.instr(F.decode(F.col("record"), "ISO-8859-1"), _CRLF * 2)
    cut = records.select("record", F.nullif(at, F.lit(0)).alias("at")).withColumn(
        "header", F.substring("record", F.lit(1), F.col("at") + 3)
    )
    size = field("Content-Length").try_cast("int")
    rest = F.octet_length("record") - F.col("at") - 3 - size
    sound = (rest == 4) & (F.substring("record", F.octet_length("record") - 3, F.lit(4)) == F.lit((_CRLF * 2).encode()))
    body = F.substring("record", F.col("at") + 4, size)
    broken = F.raise_error(F.lit("bytes that are no WARC record")).cast("binary")
    return cut.select("header", F.when(F.coalesce(sound, F.lit(False)), body).otherwise(broken).alias("body"))


def field(name: str, header: str = "header") -> Column:
    """Value of a header line, null where the header has no such line."""
    value = F.regexp_extract(F.decode(F.col(header), "utf-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def _page(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+):", 1).try_cast("long")


def record_facts(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records as bytes.

    Size and digest are those of the body that was read; a digest that doesn't
    match the header's ends the job with an error. A revisit has those of the
    record that it refers to, which must be there with the same digest.
    """
    read = freeze(
        parsed(records).select(
            field("WARC-Record-ID").alias("name"), field("WARC-Type").alias("record_type"),
            field("WARC-Refers-To").alias("refers"), field("WARC-Payload-Digest").alias("said"),
            F.octet_length("body").cast("long").alias("payload_bytes"), F.sha1("body").alias("payload_digest"),
        )
    )
    revisit = F.col("record_type") == "revisit"
    matches = F.concat(F.lit("sha1:"), F.col("payload_digest")) == F.col("said")
    wrong = F.raise_error(F.lit("a header doesn't match its payload"))
    whole = read.where(~revisit)
    # One row per group of copies, whatever their number.
    wanted = read.where(revisit).select(F.col("refers").alias("name")).distinct()
    targets = freeze(
        whole.join(wanted, "name").select(
            F.col("name").alias("refers"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest")
        )
    )
    targets = broadcast_rows(targets, targets.count(), BROADCAST_TARGETS)
    followed = read.where(revisit).join(targets, "refers", "left").select(
        "name", "record_type", "refers", F.col("bytes").alias("payload_bytes"),
        F.when(F.coalesce(F.concat(F.lit("sha1:"), F.col("digest")) == F.col("said"), F.lit(False)), F.col("digest"))
        .otherwise(F.raise_error(F.lit("a revisit's record isn't there or has another payload")))
        .alias("payload_digest"),
    )
    own = whole.withColumn("payload_digest", F.when(matches, F.col("payload_digest")).otherwise(wrong)).select(*followed.columns)
    return own.unionByName(followed).select(
        _page(F.col("name")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        _page(F.col("refers")).alias("refers_to"),
    )
