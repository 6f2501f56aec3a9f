"""Content-addressed WARC archive.

An archive is a folder of two tables. `payloads` holds the bytes of each distinct payload
once, under their SHA-256. `records` holds the exact header bytes of every record, its
type, and the digest of its payload. Original records come back by joining the two; every
payload is hashed again when it is read, and one that does not match its digest fails the
read.

Equal payloads of at least `min_revisit` bytes are stored as one `response`, the record with
the smallest id, and `revisit` records that name it and have no block. Shorter ones are all
`response`, but share the stored bytes as well.

Payload bytes are shuffled once for writing, by digest and record id, so that a payload that a third of
the pages share never meets in one task; all grouping is on digests, combined before the
shuffle. Reading joins narrow rows; only `original_records` moves payload bytes.

Defined cases: null HTML is an empty payload, a null URL an empty target; line ends are left
out of a target. Every row is a record: rows that repeat an id with the smallest id of their
payload are all `response`, and a row without an id has a record id without a number, and is
a `response` only where no row with that payload has an id. An empty table gives an archive
without records. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import Scratch, lookup

MIN_REVISIT_BYTES = 100
RECORD_PREFIX = "urn:pairloom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


def _header() -> Column:
    """Header block of a record, from its columns, up to and with the empty line."""
    is_revisit = F.col("record_type") == "revisit"
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    record = lambda c: F.concat(F.lit(f"<{RECORD_PREFIX}"), number(c), F.lit(">\r\n"))
    # A URL may hold characters that would end its line.
    target = F.regexp_replace(F.col("target"), r"[\r\n]", "")
    length = F.when(is_revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "),
        record(F.col("id")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.when(
            is_revisit,
            F.concat(
                F.lit("\r\nWARC-Refers-To: "),
                record(F.col("refers_to")),
                F.lit(f"WARC-Profile: {PROFILE}"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (length + len(HTTP_HEAD)).cast("string"),
        F.lit("\r\n\r\n" + HTTP_HEAD),
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit: int = MIN_REVISIT_BYTES,
) -> None:
    """Write one record per row of `pages` into a new archive."""
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(url_col), F.lit("")).alias("target"),
        payload.alias("payload"),
    )
    described = scratch.write(
        rows.select(
            "id",
            "target",
            _digest(F.col("payload")).alias("digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        ),
        "described",
    )
    n_rows, n_ids = described.agg(F.count(F.lit(1)), F.count_distinct("id")).first()
    contents = scratch.write(
        described.groupBy("digest").agg(
            F.min("id").alias("first_id"), F.count(F.lit(1)).alias("records")
        ),
        "contents",
    )
    is_revisit = (F.col("payload_bytes") >= min_revisit) & ~F.col("id").eqNullSafe(
        F.col("first_id")
    )
    records = lookup(described, contents, "digest", "records").select(
        "id",
        "target",
        "digest",
        "payload_bytes",
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("first_id")).alias("refers_to"),
    )
    records.select("id", "digest", _header().cast("binary").alias("header")).write.parquet(
        f"{folder}/records"
    )
    bodies = rows.select("id", _digest(F.col("payload")).alias("digest"), "payload")
    first = bodies["digest"] == contents["digest"]
    first &= bodies["id"].eqNullSafe(contents["first_id"])
    stored = bodies.join(contents, first, "left_semi").select("digest", "payload")
    if n_rows != n_ids:
        stored = stored.dropDuplicates(["digest"])
    stored.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """`(digest, payload)`, each checked against its digest."""
    sound = F.assert_true(
        _digest(F.col("payload")) == F.col("digest"),
        F.concat(F.lit("payload does not match its digest "), F.col("digest")),
    )
    stored = spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")
    # assert_true is null where it holds.
    return stored.filter(sound.isNull())


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """`(id, record_type, digest, refers_to, header)`, parsed from the header bytes."""
    stored = spark.read.schema("id long, digest string, header binary").parquet(
        f"{folder}/records"
    )
    text = F.decode("header", "UTF-8")
    number = lambda name: F.regexp_extract(
        text, rf"\n{name}: <{RECORD_PREFIX}(-?\d+)>\r\n", 1
    )
    whole = lambda name: F.when(number(name) != "", number(name).cast("long"))
    return stored.select(
        whole("WARC-Record-ID").alias("id"),
        F.regexp_extract(text, r"\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        F.regexp_extract(text, r"\nWARC-Payload-Digest: sha256:([0-9a-f]+)\r\n", 1).alias(
            "digest"
        ),
        whole("WARC-Refers-To").alias("refers_to"),
        "header",
    )


def resolved_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with the length and digest of their full payload, as read and verified."""
    records = read_records(spark, folder)
    counts = records.groupBy("digest").agg(F.count(F.lit(1)).alias("records"))
    payloads = read_payloads(spark, folder).select(
        "digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        _digest(F.col("payload")).alias("payload_digest"),
    )
    scratch = Scratch(spark, "warc")
    known = scratch.write(payloads.join(counts, "digest"), "payloads")
    return lookup(records.drop("header"), known, "digest", "records")


def original_records(spark: SparkSession, folder: str) -> DataFrame:
    """`(id, record)`: the bytes of each record as it was archived, header and block."""
    records = read_records(spark, folder)
    end = F.lit("\r\n\r\n").cast("binary")
    with_block = records.filter("record_type = 'response'").join(
        read_payloads(spark, folder), "digest"
    )
    return with_block.select("id", F.concat("header", "payload", end).alias("record")).unionByName(
        records.filter("record_type <> 'response'").select(
            "id", F.concat("header", end).alias("record")
        )
    )
