import hashlib

import pytest
from pyspark.errors import PySparkException

from pairloom.llm import warc_archive as warc
from tests.llm.helpers import rows_of

BIG = "x" * 150
SCHEMA = "page_id long, url string, html string, digest string, records int"


def pages(spark):
    rows = [
        (1, "http://a.example\r\nWARC-Type: revisit", BIG), (2, None, BIG), (3, "u", None),
        (4, "u", ""), (5, "u", "é" * 60), (6, "u", "é" * 60), (6, "u", "é" * 60), (7, "u", "é" * 49),
        (8, "u", "é" * 49), (None, "u", BIG), (None, None, "z" * 101), (9, "u", "line\r\n\r\nWARC/1.1\r\n"),
    ]
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA).repartition(3)


def test_records_come_back(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages(spark), folder)
    found = rows_of(
        warc.resolved_records(spark, folder),
        "id", "record_type", "refers_to", "payload_bytes", "payload_digest",
    )
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    row = lambda i, kind, to, t: (i, kind, to, len(t.encode()), digest(t))
    e, s = "é" * 60, "é" * 49
    assert found == [
        row(1, "response", None, BIG), row(2, "revisit", 1, BIG),
        row(3, "response", None, ""), row(4, "response", None, ""),
        row(5, "response", None, e), row(6, "revisit", 5, e), row(6, "revisit", 5, e),
        row(7, "response", None, s), row(8, "response", None, s),
        row(9, "response", None, "line\r\n\r\nWARC/1.1\r\n"),
        row(None, "response", None, "z" * 101), row(None, "revisit", 1, BIG),
    ]


def test_payloads_are_stored_once(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages(spark), folder)
    payloads = warc.read_payloads(spark, folder)
    assert payloads.count() == payloads.select("digest").distinct().count() == 6


def test_original_records_are_whole(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages(spark), folder)
    records = [bytes(r.record) for r in warc.original_records(spark, folder).collect()]
    assert len(records) == 12
    for record in records:
        head, _, rest = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        payload = rest[:-4].removeprefix(warc.HTTP_HEAD.encode())
        if fields[b"WARC-Type"] == b"response":
            name = f"sha256:{hashlib.sha256(payload).hexdigest()}".encode()
            assert fields[b"WARC-Payload-Digest"] == name
        else:
            assert payload == b""


def test_a_damaged_payload_fails_the_read(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages(spark), folder)
    stored = spark.read.parquet(f"{folder}/payloads").selectExpr(
        "digest", "concat(payload, binary('!')) AS payload"
    )
    bad = str(tmp_path / "bad")
    stored.write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{bad}/records")
    with pytest.raises(PySparkException, match="does not match"):
        warc.resolved_records(spark, bad).collect()


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages(spark).limit(0), folder)
    assert warc.resolved_records(spark, folder).count() == 0
    assert warc.original_records(spark, folder).count() == 0
