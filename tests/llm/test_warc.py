import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from smogline.llm import warc

SCHEMA = "page_id long, url string, html string, key string, payload string, row string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def digest(body):
    return base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()


def archived(spark, shared, rows, **options):
    path = shared("warc")
    warc.write_archive(pages(spark, rows), path, **options)
    return path, warc.read_records(spark, path)


def test_records_are_rebuilt(spark, shared):
    rows = [(5, "http://a/", "<p>é"), (3, "http://b/\r\nWARC-Type: x", "<p>é"), (9, None, None), (2, "u", ""), (None, "v", "<p>é"),
            (7, "w", "x" * 300_000), (3, "again", "<p>é"), (11, "u", "end\r\n\r\nWARC/1.1\r\n")]
    path, records = archived(spark, shared, rows)
    found = {(r["page_id"], r["url"]): r for r in warc.parse_records(records).withColumn(
        "page_id", warc.page_of(F.col("record_id"))).withColumn("to", warc.page_of(F.col("refers_to"))).collect()}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        r = found[(page_id, (url or "urn:unknown").replace("\r", "%0D").replace("\n", "%0A"))]
        assert r["payload_bytes"] == len((html or "").encode()) and r["payload_digest"] == digest(html or "") == r["measured_digest"]
    kinds = [(k[0], r["record_type"], r["to"]) for k, r in found.items()]
    assert sorted(kinds, key=str) == sorted([(5, "revisit", 3), (3, "response", None), (3, "revisit", 3), (9, "revisit", 2), (2, "response", None),
                                             (None, "revisit", 3), (7, "response", None), (11, "response", None)], key=str)
    assert spark.read.parquet(f"{path}/payloads").count() == 4  # once each
    for r in records.collect():
        head, _, block = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int(head.rsplit(b"Content-Length: ", 1)[1])
        assert len(block) == length + 4 and block.endswith(b"\r\n\r\n")
        assert block[:length].partition(b"\r\n\r\n")[2] == (b"" if b"WARC-Type: revisit\r\n" in head else bytes(r["payload"]))


def test_small_payloads_are_responses(spark, shared):
    _, records = archived(spark, shared, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], min_bytes=3)
    kinds = warc.parse_records(records).select(warc.page_of(F.col("record_id")), "record_type").collect()
    assert sorted(map(tuple, kinds)) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark, shared):
    _, records = archived(spark, shared, [])
    assert warc.parse_records(records).count() == 0


def test_damage_is_found(spark, shared):
    path, _ = archived(spark, shared, [(1, "u", "good")])
    spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"evil")).write.parquet(f"{path}/other/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/other/headers")
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(spark, f"{path}/other").collect()
