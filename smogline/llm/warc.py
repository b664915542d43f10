"""A content-addressed archive of WARC records.

Payload bytes are stored once, under their SHA-256; the exact record headers are stored
apart, and records are rebuilt by joining the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import cut

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits are five hexadecimal and four base-32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column, row: Column) -> Column:
    """The id as a URN; rows without an id are told apart by their row number."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.concat(F.lit("none-"), row.cast("string"))),
                    F.lit(">"))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those whose value is null are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in pairs])


def write_archive(pages: DataFrame, path: str, *, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to ``path``.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the smallest
    page_id is a response (ids that are null come last, equal ids count in row order), the
    others are revisits that refer to it. A null html is an empty payload, a null url is
    written as ``urn:unknown``, line ends in a url are percent-encoded. Other columns are
    ignored; an empty table makes an empty archive. Payloads are grouped on the map side,
    so a payload that many pages share crosses the network once per task.
    """
    rows = pages.select(
        "page_id", F.coalesce(F.col("url"), F.lit("urn:unknown")).alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).select("*", F.unhex(F.sha2("payload", 256)).alias("key"), F.octet_length("payload").cast("long").alias("bytes"))
    (rows.groupBy("key", "bytes").agg(F.first("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))

    index = cut(rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "key", "bytes",
                            base32_sha1(F.col("payload")).alias("sha1")))
    owners = (index.filter(F.col("bytes") >= min_bytes).groupBy("key")
              .agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first"),
                   F.min("sha1").alias("low"), F.max("sha1").alias("high"))
              # two digests and a length that agree: else different payloads would share a key
              .select(F.col("key").alias("own_key"), "first",
                      F.when(F.col("low") == F.col("high"), True).otherwise(
                          F.raise_error(F.lit("payloads of one SHA-256 differ")).cast("boolean")).alias("verified")))
    joined = index.join(owners, F.col("key") == F.col("own_key"), "left")
    revisit = F.coalesce(F.col("verified") & (F.col("row") != F.col("first.row")), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    header = F.concat(F.lit(f"WARC/1.1{CRLF}"), _lines(
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        ("WARC-Target-URI", url),
        ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        ("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("first.page_id"), F.col("first.row")))),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", block.cast("string"))), F.lit(CRLF))
    (joined.withColumn("revisit", revisit).withColumn("http", http)
     .select("row", "page_id", "key", "revisit", header.cast("binary").alias("header"), F.col("http").cast("binary").alias("http"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The archive's records: ``record`` is the original bytes, ``payload`` the full payload.

    Every payload is checked against the digest it is stored under; a damaged one, or a
    header without its payload, fails the read instead of giving other bytes.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.coalesce(F.unhex(F.sha2("payload", 256)) == F.col("key"), F.lit(False))
    checked = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload is damaged")).cast("binary"))
    body = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload"))
    return (headers.join(payloads.select("key", "payload"), "key", "left").withColumn("payload", checked)
            .select("row", F.concat("header", "http", body, F.lit(b"\r\n\r\n")).alias("record"), "payload"))


def parse_records(records: DataFrame) -> DataFrame:
    """The fields of the records' headers, with the payload's measured length and digest."""
    header = F.substring_index(F.col("record").cast("string"), CRLF + CRLF, 1)

    def field(name: str) -> Column:
        found = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    return records.withColumn("header", header).select(
        "row", field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        field("Content-Length").cast("long").alias("content_bytes"),
        F.octet_length("record").cast("long").alias("record_bytes"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("measured_digest"))


def page_of(record_id: Column) -> Column:
    """The page_id within a record's id, null for records without one."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
