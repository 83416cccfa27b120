"""Content-addressed web archive: payload bytes once by digest, record headers apart, records put together by joins.

An archive is a folder of two tables. `payloads` has a row for each distinct payload, under its SHA-256. `records` has a row
for each capture: the exact bytes that come before the payload in its record (WARC header and HTTP header, or the whole
block of a revisit), and the SHA-256 of the payload it stands for. Nothing else is kept: whatever is read back comes from
header bytes and payload bytes, and every payload is hashed again when it is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CRLF = "\r\n"
#: URN of a capture, followed by its page_id.
URN = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Digits of base 32, and those that `conv` writes.
BASE32, CONV_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: A payload with more copies than one in so many records is joined apart from the others.
HOT_SHARE = 1000
SALTS = 64


def sha1_base32(data: Column) -> Column:
    """Upper-case base 32 of the SHA-1 of bytes: 160 bits are 32 digits, 60 or 40 bits at a time."""
    digest = F.sha1(data)
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]
    digits = [F.lpad(F.conv(F.substring(digest, at, n), 16, 32), width, "0") for at, n, width in parts]
    return F.translate(F.concat(*digits), CONV_DIGITS, BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _urn(page_id: str) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(">"))


def _captures(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    # a header line ends at a line feed, so those of an address are written as percent codes
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), uri.alias("uri"), payload.alias("payload"))
    return named.withColumn("digest", F.unhex(F.sha2("payload", 256)))


def _store(captures: DataFrame) -> DataFrame:
    """(digest, payload, size, sha1, response, n): equal payloads collapse in the tasks that read them.

    That equal SHA-256 means equal payload is checked by length and SHA-1 of all captures, not taken for granted.
    """
    each = captures.select("digest", "page_id", "payload", F.octet_length("payload").cast("long").alias("size"), sha1_base32(F.col("payload")).alias("sha1"))
    found = each.groupBy("digest").agg(
        F.first("payload").alias("payload"),
        F.min("size").alias("size"),
        F.max("size").alias("largest"),
        F.min("sha1").alias("sha1"),
        F.max("sha1").alias("last"),
        F.max("page_id").alias("response"),
        F.count(F.lit(1)).alias("n"),
    )
    clash = (F.col("size") != F.col("largest")) | (F.col("sha1") != F.col("last"))
    checked = F.when(clash, F.raise_error(F.lit("two payloads have one SHA-256"))).otherwise(F.col("payload"))
    return found.select("digest", checked.alias("payload"), "size", "sha1", "response", "n")


def joined_by_digest(records: DataFrame, payloads: DataFrame, carried: list[str]) -> DataFrame:
    """`records` with the columns `carried` of their payload.

    A payload with more than a thousandth of all records, of which there are fewer than a thousand, has its records dealt
    to several places, and is sent to each of them; the others meet by digest.
    """
    total = payloads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = payloads.where(F.col("n") > max(1, total // HOT_SHARE)).select("digest", F.lit(SALTS).alias("salts"))
    salt = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("page_id", "head"), F.col("salts"))).otherwise(F.lit(0))
    left = records.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt.cast("int")).drop("salts")
    right = payloads.select("digest", *carried).join(F.broadcast(hot), "digest", "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return left.join(right, ["digest", "salt"]).drop("salt")


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archive every row of `pages` (page_id, url, html, other columns) in a new folder.

    Null html is an empty payload, null url gives no target. Of captures with equal payloads the one with the largest
    page_id is a response, the others revisit it; null is smaller than any page_id. Captures equal in page_id and payload are
    the same capture given more than once: each has a record, of the same type. An empty table gives empty tables.
    """
    spark = pages.sparkSession
    captures = _captures(pages)
    _store(captures).write.option("compression", "zstd").parquet(f"{path}/payloads")
    kept = spark.read.parquet(f"{path}/payloads")
    known = captures.select("page_id", "uri", "digest", F.lit("").alias("head"))
    known = joined_by_digest(known, kept, ["size", "sha1", "response"])
    revisit = ~F.col("page_id").eqNullSafe(F.col("response"))
    size = F.col("size").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF + CRLF))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    refers = F.when(revisit, _urn("response"))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn("page_id")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", refers),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    )
    records = known.select("page_id", "digest", F.encode(head, "UTF-8").alias("head"))
    records.write.option("compression", "zstd").parquet(f"{path}/records")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload, n) of an archive; a payload that does not have its digest is an error."""
    rows = spark.read.parquet(f"{path}/payloads").select("digest", "payload", "n")
    wrong = F.raise_error(F.lit("a payload does not have its digest"))
    sound = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    return rows.withColumn("payload", F.when(sound, F.col("payload")).otherwise(wrong))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, head, payload, record): the exact bytes of every record, and the payload it stands for.

    The record of a revisit ends after its HTTP header; its payload comes from the response.
    """
    rows = spark.read.parquet(f"{path}/records")
    rows = joined_by_digest(rows, payloads(spark, path), ["payload"])
    block = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return rows.select("page_id", "head", "payload", F.concat("head", block, F.lit((CRLF + CRLF).encode())).alias("record"))


def _field(name: str) -> Column:
    """The value of a header field, empty where there is none. Fields of a record come before the first empty line."""
    return F.regexp_extract(F.decode("head", "UTF-8"), rf"\A(?:[^\r\n]+\r\n)*?{name}: ([^\r\n]*)\r\n", 1)


def _page(urn: str) -> Column:
    return F.nullif(F.regexp_extract(urn, rf"^<{URN}(-?\d+)>$", 1), F.lit("")).cast("long")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Header fields are read from the header's bytes; an empty url reads as null. Length and SHA-1 are taken from the stored
    payload, once for all records that stand for it; a header that names another SHA-1 is an error.
    """
    told = spark.read.parquet(f"{path}/records").select(
        "digest",
        "page_id",
        "head",
        _field("WARC-Record-ID").alias("id"),
        _field("WARC-Target-URI").alias("uri"),
        _field("WARC-Payload-Digest").alias("told"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Refers-To").alias("refers"),
    )
    measured = payloads(spark, path).select(
        "digest", "n", F.octet_length("payload").cast("long").alias("payload_bytes"), sha1_base32(F.col("payload")).alias("payload_digest")
    )
    found = joined_by_digest(told, measured, ["payload_bytes", "payload_digest"])
    wrong = F.raise_error(F.lit("a header names another payload"))
    agrees = F.col("told") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    return found.select(
        _page("id").alias("page_id"),
        F.nullif("uri", F.lit("")).alias("url"),
        "payload_bytes",
        F.when(agrees, F.col("payload_digest")).otherwise(wrong).alias("payload_digest"),
        "record_type",
        _page("refers").alias("refers_to"),
    )
