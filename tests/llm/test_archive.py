"""The web archive: exact bytes of every record, parsed by plain Python."""

import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from callgrid.llm.tables import new_path
from callgrid.llm.warc_store import read_captures, records, write_archive

SCHEMA = "page_id long, url string, html string, digest string, head string, n int, payload string, salt int, response long, size long"


def pages(spark):
    html = [None, "", "<p>é</p>", "a\r\n\r\nWARC/1.1\r\n", "x" * 70_000, "y", "y ", *["same"] * 12]
    rows = [(100 - 3 * i, f"http://h.org/{i}", t, "d", "h", i, "p", i, i, i) for i, t in enumerate(html)]
    rows += [(500, None, "y", *rows[0][3:]), (501, "http://h.org/\r\nWARC-Type: fake", "z", *rows[0][3:]), (502, "", "z", *rows[0][3:])]
    rows += [(None, "http://h.org/n", "same", *rows[0][3:]), (None, "http://h.org/m", "alone", *rows[0][3:])]
    rows += [rows[2], (100, "http://h.org/other", "another", *rows[0][3:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parsed(record):
    """(header fields, block) of a record."""
    head, rest = record.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    assert version == "WARC/1.1" and len(fields) == len(lines)
    block = rest[: int(fields["Content-Length"])]
    assert rest[len(block) :] == b"\r\n\r\n"
    return fields, block


def test_archive_keeps_exact_records(spark):
    given = [(r["page_id"], r["url"], (r["html"] or "").encode()) for r in pages(spark).collect()]
    last = defaultdict(lambda: None)
    for i, _, data in given:
        last[data] = max(last[data], i, key=lambda x: (x is not None, x)) if data in last else i
    path = new_path(spark, "test-warc")
    write_archive(pages(spark), path)

    got = [tuple(r) for r in read_captures(spark, path).drop("url").collect()]
    want = [(i, len(d), sha1(d), "response" if i == last[d] else "revisit", None if i == last[d] else last[d]) for i, _, d in given]
    assert sorted(got, key=repr) == sorted(want, key=repr)

    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert sorted(bytes(r["payload"]) for r in stored) == sorted(set(d for _, _, d in given))
    assert all(bytes(r["digest"]) == hashlib.sha256(bytes(r["payload"])).digest() for r in stored)

    seen = []
    for r in records(spark, path).collect():
        assert bytes(r["record"]).startswith(bytes(r["head"]))
        fields, block = parsed(bytes(r["record"]))
        http, body = block.split(b"\r\n\r\n", 1)
        data, i = bytes(r["payload"]), r["page_id"]
        assert fields["WARC-Payload-Digest"] == f"sha1:{sha1(data)}" and f"Content-Length: {len(data)}" in http.decode()
        assert fields["WARC-Record-ID"] == f"<urn:page:{'' if i is None else i}>"
        if i == last[data]:
            assert fields["WARC-Type"] == "response" and body == data and "WARC-Refers-To" not in fields
        else:
            assert fields["WARC-Type"] == "revisit" and body == b"" and fields["WARC-Refers-To"] == f"<urn:page:{last[data]}>"
        seen.append((i, fields.get("WARC-Target-URI"), data))
    escaped = [(i, u and u.replace("\r", "%0D").replace("\n", "%0A"), d) for i, u, d in given]
    assert sorted(seen, key=repr) == sorted(escaped, key=repr)


def test_archive_of_nothing(spark):
    path = new_path(spark, "test-warc")
    write_archive(pages(spark).limit(0), path)
    assert read_captures(spark, path).collect() == [] and records(spark, path).collect() == []


def test_damaged_archives_are_errors(spark):
    path = new_path(spark, "test-warc")
    write_archive(pages(spark), path)
    harmed, stored = new_path(spark, "test-warc"), spark.read.parquet(f"{path}/payloads")
    other = F.when(F.col("payload") == F.lit(b"y"), F.lit(b"Y")).otherwise(F.col("payload"))
    stored.withColumn("payload", other).write.parquet(f"{harmed}/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{harmed}/records")
    with pytest.raises(Exception, match="does not have its digest"):
        read_captures(spark, harmed).collect()
    harmed = new_path(spark, "test-warc")
    stored.write.parquet(f"{harmed}/payloads")
    head = F.encode(F.regexp_replace(F.decode("head", "UTF-8"), "Digest: sha1:.", "Digest: sha1:1"), "UTF-8")
    spark.read.parquet(f"{path}/records").withColumn("head", head).write.parquet(f"{harmed}/records")
    with pytest.raises(Exception, match="names another payload"):
        read_captures(spark, harmed).collect()
