import base64
import hashlib
import re

import pytest

from corpuscle.llm import warc
from corpuscle.session import fresh_path

PAGES = [(3, "http://a/3", "same"), (1, "http://a/1", "same"), (2, None, None), (5, "http://a/5", ""), (4, "a\r\nX: y", "é<b>"),
         (None, "http://a/n", "same"), (6, "http://a/6", "x" * 300_000)]
SCHEMA = "page_id long, url string, html string"


def test_records_come_back(spark):
    pages = spark.createDataFrame([(*p, "noise", 1) for p in PAGES], SCHEMA + ", payload string, `key` int")
    path = warc.write_archive(pages)
    rows = {r["key"]: r for r in warc.read_archive(spark, path).collect()}
    assert len(rows) == len(PAGES)
    first = {"same": 1, "": 2, "é<b>": 4, "x" * 300_000: 6}
    for key, url, html in PAGES:
        row, body = rows[key], (html or "").encode()
        assert bytes(row["payload"]) == body and row["payload_bytes"] == len(body)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        leads = first[html or ""] == key
        assert (row["record_type"], row["refers_to"]) == (("response", None) if leads else ("revisit", first[html or ""]))
        head, record = bytes(row["head"]), bytes(row["record"])
        assert record == head + (body if leads else b"") + b"\r\n\r\n"
        block = record[head.index(b"\r\n\r\n") + 4:-4]
        assert int(re.search(rb"\r\nContent-Length: (\d+)\r\n\r\nHTTP", head)[1]) == len(block)
        assert b"\r\nX: y" not in head
    assert spark.read.parquet(f"{path}/payloads").count() == 4


def test_short_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    rows = warc.read_archive(spark, warc.write_archive(pages, min_bytes=3)).collect()
    assert {r["key"]: r["record_type"] for r in rows} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_repeated_rows_and_lone_null_keys(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (None, "u", "b"), (None, "u", "b")], SCHEMA)
    rows = warc.read_archive(spark, warc.write_archive(pages)).collect()
    assert len(rows) == 4 and {r["record_type"] for r in rows} == {"response"}


def test_empty_table(spark):
    assert warc.read_archive(spark, warc.write_archive(spark.createDataFrame([], SCHEMA))).count() == 0


def test_a_changed_payload_is_noticed(spark):
    path, other = warc.write_archive(spark.createDataFrame(PAGES, SCHEMA)), fresh_path(spark, "changed")
    stored = spark.read.parquet(f"{path}/payloads")
    stored.selectExpr("sha256", "first_key", "payload_bytes", "payload_digest", "concat(payload, X'00') AS payload").write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, other).select("payload_digest").collect()
