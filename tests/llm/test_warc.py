from __future__ import annotations

import base64
import hashlib
import tempfile
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aduana.llm.warc import OP4_SQL, op4_warc, read_archives, write_archives
from tests.compare import connect
from tests.llm.cases import SF, crowded, table

PAGES = "page_id long, url string, html string"
NESTED = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:99>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
ODD = [
    (1, "http://a.example.com/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "x\r\nContent-Length: 3\r\n\r\n", None),
    (4, "", ""), (None, "u", "<p>one</p>"), (None, None, None), (5, "é", "é𝒳" * 50), (6, "u", "WARC/1.0\r\n" * 4),
    (7, "u", NESTED), (8, "u", NESTED * 3), (9, "u", "a" + NESTED), (10, "u", "\r\n\r\n" + NESTED + "\r\n"),
    (11, "u", "z" * 300_000), (12, "u", NESTED), (12, "u", NESTED), (13, "u", "WARC/1.0"), (14, "u", "\x00\x01 \n"),
]


def expected(rows):
    by_payload = defaultdict(list)
    for page_id, _, html in rows:
        by_payload[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        known = [x for x in by_payload[html or ""] if x is not None]
        first = max(known) if known else None
        revisit = first is not None and page_id != first
        out.append((
            page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
            "revisit" if revisit else "response", first if revisit else None,
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", ["128m", "700", "64k"])
def test_odd_rows_in_blocks_of_any_size(spark, block):
    """With small blocks records and payloads span several of them."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = crowded(spark.createDataFrame(ODD, PAGES)).coalesce(2)
        got = sorted([tuple(r) for r in op4_warc(spark, df).collect()], key=repr)
        assert got == expected(ODD)
        assert op4_warc(spark, df.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_whole_table_equals_sql(spark):
    got = op4_warc(spark, table(spark, "pages"))
    sql = connect(SF).execute(OP4_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(sql.fetchall(), key=repr)


def test_archives_are_plain_records(spark):
    path = tempfile.mkdtemp(prefix="aduana-warc-") + "/out"
    rows = [(1, "http://a.example.com/", "é"), (2, "http://a.example.com/", "é")]
    write_archives(spark, spark.createDataFrame(rows, PAGES).coalesce(1), path)
    data = b"".join(open(r["path"].removeprefix("file:"), "rb").read() for r in
                    spark.read.format("binaryFile").load(path).select("path").collect())
    assert data.count(b"WARC/1.0\r\n") == 2 and data.endswith(b"\r\n\r\n")
    assert "é".encode() + b"\r\n\r\n" in data
    assert b"WARC-Refers-To: <urn:x-page:2>\r\n" in data
    assert data.count(b"Content-Length: 2\r\n") == 2  # of the payload, in the HTTP heads


def test_small_payloads_are_whole(spark):
    path = tempfile.mkdtemp(prefix="aduana-warc-") + "/out"
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    write_archives(spark, spark.createDataFrame(rows, PAGES), path, min_bytes=3)
    got = {r["id"]: (r["type"], r["refers_to"]) for r in read_archives(spark, path).collect()}
    assert got == {"1": ("response", None), "2": ("response", None), "3": ("revisit", "4"), "4": ("response", None)}


def test_archive_of_many_records_with_the_magic_inside(spark):
    """Each record's pieces are found by what was carried forward, not by comparing them with all records."""
    n = 20_000
    pages = spark.range(n).selectExpr("id as page_id", "'u' as url", f"concat('{{}}', id, 'x') as html".format(
        NESTED.replace("\r", "\\r").replace("\n", "\\n")))
    began = time.perf_counter()
    rows = op4_warc(spark, pages.coalesce(1)).agg(
        F.count("*").alias("n"), F.sum("payload_bytes").alias("bytes"), F.countDistinct("payload_digest").alias("texts")
    ).first()
    assert time.perf_counter() - began < 90
    assert rows["n"] == rows["texts"] == n
    assert rows["bytes"] == sum(len(NESTED) + len(str(i)) + 1 for i in range(n))


def test_broken_archive_is_told(spark):
    path = tempfile.mkdtemp(prefix="aduana-warc-")
    with open(f"{path}/a.warc", "wb") as f:
        f.write(NESTED.encode() + b"junk" + NESTED.encode())
    with pytest.raises(ValueError, match="a.warc"):
        read_archives(spark, path)
