"""WARC archives: written, read back, digests and revisits."""

import base64
import hashlib

from comparing import rows_of, rows_of_sql

from sessiongrid.llm import warc
from sessiongrid.llm.common import new_folder
from sessiongrid.llm.queries import ORACLE_SQL, QUERIES

PAGE = "page_id long, url string, html string"


def b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_awkward_payloads(spark):
    pages = ["", None, "a\r\nb", "\r\n", "\r\n\r\n", "x\r", "\r", "\n", "\r\r\n", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "0\r\n\r\n", "é" * 40, "tail\r\n", "a\rb\nc\r\n\r", "same", "same", "same"]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 2 else None, h) for k, h in enumerate(pages)]
    rows += [(100, "u", "twice"), (100, "u", "twice"), (None, "u", "lonely")]
    for chunk in (1, 2, 3, 7, 16384):
        path = new_folder(spark, "warc")
        got = warc.archive(spark.createDataFrame(rows, PAGE), path, chunk=chunk).collect()
        assert len(got) == len(rows) and all(r["digest_ok"] for r in got)
        by = {r["page_id"]: r for r in got}
        for k, _, h in rows:
            raw = (h or "").encode()
            assert (by[k]["payload_bytes"], by[k]["payload_digest"]) == (len(raw), b32(raw))
        assert (by[16]["record_type"], by[16]["refers_to"]) == ("response", None)
        assert (by[14]["record_type"], by[14]["refers_to"]) == ("revisit", 16)
        assert (by[0]["record_type"], by[0]["refers_to"]) == ("revisit", 1)
        assert {r["record_type"] for r in got if r["page_id"] == 100} == {"response"}


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "aaaa"), (4, "u", "aaaa")]
    got = {r["page_id"]: r["refers_to"] for r in warc.archive(spark.createDataFrame(rows, PAGE), new_folder(spark, "warc"), min_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}


def test_file_is_a_valid_archive(spark):
    import glob
    import gzip

    path = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([(1, "http://h/", "ab" * 30), (2, "http://h/2", "ab" * 30), (3, "http://h/3", "c" * 50), (4, None, "")], PAGE).coalesce(1), path, chunk=50)
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(path.removeprefix("file://") + "/part-*.gz")))
    records = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        n = int(dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])[b"Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        data, records = rest[n + 4 :], records + 1
    assert records == 4


def test_chunk_table_carries_running_digests(spark):
    rows = warc.chunk_table(spark.createDataFrame([(1, "u", "abcdef")], PAGE), chunk=4).orderBy("chunk").collect()
    assert [r["chunk"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[1]["digest"] == hashlib.sha1(b"abcd").hexdigest() and rows[2]["digest"] == hashlib.sha1(b"abcdef").hexdigest()


def test_long_payload_and_clashing_columns(spark):
    text = "payload \u00fc\r\n" * 400_000
    df = spark.createDataFrame([("a>b c", "u", text, 1, "x"), ("null", "u", "s", 2, "y"), (None, "u", "s", 3, "z")], "page_id string, url string, html string, chunk int, sha string")
    got = {r["page_id"]: r for r in warc.archive(df, new_folder(spark, "warc")).collect()}
    assert got["a>b c"]["payload_digest"] == b32(text.encode()) and got["a>b c"]["payload_bytes"] == len(text.encode())
    assert (got["null"]["record_type"], got[None]["record_type"], got[None]["refers_to"]) == ("response", "revisit", "null")
    rows = warc.chunk_table(df).groupBy("record").count().collect()
    assert max(r["count"] for r in rows) == -(-len(text.encode()) // warc.CHUNK) + 3


def test_empty(spark):
    assert warc.archive(spark.createDataFrame([], PAGE), new_folder(spark, "warc")).count() == 0


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op5_warc"](spark, sf_dir).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in got} == {k: (len(h.encode()), b32(h.encode())) for k, h in pages.items()}


def test_query_equals_sql(spark, duck, sf_dir):
    df = QUERIES["op5_warc"](spark, sf_dir)
    want, names = rows_of_sql(duck, ORACLE_SQL["op5_warc"])
    assert sorted(df.columns) == names and rows_of(df) == want
