"""WARC archives as a chunked record table.

Writing: built-in functions cut a page, at the scan, into rows (record, chunk number, piece). Chunk 0 is the record's
header, its payload follows in pieces of at most CHUNK bytes under HTTP chunked transfer coding, and the last rows end
it. Ids and digests alone are grouped to tell responses from revisits; the pieces are shuffled at most once, by page, and
sorted by record and chunk number. A task then carries the SHA-1 of the payload on from piece to piece, holding one piece at a
time, and checks it against the digest in the header. Spark's text writer writes the pieces with CRLF as line end: every
piece ends with CRLF in the format, so the gzip-packed part files are WARC 1.1 files. Reading: the lines of a file come in
order; a small state machine counts payload bytes and carries the digest on. No Python worker holds a whole record; the
JVM holds one page's html, as the table's cell, and its pieces at the scan.

Of the records with equal payloads of at least min_bytes bytes, the one with the largest page_id is the response, others
are revisits that refer to it. Null html counts as empty. Repeated rows that equal in page_id and payload are written
each with the same type; null page_ids come below all others and are read back as null. Any type of page_id that casts
to text and back will do. An empty table gives no records. Urls lose line ends. Extra columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes in a piece of payload.
CHUNK = 16_384
#: Tasks over which rows of one page_id and payload are dealt.
SALTS = 8
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}"
#: Stands in a header for the digest, which built-in functions do not write in base32.
DIGEST = "{sha1}"
KEYS = ["page_id", "sha", "bytes"]


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, sha, bytes and newest, the page_id of the response to payloads that are equal; html stays at the scan."""
    rows = pages.select("page_id", F.sha1(_payload()).alias("sha"), F.octet_length(_payload()).alias("bytes"))
    newest = rows.where(F.col("bytes") >= min_bytes).groupBy("sha", "bytes").agg(F.max("page_id").alias("newest"))
    return rows.distinct().join(newest, ["sha", "bytes"], "left").select(*KEYS, "newest")


def pieces(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """record, the KEYS, url, chunk and piece; of a page without payload there are a header and an end."""
    rows = pages.select("page_id", "url", _payload().alias("raw"), F.monotonically_increasing_id().alias("record"))
    rows = rows.withColumns({"sha": F.sha1("raw"), "bytes": F.octet_length("raw")})
    n = F.ceil(F.col("bytes") / chunk).cast("int")

    def piece(k: Column) -> Column:
        size = F.least(F.lit(chunk), F.col("bytes") - (k - 1) * chunk)
        return F.concat(F.encode(F.concat(F.lower(F.hex(size)), F.lit(CRLF)), "UTF-8"), F.substring("raw", (k - 1) * chunk + 1, F.lit(chunk)))

    part = lambda k, b: F.struct(k.cast("int").alias("chunk"), b.alias("piece"))
    ends = [part(F.lit(0), F.lit(b"")), part(n + 1, F.lit(b"0\r\n")), part(n + 2, F.lit(b"\r\n"))]
    body = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: part(k, piece(k)))).otherwise(F.array().cast("array<struct<chunk:int,piece:binary>>"))
    found = rows.select("record", *KEYS, "url", n.alias("n"), F.explode(F.concat(body, F.array(*ends))).alias("x"))
    return found.select("record", *KEYS, F.when(F.col("x.chunk") == 0, F.col("url")).alias("url"), "n", "x.*")


def _urn(page_id: Column) -> Column:
    return F.when(page_id.isNull(), "<urn:null>").otherwise(F.concat(F.lit("<urn:page:"), F.url_encode(page_id.cast("string")), F.lit(">")))


def _header(chunk: int) -> Column:
    """The header of a record by url, KEYS, n, revisit and newest."""
    last = F.col("bytes") - (F.col("n") - 1) * chunk
    coded = lambda size: F.length(F.hex(size)) + size + 4
    body = F.when(F.col("revisit"), 0).when(F.col("n") == 0, 5).otherwise((F.col("n") - 1) * (len(f"{chunk:x}") + chunk + 4) + coded(last) + 5)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    target = F.trim(F.regexp_replace(F.coalesce("url", F.lit("")), r"\s+", " "))
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    refers = F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _urn(F.col("newest"))))).otherwise("")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", kind), line("WARC-Record-ID", _urn(F.col("page_id"))), line("WARC-Target-URI", target), line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.lit(f"sha1:{DIGEST}")), line("X-Payload-Length", F.col("bytes").cast("string")), refers,
        line("Content-Type", F.lit("application/http;msgtype=response")), line("Content-Length", (body + len(HTTP) + 2).cast("string")), F.lit(CRLF + HTTP),
    )


def chunk_table(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table: record, chunk, piece and the digest of the payload up to there, sorted in each partition."""
    salted = types(pages, min_bytes).withColumn("salt", F.explode(F.array(*[F.lit(k).cast("long") for k in range(SALTS)])))
    # all pieces of a record come from one row and share the keys of the join, so one task gets them with or without a shuffle
    rows = pieces(pages, chunk).withColumn("salt", F.pmod("record", F.lit(SALTS)))
    same = F.col("x.page_id").eqNullSafe(F.col("y.page_id")) & (F.col("x.sha") == F.col("y.sha")) & (F.col("x.bytes") == F.col("y.bytes")) & (F.col("x.salt") == F.col("y.salt"))
    rows = rows.alias("x").join(salted.alias("y"), same).select("x.*", "y.newest")
    rows = rows.withColumn("revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("newest")) & F.col("newest").isNotNull(), F.lit(False)))
    rows = rows.where("not revisit or chunk = 0 or chunk = n + 2")
    piece = F.when(F.col("chunk") == 0, F.encode(_header(chunk), "UTF-8")).otherwise(F.col("piece"))
    rows = rows.select("record", "chunk", "n", "sha", piece.alias("piece")).sortWithinPartitions("record", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha1()
        for batch in batches:
            done, digests = [], []
            for k, n, sha, piece in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                raw, digest = piece.as_py(), None
                if k == 0:
                    running = hashlib.sha1()
                    raw = raw.replace(DIGEST.encode(), base64.b32encode(bytes.fromhex(sha)), 1)
                elif k <= n:
                    running.update(memoryview(raw)[raw.index(b"\n") + 1 :])
                    digest = running.hexdigest()
                elif k == n + 1 and running.hexdigest() != sha:
                    raise ValueError("the pieces of a payload do not give its digest")
                done.append(raw)
                digests.append(digest)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(done, pa.binary()), pa.array(digests, pa.string())], names=["record", "chunk", "piece", "digest"])

    return rows.mapInArrow(run, "record long, chunk int, piece binary, digest string")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, chunk: int = CHUNK) -> None:
    """Write the records as gzip-packed WARC files, one for each partition."""
    rows = chunk_table(pages, min_bytes, chunk)
    rows.select(F.col("piece").cast("string")).write.option("lineSep", CRLF).option("compression", "gzip").text(path)


class Reader:
    """State machine over the lines of one archive; ``line`` returns a record once it is complete."""

    def __init__(self):
        self.state, self.head, self.left = "start", {}, 0

    def line(self, raw: bytes):
        if self.state == "start":
            if raw == b"WARC/1.1":
                self.state, self.head = "head", {}
                self.sha, self.size = hashlib.sha1(), 0
        elif self.state == "head":
            if raw:
                name, _, value = raw.decode().partition(": ")
                self.head[name] = value
            else:
                self.state = "http"
        elif self.state == "http":
            if not raw:
                self.state = "size" if self.head["WARC-Type"] == "response" else "end"
        elif self.state == "size":
            self.left = int(raw, 16)
            self.state = "data" if self.left else "last"
        elif self.state == "data":
            if len(raw) < self.left:  # the payload itself has CRLF here
                raw += b"\r\n"
            elif len(raw) == self.left:  # the line end is the piece's own
                self.state = "size"
            if len(raw) > self.left:
                raise ValueError(f"a piece of {self.head.get('WARC-Record-ID')} is longer than its length says")
            self.sha.update(raw)
            self.size += len(raw)
            self.left -= len(raw)
        elif self.state == "last":
            self.state = "end"
        if self.state == "end" and not raw:
            self.state = "start"
            return self.record()
        return None

    def record(self) -> tuple:
        ident = lambda v: None if v in (None, "<urn:null>") else unquote_plus(v[len("<urn:page:") : -1])
        kind, digest = self.head["WARC-Type"], self.head["WARC-Payload-Digest"].removeprefix("sha1:")
        ok, size = True, int(self.head["X-Payload-Length"])
        if kind == "response":
            found = base64.b32encode(self.sha.digest()).decode()
            ok = found == digest and self.size == size
            digest, size = found, self.size
        return ident(self.head["WARC-Record-ID"]), size, digest, kind, ident(self.head.get("WARC-Refers-To")), ok


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """One row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok.

    Packed files cannot be split, so one task sees a file's lines in order.
    """
    lines = spark.read.option("lineSep", CRLF).text(path).select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"]
        file, reader = None, Reader()
        for batch in batches:
            out = []
            for raw, at in zip(batch.column(0), batch.column(1).to_pylist()):
                if at != file:
                    file, reader = at, Reader()
                if (found := reader.line(raw.as_py())) is not None:
                    out.append(found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    found = lines.mapInArrow(run, "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string, digest_ok boolean")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive(pages: DataFrame, path: str, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write pages to WARC files under path, and read them back."""
    write_archives(pages, path, min_bytes, chunk)
    return read_archives(pages.sparkSession, path, dict(pages.dtypes)["page_id"])
