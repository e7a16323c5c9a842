"""Secret scans by corpus-wide ownership frequency.

Every whole text is scanned once for candidates: assignments to a name like ``password``, access keys, long runs of
hexadecimal digits (the base kinds, whose spans always stay), and other long tokens with the look of a key. Only hashes
of the candidates travel. They are aggregated over the whole corpus by distinct repositories and owners: a value that
several owners hold is an example that was copied, one that is specific to an owner and looks like a key is live. Tokens
outside the base spans become spans of the kind ``live`` if their value is live.

Null texts count as empty and have no spans. Places are code points, ends exclusive. A null owner or repository counts
as none, so a value that only such rows hold is nobody's example. Repeated rows are rows of their own and of one
repository; an empty table gives an empty result; columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXTS, keep_table

#: Kinds in the order that breaks ties of spans.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Least characters of an assigned value.
ASSIGNED = 6
#: Distinct owners from which on a value is an example that was copied.
EXAMPLE_OWNERS = 3
#: A value looks like a key with so many characters, so many of them distinct, a digit and a letter.
LIVE_CHARS, LIVE_DISTINCT = 16, 10

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("value", T.StringType()), T.StructField("looks_live", T.BooleanType())])


def looks_live(value: str) -> bool:
    return len(value) >= LIVE_CHARS and len(set(value)) >= LIVE_DISTINCT and any("0" <= c <= "9" for c in value) and any(c.isalpha() for c in value)


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base spans, then of the tokens outside of them that look like keys."""
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in found)
    k, reach = 0, 0  # base spans that start before the token's end, and their furthest end
    for m in TOKEN.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][1])
            k += 1
        if reach <= m.start() and looks_live(m[0]):
            found.append(("live", *m.span(), m[0]))
    return found


def scan(docs: DataFrame, owner: Column, repository: Column, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of docs: key, owner, repository and the array of candidate spans, values as hashes of 128 bits."""
    chosen = docs.select(F.col(f"`{key}`").alias("key"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*chosen.schema.fields[:3], T.StructField("spans", T.ArrayType(SPAN))])
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("looks_live", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": kind, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()[:32], "looks_live": looks_live(v)} for kind, a, b, v in candidates(t.as_py() or "")]
                for t in batch.column(3)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, spans_type)], names=schema.names)

    return chosen.mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """Per value: n_spans, n_repositories, n_owners, and the verdict ``example``, ``live`` or ``plain``.

    found: rows of (owner, repository, value, looks_live). Repositories belong to their owners. Counts are added up in
    three steps, each over what the one before has left, so a value that a third of all rows hold is never one group.
    """
    by_repository = found.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"), F.max("looks_live").alias("looks_live"))
    by_owner = by_repository.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count("repository").alias("repositories"), F.max("looks_live").alias("looks_live"))
    summed = by_owner.groupBy("value").agg(F.sum("n").alias("n_spans"), F.sum("repositories").alias("n_repositories"), F.count("owner").alias("n_owners"), F.max("looks_live").alias("looks_live"))
    verdict = F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example").when(F.col("looks_live"), "live").otherwise("plain")
    return summed.select("value", "n_spans", "n_repositories", "n_owners", verdict.alias("verdict"))


def spans_with_verdicts(docs: DataFrame, owner: Column, repository: Column, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of docs: key and spans, an array of (start, order of the kind, kind, end, verdict) in order.

    Base spans are all there; tokens only if they are live. The spans are written once; verdicts join them by value, on
    both sides by a shuffle that Spark may split where one value is frequent.
    """
    found = keep_table(scan(docs, owner, repository, text_col, key).withColumn("row", F.monotonically_increasing_id()), "secrets", TEXTS)
    each = found.select("row", "key", "owner", "repository", F.inline("spans"))
    verdicts = keep_table(ownership(each.select("owner", "repository", "value", "looks_live")).select("value", "verdict"), "ownership")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", order.alias("order"), "kind", "end", "verdict")
    joined = each.join(verdicts, "value").where((F.col("kind") != "live") | (F.col("verdict") == "live"))
    some = joined.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return found.select("row", "key").join(some, "row", "left").select(F.col("key").alias(key), F.coalesce("spans", F.array().cast(some.schema["spans"].dataType)).alias("spans"))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Counts and digest of the base spans, all spans as text, and how many values are live and how many examples."""
    spans = F.col("spans")

    def count(field: str, value: str) -> Column:
        return F.size(F.filter(spans, lambda s: s[field] == value)).cast("long")

    counts = [count("kind", kind).alias(f"n_{kind}") for kind in KINDS[:3]]
    base = F.filter(spans, lambda s: s["kind"] != "live")
    verdicts = count("verdict", "live").alias("n_live"), count("verdict", "example").alias("n_examples")
    found = spans_with_verdicts(docs, owner, repository)
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(spans).alias("spans"), *verdicts)
