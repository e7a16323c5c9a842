"""Document fingerprints by content-defined chunking.

A gear hash over the last bytes puts chunk boundaries where its masked bits are zero; the mask is stricter before the
normal size than behind it, within least and most sizes. The fingerprint is the set of chunk digests with lengths, as
text: ``digest:length`` for each distinct chunk, in order of digest. Likeness of two fingerprints is the length of the
chunks they share over the lesser of their lengths (containment): an insertion moves only the boundaries near it.

Null counts as empty; the empty text's fingerprint is empty, its likeness is 1 to another empty one and 0 to others.
Equal texts have equal fingerprints. Next documents go by (doc_id, text); rows without an id stand first and each
repeated row is its own document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions

#: Chunk sizes in bytes.
LEAST, NORMAL, MOST = 16, 64, 256
#: Boundary masks: strict before the normal size (8 bits), loose behind it (4 bits).
STRICT, LOOSE = 0xFF000000, 0xF0000000
#: The gear: 256 pseudo-random 32-bit numbers from a rule.
GEAR = np.frombuffer(b"".join(hashlib.sha256(b"gear%d" % i).digest()[:4] for i in range(256)), dtype="<u4")
#: Bytes hashed at a time.
BLOCK = 1 << 20


def _candidates(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions behind bytes at which the strict mask is met, and the loose one."""
    strict, loose = [], []
    for lo in range(0, len(raw), BLOCK):
        back = min(lo, 31)  # the hash at a byte depends on 32 bytes
        h = GEAR[raw[lo - back : lo + BLOCK]]
        for k in (1, 2, 4, 8, 16):
            h[k:] += h[:-k] << np.uint32(k)
        h = h[back:]
        at = np.flatnonzero((h & np.uint32(LOOSE)) == 0)
        loose.append(at + lo + 1)
        strict.append(at[(h[at] & np.uint32(STRICT)) == 0] + lo + 1)
    return (np.concatenate(strict), np.concatenate(loose)) if loose else (np.zeros(0, np.int64),) * 2


def boundaries(raw: bytes) -> list[int]:
    """Ends of the chunks."""
    strict, loose = (x.tolist() for x in _candidates(np.frombuffer(raw, np.uint8)))
    strict.append(len(raw) + MOST)
    loose.append(len(raw) + MOST)
    ends, start, s, e, n = [], 0, 0, 0, len(raw)
    while n - start > LEAST:
        while strict[s] < start + LEAST:
            s += 1
        if strict[s] < start + NORMAL:
            end = strict[s]
        else:
            while loose[e] < start + NORMAL:
                e += 1
            end = min(loose[e], start + MOST)
        if end >= n:
            break
        ends.append(end)
        start = end
    return [*ends, n] if n else []


def chunks(text: str | None) -> dict[int, int]:
    """Length by digest of the distinct chunks."""
    import xxhash

    raw = (text or "").encode("utf-8", "surrogatepass")
    digest, found, a = xxhash.xxh3_64_intdigest, {}, 0
    for b in boundaries(raw):
        found[digest(raw[a:b])] = b - a
        a = b
    return found


def as_text(found: dict[int, int]) -> str:
    return " ".join(f"{d:016x}:{n}" for d, n in sorted(found.items()))


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    if len(b) < len(a):
        a, b = b, a
    return sum(n for d, n in a.items() if d in b) / min(sum(a.values()), sum(b.values()))


def fingerprint_documents(df: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """df with the fingerprint of each whole text; a column of that name is replaced."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()])
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([as_text(chunks(t.as_py())) for t in texts], pa.string())], names=schema.names)

    return kept.mapInArrow(run, schema)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in ranges of doc_id, each range closed by a copy (ghost) of the row that follows it.

    The ranges' bounds are quantiles of doc_id; their number follows the session's shuffle partitions. Columns:
    range, ghost, doc_id, text; sorted by these within each partition, so that neighbours follow each other.
    """
    spark = docs.sparkSession
    n = 4 * shuffle_partitions(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = docs.select("doc_id").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.2 / n) if docs.schema["doc_id"].dataType != T.StringType() else []
    bounds = sorted({int(b) for b in bounds})
    cut_points = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    ranged = rows.withColumn("range", F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(cut_points, lambda b: b <= F.col("doc_id")))))
    heads = {r["range"]: r["first"] for r in ranged.groupBy("range").agg(F.min("doc_id").alias("first")).collect()}
    order = sorted(heads)
    follows = dict(zip(order[1:] + order[:1], order))  # range -> the range before it, around the circle
    if not order:
        return ranged.select("range", F.lit(False).alias("ghost"), "doc_id", "text").limit(0)
    is_first = F.col("doc_id").isin([heads[r] for r in order if r != -1])
    marked = rows.where(is_first | F.col("doc_id").isNull() if -1 in heads else is_first)
    ghost_range = F.create_map(*[F.lit(x) for r in order for x in ("null" if r == -1 else str(heads[r]), follows[r])])[F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))]
    ghosts = marked.groupBy("doc_id").agg(F.min("text").alias("text")).select(ghost_range.alias("range"), F.lit(True).alias("ghost"), "doc_id", "text")
    spread = ranged.select("range", F.lit(False).alias("ghost"), "doc_id", "text").unionByName(ghosts)
    return spread.repartition(shuffle_partitions(spark), "range").sortWithinPartitions("range", "ghost", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """text with its last half replaced by as many first code points of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Per row of docs: fingerprints of the text and of its edited form, and likeness to that and to the next document."""
    ordered = with_next(docs)
    fields = [("doc_id", None), ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()), ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType())]
    schema = T.StructType([docs.schema["doc_id"] if t is None else T.StructField(c, t) for c, t in fields])

    def compared(held: tuple, text: str, found: dict[int, int]) -> list:
        doc_id, own, mine = held
        changed = edited(own, text)
        other = chunks(changed)
        return [doc_id, len(own), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_text(mine), as_text(other), likeness(mine, other), likeness(mine, found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = None, None
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                r, ghost, doc_id, text = (batch.column(c)[k].as_py() for c in range(4))
                found = chunks(text)
                if held is not None and place == r:
                    out.append(compared(held, text, found))
                held, place = (None, None) if ghost else ((doc_id, text, found), r)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)

    return ordered.mapInArrow(run, schema)
