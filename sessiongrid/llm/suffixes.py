"""Exact removal of repeated substrings with a distributed, sparse suffix array.

A byte goes if a string of ``window`` bytes that also starts elsewhere (in any document) covers it. Not every suffix is
sorted. Each window has an anchor, the place of its lowest hashed GRAM bytes, so equal windows have their anchors at the
same offset; the windows that share an anchor form a chunk of text around it. The steps:

1. Chunks are hashed where they are read, counted within a batch (so copies shrink before the shuffle), and dealt by the
   anchor's gram. A gram seen once rules its chunk out; equal chunks repeat as a whole; what is left are chunks that
   share a gram but differ somewhere. One of each distinct kind goes on.
2. Their texts are fetched, and their suffixes range-partitioned by leading bytes with sampled splitters
   (repartitionByRange). Each bucket sorts its windows by multikey quicksort, eight bytes at a time: runs of equal keys
   go one level deeper, single ones drop out. Windows equal to the end are repeated.
3. A run of one gram may lie across a boundary. For the first and last gram of each bucket the digests of the distinct
   windows are dealt by gram and digest and compared between buckets.
4. The ranges of repeated windows go back to all chunks of equal content, and from there to the documents.

Null counts as empty; shorter texts than the window keep everything. Documents with one id and different texts are told
apart; repeated rows are copies of each other, so what they share goes. Tables may be empty. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, keep_table, shuffle_partitions

WINDOW, GRAM = 200, 64
#: Bytes hashed together in a task, so that its arrays fit a cache; longer texts are taken in overlapping pieces.
BLOCK = 1 << 16
#: Rows of chunks that a bucket sorts at the same time (whole grams).
TOGETHER = 2_000
#: A window at a boundary between buckets: digest, chunk, offset, and whether its bucket has no other like it.
EDGE = np.dtype([("d1", "<i8"), ("d2", "<i8"), ("chunk", "<i8"), ("k", "<i4"), ("alone", "?")])
#: Bytes of documents that a task returns at a time.
RETURNED = 4_000_000


class Hashes:
    """Two independent polynomial hashes, modulo 2**64, of any substring of a block."""

    def __init__(self, size: int):
        rng = np.random.default_rng(20240229)
        self.tables, self.powers, self.inverses = [], [], []
        for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
            self.tables.append(rng.integers(1, 1 << 63, 256, dtype=np.uint64))
            for store, b in ((self.powers, base), (self.inverses, pow(base, -1, 1 << 64))):
                steps = np.full(size + 1, b, np.uint64)
                steps[0] = 1
                store.append(np.multiply.accumulate(steps))

    def prefix(self, which: int, raw: np.ndarray) -> np.ndarray:
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.tables[which][raw] * self.powers[which][: len(raw)], out=out[1:])
        return out

    def of(self, which: int, prefix: np.ndarray, start, end) -> np.ndarray:
        h = (prefix[end] - prefix[start]) * self.inverses[which][start]
        h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def chunks(raw: np.ndarray, sizes: np.ndarray, hashes: Hashes, window: int, gram: int):
    """Of texts that stand in raw one behind the other: text number, start, windows, anchor, gram hash, chunk hash."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(raw) < window:
        return none
    begin = np.cumsum(sizes) - sizes
    fit = np.flatnonzero(sizes >= window)
    count = sizes[fit] - window + 1
    if not len(fit):
        return none
    text = np.repeat(fit, count)
    p = np.arange(int(count.sum())) + np.repeat(begin[fit] - (np.cumsum(count) - count), count)
    of_gram, of_chunk = hashes.prefix(0, raw), hashes.prefix(1, raw)
    at = np.arange(len(raw) - gram + 1)
    g = hashes.of(0, of_gram, slice(0, len(at)), slice(gram, len(raw) + 1))
    low = np.uint64((1 << 22) - 1)  # of equal grams the leftmost is the anchor
    anchor = (_sliding_min((g & ~low) | at.astype(np.uint64), window - gram + 1)[p] & low).astype(np.int64)
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(p)))
    start, anchor, text = p[first], anchor[first], text[first]
    return text, start - begin[text], n, anchor - start, g[anchor], hashes.of(1, of_chunk, start, start + n - 1 + window)


def _pieces(values: list[bytes], window: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in blocks: row numbers, offsets and bytes; pieces of a long text overlap so that each window is in one."""
    rows, offsets, parts, held = [], [], [], 0
    for k, v in enumerate(values):
        for lo in range(0, max(1, len(v) - window + 1), BLOCK - window + 1):
            part = v[lo : lo + BLOCK]
            if held + len(part) > BLOCK and rows:
                yield rows, offsets, parts
                rows, offsets, parts, held = [], [], [], 0
            rows.append(k)
            offsets.append(lo)
            parts.append(part)
            held += len(part)
    if rows:
        yield rows, offsets, parts


def _with_key(docs: DataFrame) -> DataFrame:
    """doc_id, tag (the text's hash, tells apart texts of one id) and the text's bytes."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("tag"), F.encode(text, "UTF-8").alias("raw"))


#: Start and number of windows of a chunk in one integer.
def _place(start, n):
    return start << 8 | n


def chunk_rows(docs: DataFrame, window: int, gram: int, combine: bool) -> DataFrame:
    """gram, chunk (hashes), doc_id, tag, place, copies: each chunk, or with combine one of each kind in a batch."""
    if not gram < window < gram + 256:
        raise ValueError("a chunk has 255 windows at most")
    keyed = _with_key(docs)
    schema = T.StructType([T.StructField("gram", T.LongType()), T.StructField("chunk", T.LongType()), docs.schema["doc_id"], T.StructField("tag", T.LongType()), T.StructField("place", T.LongType()), T.StructField("copies", T.LongType()), T.StructField("anchor", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(BLOCK)
        for batch in batches:
            for rows, offsets, parts in _pieces(batch.column(2).to_pylist(), window):
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                text, start, n, anchor, g, c = chunks(np.frombuffer(b"".join(parts), np.uint8), sizes, hashes, window, gram)
                row, copies = np.array(rows)[text], np.ones(len(text), np.int64)
                place = _place(start + np.array(offsets)[text], n)
                if combine and len(c):
                    order = np.lexsort((g, c))
                    edge = np.ones(len(c), bool)
                    edge[1:] = (c[order][1:] != c[order][:-1]) | (g[order][1:] != g[order][:-1])
                    kept = np.flatnonzero(edge)
                    copies = np.diff(np.append(kept, len(c)))
                    kept = order[kept]
                    g, c, row, place, anchor = g[kept], c[kept], row[kept], place[kept], anchor[kept]
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(place), pa.array(copies), pa.array(anchor, pa.int32())], names=schema.names)

    return keyed.mapInArrow(run, schema)


def _fetched(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The texts of chunks: gram, chunk, whole (repeated as it is), anchor (offset), text."""
    places = wanted.select("doc_id", "tag", F.struct(F.col("gram"), F.col("chunk"), (F.col("copies") > 1).alias("whole"), F.col("anchor"), F.shiftright("place", 8).alias("start"), F.col("place").bitwiseAND(F.lit(255)).alias("n")).alias("c"))
    by_doc = places.groupBy("doc_id", "tag").agg(F.collect_list("c").alias("cs"))
    keyed = _with_key(docs)
    joined = keyed.join(by_doc, keyed["doc_id"].eqNullSafe(by_doc["doc_id"]) & (keyed["tag"] == by_doc["tag"])).select("raw", "cs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "chunk", "whole", "anchor", "text"]
        for batch in batches:
            for raw, cs in zip(batch.column(0), batch.column(1)):
                raw, cs = raw.as_py(), cs.as_py()
                texts = [raw[c["start"] : c["start"] + c["n"] - 1 + window] for c in cs]
                yield pa.RecordBatch.from_arrays([pa.array([c["gram"] for c in cs], pa.int64()), pa.array([c["chunk"] for c in cs], pa.int64()), pa.array([c["whole"] for c in cs], pa.bool_()), pa.array([c["anchor"] for c in cs], pa.int32()), pa.array(texts, pa.binary())], names=names)

    return joined.mapInArrow(run, "gram long, chunk long, whole boolean, anchor int, text binary")


def _words(buf: np.ndarray) -> np.ndarray:
    """At each place, its eight bytes as a number that sorts as they do."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    out = np.zeros(len(buf), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(buf)]
    return out


def _repeats(active: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the runs of one member; run counts from 0 and is sorted."""
    more = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
    active, run = active[more], run[more]
    return active, np.cumsum(np.append(True, run[1:] != run[:-1])) - 1 if len(run) else run


def equal_windows(words: np.ndarray, at: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Class number of each window that equals another of its group, -1 of single ones; by multikey quicksort.

    All runs are partitioned at the same time, each by the next eight bytes of the member in its middle. Members equal
    to that pivot go a level deeper, lesser and greater ones are runs of their own at the same level; runs of one leave.
    """
    result, classes = np.full(len(at), -1, np.int64), 0
    order = np.argsort(group, kind="stable")
    run = np.unique(group[order], return_inverse=True)[1] if len(order) else order
    stack = [(0, *_repeats(order, run))]
    levels = -(-window // 8)
    while stack:
        depth, active, run = stack.pop()
        while len(active) and depth < levels:
            back = max(0, 8 * (depth + 1) - window)  # the last key overlaps the one before
            key = words[at[active] + (8 * depth - back)]
            begin = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            size = np.diff(np.append(begin, len(run)))
            pivot = key[begin + size // 2][run]
            same = key == pivot
            if not same.all():
                aside = ~same
                part = run[aside] * 2 + (key[aside] > pivot[aside])
                way = np.argsort(part, kind="stable")
                stack.append((depth, *_repeats(active[aside][way], np.unique(part[way], return_inverse=True)[1])))
                active, run = active[same], run[same]
                active, run = _repeats(active, np.unique(run, return_inverse=True)[1])
            depth += 1
        if len(active):
            result[active] = classes + run
            classes += int(run[-1]) + 1
    return result


def _sort_bucket(window: int, ranges: int):
    """A task's work on a bucket: rows sorted by leading bytes, gram and chunk in; ranges and boundary windows out.

    Boundary windows come packed, a value for each gram and each of ``ranges`` ranges of digests.
    """
    names = ["gram", "chunk", "first", "last", "part", "edge"]

    def sort(rows: list, edge_grams: set[int]) -> Iterator[pa.RecordBatch]:
        g, c, whole, anchor, texts = rows
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        n = sizes - window + 1
        begin = np.cumsum(sizes) - sizes
        buf = np.frombuffer(b"".join(texts), np.uint8)
        of = np.repeat(np.arange(len(texts)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        new = np.ones(len(g), bool)
        new[1:] = g[1:] != g[:-1]
        group = np.cumsum(new)[of] * 1024 + (anchor[of] - k + 512)  # equal windows have their anchors at the same offset
        classes = equal_windows(_words(buf), begin[of] + k, group, window)
        hit = (classes >= 0) & ~whole[of]
        at = np.flatnonzero(hit)
        if len(at):
            cuts = np.ones(len(at), bool)
            cuts[1:] = (at[1:] != at[:-1] + 1) | (of[at][1:] != of[at][:-1])
            lo = np.flatnonzero(cuts)
            hi = np.append(lo[1:], len(at)) - 1
            owner = of[at[lo]]
            yield pa.RecordBatch.from_arrays([pa.array(g[owner]), pa.array(c[owner]), pa.array(k[at[lo]], pa.int32()), pa.array(k[at[hi]], pa.int32()), pa.nulls(len(lo), pa.int32()), pa.nulls(len(lo), pa.binary())], names=names)
        if edge_grams:
            edge = np.flatnonzero(np.isin(g, list(edge_grams))[of])
            single = edge[classes[edge] < 0]
            shared = edge[classes[edge] >= 0]
            shared = shared[np.unique(classes[shared], return_index=True)[1]]
            chosen = np.concatenate([single, shared])
            alone = np.concatenate([~whole[of[single]], np.zeros(len(shared), bool)])
            if len(chosen):
                yield packed(g, c, of, k, begin, buf, chosen, alone)

    def packed(g, c, of, k, begin, buf, chosen, alone) -> pa.RecordBatch:
        """One value for each gram and range of digests: the digests of its windows with chunk, offset and alone."""
        digests = np.array([np.frombuffer(hashlib.blake2b(buf[a : a + window].tobytes(), digest_size=16).digest(), np.int64) for a in (begin[of] + k)[chosen].tolist()])
        rows = np.zeros(len(chosen), EDGE)
        rows["d1"], rows["d2"], rows["chunk"], rows["k"], rows["alone"] = digests[:, 0], digests[:, 1], c[of[chosen]], k[chosen], alone
        owner, part = g[of[chosen]], (digests[:, 0].view(np.uint64) % np.uint64(ranges)).astype(np.int32)
        order = np.lexsort((part, owner))
        rows, owner, part = rows[order], owner[order], part[order]
        cut_at = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])))
        values = [rows[i:j].tobytes() for i, j in zip(cut_at.tolist(), [*cut_at[1:].tolist(), len(rows)])]
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array(owner[cut_at]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.array(part[cut_at]), pa.array(values, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), batch.column(4).to_pylist()]
            held = new if held is None else [*(np.concatenate(x) for x in zip(held[:4], new[:4])), held[4] + new[4]]
            first = int(held[0][0]) if first is None else first
            if len(held[0]) >= TOGETHER:
                other = np.flatnonzero(held[0] != held[0][-1])
                done = int(other[-1]) + 1 if len(other) else 0  # the last gram may go on
                if done:
                    yield from sort([x[:done] for x in held], {first})
                    held = [x[done:] for x in held]
        if held is not None:
            yield from sort(held, {first, int(held[0][-1])})

    return run


def _compare_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed windows sorted by gram and range in; ranges of the windows that two buckets have out."""
    last, held = None, []

    def compare() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        order = np.lexsort((rows["d2"], rows["d1"]))
        rows = rows[order]
        same = (rows["d1"][1:] == rows["d1"][:-1]) & (rows["d2"][1:] == rows["d2"][:-1])
        found = rows[(np.append(same, False) | np.append(False, same)) & rows["alone"]]
        if len(found):
            gram = pa.array(np.full(len(found), last[0], np.int64))
            yield pa.RecordBatch.from_arrays([gram, pa.array(found["chunk"]), pa.array(found["k"]), pa.array(found["k"])], names=["gram", "chunk", "first", "last"])

    for batch in batches:
        for gram, part, edge in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (gram, part) != last:
                if len(held) > 1:
                    yield from compare()
                last, held = (gram, part), []
            held.append(np.frombuffer(edge, EDGE))
    if len(held) > 1:
        yield from compare()


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, tag, first, last): inclusive ranges of starts of repeated windows."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    dealt = chunk_rows(docs, window, gram, True).repartition(parts, "gram")
    kinds = dealt.groupBy("gram", "chunk").agg(F.sum("copies").alias("copies"), F.first("doc_id").alias("doc_id"), F.first("tag").alias("tag"), F.first("place").alias("place"), F.first("anchor").alias("anchor"))
    grams = dealt.groupBy("gram").agg(F.sum("copies").alias("total"), (F.min("chunk") != F.max("chunk")).alias("differ")).where("total > 1")
    kinds = keep_table(kinds.join(grams, "gram").select("gram", "chunk", "copies", "doc_id", "tag", "place", "anchor", "differ"), "kinds")
    mixed = kinds.where("differ")
    texts = keep_table(_fetched(docs, mixed, window), "chunks")
    order = [F.expr("substring(text, anchor + 1, 16)"), "gram", "chunk"]  # leading bytes of the suffix first
    buckets = texts.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = cut(buckets.mapInArrow(_sort_bucket(window, parts), "gram long, chunk long, first int, last int, part int, edge binary"))
    edges = found.where(F.col("edge").isNotNull()).select("gram", "part", "edge").repartition(parts, "gram", "part").sortWithinPartitions("gram", "part")
    across = edges.mapInArrow(_compare_edges, "gram long, chunk long, first int, last int")
    part = found.where(F.col("edge").isNull()).select("gram", "chunk", "first", "last").unionByName(across)
    whole = kinds.where("copies > 1").select("gram", "chunk", F.lit(0).alias("first"), (F.col("place").bitwiseAND(F.lit(255)) - 1).cast("int").alias("last"))
    everywhere = chunk_rows(docs, window, gram, False).select("gram", "chunk", "doc_id", "tag", "place")
    start = F.shiftright("place", 8)
    return everywhere.join(whole.unionByName(part), ["gram", "chunk"]).select("doc_id", "tag", (start + F.col("first")).alias("first"), (start + F.col("last")).alias("last"))


def spans(first: np.ndarray, last: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that windows starting in these ranges cover."""
    out: list[tuple[int, int]] = []
    for k in np.argsort(first, kind="stable").tolist():
        a, b = int(first[k]), int(last[k]) + window
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, removed (spans of bytes) and kept, the bytes that stay."""
    marks = repeated(docs, window, gram).groupBy("doc_id", "tag").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    keyed = _with_key(docs)
    joined = keyed.join(marks, keyed["doc_id"].eqNullSafe(marks["doc_id"]) & (keyed["tag"] == marks["tag"]), "left").select(keyed["doc_id"], "raw", "first", "last")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("removed", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, kept, at, held = [], [], [], 0, 0
            for k, (raw, first, last) in enumerate(zip(batch.column(1), batch.column(2), batch.column(3))):
                raw = raw.as_py()
                gone = spans(first.values.to_numpy(), last.values.to_numpy(), window) if first.is_valid else []
                sizes.append(len(raw))
                removed.append([{"start": a, "end": b} for a, b in gone])
                ends = [0, *(x for s in gone for x in s), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2])))
                held += len(raw)
                if held > RETURNED or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(removed, span_type), pa.array(kept, pa.binary())], names=schema.names)
                    at, held = k + 1, 0
                    sizes, removed, kept = [], [], []

    return joined.mapInArrow(run, schema)


def report(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    done = remove_repeats(docs, window, gram)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
