"""Alignment of two tokenizers' tokens by union-find over the graph of tokens that overlap.

Each text is cut by a byte-level BPE (A, over a blank and the text) and by a piece model (B, which adds that blank). Tokens
of both sides whose byte ranges overlap are the edges of a bipartite graph; its connected components, found by
union-find, are the minimal groups: stretches between places where both sides end a token. The members of a component
expand to links, all pairs of its A and its B tokens, counted as pairs of ids with their multiplicities, so a group of
many repeated tokens stays small.

Texts are taken in units of a few million characters at most. A unit counts its documents for each pair of ids that it
holds, these counts are added up over the corpus, and joined back to each unit's pairs: no key has more rows than
there are units. A unit and its pairs meet by the unit's number.

Null and empty texts, and texts whose tokens' bytes on a side differ from the blank and the text, have no tokens: zeros
and an empty ``groups``. Repeated rows and rows without an id are documents of their own. An empty table gives an empty
result; columns other than those named are ignored. Tables hold units, not documents, until the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SLICE_CHARS, ByteBPE, gather
from .common import TEXTS, keep_table

#: Characters from which on a unit is full; a longer text is one of its own or the last of one.
UNIT_CHARS = 2_000_000
#: Texts that go to Python at once; tokenizers do better on many, and take SLICE_CHARS characters of them at a time.
ROWS = 4 * TEXTS
#: Pairs of ids expanded at once.
BLOCK = 1 << 21
#: Bits of B's ids in a pair, the bits above are A's id.
B_BITS = 20
#: B's mark of a blank (fixed value of piece models).
MARK = "▁"


class PlainBPE(ByteBPE):
    """Byte-level BPE that takes the strings of special tokens as ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special, self._special = {}, None


class _Bytes:
    """Bytes and decimal digits of a vocabulary's ids."""

    def __init__(self, entries: list[bytes]):
        self.length, self.at, self.flat = self._laid_out(entries)
        self.digits_length, self.digits_at, self.digits = self._laid_out([b"%d," % i for i in range(len(entries))])

    @staticmethod
    def _laid_out(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        length = np.array(list(map(len, entries)), np.int64)
        return length, np.cumsum(length) - length, np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.at[ids], self.length[ids]).tobytes()


class Tokenizers:
    """The two tokenizers with the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self._a, self._b = PlainBPE(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a = _Bytes(self._a.token_bytes())
        pieces = self._b.id_to_piece(list(range(self._b.get_piece_size())))
        self.b = _Bytes([bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per text the ids of A and of B; none on both sides where the text is empty or a side's bytes differ from it."""
        a_ids = [x.astype(np.int64) for x in self._a.encode_batch([" " + t for t in texts])]
        b_ids = [np.array(x, np.int64) for x in self._b.encode(texts, num_threads=1)]
        for k, t in enumerate(texts):
            raw = (" " + t).encode()
            if not t or self.a.joined(a_ids[k]) != raw or self.b.joined(b_ids[k]) != raw:
                a_ids[k] = b_ids[k] = np.zeros(0, np.int64)
        return a_ids, b_ids


def components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Union-find: per node the least node of its component. left and right are the ends of the edges.

    Roots hook onto the least root that an edge leads to, then every node's path is halved until it points to its root.
    """
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        differ = a != b
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if np.array_equal(above, root):
                break
            root = above
    return root


def groups(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each A and of each B token, numbered from 0 in their order, from the tokens' lengths in bytes."""
    n_a, a_end, b_end = len(a_len), np.cumsum(a_len), np.cumsum(b_len)
    first = np.searchsorted(b_end, a_end - a_len, side="right")  # the B token that holds the A token's first byte
    count = np.searchsorted(b_end, a_end, side="left") - first + 1
    left = np.repeat(np.arange(n_a), count)
    right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    root = components(n_a + len(b_len), left, n_a + right)
    number = np.cumsum(root[:n_a] == np.arange(n_a)) - 1  # a component's least node is its first A token
    return number[root[:n_a]], number[root[n_a:]]


def _counted(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, id) in order, with their numbers of tokens."""
    keys, n = np.unique(group << B_BITS | ids, return_counts=True)
    return keys >> B_BITS, keys & ((1 << B_BITS) - 1), n


def links(a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, number of links) of the distinct pairs of each document, in this order.

    doc: document of each group. A pair is the A id in the bits above B_BITS and the B id below. Groups expand BLOCK pairs at a time;
    those of a larger one are expanded in rows of its A ids.
    """
    ga, a, na = _counted(a_group, a_ids)
    gb, b, nb = _counted(b_group, b_ids)
    size = np.bincount(gb, minlength=len(doc))
    first = np.cumsum(size) - size
    count, at = size[ga], first[ga]  # each distinct A id of a group meets the group's distinct B ids
    total = np.cumsum(count)
    span = 2 * B_BITS
    done: list[tuple[np.ndarray, np.ndarray]] = []
    lo = 0
    while lo < len(ga):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + BLOCK, side="right")))
        c = count[lo:hi]
        row = np.repeat(np.arange(lo, hi), c)
        col = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(at[lo:hi], c)
        done.append(_summed(doc[ga[row]] << span | a[row] << B_BITS | b[col], na[row] * nb[col]))
        if len(done) > 1 and len(done[-1][0]) >= len(done[-2][0]):  # sums stay about as large as their distinct pairs
            (k1, n1), (k2, n2) = done.pop(), done.pop()
            done.append(_summed(np.concatenate([k2, k1]), np.concatenate([n2, n1])))
        lo = hi
    keys, n = _summed(np.concatenate([k for k, _ in done]), np.concatenate([x for _, x in done])) if done else (np.zeros(0, np.int64),) * 2
    return keys >> span, keys & ((1 << span) - 1), n


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(n, heads) if len(heads) else n


def groups_as_text(a: _Bytes, b: _Bytes, a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;...`` of all groups as bytes, and the end in it of each group, whose last sign is a semicolon."""
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    length = np.concatenate([a.digits_length[a_ids], b.digits_length[b_ids]])[order]
    flat = np.concatenate([a.digits, b.digits])
    text = gather(flat, np.concatenate([a.digits_at[a_ids], b.digits_at[b_ids] + len(a.digits)])[order], length)
    ends = np.cumsum(length)
    n_a, n_b = np.bincount(a_group), np.bincount(b_group)
    last_b = np.cumsum(n_a + n_b)
    text[ends[last_b - n_b - 1] - 1] = ord("|")
    text[ends[last_b - 1] - 1] = ord(";")
    return text, ends[last_b - 1]


def packed(x: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs, behind the name of their type."""
    kind = next(k for k in ("u1", "u2", "u4", "u8") if not len(x) or int(x.max()) < 1 << 8 * int(k[1]))
    return kind.encode() + x.astype(f"<{kind}").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<{raw[:2].decode()}", offset=2).astype(np.int64)


def _stretches(sizes: list[int], full: int) -> Iterator[tuple[int, int]]:
    """(start, end) of consecutive texts, each stretch ending with the text that makes it full."""
    start, total = 0, 0
    for k, n in enumerate(sizes):
        total += n
        if total >= full or k + 1 == len(sizes):
            yield start, k + 1
            start, total = k + 1, 0


def aligned_units(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows of units: arrays over the unit's documents (key, numbers of tokens, groups and links, digest of the groups,
    links as packed numbers), and its distinct pairs of ids with how many of its documents hold them linked.

    ``places`` and ``times`` of a document: which of the unit's pairs it holds (as differences) and how many links.
    """
    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text_col}`").alias("text"))
    numbers = ("n_a", "n_b", "n_groups", "n_links")
    schema = T.StructType(
        [T.StructField("key", T.ArrayType(chosen.schema["key"].dataType)), *[T.StructField(c, T.ArrayType(T.LongType())) for c in numbers], T.StructField("digest", T.ArrayType(T.StringType()))]
        + [T.StructField(c, T.ArrayType(T.BinaryType())) for c in ("places", "times")] + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "n_docs")]
    )

    def unit(model: Tokenizers, keys: pa.Array, a_ids: list[np.ndarray], b_ids: list[np.ndarray]) -> pa.RecordBatch:
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a_ids, b_ids))
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_group, b_group = groups(model.a.length[a], model.b.length[b])
        last = np.cumsum(n_a) - 1  # of each document, its last A token
        edge = np.concatenate([a_group, [-1]])[np.where(n_a > 0, last, -1)] + 1  # and the groups up to its end
        edge = np.maximum.accumulate(edge)
        n_groups = np.diff(np.concatenate([[0], edge]))
        doc = np.repeat(np.arange(len(keys)), n_groups)
        held, pair, times = links(a_group, a, b_group, b, doc)
        pairs, place, n_docs = np.unique(pair, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(held, np.arange(len(keys) + 1))
        text, ends = groups_as_text(model.a, model.b, a_group, a, b_group, b) if len(a) else (np.zeros(0, np.uint8), np.zeros(0, np.int64))
        ends = np.concatenate([[0], ends])
        row = {"n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": n_groups.tolist(), "n_links": [], "digest": [], "places": [], "times": [], "pairs": pairs, "n_docs": n_docs}
        for k in range(len(keys)):
            lo, hi = cuts[k : k + 2].tolist()
            row["n_links"].append(int(times[lo:hi].sum()))
            row["places"].append(packed(np.diff(place[lo:hi], prepend=0)))
            row["times"].append(packed(times[lo:hi]))
            written = text[ends[edge[k] - n_groups[k]] : ends[edge[k]]]
            row["digest"].append(hashlib.sha256(written[:-1].tobytes()).hexdigest() if len(written) else "")
        types = {f.name: pa.list_(pa.int64()) for f in schema.fields} | {"digest": pa.list_(pa.string()), "places": pa.list_(pa.binary()), "times": pa.list_(pa.binary())}
        whole = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
        return pa.RecordBatch.from_arrays([whole, *[pa.array([row[c]], types[c]) for c in schema.names[1:]]], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tokenizers(a_path, b_path)
        for batch in batches:
            sizes = [len(t.as_py() or "") for t in batch.column(1)]
            for start, stop in _stretches(sizes, SLICE_CHARS):
                a_ids, b_ids = model.encode([t.as_py() or "" for t in batch.column(1).slice(start, stop - start)])
                for lo, hi in _stretches(sizes[start:stop], UNIT_CHARS):
                    yield unit(model, batch.column(0).slice(start + lo, hi - lo), a_ids[lo:hi], b_ids[lo:hi])

    return chosen.mapInArrow(run, schema).withColumn("unit", F.monotonically_increasing_id())


def pair_counts(units: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents of the corpus hold the pair linked, and whether no pair of its A id has more.

    The highest counts are broadcast: there are as many at most as A has ids.
    """
    counted = units.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.n_docs").alias("n"))
    counts = keep_table(counted.withColumn("a", F.shiftright("pair", B_BITS)), "pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    n_best: links whose count is the highest of their A id,
    count_sum: the counts of all links added up.
    """
    units = keep_table(aligned_units(docs, a_path, b_path), "units", ROWS)
    known = pair_counts(units)
    theirs = units.select(F.col("unit").alias("holder"), F.explode("pairs").alias("pair")).join(known, "pair").select("holder", "pair", "n", "best")
    own = units.select("unit", "key", "n_a", "n_b", "n_groups", "n_links", "digest", "places", "times")
    longs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("groups_sha256", T.StringType())])

    def judged(left: pa.Table, right: pa.Table) -> pa.Table:
        """The unit's row, and its pairs with their counts."""
        order = np.argsort(right["pair"].to_numpy())
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy()[order].astype(np.int64)
        value = lambda c: left[c].combine_chunks()[0].values
        n_best, count_sum = [], []
        for places, times in zip(value("places"), value("times")):
            at, each = np.cumsum(unpacked(places.as_py())), unpacked(times.as_py())
            n_best.append(int((each * best[at]).sum()))
            count_sum.append(int((each * n[at]).sum()))
        return pa.table([value("key"), *map(value, longs[:4]), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), value("digest")], names=schema.names)

    return own.groupBy("unit").cogroup(theirs.groupBy("holder")).applyInArrow(judged, schema)
