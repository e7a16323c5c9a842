"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64 bits, by majority over the XXH64 (seed 42) of word shingles, repeats included. Those within
max_bits differing bits are linked. The distinct fingerprints are cut into six blocks; two that differ in four bits
or fewer agree in two blocks at least, so the tries are built under each of the 15 pairs of blocks, one for each value
of the pair. A trie is its sorted fingerprints: a node is a range of them. Node pairs are walked together level by
level, differing bits are added up, and a pair of nodes is pruned once over the budget. A trie of many fingerprints
is dealt out as pairs of its chunks. Each task returns a spanning forest of its links, never all pairs; components
come from alternating large-star and small-star steps on distributed edges.

Null texts count as empty: no words, fingerprint zero, linked like any other. Repeated rows get the same class;
documents without an id are fingerprinted but give no class its number, a class of those alone has a null one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, shuffle_partitions

WORDS_PER_SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Widths of the blocks, from the highest bit.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of one trie that are walked together; larger tries are dealt out by pairs of chunks.
CHUNK = 2048
#: Node pairs expanded at once in a task, and the number of leaf pairs below which nodes are compared outright.
FRONTIER, LEAVES = 1 << 18, 16
#: Rows of whole tries that a task walks at the same time.
TOGETHER = 100_000


def lower_ascii(text: bytes) -> bytes:
    return text.lower()  # bytes: A-Z only


def shingle_hashes(text: str | None, words_per_shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, repeats included, at most 65,536 at a time (big-endian); none of a text without words."""
    import xxhash

    raw = b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", lower_ascii((text or "").encode("utf-8", "surrogatepass"))))
    if not raw:
        return
    at = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
    starts = np.concatenate([[0], at + 1])
    n = max(1, len(starts) - words_per_shingle + 1)
    ends = np.concatenate([at, [len(raw)]])[min(words_per_shingle, len(starts)) - 1 :]
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, 1 << 16):
        yield np.array([digest(raw[a:b], SEED) for a, b in zip(starts[lo : min(n, lo + (1 << 16))].tolist(), ends[lo : lo + (1 << 16)].tolist())], dtype=">u8")


def majority(blocks: Iterable[np.ndarray]) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for h in blocks:
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        for k in range(0, len(bits), 255):  # sums of up to 255 bits fit a byte
            counts += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
        n += len(h)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint(text: str | None, words_per_shingle: int = WORDS_PER_SHINGLE) -> int:
    return majority(shingle_hashes(text, words_per_shingle))


def fingerprints(docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""
    chosen = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words_per_shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return chosen.mapInArrow(run, T.StructType([chosen.schema["doc_id"], T.StructField("fp", T.LongType())]))


def _block_pairs() -> list[int]:
    """For each pair of blocks, the mask of their bits."""
    tops = np.cumsum((0, *BLOCKS)).tolist()
    masks = [((1 << w) - 1) << (64 - t - w) for t, w in zip(tops, BLOCKS)]
    return [a | b for a, b in combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cross(lo1, hi1, lo2, hi2):
    """All index pairs of ranges, pair of ranges by pair of ranges."""
    n1, n2 = hi1 - lo1, hi2 - lo2
    total = n1 * n2
    ends = np.cumsum(total)
    k = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - total, total)
    width = np.repeat(n2, total)
    return np.repeat(lo1, total) + k // np.maximum(width, 1), np.repeat(lo2, total) + k % np.maximum(width, 1)


def trie_links(fps: np.ndarray, ends: np.ndarray, left: np.ndarray, across: np.ndarray, max_bits: int) -> np.ndarray:
    """Spanning forest of the links between fingerprints (uint64) of many tries, walked at the same time.

    ends: where the tries end, one behind the other, each ascending and distinct. across: for each fingerprint, whether
    its trie is a pair of chunks, of which only links across the two are sought; left: whether it is of the first.
    """
    root = np.arange(len(fps))
    forest: list[np.ndarray] = []
    zero = [np.concatenate([[0], np.cumsum((fps >> np.uint64(63 - d)) & np.uint64(1) == 0)]) for d in range(64)]
    lefts = np.concatenate([[0], np.cumsum(left)])
    begins = np.concatenate([[0], ends[:-1]])
    stack = [(0, begins, ends, begins, ends, np.zeros(len(ends), np.int64))]

    def join(i: np.ndarray, j: np.ndarray) -> None:
        """Unite by hooking roots onto smaller ones; the links that did so are the forest."""
        nonlocal root
        while True:
            a, b = root[i], root[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            high, low = np.maximum(a, b), np.minimum(a, b)
            tops, at = np.unique(high, return_index=True)
            forest.append(np.stack([fps[i[at]], fps[j[at]]]))
            root[tops] = low[at]
            while (root[root] != root).any():
                root = root[root]

    while stack:
        d, lo1, hi1, lo2, hi2, bits = stack.pop()
        while len(lo1):
            if len(lo1) > FRONTIER:
                half = len(lo1) // 2
                stack.append((d, lo1[half:], hi1[half:], lo2[half:], hi2[half:], bits[half:]))
                lo1, hi1, lo2, hi2, bits = lo1[:half], hi1[:half], lo2[:half], hi2[:half], bits[:half]
            need = ~((lo1 + 1 == hi1) & (lo2 + 1 == hi2) & (root[lo1] == root[lo2]))  # leaves already united
            ours = lefts[hi1] - lefts[lo1] + lefts[hi2] - lefts[lo2]
            need &= ~across[lo1] | (ours > 0) & (ours < hi1 - lo1 + hi2 - lo2)  # nodes of one chunk alone
            small = need & (((hi1 - lo1) * (hi2 - lo2) <= LEAVES) | (d == 64))
            if small.any():
                i, j = _cross(lo1[small], hi1[small], lo2[small], hi2[small])
                near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
                near &= np.where(across[i], left[i] != left[j], i < j)
                join(i[near], j[near])
            go = need & ~small
            lo1, hi1, lo2, hi2, bits = lo1[go], hi1[go], lo2[go], hi2[go], bits[go]
            if not len(lo1):
                break
            z = zero[d]
            mid1, mid2 = lo1 + z[hi1] - z[lo1], lo2 + z[hi2] - z[lo2]
            same = (lo1 == lo2) & (hi1 == hi2)
            nodes = [(lo1, mid1, lo2, mid2, bits), (mid1, hi1, mid2, hi2, bits), (lo1, mid1, mid2, hi2, bits + 1), (mid1[~same], hi1[~same], lo2[~same], mid2[~same], bits[~same] + 1)]
            lo1, hi1, lo2, hi2, bits = (np.concatenate(x) for x in zip(*nodes))
            live = (bits <= max_bits) & (lo1 < hi1) & (lo2 < hi2)
            lo1, hi1, lo2, hi2, bits, d = lo1[live], hi1[live], lo2[live], hi2[live], bits[live], d + 1
    return np.concatenate(forest, axis=1) if forest else np.zeros((2, 0), np.uint64)


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): a spanning set of the links between the distinct fingerprints of column fp."""
    if not 0 <= max_bits <= 4:
        raise ValueError("six blocks find up to four differing bits")
    masks = _block_pairs()
    tries = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(k).alias("block"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for k, m in enumerate(masks)])).alias("trie")).select("fp", "trie.*")
    sizes = tries.groupBy("block", "value").agg(F.count("*").alias("n")).where("n > 1")
    dealt = tries.join(sizes, ["block", "value"]).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(others))
    dealt = dealt.select("fp", "block", "value", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "own")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    trie_order = [F.col("fp") < 0, F.col("fp")]  # unsigned
    keys = ["block", "value", "c1", "c2"]

    def walk(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """rows: fp, the trie's four keys, own; whole tries, sorted by trie and fingerprint."""
        change = np.zeros(len(rows[0]), bool)
        for k in range(1, 5):
            change[1:] |= rows[k][1:] != rows[k][:-1]
        ends = np.append(np.flatnonzero(change), len(rows[0]))
        found = trie_links(rows[0], ends, rows[5] == rows[3], rows[3] != rows[4], max_bits).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found.min(axis=0)), pa.array(found.max(axis=0))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by trie; whole tries are held until there are enough for a walk."""
        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(k).to_numpy() for k in range(6)]
            new[0] = new[0].view(np.uint64)
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if len(held[0]) >= TOGETHER:
                same = np.ones(len(held[0]), bool)  # as the last trie, which may go on
                for k in range(1, 5):
                    same &= held[k] == held[k][-1]
                done = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if done:
                    yield from walk([x[:done] for x in held])
                    held = [x[done:] for x in held]
        if held is not None and len(held[0]):
            yield from walk(held)

    spread = dealt.repartition(shuffle_partitions(fps.sparkSession), *keys).sortWithinPartitions(*keys, *trie_order)
    return spread.select("fp", *keys, "own").mapInArrow(run, schema).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b) but the roots; a root is the smallest node that its component has.

    Alternating large-star and small-star steps until nothing changes; each step is cut from its lineage.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        now = cut(small)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen


def near_duplicates(docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of all documents that links reach, for each row of docs."""
    fps = cut(fingerprints(docs, words_per_shingle))
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(firsts.select("fp"), max_bits))
    rooted = firsts.join(roots, firsts.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.join(lows, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")
