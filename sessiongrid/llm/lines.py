"""Line dedup by an exact set-similarity join.

A line's tokens are its distinct words (parted by blanks, tabs, VT, FF, CR). A line goes if an earlier line (of any row) has a
Jaccard similarity of ``threshold`` or more to it, whether or not that one stays. Rows are ordered by doc_id (null
last), then by the hash of their text; each row is a document of its own, also one without an id, with a repeated id, or
equal to another in both (of such, one is the first). The steps:

1. The texts are written once, and their ids sorted; a line's place is one integer that ascends with that order.
2. Word counts of the whole corpus, in a fixed number of counters, order the tokens by rarity: a token is a 64-bit
   integer, the level of its counter above its hash.
3. Lines of one token set are one class (128 bits of hash); all but the first line of a class go.
4. Classes meet where they share a prefix token: the first n - ceil(threshold * n) + 1 of n tokens, which similar sets
   must share. A frequent token alone would gather too many: it is joined with each token that follows it in a prefix longer
   by one, as similar sets share a second token there. Classes whose tokens just before those of a key are the same as
   well meet by an earlier key and not again. The first shared token bounds how many can follow (position), sizes
   bound the similarity (length), and a bitmap bounds it too: tokens toggle bits of a map, and sets whose maps differ in k
   bits differ in k tokens at least.
5. Large groups of near copies do not meet pair by pair: each class is first compared with the earliest of those that
   share one of its LEADING prefix tokens, in one of SALTS groups; only classes that stay seek all earlier ones.
6. The similarity is verified on the words themselves, not on hashes; of each class's earlier ones the nearest first.

Steps 1 and 3 to 6 are built-in functions. Words are counted and turned into tokens in Arrow batches, as that takes
a quarter of the time of built-in array functions (figures in the README).

Lines without words always stay. Null texts have no lines; removing all lines leaves the empty text. Lists of lines go to
the texts by broadcast up to BROADCAST_BYTES, else by a shuffle. Any type of doc_id that Spark can sort will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXTS, batches_of, cut, drop_table, free_shuffles, keep_table, shuffle_partitions, text_key

THRESHOLD = 0.8
#: Counters of words, and how many of them are one row when they are added up.
COUNTERS, TOGETHER = 1 << 20, 1 << 12
#: Bytes of text that are turned into tokens at once (whole texts; more if a text is longer) and hashed at once.
SLICE = 1 << 18
#: A token whose counter holds this many words or more is frequent.
FREQUENT = 2048
LEADING, SALTS = 4, 16
#: Pairs of one early line beyond which they are dealt out.
DEALT = 1000
BROADCAST_BYTES = 32 << 20
#: Keys by which classes meet are joined in so many shares, so that the disk holds the shuffle of one share at a time.
SHARES = 2
#: Bits of a place that one long integer holds; beyond, places are decimals.
PLACE_BITS = 62
#: No token of a prefix.
NONE = -(1 << 31)


def numbered_texts(docs: DataFrame) -> DataFrame:
    """seq (ascends with the order of rows), row (all columns of docs) and n_lines.

    The texts are written once, with a number for each; only ids and hashes are sorted.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))), F.lit(0))
    texts = keep_table(docs.select(F.monotonically_increasing_id().alias("number"), row.alias("row"), n.alias("n_lines"), text_key().alias("key")), "texts")
    order = [F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("key"), F.col("number")]
    ids = texts.select("number", *[c.alias(f"k{k}") for k, c in enumerate(order[:3])])
    ids = ids.repartitionByRange("k0", "k1", "k2", "number").sortWithinPartitions("k0", "k1", "k2", "number")
    ids = cut(ids.select("number", F.monotonically_increasing_id().alias("seq")))
    few = ids.count() * 16 <= BROADCAST_BYTES
    return texts.join(F.broadcast(ids) if few else ids, "number").select("seq", "row", "n_lines")


class Places:
    """Packs (seq, line number) into one number and back; seq is a partition above 33 bits of row."""

    def __init__(self, kept: DataFrame):
        row = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1))
        most = kept.agg(F.max(F.shiftrightunsigned("seq", 33)).alias("part"), F.max(row).alias("row"), F.max("n_lines").alias("line")).first()
        part, self.row, self.line = (int(x or 0).bit_length() for x in most)
        self.long = part + self.row + self.line <= PLACE_BITS

    def pack(self, seq: Column, line: Column) -> Column:
        if self.long:
            at = F.shiftleft(F.shiftrightunsigned(seq, 33), self.row).bitwiseOR(seq.bitwiseAND(F.lit((1 << self.row) - 1)))
            return F.shiftleft(at, self.line).bitwiseOR(line.cast("long"))
        return (seq.cast("decimal(20,0)") * F.lit(1 << self.line).cast("decimal(11,0)") + line).cast("decimal(32,0)")

    def unpack(self, at: Column) -> tuple[Column, Column]:
        if self.long:
            doc = F.shiftrightunsigned(at, self.line)
            seq = F.shiftleft(F.shiftrightunsigned(doc, self.row), 33).bitwiseOR(doc.bitwiseAND(F.lit((1 << self.row) - 1)))
            return seq, at.bitwiseAND(F.lit((1 << self.line) - 1)).cast("int")
        size = F.lit(1 << self.line).cast("decimal(11,0)")
        return F.floor(at / size).cast("long"), F.pmod(at, size).cast("int")


def _plain(text: Column) -> Column:
    """text with the other separators as blanks."""
    odd = text.contains("\t") | text.contains("\r") | text.contains("\x0b") | text.contains("\x0c")
    return F.when(odd, F.translate(text, "\t\r\x0b\x0c", "    ")).otherwise(text)


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    """A one-to-one mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


#: Odd multipliers of the mixes, and of the first bytes of a word.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
BYTES = _mixed(_mixed(np.arange(1, 65, dtype=np.uint64), MIX[0]), MIX[1]) | np.uint64(1)
PARTS = np.zeros(256, bool)
PARTS[list(b" \t\n\x0b\x0c\r")] = True


def _hashed(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of raw, in order."""
    inside = ~PARTS[raw]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    # a sum of bytes by multipliers; from byte 64 on, the multipliers are mixed anew with the number of the block
    by = BYTES[at & 63]
    if (long := at >= 64).any():
        by[long] = _mixed(by[long] ^ (at[long] >> 6).astype(np.uint64), MIX[2]) | np.uint64(1)
    return _mixed(np.add.reduceat((raw[inside].astype(np.uint64) + np.uint64(1)) * by, firsts), MIX[0]), starts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, line number) of every word of texts, in order.

    Work on bytes takes some 50 times their room, so it is done on pieces that end at a separator.
    """
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    found, at = [], 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw):
            gaps = np.flatnonzero(PARTS[raw[end : end + SLICE]])
            end = end + int(gaps[0]) if len(gaps) else min(end + SLICE, len(raw))
            if len(gaps):
                break
        hashes, starts = _hashed(raw[at:end])
        found.append((hashes, starts + at))
        at = end
    if not any(len(h) for h, _ in found):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, starts = (np.concatenate(x) for x in zip(*found))
    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, starts)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    text = np.searchsorted(begins, starts, side="right") - 1
    return hashes, text, line - np.searchsorted(breaks, begins)[text]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows that have SLICE bytes of text, or one row; null as empty."""
    values = batch.column(column)
    values = values.view(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary())
    first, held, size = 0, [], 0
    for k in range(len(values)):
        held.append(values[k].as_py() or b"")
        size += len(held[-1])
        if size >= SLICE:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def rarity_levels(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Levels 0 to 15 of all counters (doublings of the count, level 4 at the mean), and the level where frequent begins."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, some in _slices(batch, 0):
                np.add.at(n, (word_hashes(some)[0] & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        rows = [(k, np.ascontiguousarray(n[k * TOGETHER : (k + 1) * TOGETHER]).tobytes()) for k in range(COUNTERS // TOGETHER)]
        yield pa.RecordBatch.from_pydict({"block": pa.array([k for k, _ in rows], pa.int32()), "counts": pa.array([c for _, c in rows], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(c, np.int64)
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    schema = "block int, counts binary"
    counted = texts.select("text").mapInArrow(count, schema).repartition(min(shuffle_partitions(texts.sparkSession), COUNTERS // TOGETHER), "block")
    n = np.zeros(COUNTERS, np.int64)
    with batches_of(texts.sparkSession, TEXTS):
        sums = counted.mapInArrow(add, schema).collect()
    for r in sums:
        n[r["block"] * TOGETHER : (r["block"] + 1) * TOGETHER] = np.frombuffer(r["counts"], np.int64)
    mean = max(1, int(n.sum())) / COUNTERS
    levels = np.clip(np.floor(np.log2(np.maximum(n, 1) / mean)) + 4, 0, 15).astype(np.uint8)
    return levels, int(np.ceil(np.log2(FREQUENT / mean))) + 4


def _line_batch(seqs: np.ndarray, texts: list[bytes], levels: np.ndarray, frequent: int, t: int) -> pa.RecordBatch:
    hashes, text, line_no = word_hashes(texts)
    tokens = (levels[(hashes & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(59)) | (hashes >> np.uint64(5))
    change = np.ones(len(text), bool)
    change[1:] = (text[1:] != text[:-1]) | (line_no[1:] != line_no[:-1])
    line = np.cumsum(change) - 1
    width = np.uint64(max(1, int(line[-1] if len(line) else 0).bit_length()))
    order = np.argsort((line.astype(np.uint64) << (np.uint64(64) - width)) | ((tokens << np.uint64(1)) >> width))
    tokens, line = tokens[order], line[order]
    new = np.ones(len(line), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (line[1:] != line[:-1])
    tokens, line = tokens[new], line[new]
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    n = np.diff(np.append(starts, len(line)))
    bits = np.uint64(1) << (tokens & np.uint64(63))
    half = np.where(tokens & np.uint64(64), bits, np.uint64(0))
    reduced = lambda f, x: (f.reduceat(x, starts) if len(starts) else x[:0]).view(np.int64)
    few = np.minimum(n, n - -(-n * t // 1000) + 2)
    chosen = np.arange(len(line)) - np.repeat(starts, n) < np.repeat(few, n)
    short = (tokens[chosen] & np.uint64((1 << 30) - 1)).astype(np.int32)
    short = np.where((tokens[chosen] >> np.uint64(59)).astype(np.int64) >= frequent, -1 - short, short)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(few)).astype(np.int32)), pa.array(short, pa.int32()))
    maps = [reduced(np.bitwise_xor, bits), reduced(np.bitwise_xor, half)]
    columns = [seqs[text[change]], line_no[change].astype(np.int32), *(reduced(np.add, _mixed(_mixed(tokens, m), MIX[2])) for m in MIX[:2]), n.astype(np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists, *map(pa.array, maps)], names=["seq", "line_no", "c1", "c2", "n", "prefix", "b", "half"])


def line_table(texts: DataFrame, places: Places, t: int) -> DataFrame:
    """at, c1 and c2 (class), n, prefix (30 bits of each token; -1 - bits if frequent) and bitmaps of the lines with words."""
    levels, frequent = rarity_levels(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = batch.column(0).to_numpy()
            for first, some in _slices(batch, 1):
                yield _line_batch(seqs[first : first + len(some)], some, levels, frequent, t)

    lines = texts.select("seq", "text").mapInArrow(run, "seq long, line_no int, c1 long, c2 long, n int, prefix array<int>, b long, half long")
    return keep_table(lines.select(places.pack(F.col("seq"), F.col("line_no")).alias("at"), "c1", "c2", "n", "prefix", "b", "half"), "lines", TEXTS)


def _least_shared(n1: Column, n2: Column, t: int) -> Column:
    """The least number of shared tokens for a similarity of t thousandths."""
    return F.ceil((n1 + n2) * F.lit(t) / F.lit(1000 + t) - F.lit(1e-9))


def _differ(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """By their bitmaps, two classes differ in that many tokens at least."""
    whole, half = x["b"].bitwiseXOR(y["b"]), x["half"].bitwiseXOR(y["half"])
    return F.bit_count(half) + F.bit_count(whole.bitwiseXOR(half))


def _close(x: dict[str, Column], y: dict[str, Column], t: int) -> Column:
    """Length and bitmap filters for two classes by n, b and half."""
    n1, n2 = x["n"], y["n"]
    return (F.least(n1, n2) * 1000 >= F.greatest(n1, n2) * t) & (n1 + n2 - _differ(x, y) >= 2 * _least_shared(n1, n2, t))


def _nearest(pairs: DataFrame) -> DataFrame:
    """(late, early): of each late class the early one that differs least by the bitmaps."""
    return pairs.groupBy("late").agg(F.min(F.struct("differ", "early")).alias("x")).select("late", "x.early")


def _leaders(classes: DataFrame, t: int) -> DataFrame:
    """(late, early): each class with the nearest leader, the earliest that share a leading token and its salt.

    The salt also depends on the token, so that near copies with the same tokens meet different leaders.
    """
    tokens = F.slice(F.sort_array(F.transform(F.slice("prefix", F.lit(1), F.size("prefix") - 1), lambda x: F.xxhash64(x))), 1, LEADING)
    posts = classes.select("at", "n", "b", "half", F.explode(tokens).alias("token")).withColumn("salt", F.pmod(F.xxhash64("at", "token"), F.lit(SALTS)))
    leads = posts.groupBy("token", "salt").agg(F.min(F.struct("at", "n", "b", "half")).alias("lead"), F.count("*").alias("size")).where("size > 1")
    leads = leads.select("token", "salt", "lead.*")
    x, y = ({c: F.col(f"{a}.{c}") for c in ("n", "b", "half")} for a in "xy")
    met = posts.alias("x").join(leads.alias("y"), ["token", "salt"]).where((F.col("y.at") < F.col("x.at")) & _close(x, y, t))
    return cut(_nearest(met.select(F.col("x.at").alias("late"), F.col("y.at").alias("early"), _differ(x, y).alias("differ"))))


def _lead() -> Column:
    """One of the keys of a class: that of its first frequent token with the next one, else that of its first token."""
    at = F.array_position(F.transform("prefix", lambda x: x < 0), True).cast("int")  # from 1; 0 if there is none
    pair = F.xxhash64(F.get("prefix", at - 1), F.get("prefix", at))
    return F.when((at > 0) & (at < F.size("prefix")), pair).otherwise(F.get("prefix", F.lit(0)).cast("long"))


def _met(classes: DataFrame, gone: DataFrame, t: int) -> list[DataFrame]:
    """Of each share of the keys (late, early, differ): classes that share a prefix token or, of a frequent one, two; without late ones of ``gone``.

    A pair that shares a run of tokens comes once for the run, not for each key in it; a pair of classes with the same lead, the
    key of their first frequent token (of the first token, where none is frequent), comes by that key alone.
    """
    seeks = F.when(F.col("gone").isNull(), 1).otherwise(0).cast("long")
    rows = classes.join(gone.select(F.col("late").alias("at"), F.lit(True).alias("gone")), "at", "left").select("at", "n", "b", "half", "prefix", seeks.alias("seeks"))
    # one integer for n, the position and whether the class seeks earlier ones
    what = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft(F.col("pos").cast("long"), 1)).bitwiseOR(F.col("seeks")).alias("what")
    # the prefix tokens just before the one or two of the key: where two classes have the same there, they meet by an earlier key
    before = lambda pos: F.coalesce(F.get("prefix", pos - 1), F.lit(NONE))
    posts = rows.select("at", "b", "half", "n", "seeks", "prefix", _lead().alias("lead"), F.posexplode("prefix").alias("pos", "token")).where(F.col("pos") < F.size("prefix") - 1).withColumn("first", before(F.col("pos")))
    alone = posts.where("token >= 0").select("at", "b", "half", "lead", what, "first", F.lit(NONE).alias("second"), F.col("token").cast("long").alias("key"))
    paired = posts.where("token < 0").select("at", "b", "half", "lead", what, "first", "token", "prefix", "pos", F.posexplode(F.slice("prefix", F.col("pos") + 2, F.size("prefix"))).alias("on", "next"))
    second = F.when(F.col("on") > 0, before(F.col("pos") + F.col("on") + 1)).otherwise(F.lit(NONE))
    posts = alone.unionByName(paired.select("at", "b", "half", "lead", "what", "first", second.alias("second"), F.xxhash64("token", "next").alias("key")))
    x, y = ({"n": F.shiftright(f"{a}.what", 32), "pos": F.shiftright(f"{a}.what", 1).bitwiseAND(F.lit((1 << 31) - 1)), "seeks": F.col(f"{a}.what").bitwiseAND(F.lit(1)), "b": F.col(f"{a}.b"), "half": F.col(f"{a}.half")} for a in "xy")
    # the token of the post is the first that both share, or another post finds them
    room = F.least(x["n"] - x["pos"], y["n"] - y["pos"]) >= _least_shared(x["n"], y["n"], t)
    # both sides read the same columns and no filter is of one side alone, so that one shuffle serves both
    late = (F.col("y.at") < F.col("x.at")) & (x["seeks"] * 2 + y["seeks"] >= 2)
    new = reduce(and_, [(F.col(f"x.{c}") != F.col(f"y.{c}")) | (F.col(f"x.{c}") == NONE) for c in ("first", "second")])
    # both have a post of a lead that they share, and meet there whatever stands before it
    once = F.when(F.col("x.lead") == F.col("y.lead"), F.col("x.key") == F.col("x.lead")).otherwise(new & room)
    found = []
    for k in range(SHARES):
        some = posts.where(F.pmod("key", F.lit(SHARES)) == k)
        met = some.alias("x").join(some.alias("y"), F.col("x.key") == F.col("y.key")).where(late & once & _close(x, y, t))
        found.append(met.select(F.col("x.at").alias("late"), F.col("y.at").alias("early"), _differ(x, y).alias("differ")))
    return found


def _meetings(classes: DataFrame, gone: DataFrame, t: int) -> DataFrame:
    """(late, early, differ) of the pairs that meet, each once."""
    found = []
    for met in _met(classes, gone, t):
        found.append(cut(met.distinct()))
        free_shuffles(classes.sparkSession)
    return cut(reduce(DataFrame.unionByName, found).distinct())


def _lists(places: Places, at: DataFrame) -> tuple[DataFrame, bool]:
    """seq and line_nos of the places in column at, and whether they may be broadcast: 64 bytes a list, 8 a number."""
    seq, line = places.unpack(F.col("at"))
    lists = cut(at.select(seq.alias("seq"), line.alias("line_no")).groupBy("seq").agg(F.collect_list("line_no").alias("line_nos")))
    size = lists.agg(F.sum(F.size("line_nos") * 8 + 64)).first()[0] or 0
    return lists, size <= BROADCAST_BYTES


def _beside(texts: DataFrame, places: Places, at: DataFrame, how: str) -> DataFrame:
    """texts with line_nos of the places in column at."""
    lists, few = _lists(places, at)
    return texts.join(F.broadcast(lists) if few else lists, "seq", how)


def _verified(texts: DataFrame, places: Places, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs (late, early) whose sets of words have that similarity."""
    wanted = pairs.select(F.col("late").alias("at")).union(pairs.select("early")).distinct()
    found = _beside(texts.select("seq", F.split(_plain(F.col("text")), "\n").alias("lines")), places, wanted, "inner")
    found = found.select("seq", F.explode(F.transform("line_nos", lambda k: F.struct(k.alias("k"), F.get("lines", k).alias("line")))).alias("x"))
    words = keep_table(found.select(places.pack(F.col("seq"), F.col("x.k")).alias("at"), F.array_distinct(_words(F.col("x.line"))).alias("words")), "words")
    # pairs of an early line that has many are dealt out over copies of its words
    many = pairs.groupBy("early").agg(F.ceil(F.count("*") / DEALT).alias("deals")).where("deals > 1")
    dealt = pairs.join(many, "early", "left").select("late", "early", F.pmod(F.xxhash64("late"), F.coalesce("deals", F.lit(1))).alias("deal"))
    copies = words.join(many.withColumnRenamed("early", "at"), "at", "left").select(F.col("at").alias("early"), F.col("words").alias("words2"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("deals", F.lit(1)) - 1)).alias("deal"))
    both = dealt.join(copies, ["early", "deal"]).join(words.select(F.col("at").alias("late"), "words"), "late")
    common = F.size(F.array_intersect("words", "words2"))
    found = cut(both.where(common * 1000 >= (F.size("words") + F.size("words2") - common) * t).select("late").distinct())
    drop_table(words)
    return found


def removed_lines(texts: DataFrame, threshold: float = THRESHOLD) -> tuple[Places, DataFrame]:
    """The places (at) of the lines to remove; texts: seq, text and n_lines."""
    if not 0.5 < threshold <= 1:
        raise ValueError("the threshold must be above 0.5 and at most 1")
    t = round(threshold * 1000)
    places = Places(texts)
    lines = line_table(texts, places, t)
    same = lines.groupBy("c1", "c2").agg(F.min(F.struct("at", "n", "b", "half", "prefix")).alias("first"))
    classes = keep_table(same.select("first.*"), "classes")
    repeated = cut(lines.select("at").join(classes.select("at"), "at", "left_anti"))
    drop_table(lines)
    several = classes.where("n > 1")  # a single word is similar to itself alone
    gone = _verified(texts, places, _leaders(several, t), t)
    pairs = _meetings(several, gone, t)
    drop_table(classes)
    near = _verified(texts, places, cut(_nearest(pairs)), t)
    more = _verified(texts, places, cut(pairs.join(near, "late", "left_anti").select("late", "early")), t)
    return places, repeated.union(gone).union(near).union(more).distinct()


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with text reduced to the lines that stay, and n_lines and n_removed (columns of these names are replaced)."""
    kept = numbered_texts(docs)
    places, gone = removed_lines(kept.select("seq", F.col("row.text").alias("text"), "n_lines"), threshold)
    name = next(c for c in docs.columns if c.lower() == "text")
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != name]
    rows = kept.select("seq", F.struct(F.lit(0), *others).alias("rest"), F.split("row.text", "\n").alias("lines"), "n_lines")
    rows = _beside(rows, places, gone, "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "line_nos")
    text = F.when(F.col("line_nos").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(left, lambda k: F.get("lines", k)), "\n"))
    out = [text.alias(c) if c == name else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    removed = F.when(F.col("line_nos").isNull(), 0).otherwise(F.size("line_nos"))
    return rows.select(*out, F.col("n_lines").cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


def report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    done = dedup_lines(docs.select("doc_id", "text"), threshold)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
