"""Near copies of documents: SimHash links, and an exact set-similarity join for those that SimHash does not reach.

Texts are linked if their fingerprints differ in simhash.MAX_BITS bits at most, or if the sets of their word shingles
have a Jaccard similarity of ``threshold`` or more. Similar sets can differ in many bits, so no budget of bits finds all
of them. The steps:

1. A pass over the texts gives each its fingerprint, the number and hash of its shingle set, and the set's prefix: the
   first n - ceil(threshold * n) + 1 of n shingle hashes in ascending order. Similar sets share a prefix token.
2. A passage that many texts share would fill their prefixes. So tokens that more than FREQUENT prefixes hold are counted,
   with all tokens of the sets concerned, and stand last, the most frequent at the end; those sets get prefixes in this
   order: their own tokens first. All other sets' prefixes hold no such token and are the same in both orders. Tokens
   are counted in SHARES by their hash and sets are ordered in SHARES by theirs, one after the other.
3. Classes by SimHash, and by equal sets.
4. Sets of different classes meet where they share a prefix token, under length, positional and bitmap filters (hashes
   toggle bits of a map of two bits or more for each shingle; sets whose maps differ in k bits differ in k shingles at
   least; the longer of two maps is folded to the length of the shorter), and Jaccard is verified on the whole sets. First each set meets the first one of its tokens, so that a large group becomes one
   class without meeting pair by pair; then those meet that are still in different classes.

Null texts count as empty; texts without words are one class. Repeated rows and rows without an id are classed like all
others; ids are of any type. Columns other than doc_id and text are ignored; an empty table gives an empty result. XXH64
hashes stand for shingles and texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import TEXTS, cut, drop_table, free_shuffles, keep_table, text_key

THRESHOLD = 0.8
BROADCAST_BYTES = 32 << 20
#: Prefixes from which on a token is frequent.
FREQUENT = 64
#: Whole sets are counted and ordered in so many shares, so that the disk holds the shuffle of one share at a time.
SHARES = 8
#: Bits of a set's map at least; maps are powers of two.
MAP = 1024


def shingle_set(blocks: list[np.ndarray]) -> np.ndarray:
    """Distinct hashes, ascending (as signed integers)."""
    return np.unique(np.concatenate(blocks).astype(np.uint64).view(np.int64)) if blocks else np.zeros(0, np.int64)


def _prefix(n: int, t: int) -> int:
    return n - -(-n * t // 1000) + 1 if n else 0


def bitmap(own: np.ndarray) -> np.ndarray:
    """Parities of the hashes by their low bits; a map of too few bits for its set would tell nothing."""
    bits = max(MAP, 1 << (2 * len(own)).bit_length())
    return np.packbits((np.bincount(own & (bits - 1), minlength=bits) & 1).astype(np.uint8)).view(np.int64)


def shingle_rows(docs: DataFrame, words: int, t: int) -> DataFrame:
    """doc_id, key (hash of the text), fp, cls (hash of the shingle set), n, prefix and map of each row."""
    import xxhash

    chosen = docs.select("doc_id", text_key().alias("key"), "text")
    schema = T.StructType([chosen.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("key", "fp", "cls")), T.StructField("n", T.IntegerType()), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("prefix", "map"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                fps, classes, sizes, prefixes, maps = [], [], [], [], []
                for text in some.column(2):
                    blocks = list(simhash.shingle_hashes(text.as_py(), words))
                    own = shingle_set(blocks)
                    fps.append(simhash.majority(blocks))
                    classes.append(xxhash.xxh64_intdigest(own.tobytes()))
                    sizes.append(len(own))
                    prefixes.append(own[: _prefix(len(own), t)].copy())  # a view would keep the whole set
                    maps.append(bitmap(own))
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (prefixes, maps)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), signed(fps), signed(classes), pa.array(sizes, pa.int32()), *lists], names=schema.names)

    return chosen.mapInArrow(run, schema)


def _least(t: int) -> Column:
    """The least number of shared tokens of sets of n and n2 for a similarity of t thousandths."""
    return F.ceil((F.col("n") + F.col("n2")) * F.lit(t) / F.lit(1000 + t) - F.lit(1e-9))


def _folded(column: str, words: Column) -> Column:
    """A map folded to so many words (a power of two): the parities by fewer low bits."""
    parts = F.sequence(F.lit(1), (F.size(column) / words).cast("int") - 1)
    whole = F.aggregate(parts, F.slice(column, F.lit(1), words), lambda acc, k: F.zip_with(acc, F.slice(column, k * words + 1, words), lambda a, b: a.bitwiseXOR(b)))
    return F.when(F.size(column) == words, F.col(column)).otherwise(whole)


def _mapped(rows: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """(cls, other, differ) of the pairs (cls, other, n, n2) whose maps, which differ in that many bits, allow that similarity."""
    wanted = pairs.select("cls").union(pairs.select(F.col("other").alias("cls"))).distinct()
    maps = cut(rows.select("cls", "map").join(wanted, "cls").groupBy("cls").agg(F.first("map").alias("map")))
    both = pairs.join(maps, "cls").join(maps.select(F.col("cls").alias("other"), F.col("map").alias("map2")), "other")
    least = F.least(F.size("map"), F.size("map2"))
    bits = F.zip_with(_folded("map", least), _folded("map2", least), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differ = F.aggregate(bits, F.lit(0), lambda acc, x: acc + x)
    return cut(both.withColumn("differ", differ).where(F.col("n") + F.col("n2") - F.col("differ") >= 2 * _least(t)).select("cls", "other", "differ"))


def _nearest(pairs: DataFrame) -> DataFrame:
    """(cls, other): of each set the one whose map differs least."""
    return cut(pairs.groupBy("cls").agg(F.min(F.struct("differ", "other")).alias("x")).select("cls", "x.other"))


def _whole_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls, fp and tokens (all shingle hashes) of the wanted sets (cls), from their texts."""
    places = cut(rows.join(wanted, "cls").groupBy("cls").agg(F.min("key").alias("key"), F.min("fp").alias("fp")))
    few = places.count() * 32 <= BROADCAST_BYTES  # three integers and their place in the table of the join
    texts = docs.select(text_key().alias("key"), "text").join(F.broadcast(places) if few else places, "key").select("cls", "fp", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                sets = [shingle_set(list(simhash.shingle_hashes(x.as_py(), words))) for x in some.column(2)]
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "fp", "tokens"])

    return keep_table(texts.dropDuplicates(["cls"]).mapInArrow(run, "cls long, fp long, tokens array<long>"), "tokens", TEXTS)


def _verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, words: int, t: int) -> DataFrame:
    """(a, b): fingerprints of the pairs (cls, other) whose sets have that similarity."""
    sets = _whole_sets(docs, rows, pairs.select("cls").union(pairs.select(F.col("other").alias("cls"))).distinct(), words)
    both = pairs.join(sets, "cls").join(sets.select(F.col("cls").alias("other"), F.col("fp").alias("fp2"), F.col("tokens").alias("tokens2")), "other")
    common = F.size(F.array_intersect("tokens", "tokens2"))
    found = cut(both.where(common * 1000 >= (F.size("tokens") + F.size("tokens2") - common) * t).select(F.col("fp").alias("a"), F.col("fp2").alias("b")))
    drop_table(sets)
    return found


def _beside(df: DataFrame, tokens: DataFrame, how: str = "inner") -> DataFrame:
    """df joined to a table of tokens, which is broadcast if its size allows; else Spark splits the frequent ones."""
    return df.join(F.broadcast(tokens) if tokens.count() * 24 <= BROADCAST_BYTES else tokens, "token", how)


def _share(column: str, k: int) -> Column:
    """Whether a hash is of share k."""
    return F.pmod(column, F.lit(SHARES)) == k


def prefix_posts(docs: DataFrame, rows: DataFrame, words: int, t: int) -> DataFrame:
    """A table of cls, fp, n, pos and token of each prefix token of each set, frequent tokens last."""
    sets = keep_table(rows.where("n > 0").select("cls", "fp", "n", "prefix").dropDuplicates(["cls"]), "sets")
    posts = sets.select("cls", "fp", "n", F.posexplode("prefix").alias("pos", "token"))
    frequent = cut(posts.groupBy("token").agg(F.count("*").alias("held")).where(F.col("held") > FREQUENT))
    if frequent.isEmpty():
        found = keep_table(posts, "posts")
        drop_table(sets)
        return found
    concerned = cut(_beside(posts, frequent).select("cls").distinct())
    first = _whole_sets(docs, rows, concerned, words)
    # frequent among all tokens of these sets, so that no passage comes back with its other tokens
    tokens = first.select(F.explode("tokens").alias("token"))
    for k in range(SHARES):
        free_shuffles(docs.sparkSession)
        more = cut(tokens.where(_share("token", k)).groupBy("token").agg(F.count("*").alias("held")).where(F.col("held") > FREQUENT))
        frequent = frequent.unionByName(more)
    frequent = cut(frequent.groupBy("token").agg(F.max("held").alias("held")))
    last = cut(_beside(posts, frequent).select("cls").distinct())
    second = _whole_sets(docs, rows, cut(last.join(concerned, "cls", "left_anti")), words)
    found = keep_table(posts.join(last, "cls", "left_anti").select("cls", "fp", "n", "pos", "token"), "posts")
    drop_table(sets)
    size = F.expr(f"n - (n * {t} + 999) div 1000 + 1").cast("int")
    for k in range(SHARES):
        free_shuffles(docs.sparkSession)
        some = first.unionByName(second).where(_share("cls", k)).select("cls", "fp", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
        each = _beside(some, frequent, "left")
        ordered = each.groupBy("cls", "fp", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "token"))).alias("tokens"))
        found = found.unionByName(keep_table(ordered.select("cls", "fp", "n", F.posexplode(F.slice("tokens.token", F.lit(1), size)).alias("pos", "token")), "posts"))
    for table in (first, second):
        drop_table(table)
    return found


def fingerprint_roots(docs: DataFrame, rows: DataFrame, words: int, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root) of fingerprints as simhash.components gives them; rows: the kept shingle_rows of docs."""
    t = round(threshold * 1000)
    lows = rows.where("n > 0").groupBy("cls").agg(F.min("fp").alias("b"), F.max("fp").alias("high")).where("b <> high")
    same = rows.join(lows, "cls").select(F.col("fp").alias("a"), "b").where("a <> b").distinct()
    edges = cut(simhash.links(rows.select("fp").distinct()).unionByName(same))
    roots = simhash.components(edges)

    posts = prefix_posts(docs, rows, words, t)
    shared = cut(posts.groupBy("token").agg(F.count("*").alias("posts")).where("posts > 1").select("token"))
    met = keep_table(_beside(posts, shared), "meetings")
    drop_table(posts)

    def known(roots: DataFrame) -> DataFrame:
        """met with the class so far."""
        return met.join(roots, met["fp"] == roots["node"], "left").select("token", "cls", "n", "pos", F.coalesce("root", "fp").alias("root"))

    apart = F.col("root") != F.col("root2")
    # shared tokens can stand before both places, or from there on
    most = F.least("pos", "pos2") + F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    close = (F.least("n", "n2") * 1000 >= F.greatest("n", "n2") * t) & (most >= _least(t))
    # one aggregation gives the tokens of several classes and their first set
    lead = known(roots).groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("cls", "n", "pos", "root")).alias("x")).where("low <> high")
    lead = lead.select("token", F.col("x.cls").alias("other"), F.col("x.n").alias("n2"), F.col("x.pos").alias("pos2"), F.col("x.root").alias("root2"))
    met_lead = cut(known(roots).join(lead, "token").where(apart & close).select("cls", "other", "n", "n2").distinct())
    first = _nearest(_mapped(rows, met_lead, t))
    edges = edges.unionByName(_verified(docs, rows, first, words, t))
    roots = simhash.components(edges)

    several = known(roots).groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    now = known(roots).join(several, "token")
    other = now.select("token", F.col("cls").alias("other"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("root").alias("root2"))
    pairs = now.join(other, "token").where((F.col("other") < F.col("cls")) & apart & close).select("cls", "other", "n", "n2").distinct()
    # whole sets are large, so each meets its nearest one first, and others only while their classes are still apart
    pairs = _mapped(rows, cut(pairs.join(first, ["cls", "other"], "left_anti")), t)
    near = _nearest(pairs)
    edges = edges.unionByName(_verified(docs, rows, near, words, t))
    roots = simhash.components(edges)
    fps = rows.groupBy("cls").agg(F.min("fp").alias("fp"))
    classes = fps.join(roots, fps["fp"] == roots["node"], "left").select("cls", F.coalesce("root", "fp").alias("root"))
    left = pairs.join(near, ["cls", "other"], "left_anti").join(classes, "cls").join(classes.select(F.col("cls").alias("other"), F.col("root").alias("root2")), "other")
    roots = simhash.components(edges.unionByName(_verified(docs, rows, cut(left.where(apart).select("cls", "other")), words, t)))
    drop_table(met)
    return roots


def near_copies(docs: DataFrame, words: int, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, key and class (a number that linked texts share) of each row of docs."""
    rows = keep_table(shingle_rows(docs, words, round(threshold * 1000)), "shingles", TEXTS)
    roots = fingerprint_roots(docs, rows, words, threshold)
    found = cut(rows.join(roots, rows["fp"] == roots["node"], "left").select("doc_id", "key", F.coalesce("root", "fp").alias("class")))
    drop_table(rows)
    return found
