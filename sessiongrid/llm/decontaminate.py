"""Benchmark decontamination by a prefix-filtered set join; built-in functions only.

An item's windows are its runs of ``window`` words (a shorter item is one window). A window can only occur where all its
tokens do, so the tokens of each window are ordered by rarity in the corpus (document counts over all rows) and the
necessary prefix is its rarest token. Document tokens are joined to those prefix tokens alone; the token's place in the
window gives the one possible start (positional bound), the window must fit the document (length bound), and the
window-sized slice of the document is compared word by word.

The benchmark is joined in blocks of at most BLOCK windows, each broadcast; the number of blocks follows the size
of the benchmark, which is counted first. Documents are read once for each block and never shuffled as text.

Null texts and texts without words have no hits. Repeated documents are matched apart and give a row each; repeated
items count once by item_id; items without an id count as the empty id. An empty table of either kind works: no rows, or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

WINDOW = 10
#: Windows that are broadcast at a time (about 300 bytes each).
BLOCK = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII other than digits and letters parts words; all else belongs to them.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words with A-Z lower-cased; lower() does that faster where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct windows: wid, w (words), items (ids as strings)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))))
    runs = items.select("item", "w", starts.alias("at")).select("item", F.slice("w", F.col("at"), F.lit(window)).alias("w"))
    return runs.groupBy("w").agg(F.array_sort(F.collect_set("item")).alias("items")).select(F.xxhash64("w").alias("wid"), "w", "items")


def prefixes(docs: DataFrame, found: DataFrame, blocks: int) -> DataFrame:
    """The windows with their rarest token and its place: windows with a token that no document has are left out."""
    tokens = cut(found.select(F.explode("w").alias("token")).distinct())
    counts = []
    for b in range(blocks):
        some = F.broadcast(tokens.where(F.pmod(F.xxhash64("token"), F.lit(blocks)) == b))
        counts.append(docs.select(F.explode(words(F.col("text"))).alias("token")).join(some, "token").groupBy("token").agg(F.count("*").alias("n")))
    counts = reduce(DataFrame.unionByName, counts)
    each = found.select("wid", "w", "items", F.posexplode("w").alias("place", "token"))
    ranked = each.join(counts, "token", "left")
    rarest = ranked.groupBy("wid", "w", "items").agg(F.min(F.struct("n", "token", "place")).alias("r"), F.count("n").alias("known"))
    return rarest.where(F.col("known") == F.size("w")).select("wid", "w", "items", F.col("r.token").alias("token"), F.col("r.place").alias("place"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words and hits (start, length, items of each window that occurs), a row for each document."""
    found = cut(windows(benchmark, window))
    blocks = max(1, -(-found.count() // BLOCK))
    rare = cut(prefixes(docs, found, blocks))
    parts = []
    for b in range(blocks):
        some = rare.where(F.pmod("wid", F.lit(blocks)) == b)
        if b == 0:  # the empty token closes each document, so that those without hits keep their row
            close = docs.sparkSession.range(1).select(F.lit(None).cast("long").alias("wid"), F.array().cast("array<string>").alias("w"), F.array().cast("array<string>").alias("items"), F.lit("").alias("token"), F.lit(0).alias("place"))
            some = some.unionByName(close)
        texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
        each = texts.select("doc_id", "text_hash", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("at", "token"))
        start = F.col("at") - F.col("place")
        fits = (start >= 0) & (start + F.size("w") <= F.size("words"))
        same = F.slice("words", start + 1, F.size("w")) == F.col("w")
        joined = each.join(F.broadcast(some), "token").where(F.col("wid").isNull() | F.when(fits, same).otherwise(False))
        hit = F.when(F.col("wid").isNotNull(), F.struct(start.alias("start"), F.size("w").alias("length"), F.col("items")))
        parts.append(joined.select("doc_id", "text_hash", F.size("words").alias("n_words"), hit.alias("hit")))
    rows = reduce(DataFrame.unionByName, parts)
    grouped = rows.groupBy("doc_id", "text_hash").agg(F.max("n_words").alias("n_words"), F.collect_list("hit").alias("hits"), F.sum(F.when(F.col("hit").isNull(), 1).otherwise(0)).alias("copies"))
    apart = F.when(F.col("copies") == 1, F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.col("copies").cast("int")))
    # hits of repeated rows came in once for each of them
    return grouped.withColumn("copy", F.explode(apart)).select("doc_id", "text_hash", "n_words", F.array_distinct("hits").alias("hits"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hits of each document in numbers: words, words under a hit, and the items that occur."""
    found = matches(docs, benchmark, window)
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    rows = found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(covered).cast("long").alias("n_hit"), items.alias("items"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the rows in which a window occurs."""
    bad = matches(docs, benchmark, window).where(F.size("hits") > 0).select("doc_id", "text_hash").distinct()
    marked = docs.withColumn("__hash", F.xxhash64("text"))
    return marked.join(bad, marked["doc_id"].eqNullSafe(bad["doc_id"]) & (marked["__hash"] == bad["text_hash"]), "left_anti").drop("__hash")
