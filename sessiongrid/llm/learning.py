"""What the two text classifiers share: the bounded training sample and the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, held_out

#: Labelled rows that a classifier is fitted on, at most, for each of the two classes on average. The lowest hashes of
#: doc_id are taken over both classes together, so the sample is the same however the table is partitioned, and its
#: ratio of classes is that of all labelled rows however large the table is: the thresholds of scores stay what they mean.
SAMPLE_PER_CLASS = 4_000
#: Bytes of the sample's texts at most; of the order by hash, what comes behind is left out.
SAMPLE_BYTES = 128 << 20


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, text, label) of at most 2 x per_class documents and SAMPLE_BYTES outside the held-out fold, one row an id.

    Only ids and labels are sorted; the ids chosen are broadcast to the scan of texts. Ids are compared as text, so they may
    be of different types. Of several rows of one id, that with the least hash of its text is taken.
    """
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).where(F.col("label").isin(0, 1))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class).select(F.col("doc_id").cast("string").alias("id"), "label")
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), F.col("doc_id").cast("string") == F.col("id"))
    one = cut(found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # over the sample alone
    fits = one.select("doc_id", so_far.alias("bytes")).where(F.col("bytes") <= SAMPLE_BYTES).select("doc_id")
    return one.join(F.broadcast(fits), "doc_id").select("doc_id", "text", "label")


def with_contract(scored: DataFrame, threshold: float, *more: str) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *more)
