"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. The first four return the columns of
documents; the last adds what the tokenizer makes of each text. ``run`` writes each stage as Parquet in the shared
folder before the next reads it, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessiongrid.llm import bpe, decontaminate, lines, nearcopies, toxicity
from sessiongrid.llm.common import TEXTS, batches_of, cut, keep_table, mark_copies, table, text_key
from sessiongrid.llm.queries import TOXIC_FROM, tokenizer_path

#: The near-duplicate stage takes shingles of five words.
SHINGLE = 5


def packed(docs: DataFrame, *plain: str) -> tuple[DataFrame, str]:
    """docs as the columns ``plain`` and one struct of all others, so that no stage's own columns clash with them; its name."""
    name = "__rest"
    while name in docs.columns:
        name += "_"
    others = [F.col(f"`{c}`") for c in docs.columns if c not in plain]
    return docs.select(*plain, F.struct(F.lit(0).alias("__"), *others).alias(name)), name


def unpacked(rows: DataFrame, docs: DataFrame, name: str, *plain: str) -> DataFrame:
    return rows.select(*[F.col(c) if c in plain else F.col(f"`{name}`.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by a model of the labelled ones among them."""
    with batches_of(spark, TEXTS):
        model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    rows, rest = packed(docs, "text")
    return unpacked(toxicity.score_documents(rows, model).where(F.col("score") < TOXIC_FROM), docs, rest, "text")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that resemble an earlier one."""
    rows, rest = packed(docs, "doc_id", "text")
    done = unpacked(lines.dedup_lines(rows), docs, rest, "doc_id", "text")
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row, the first by doc_id (null last) and hash of the text."""
    ident = {"last": F.col("doc_id").isNull(), "id": F.col("doc_id"), "key": F.col("key")}
    place = F.struct(*[x.alias(c) for c, x in ident.items()])
    found = nearcopies.near_copies(docs.select("doc_id", "text"), SHINGLE).select(place.alias("place"), "class")
    lows = found.groupBy("class").agg(F.min("place").alias("low"))
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    keys = ["last", "id", "key"]
    copies = cut(found.join(lows, "class").where(~F.col("place").eqNullSafe(F.col("low"))).select("place.last", text(F.col("place.id")).alias("id"), "place.key").distinct())
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").isNull().alias("last"), text(F.col("doc_id")).alias("id"), text_key().alias("key"))
    kept = keyed.join(copies, keys, "left_anti")
    return mark_copies(kept, keys, "again").where(~F.col("again")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them; a table, written TEXTS rows at a time."""
    return keep_table(bpe.round_trip(docs.select("doc_id", "text"), tokenizer_path()), "bpe", TEXTS)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The first stage applies a trained model, which SQL cannot express; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_table(stage(spark, docs, sf_dir), name, TEXTS)
    return STAGES[-1][1](spark, docs, sf_dir)
