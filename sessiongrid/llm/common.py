"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a new temporary one where that is unset in local mode."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sessiongrid-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: rows in the shared folder, no lineage, safe against lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table or archive that an operator writes."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Whole texts that go to Python at once; Spark's default of 10,000 rows suits numbers.
TEXTS = 512
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Within it, what is run hands Arrow batches of so many rows at most to Python (None: as the session says)."""
    before = spark.conf.get(BATCH)
    if rows is not None:
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def keep_table(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back; for rows too wide for checkpoint().

    batch: rows that go to Python at once.
    """
    path = new_folder(df.sparkSession, name)
    with batches_of(df.sparkSession, batch):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table made by keep_table that nothing reads again, and those of shuffles."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    free_shuffles(df.sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of shuffles deleted that nothing refers to any more: Spark does so once the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """Hash of a text, null as empty; with doc_id it tells rows apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def mark_copies(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows with the boolean column name: false for one row of each value of keys (not null), true for all others.

    Rows that share their keys are written once, so that their numbers hold; usually there are none.
    """
    several = cut(rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*keys))
    if several.isEmpty():
        return rows.withColumn(name, F.lit(False))
    columns = [F.col(f"`{c}`") for c in rows.columns]
    alone = rows.join(several, keys, "left_anti").select(*columns, F.lit(False).alias(name))
    many = keep_table(rows.join(several, keys, "left_semi").select(*columns, F.monotonically_increasing_id().alias("__row")), "copies")
    first = many.groupBy(*keys).agg(F.min("__row").alias("__first"))
    marked = many.join(first, keys).select(*columns, (F.col("__row") != F.col("__first")).alias(name))
    return alone.unionByName(marked)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id"):
    """The fold that no classifier may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
