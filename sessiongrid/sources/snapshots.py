"""Immutable, checksummed snapshots as Parquet folders with a manifest of metadata rows.

A snapshot's content hash does not depend on row order or partitioning: the SHA-256 of each canonical row is folded into
sums that add up in any order, so no task ever holds all rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "snapshot_id string, dataset string, content_hash string, n_rows long, columns string, status string, revision long, schema string"


def canonical(df: DataFrame) -> list[Column]:
    """Columns in order of name; non-finite numbers are null and -0.0 is 0.0."""
    out = []
    for c, t in sorted(df.dtypes):
        x = F.col(f"`{c}`")
        out.append((F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x + F.lit(0.0)) if t in ("double", "float") else x).alias(c))
    return out


def row_hash(df: DataFrame) -> Column:
    return F.sha2(F.to_json(F.struct(*canonical(df)), {"ignoreNullFields": "false"}), 256)


def content_hash(df: DataFrame) -> DataFrame:
    """n_rows and content_hash: sums of the four quarters of all row hashes, hashed once more."""
    h = df.select(row_hash(df).alias("h"))
    quarter = lambda k: F.sum(F.conv(F.substring("h", 16 * k + 1, 16), 16, 10).cast("decimal(38,0)"))
    sums = h.agg(F.count("*").alias("n_rows"), *[quarter(k).alias(f"q{k}") for k in range(4)])
    return sums.select("n_rows", F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), *[F.coalesce(F.col(f"q{k}"), F.lit(0)).cast("string") for k in range(4)]), 256).alias("content_hash"))


class SnapshotStore:
    """Snapshots below a root path; a snapshot exists once its manifest row does."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def find(self, dataset: str, content_hash: str | None = None) -> str | None:
        """The newest usable snapshot of a dataset."""
        rows = self.manifest().where((F.col("dataset") == dataset) & (F.col("status") == "COMPLETE"))
        if content_hash:
            rows = rows.where(F.col("content_hash") == content_hash)
        found = rows.orderBy(F.desc("revision")).limit(1).collect()
        return found[0]["snapshot_id"] if found else None

    def save(self, df: DataFrame, dataset: str, status: str = "COMPLETE") -> str:
        """Write df unless the same content is there already; the manifest row comes last."""
        mark = content_hash(df).first()
        if known := self.find(dataset, mark["content_hash"]):
            return known
        revision = self.manifest().where(F.col("dataset") == dataset).count() + 1
        ident = f"{dataset}-{revision:04d}-{mark['content_hash'][:12]}"
        df.write.mode("overwrite").parquet(f"{self.root}/data/{ident}")
        row = [(ident, dataset, mark["content_hash"], mark["n_rows"], ",".join(df.columns), status, revision, df.schema.json())]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return ident

    def read(self, ident: str, verified: bool = True, order_by: list[str] | None = None) -> DataFrame:
        """The rows of a snapshot with the schema of its manifest row, in order of the identity columns if they are given.

        verified: compare the rows with the manifest first, and raise if they differ.
        """
        rows = self.manifest().where(F.col("snapshot_id") == ident).select("schema").collect()
        if not rows:
            raise ValueError(f"no snapshot {ident}")
        if verified and (issues := self.verify(ident)):
            raise ValueError(f"snapshot {ident}: {issues}")
        df = self._rows(ident, rows[0]["schema"])
        return df.orderBy(*order_by) if order_by else df

    def _rows(self, ident: str, schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.root}/data/{ident}")

    def verify(self, ident: str) -> list[str]:
        """What differs between a snapshot and its manifest row."""
        rows = self.manifest().where(F.col("snapshot_id") == ident).collect()
        if not rows:
            return ["NOT_IN_MANIFEST"]
        row = rows[0]
        df = self._rows(ident, row["schema"])
        mark = content_hash(df).first()
        checks = {"CONTENT_HASH": mark["content_hash"] == row["content_hash"], "ROW_COUNT": mark["n_rows"] == row["n_rows"], "COLUMNS": ",".join(df.columns) == row["columns"], "STATUS": row["status"] == "COMPLETE"}
        return [name for name, ok in checks.items() if not ok]


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """By key: ADDED, REMOVED or CHANGED rows with the changed columns; repeated keys are told apart by number."""
    values = [c for c in new.columns if c not in keys]

    def numbered(df: DataFrame, prefix: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in values])
        return df.select(*keys, F.row_number().over(w).alias("copy"), F.struct(*values).alias(prefix))

    both = numbered(old, "o").join(numbered(new, "n"), [*keys, "copy"], "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in sorted(values)]))
    kind = F.when(F.col("o").isNull(), "ADDED").when(F.col("n").isNull(), "REMOVED").when(F.size(changed) > 0, "CHANGED")
    return both.select(*keys, "copy", kind.alias("change"), F.when(F.col("o").isNotNull() & F.col("n").isNotNull(), F.array_join(changed, "|")).alias("columns")).where("change is not null")


def revision(old: DataFrame, new: DataFrame, keys: list[str], date: str) -> DataFrame:
    """One row over diff: changed rows and cells, changed columns (those of one side alone too), and the dates of rows that
    came or went. date is one of the keys."""
    values = [c for c in new.columns if c in old.columns and c not in keys]
    alone = sorted(set(old.columns) ^ set(new.columns))
    rows = diff(old.select(*keys, *values), new.select(*keys, *values), keys).withColumn("cols", F.split("columns", r"\|"))
    cells = F.when(F.col("change") == "CHANGED", F.size("cols") + len(alone)).otherwise(0)
    dates = lambda kind: F.array_join(F.array_sort(F.collect_set(F.when(F.col("change") == kind, F.col(date).cast("string")))), "|")
    changed = F.flatten(F.collect_set(F.when(F.col("change") == "CHANGED", F.col("cols"))))
    return rows.agg(
        F.count_if(F.col("change") == "CHANGED").alias("changed_row_count"), F.coalesce(F.sum(cells), F.lit(0)).cast("long").alias("changed_cell_count"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(changed, F.array(*map(F.lit, alone)).cast("array<string>")))), "|").alias("changed_columns"), dates("ADDED").alias("added_dates"), dates("REMOVED").alias("removed_dates"),
    )
