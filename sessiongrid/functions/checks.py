"""Assertions inside a plan: a row that violates one fails the query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require(df: DataFrame, ok: Column, message: Column | str) -> DataFrame:
    """df, which fails when it is run if ok is not true for a row.

    The check is a filter that keeps every row or raises, so no selection of columns can prune it, nor can a count. Rows
    that a later filter drops may go unchecked, as Spark may drop them first.
    """
    failed = F.raise_error(F.lit(message) if isinstance(message, str) else message).cast("boolean")
    return df.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(failed))


def resolved(df: DataFrame, column: str, described_by: str) -> DataFrame:
    """df, which fails for a row without a value in column; the message names its value of described_by."""
    return require(df, F.col(column).isNotNull(), F.concat(F.lit(f"{column} does not resolve for "), F.coalesce(F.col(described_by).cast("string"), F.lit("null"))))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, which fails if two rows share keys. Rows that a join has brought together by these keys are not shuffled again."""
    counted = df.withColumn("__same", F.count("*").over(Window.partitionBy(*keys)))
    message = F.concat(F.lit(f"repeated {', '.join(keys)}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    return require(counted, F.col("__same") == 1, message).drop("__same")
