"""Purged, expanding walk-forward folds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import per_session


@dataclass(frozen=True)
class FoldConfig:
    validation: int = 60
    test: int = 20
    minimum_fit: int = 252
    horizon: int = 3
    history: int = 21


def folds(calendar: DataFrame, config: FoldConfig = FoldConfig(), first_test_index: int | None = None) -> DataFrame:
    """One row for each complete test block; the first begins where the least fit is reached, or as given."""
    c = config
    least = c.history - 1 + c.minimum_fit + c.horizon + c.validation
    first = least if first_test_index is None else first_test_index
    if first < least:
        raise ValueError(f"the first test session must be number {least} or later")
    total = calendar.agg(F.count("*").alias("n"))
    starts = total.where(F.col("n") >= first + c.test).select(F.explode(F.sequence(F.lit(first), F.col("n").cast("int") - c.test, F.lit(c.test))).alias("t"))
    rows = starts.select(
        F.format_string("fold_%03d", ((F.col("t") - first) / c.test).cast("int") + 1).alias("fold_id"),
        F.lit(c.history - 1).alias("training_start"), (F.col("t") - c.validation - 1).alias("training_end"),
        (F.col("t") - c.validation).alias("validation_start"), (F.col("t") - 1).alias("validation_end"),
        F.col("t").alias("test_start"), (F.col("t") + c.test - 1).alias("test_end"),
    )
    names = [n for n in rows.columns if n != "fold_id"]
    out = rows
    for n in names:
        out = out.join(per_session(calendar.select(F.col("session_index").cast("int").alias(n), F.col("session_date").alias(f"{n}_date"))), n)
    purged = F.col("validation_start") - F.col("training_start") - c.horizon
    return out.select("fold_id", *[f"{n}_date" for n in names], purged.cast("long").alias("fit_labeled_sessions"), F.lit(c.validation - c.horizon).cast("long").alias("validation_labeled_sessions"), F.lit(c.test).cast("long").alias("test_sessions"))


def split(panel: DataFrame, fold_table: DataFrame) -> DataFrame:
    """panel rows by fold and part (fit, validation, test); labels must be available before the next part begins.

    The fold table has fewer rows than there are sessions and is broadcast, so the panel is not shuffled.
    """
    d, available = F.col("prediction_date"), F.col("label_available_date")
    labelled = (F.col("label_status") == "LABELED") & F.col("label").isin(0, 1)
    part = (
        F.when(d.between(F.col("training_start_date"), F.col("training_end_date")) & labelled & (available < F.col("validation_start_date")), "fit")
        .when(d.between(F.col("validation_start_date"), F.col("validation_end_date")) & labelled & (available < F.col("test_start_date")), "validation")
        .when(d.between(F.col("test_start_date"), F.col("test_end_date")), "test")
    )
    joined = panel.where("prediction_eligible").join(per_session(fold_table), d.between(F.col("training_start_date"), F.col("test_end_date")))
    return joined.withColumn("part", part).where("part is not null")


def split_counts(panel: DataFrame, fold_table: DataFrame) -> DataFrame:
    return split(panel, fold_table).groupBy("fold_id", "part").agg(
        F.count("*").alias("n_rows"), F.countDistinct("prediction_date").alias("sessions"), F.count_if(F.col("label") == 1).alias("positive"), F.count_if(F.col("label") == 0).alias("negative")
    )
