"""Nominal prices: undo the providers' adjustment for later splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import positive

PRICES = ["open", "high", "low", "close"]


def restore_nominal(bars: DataFrame, key: str = "ticker", date: str = "date", split: str = "stock_splits") -> DataFrame:
    """bars with split_factor, the product of all splits strictly after the row, and yf_nominal_* prices.

    Zero, negative, missing and infinite split values do not count; a row's own split does not count for it.
    """
    value = F.col(split).try_cast("double")
    valid = F.coalesce((value > 0) & (value < float("inf")) & ~F.isnan(value), F.lit(False))
    later = Window.partitionBy(key).orderBy(date).rowsBetween(1, Window.unboundedFollowing)
    rows = bars.withColumn("split_valid", valid).withColumn("split_ignored", ~valid & F.coalesce(value != 0, F.lit(False)))
    factor = F.coalesce(F.product(F.when(valid, value).otherwise(1.0)).over(later), F.lit(1.0))
    rows = rows.withColumn("split_factor", factor)
    return rows.withColumns({f"yf_nominal_{p}": positive(F.col(p)) * F.col("split_factor") for p in PRICES})


def keep_last(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the last by an explicit total order."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return frame.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def factor_changes(frame: DataFrame, rtol: float = 1e-4, atol: float = 5e-5) -> DataFrame:
    """adjustment_factor, previous_adjustment_factor and whether the factor has changed, by ticker."""
    factor = F.when(positive(F.col("is_raw_close")).isNotNull(), F.col("is_adjusted_close").try_cast("double") / F.col("is_raw_close").try_cast("double"))
    rows = frame.withColumn("adjustment_factor", factor)
    before = F.lag("adjustment_factor").over(Window.partitionBy("ticker").orderBy("date"))
    rows = rows.withColumn("previous_adjustment_factor", before)
    differs = F.abs(F.col("adjustment_factor") - F.col("previous_adjustment_factor")) > atol + rtol * F.abs("previous_adjustment_factor")
    return rows.withColumn("adjustment_factor_changed", F.coalesce(differs, F.lit(False)))


def merge_sources(history: DataFrame, nominal: DataFrame, auxiliary: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of the three sources on ticker and date, with a flag for each."""
    parts = [df.withColumn(f"has_{name}", F.lit(True)) for name, df in (("history", history), ("nominal", nominal), ("auxiliary", auxiliary))]
    joined = parts[0].join(parts[1], keys, "full_outer").join(parts[2], keys, "full_outer")
    return joined.fillna(False, subset=["has_history", "has_nominal", "has_auxiliary"])
