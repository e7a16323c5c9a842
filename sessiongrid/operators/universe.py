"""Prediction universe and training panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import is_true, positive
from .grid import per_session, shift_sessions

KEY = ["security_id", "prediction_date"]


def prediction_universe(master: DataFrame, observations: DataFrame, features: DataFrame, calendar: DataFrame, benchmark: DataFrame, minimum_history: int = 21) -> DataFrame:
    """Eligibility of each known key on its day, with the first reason against it.

    Keys are the union of master x sessions, observations and features. master may carry prediction_date.
    """
    sessions = calendar.withColumnRenamed("session_date", "prediction_date")
    if "prediction_date" not in master.columns:
        master = master.select("security_id").distinct().crossJoin(per_session(sessions.select("prediction_date")))
    keys = master.select(*KEY, F.lit(True).alias("in_master")).distinct()
    seen = observations.withColumn("observed", F.lit(True))
    made = features.select(*KEY, F.lit(True).alias("has_feature"))
    panel = keys.join(seen, KEY, "full_outer").join(made, KEY, "full_outer").join(per_session(sessions), "prediction_date", "left")
    index = benchmark.select("prediction_date", positive(F.col("benchmark_close")).isNotNull().alias("has_benchmark"))
    panel = panel.join(per_session(index), "prediction_date", "left")
    first = F.min(F.when(F.col("observed"), F.col("session_index"))).over(Window.partitionBy("security_id"))
    panel = panel.withColumn("available_history_sessions", F.col("session_index") - first + 1)
    o, h, low, c = (positive(F.col(f"yf_nominal_{n}")) for n in ("open", "high", "low", "close"))
    whole = o.isNotNull() & h.isNotNull() & low.isNotNull() & c.isNotNull()
    valid = is_true(whole & (h >= F.greatest(o, c)) & (low <= F.least(o, c)) & (h >= low))
    volume = lambda name: F.when((F.col(name) >= 0) & (F.col(name) < float("inf")), F.col(name))
    a, b = volume("is_tl_volume"), volume("yf_share_volume")
    traded = is_true(a > 0) | is_true(b > 0)
    none = a.isNotNull() & b.isNotNull() & ~traded
    reason = (
        F.when(~is_true(F.col("in_master")), "NOT_IN_MASTER_UNIVERSE")
        .when(~is_true(F.col("observed")), "NO_T_OBSERVATION")
        .when(~valid, "INVALID_T_OHLC")
        .when(none, "NO_TRADE_ON_T")
        .when(~traded, "MISSING_TRADE_EVIDENCE")
        .when(~is_true(F.col("available_history_sessions") >= minimum_history), "INSUFFICIENT_HISTORY")
        .when(~is_true(F.col("has_feature")), "MISSING_FEATURE_ROW")
        .when(~is_true(F.col("has_benchmark")), "MISSING_XU100_SESSION")
    )
    panel = panel.withColumn("prediction_exclusion_reason", reason)
    return panel.select(*KEY, F.col("prediction_exclusion_reason").isNull().alias("prediction_eligible"), "prediction_exclusion_reason", "available_history_sessions")


def daily_universe(universe: DataFrame, observations: DataFrame, features: DataFrame) -> DataFrame:
    """Securities, eligible ones, observations and feature rows of each day."""
    days = universe.groupBy("prediction_date").agg(F.countDistinct("security_id").alias("securities"), F.count_if("prediction_eligible").alias("eligible"))
    seen = observations.groupBy("prediction_date").agg(F.count("*").alias("observed"))
    made = features.groupBy("prediction_date").agg(F.count("*").alias("features"))
    return days.join(seen, "prediction_date", "left").join(made, "prediction_date", "left").fillna(0, subset=["observed", "features"])


def daily_exclusions(universe: DataFrame) -> DataFrame:
    """Rows by day and reason, with a zero where a reason does not occur on a day."""
    days = universe.select("prediction_date").distinct()
    reasons = universe.where("prediction_exclusion_reason is not null").select("prediction_exclusion_reason").distinct()
    counts = universe.where("prediction_exclusion_reason is not null").groupBy("prediction_date", "prediction_exclusion_reason").agg(F.count("*").alias("n"))
    grid = days.crossJoin(F.broadcast(reasons))  # the reasons are those of prediction_universe
    return grid.join(counts, ["prediction_date", "prediction_exclusion_reason"], "left").fillna(0, subset=["n"])


def training_panel(universe: DataFrame, features: DataFrame, labels: DataFrame, calendar: DataFrame, as_of: str, horizon: int = 3) -> DataFrame:
    """universe with features and labels (colliding names get the suffix _label) and model_row.

    A label is available ``horizon`` sessions after its day; model rows are eligible, labelled and available as of a date.
    """
    clash = [c for c in labels.columns if c not in KEY and (c in universe.columns or c in features.columns)]
    for c in clash:
        labels = labels.withColumnRenamed(c, f"{c}_label")
    panel = universe.join(features, KEY, "left").join(labels, KEY, "left")
    panel = shift_sessions(panel, calendar, horizon, "label_available_date")
    usable = F.col("prediction_eligible") & (F.col("label_status") == "LABELED") & F.col("label").isin(0, 1) & (F.col("label_available_date") <= F.lit(as_of).cast("date"))
    return panel.withColumn("model_row", is_true(usable))
