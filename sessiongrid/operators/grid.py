"""Session calendars and dense entity x session grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import unique


def build_calendar(*observed: DataFrame, date: str = "prediction_date") -> DataFrame:
    """(session_date, session_index): the distinct observed sessions, numbered from 0.

    Each frame is reduced to its distinct dates before the union; the numbering window sees sessions alone.
    """
    dates = None
    for df in observed:
        part = df.select(F.col(date).alias("session_date")).where(F.col(date).isNotNull()).distinct()
        dates = part if dates is None else dates.union(part)
    numbered = F.row_number().over(Window.orderBy("session_date")) - 1
    return dates.distinct().select("session_date", numbered.cast("long").alias("session_index"))


def per_session(df: DataFrame) -> DataFrame:
    """df, which has one row for each session, for a broadcast: there are 36,525 dates in a century, so its size is
    bounded whatever the panel's is."""
    return F.broadcast(df)


def densify(observations: DataFrame, calendar: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """Every security on every session, with _source_row_present; benchmark adds its columns by session.

    Two observations of a security and session fail the query.
    """
    grid = observations.select("security_id").distinct().crossJoin(per_session(calendar.withColumnRenamed("session_date", "prediction_date")))
    rows = grid.join(observations.withColumn("_source_row_present", F.lit(True)), ["security_id", "prediction_date"], "left")
    rows = unique(rows.withColumn("_source_row_present", F.coalesce("_source_row_present", F.lit(False))), ["security_id", "prediction_date"])
    return rows.join(per_session(benchmark), "prediction_date", "left") if benchmark is not None else rows


def outside_calendar(observations: DataFrame, calendar: DataFrame, date: str = "prediction_date") -> DataFrame:
    """Rows whose date is no session: within the calendar's bounds an exclusion, outside them an error."""
    bounds = calendar.agg(F.min("session_date").alias("low"), F.max("session_date").alias("high"))
    rows = observations.join(per_session(calendar), observations[date] == calendar["session_date"], "left_anti").crossJoin(F.broadcast(bounds))  # one row
    inside = F.col(date).between(F.col("low"), F.col("high"))
    return rows.withColumn("exclusion_reason", F.when(inside, "YFINANCE_NON_SESSION_WITHIN_VERIFIED_CALENDAR_BOUNDS").otherwise("OUTSIDE_CALENDAR_BOUNDS")).drop("low", "high")


def shift_sessions(rows: DataFrame, calendar: DataFrame, by: int, name: str, date: str = "prediction_date") -> DataFrame:
    """rows with the date ``by`` sessions later (null past the end), by way of the session's number."""
    here = calendar.select(F.col("session_date").alias(date), (F.col("session_index") + by).alias("__to"))
    there = calendar.select(F.col("session_index").alias("__to"), F.col("session_date").alias(name))
    return rows.join(per_session(here), date, "left").join(per_session(there), "__to", "left").drop("__to")


def internal_gaps(observations: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per security: observed, missing and longest run of missing sessions between its first and last observation."""
    sessions = calendar.withColumnRenamed("session_date", "prediction_date")
    rows = observations.select("security_id", "prediction_date").distinct().join(per_session(sessions), "prediction_date")
    gap = F.lead("session_index").over(Window.partitionBy("security_id").orderBy("session_index")) - F.col("session_index") - 1
    return (
        rows.withColumn("gap", F.coalesce(gap, F.lit(0)))
        .groupBy("security_id")
        .agg(
            F.min("prediction_date").alias("first_observed"),
            F.max("prediction_date").alias("last_observed"),
            F.count("*").alias("observed_sessions"),
            F.sum("gap").cast("long").alias("missing_sessions"),
            F.max("gap").cast("long").alias("longest_gap"),
        )
    )
