"""The feature query end to end: bars to sessions to 32 features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bars import benchmark
from ..operators.features import FEATURES, all_features, on_sessions
from ..operators.grid import build_calendar, densify


def dense(panel: DataFrame) -> DataFrame:
    """The panel on every session of its own calendar, with its own index."""
    return densify(panel, build_calendar(panel), benchmark(panel))


def observed(panel: DataFrame) -> DataFrame:
    """The panel's rows on its own sessions with its own index; one aggregation gives both, and no row is made up.

    The index is asked for all columns that features read, by a count that every session passes, so that both read the
    same shuffled rows; with the close alone Spark would shuffle the trades once more for it.
    """
    number = F.row_number().over(Window.orderBy("prediction_date")) - 1
    index = benchmark(panel, F.greatest(F.count("*"), *[F.count(c) for c in ("open", "high", "low", "tl_volume")]).alias("__rows")).where("prediction_date is not null and __rows > 0")
    sessions = index.drop("__rows").withColumn("session_index", number.cast("long"))
    return on_sessions(panel, sessions)


def feature_query(panel: DataFrame) -> DataFrame:
    return all_features(observed(panel)).select("security_id", "prediction_date", "session_index", *FEATURES)
