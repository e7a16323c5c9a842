"""The training plan: universe, features and labels put together behind its guards."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.checks import unique
from ..operators.universe import KEY, training_panel
from .guards import guard


def training_plan(universe: DataFrame, features: DataFrame, labels: DataFrame, calendar: DataFrame, as_of: str, horizon: int = 3) -> DataFrame:
    """training_panel of tables that pass: features bear no column of the future (checked at once), and no two rows of the
    panel share a security and a day (fails when run, whatever is read), so each table had one row for each."""
    guard(features.drop(*KEY), required=[])
    return unique(training_panel(universe, features, labels, calendar, as_of, horizon), list(KEY))
