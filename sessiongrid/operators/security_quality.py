"""Quality of each security and of the whole panel.

Identity rows, observations, clean rows and labels are tagged and stacked, and added up in one aggregation: one shuffle by
security with a partial step before it, instead of four aggregations and the joins between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import unique
from ..functions.nulls import is_true, number
from .features import FEATURES, RANKS

PRICES = [f"yf_nominal_{x}" for x in ("open", "high", "low", "close")]
COUNTS = [
    "observed_session_count", "invalid_or_missing_ohlc_count", "non_positive_price_count", "both_volumes_missing_or_zero_count", "cross_source_warning_count", "entry_eligible_count", "requires_review_count",
    "positive_label_count", "negative_label_count", "na_label_count",
]


def invalid_bar() -> Column:
    """A nominal price is missing, not finite or not positive, or the four contradict each other."""
    o, h, low, c = (number(F.col(x)) for x in PRICES)
    good = (o > 0) & (h > 0) & (low > 0) & (c > 0) & (h >= F.greatest(o, c)) & (low <= F.least(o, c)) & (h >= low)
    return ~is_true(good)


def _tagged(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    return df.select("security_id", *[(flags[c] if c in flags else F.lit(False)).cast("boolean").alias(c) for c in COUNTS])


def by_security(status: DataFrame, identity: DataFrame, observations: DataFrame, clean: DataFrame, labels: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row for each security of status with its 16 figures.

    status: security_id, current_ticker, missing_session_count, longest_internal_gap_sessions, collection_complete. identity:
    security_id and PRICES; observations: security_id, is_tl_volume, yf_share_volume; clean: security_id,
    cross_source_price_warning, entry_eligible, requires_review; labels: security_id, label, label_status; calendar: one
    row for each session. A security without rows has zeros.
    """
    positive = lambda x: is_true(number(F.col(x)) > 0)
    low = [F.col(x).try_cast("double") <= 0 for x in PRICES]
    stacked = _tagged(identity, {"observed_session_count": F.lit(True), "invalid_or_missing_ohlc_count": invalid_bar(), "non_positive_price_count": is_true(low[0]) | is_true(low[1]) | is_true(low[2]) | is_true(low[3])})
    for part in (
        _tagged(observations, {"both_volumes_missing_or_zero_count": ~positive("is_tl_volume") & ~positive("yf_share_volume")}),
        _tagged(clean, {"cross_source_warning_count": is_true(F.col("cross_source_price_warning")), "entry_eligible_count": is_true(F.col("entry_eligible")), "requires_review_count": is_true(F.col("requires_review"))}),
        _tagged(labels, {"positive_label_count": is_true(F.col("label") == 1), "negative_label_count": is_true(F.col("label") == 0), "na_label_count": ~is_true(F.col("label_status") == "LABELED")}),
    ):
        stacked = stacked.unionByName(part)
    counted = stacked.groupBy("security_id").agg(*[F.count_if(c).alias(c) for c in COUNTS])
    sessions = calendar.agg(F.greatest(F.count("*"), F.lit(1)).alias("__sessions"))  # one row
    joined = status.join(counted, "security_id", "left").crossJoin(F.broadcast(sessions)).fillna(0, subset=COUNTS)
    return joined.select(
        "security_id", "current_ticker", "observed_session_count", (F.col("observed_session_count") / F.col("__sessions")).alias("observed_session_ratio"), "missing_session_count", "longest_internal_gap_sessions",
        *COUNTS[1:], "collection_complete",
    )


def panel_summary(features: DataFrame, calendar: DataFrame, index: DataFrame) -> DataFrame:
    """One row over the feature table: rows, securities, missing and infinite values, days on which every rank has a value,
    least, median and largest number of securities with all 32 features on a day, sessions, and the share that the index has.

    features: security_id, prediction_date and the 32, unique by key, or the query fails. Each day is one row after the
    first aggregation; medians and shares are over days.
    """
    values = [F.col(f).try_cast("double") for f in FEATURES]
    whole, missing, endless = F.lit(True), F.lit(0), F.lit(0)
    for x in values:
        none = x.isNull() | F.isnan(x)
        whole, missing, endless = whole & ~none, missing + none.cast("int"), endless + is_true(F.abs(x) == float("inf")).cast("int")
    ranked = F.lit(True)
    for r in RANKS:
        ranked = ranked & (F.count(r) > 0)
    days = unique(features, ["security_id", "prediction_date"]).groupBy("prediction_date").agg(F.count("*").alias("n"), F.count_if(whole).alias("valid"), F.sum(missing).alias("missing"), F.sum(endless).alias("endless"), ranked.alias("ranked"))
    of_days = days.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("feature_rows"), F.coalesce(F.sum("missing"), F.lit(0)).alias("feature_nan_count"), F.coalesce(F.sum("endless"), F.lit(0)).alias("infinite_feature_value_count"),
        F.count_if("ranked").alias("cross_sectional_rank_date_count"), F.coalesce(F.min("valid"), F.lit(0)).alias("daily_valid_min"), F.coalesce(F.percentile("valid", 0.5), F.lit(0.0)).alias("daily_valid_median"), F.coalesce(F.max("valid"), F.lit(0)).alias("daily_valid_max"),
    )
    known = index.select(F.col("prediction_date").alias("session_date")).distinct().withColumn("known", F.lit(1))
    dates = calendar.select("session_date").distinct().join(known, "session_date", "left")
    of_dates = dates.agg(F.count("*").alias("global_calendar_session_count"), (F.count("known") / F.greatest(F.count("*"), F.lit(1))).alias("index_calendar_match_ratio"))
    return of_days.crossJoin(F.broadcast(of_dates))  # one row each
