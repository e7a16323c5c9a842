"""Data-quality classification and entry eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import security, close_symmetric, is_true
from .ticks import upper_limits

#: Reasons in order of priority (fixed values).
REASONS = ["NO_OPEN", "NO_TRADE", "INVALID_OHLC", "NO_PREVIOUS_CLOSE", "SPECIAL_MARGIN_OR_CORPORATE_ACTION", "LIMIT_OPEN", "CORPORATE_ACTION_WINDOW", "PRICE_STEP_UNAVAILABLE"]
HORIZON = 3
LIMIT_REL, LIMIT_ABS = 1e-12, 1e-8


def ordered(flags: dict[str, Column]) -> Column:
    """The names whose flag holds, in order of priority; no sort is needed."""
    return F.array_compact(F.array(*[F.when(is_true(flags[r]), F.lit(r)) for r in REASONS if r in flags]))


def ohlc_quality(rows: DataFrame) -> DataFrame:
    """has_open, valid_nominal_ohlc (null without an open) and ohlc_quality_flag."""
    names = ["open", "high", "low", "close"]
    rows = rows.withColumns({f"yf_nominal_{n}": F.col(f"yf_nominal_{n}").try_cast("double") for n in names})
    o, h, low, c = (F.col(f"yf_nominal_{n}") for n in names)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf"))
    valid = is_true(good(o) & good(h) & good(low) & good(c) & (low <= o) & (o <= h) & (low <= c) & (c <= h))
    has_open = is_true(good(o))
    flag = F.when(~F.col("has_open"), "NO_OPEN").when(~F.col("valid_nominal_ohlc"), "INVALID_OHLC").otherwise("VALID")
    rows = rows.withColumn("has_open", has_open).withColumn("valid_nominal_ohlc", F.when(has_open, valid))
    return rows.withColumn("ohlc_quality_flag", flag).withColumns({f"missing_nominal_{n}": F.col(f"yf_nominal_{n}").isNull() for n in names})


def volume_quality(rows: DataFrame) -> DataFrame:
    """Flags of the two volumes and volume_quality_flag; a comparison with a missing volume is false."""
    a, b = F.col("is_tl_volume").try_cast("double"), F.col("yf_share_volume").try_cast("double")
    up = is_true(a > 0) | is_true(b > 0)
    zero, gone = is_true((a == 0) & (b == 0)), a.isNull() & b.isNull()
    one_gone = a.isNull() != b.isNull()
    one_zero = is_true((a == 0) & (b > 0)) | is_true((b == 0) & (a > 0))
    negative = is_true(a < 0) | is_true(b < 0)
    rows = rows.withColumns({"both_volumes_zero": zero, "both_volumes_missing": gone, "one_volume_missing": one_gone, "positive_volume_evidence": up})
    conflict = F.col("positive_volume_evidence") & (one_gone | one_zero)
    short = ~F.col("both_volumes_zero") & ~F.col("both_volumes_missing") & ~F.col("positive_volume_evidence")
    flag = (
        F.when(F.col("both_volumes_zero"), "BOTH_VOLUMES_ZERO")
        .when(F.col("both_volumes_missing"), "BOTH_VOLUMES_MISSING_UNRESOLVED")
        .when(conflict, "SOURCE_VOLUME_CONFLICT")
        .when(negative, "INVALID_VOLUME_REQUIRES_REVIEW")
        .when(short, "VOLUME_EVIDENCE_INSUFFICIENT")
        .otherwise("POSITIVE_VOLUME_CONFIRMED")
    )
    return rows.withColumns({"volume_source_conflict": conflict, "volume_requires_review": F.col("both_volumes_missing") | negative | short, "volume_quality_flag": flag})


def action_signals(rows: DataFrame) -> DataFrame:
    """Corporate-action evidence of a day and where it comes from."""
    zero = lambda c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) if c in rows.columns else F.lit(0.0)
    split, dividend = zero("yf_stock_splits") != 0, zero("yf_dividends") != 0
    other = F.abs(zero("yf_capital_gains")) + F.abs(zero("yf_other_action_value")) > 0
    factor = is_true(F.col("adjustment_factor_changed")) if "adjustment_factor_changed" in rows.columns else F.lit(False)
    provider = split | dividend | other
    source = F.when(factor & provider, "both").when(factor, "isyatirim_only").when(provider, "yfinance_only").otherwise("none")
    count = factor.cast("int") + provider.cast("int")
    return rows.withColumns({
        "corporate_action_flag": factor | provider,
        "corporate_action_source": source,
        "corporate_action_source_count": count,
        "corporate_action_source_agreement": F.when(count == 2, "BOTH_SOURCES").when(count == 1, "SINGLE_SOURCE").otherwise("NO_SIGNAL"),
        "corporate_action_signal_sources": F.array_compact(F.array(F.when(factor, "isyatirim_adjustment_factor"), F.when(provider, "yfinance_actions"))),
    })


def action_windows(rows: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Signals within the next sessions of the grid: flag, dates, sources, and whether all these sessions exist."""
    ahead = security().rowsBetween(1, horizon)
    flag = is_true(F.col("corporate_action_flag"))
    return rows.withColumns({
        "corporate_action_window_flag": is_true(F.max(flag.cast("int")).over(ahead) == 1),
        "corporate_action_window_dates": F.array_sort(F.collect_list(F.when(flag, F.col("date"))).over(ahead)),
        "corporate_action_window_signal_sources": F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(flag, F.col("corporate_action_signal_sources"))).over(ahead)))),
        "corporate_action_window_complete": F.count(F.lit(1)).over(ahead) == horizon,
    })


def cross_source_warning(rows: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """Differences of the two sources' high, low and close; the warning is null where nothing compares."""
    made, over = {}, []
    for f in ("high", "low", "close"):
        raw = F.col(f"is_raw_{f}").try_cast("double")
        gap = F.abs(raw - F.col(f"yf_nominal_{f}"))
        made[f"nominal_{f}_absolute_difference"] = gap
        made[f"nominal_{f}_percentage_difference"] = F.when(raw != 0, gap / F.abs(raw) * 100)
        over.append(gap)
    some = over[0].isNotNull() | over[1].isNotNull() | over[2].isNotNull()
    any_over = is_true(over[0] > tolerance) | is_true(over[1] > tolerance) | is_true(over[2] > tolerance)
    return rows.withColumns(made | {"cross_source_price_warning": F.when(some, any_over)})


def basic_eligibility(rows: DataFrame) -> DataFrame:
    """Reasons of a row from OHLC and volume alone; eligible is null where only a review can tell."""
    reasons = ordered({"NO_OPEN": ~F.col("has_open"), "NO_TRADE": F.col("both_volumes_zero"), "INVALID_OHLC": F.col("ohlc_quality_flag") == "INVALID_OHLC"})
    rows = rows.withColumn("entry_exclusion_reasons", reasons)
    eligible = F.when(F.size("entry_exclusion_reasons") > 0, False).when(~F.col("volume_requires_review"), True)
    return rows.withColumns({"entry_eligible": eligible, "entry_exclusion_reason": F.try_element_at("entry_exclusion_reasons", F.lit(1)), "requires_review": F.col("volume_requires_review")})


def previous_valid_close(rows: DataFrame) -> DataFrame:
    """The last valid close strictly before the row."""
    close = F.when(F.col("ohlc_quality_flag") == "VALID", F.col("yf_nominal_close"))
    return rows.withColumn("previous_nominal_close", F.last(close, ignorenulls=True).over(security().rowsBetween(Window.unboundedPreceding, -1)))


def above(a: Column, b: Column) -> Column:
    return (a > b) & ~close_symmetric(a, b, LIMIT_REL, LIMIT_ABS)


def daily_frame(grid: DataFrame, rules: DataFrame) -> DataFrame:
    """Everything known of each security and session of a dense grid, before T and T+1 are paired."""
    rows = cross_source_warning(action_windows(action_signals(volume_quality(ohlc_quality(grid)))))
    return upper_limits(previous_valid_close(basic_eligibility(rows)), rules)


CARRIED = [
    "yf_nominal_open", "yf_nominal_high", "yf_nominal_low", "yf_nominal_close", "is_tl_volume", "yf_share_volume", "previous_nominal_close", "raw_upper_limit", "tick_size",
    "estimated_upper_limit", "price_step_resolution_status", "ohlc_quality_flag", "volume_quality_flag", "cross_source_price_warning", "corporate_action_flag", "corporate_action_source_count",
]


def clean_eligibility(grid: DataFrame, rules: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Rows (security, T) whose T+1..T+horizon are sessions, with the entry's data and eligibility.

    grid must be dense (security_id, session_index, date, ...): the next row is the next session, so T+1 is a lead of
    the same window and no self-join is needed.
    """
    day = daily_frame(grid, rules)
    entry = F.lead(F.struct("date", "entry_exclusion_reasons", "requires_review", *CARRIED), 1).over(security())
    paired = day.withColumn("entry", entry).where("corporate_action_window_complete")
    e = lambda c: F.col(f"entry.{c}")
    no_close, no_limit = e("previous_nominal_close").isNull(), e("estimated_upper_limit").isNull()
    known = ~no_close & ~no_limit
    o, h, limit = e("yf_nominal_open"), e("yf_nominal_high"), e("estimated_upper_limit")
    special = known & is_true(o.isNotNull() & h.isNotNull() & (above(o, limit) | above(h, limit)))
    limit_open = known & ~special & is_true(close_symmetric(o, limit, LIMIT_REL, LIMIT_ABS))
    base = {r: F.array_contains(e("entry_exclusion_reasons"), r) for r in REASONS[:3]}
    reasons = ordered(base | {
        "NO_PREVIOUS_CLOSE": no_close, "PRICE_STEP_UNAVAILABLE": ~no_close & no_limit, "SPECIAL_MARGIN_OR_CORPORATE_ACTION": special,
        "LIMIT_OPEN": limit_open, "CORPORATE_ACTION_WINDOW": F.col("corporate_action_window_flag"),
    })
    rows = paired.select(
        "security_id", F.col("date").alias("prediction_date"), e("date").alias("entry_date"), *[e(c).alias(c) for c in CARRIED],
        "corporate_action_window_flag", "corporate_action_window_dates", "corporate_action_window_signal_sources",
        reasons.alias("entry_exclusion_reasons"), (e("requires_review") | no_close | no_limit | special).alias("requires_review"),
    )
    hard = F.size(F.filter("entry_exclusion_reasons", lambda r: r != "PRICE_STEP_UNAVAILABLE")) > 0
    review = F.col("requires_review") | F.array_contains("entry_exclusion_reasons", "PRICE_STEP_UNAVAILABLE")
    return rows.withColumns({
        "entry_eligible": F.when(hard, False).when(~review, True),
        "entry_exclusion_reason": F.try_element_at("entry_exclusion_reasons", F.lit(1)),
        "entry_exclusion_detail": F.when(F.array_contains("entry_exclusion_reasons", "NO_PREVIOUS_CLOSE"), "FIRST_TRADING_DAY_OR_NO_HISTORY"),
    })


def clean_summary(clean: DataFrame) -> DataFrame:
    """Rows by exclusion reason, with the totals under the reason ``ALL``."""
    each = clean.select(F.explode(F.concat(F.array(F.lit("ALL")), "entry_exclusion_reasons")).alias("reason"), "entry_eligible", "requires_review", "corporate_action_window_flag")
    return each.groupBy("reason").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("entry_eligible")).alias("eligible"), F.count_if(~F.col("entry_eligible")).alias("excluded"),
        F.count_if(F.col("entry_eligible").isNull()).alias("undecided"), F.count_if("requires_review").alias("review"), F.count_if("corporate_action_window_flag").alias("in_action_window"),
    )


def clean_totals(clean: DataFrame) -> DataFrame:
    """One row: the 20 counts of a clean frame."""
    held = lambda r: F.count_if(F.array_contains("entry_exclusion_reasons", r))
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return clean.agg(
        F.count("*").alias("row_count"), F.count_if("entry_eligible").alias("entry_eligible_true"), F.count_if(~F.col("entry_eligible")).alias("entry_eligible_false"), F.count_if(F.col("entry_eligible").isNull()).alias("entry_eligible_unresolved"),
        F.count_if("requires_review").alias("requires_review"), *[held(r).alias(r) for r in ("NO_OPEN", "NO_TRADE", "INVALID_OHLC", "NO_PREVIOUS_CLOSE", "LIMIT_OPEN", "SPECIAL_MARGIN_OR_CORPORATE_ACTION", "CORPORATE_ACTION_WINDOW", "PRICE_STEP_UNAVAILABLE")],
        is_("price_step_resolution_status", "RESOLVED").alias("price_step_resolution_resolved"), is_("price_step_resolution_status", "UNAVAILABLE").alias("price_step_resolution_unavailable"),
        is_("volume_quality_flag", "BOTH_VOLUMES_MISSING_UNRESOLVED").alias("both_volumes_missing"), is_("volume_quality_flag", "SOURCE_VOLUME_CONFLICT").alias("one_volume_conflict"),
        F.count_if("corporate_action_window_flag").alias("corporate_action_window_rows"), F.count_if("cross_source_price_warning").alias("cross_source_warning"),
    )


def exceptions(clean: DataFrame, limit: int) -> DataFrame:
    """The first rows (by security and day) that are not eligible, need a review or bear a price warning, at most ``limit``."""
    odd = ~is_true(F.col("entry_eligible")) | is_true(F.col("requires_review")) | is_true(F.col("cross_source_price_warning"))
    return clean.where(odd).orderBy("security_id", "prediction_date").limit(max(0, limit))


#: The first day that models learn from (fixed value).
MODEL_START = "2020-03-13"


def from_model_start(rows: DataFrame, date: str = "prediction_date") -> DataFrame:
    """rows from the models' first day on; Spark pushes the bound to the scan."""
    return rows.where(F.col(date) >= F.lit(MODEL_START).cast("date"))
