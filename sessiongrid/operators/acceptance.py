"""Comparing two sources of the same bars, and index checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_true
from ..sources.snapshots import row_hash
from .grid import per_session


def compare_sources(reference: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """reference rows with the other source's bar beside them, gaps and an open that lies in the day's range."""
    theirs = other.select(*keys, *[F.col(c).alias(f"other_{c}") for c in ("open", "high", "low", "close")], F.lit(True).alias("has_other"))
    rows = reference.join(theirs, keys, "left").withColumn("has_other", is_true(F.col("has_other")))
    gap = F.abs(F.col("close") - F.col("other_close"))
    return rows.withColumns({
        "close_gap": gap,
        "close_gap_pct": F.when(F.col("close") > 0, gap / F.col("close") * 100),
        "open_in_range": F.col("other_open").between(F.col("low"), F.col("high")),
        "price_conflict": is_true(gap > 1e-8),
    })


def acceptance_metrics(compared: DataFrame) -> DataFrame:
    """By period and ticker, with a total of each period under __ALL__ (grouping sets)."""
    sets = compared.groupingSets([["period", "ticker"], ["period"]], "period", "ticker")
    out = sets.agg(
        F.grouping("ticker").alias("is_total"), F.count("*").alias("n_rows"), F.count_if("has_other").alias("matched"), F.count_if("price_conflict").alias("conflicts"), F.count_if("open_in_range").alias("open_in_range"),
        F.percentile("close_gap_pct", F.array(F.lit(0.5), F.lit(0.95))).alias("q"), F.max("close_gap_pct").alias("max_gap_pct"),
    )
    return out.select("period", F.when(F.col("is_total") == 1, "__ALL__").otherwise(F.col("ticker")).alias("ticker"), "n_rows", "matched", (F.col("matched") / F.col("n_rows")).alias("match_rate"), "conflicts", "open_in_range", F.col("q")[0].alias("median_gap_pct"), F.col("q")[1].alias("p95_gap_pct"), "max_gap_pct")


def scale_metrics(compared: DataFrame) -> DataFrame:
    """By period and day group; a row counts in each group that it belongs to."""
    groups = F.array_compact(F.array(F.lit("all_days"), F.when(F.col("price_conflict"), "conflict_days"), F.when(~F.col("price_conflict") & F.col("has_other"), "agreeing_days"), F.when(~F.col("has_other"), "unmatched_days")))
    rows = compared.withColumn("day_group", F.explode(groups))
    return rows.groupBy("period", "day_group").agg(F.count("*").alias("n_rows"), F.countDistinct("ticker").alias("tickers"), F.avg("close_gap_pct").alias("mean_gap_pct"))


def acceptance_status(quality: DataFrame, errors: DataFrame, by: str = "period") -> DataFrame:
    """PASS, PARTIAL or FAIL with the first reason, by period; differences between sources are counted, never judged.

    quality: valid_nominal_ohlc (null where a bar is incomplete), split_factor_unavailable, nominal_conversion_consistent,
    has_yfinance_split, cross_source_price_warning. errors: one row for each provider error of a period; a period that has
    errors alone fails too.
    """
    evaluable = F.col("valid_nominal_ohlc").isNotNull()
    m = quality.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.bool_or(is_true(F.col("split_factor_unavailable"))).alias("no_factor"), F.bool_and(is_true(F.col("nominal_conversion_consistent"))).alias("consistent"), F.bool_or(is_true(F.col("has_yfinance_split"))).alias("split"),
        F.count_if(~evaluable).alias("missing_rows"), F.count_if(~F.col("valid_nominal_ohlc")).alias("invalid_rows"), F.count_if("valid_nominal_ohlc").alias("valid_rows"), F.count_if("cross_source_price_warning").alias("warning_rows"),
    )
    m = m.join(errors.groupBy(by).agg(F.count("*").alias("errors")), by, "full").fillna(0, subset=["errors", "n_rows", "missing_rows", "invalid_rows", "valid_rows", "warning_rows"])
    reason = (
        F.when(F.col("errors") > 0, "PROVIDER_ERRORS")
        .when(F.col("n_rows") == 0, "NO_ROWS")
        .when(F.col("no_factor"), "SPLIT_FACTOR_UNAVAILABLE")
        .when(~F.col("consistent"), "NOMINAL_CONVERSION_INCONSISTENT")
        .when(~F.col("split"), "NO_SPLIT_OBSERVED")
        .when(F.col("missing_rows") == F.col("n_rows"), "NO_EVALUABLE_ROW")
        .when(F.col("valid_rows") == 0, "NO_VALID_ROW")
        .otherwise("ACCEPTED")
    )
    status = F.when(F.col("reason") == "ACCEPTED", "PASS").when(F.col("reason") == "NO_SPLIT_OBSERVED", "PARTIAL").otherwise("FAIL")
    return m.withColumn("reason", reason).select(by, status.alias("status"), "reason", "errors", "missing_rows", "invalid_rows", "warning_rows")


def index_dates(raw: DataFrame, calendar: DataFrame, code: str, zone: str = "Europe/Istanbul") -> DataFrame:
    """Index rows by local date: timestamps are UTC milliseconds of local midnight."""
    ts = F.timestamp_millis(F.col("source_timestamp_ms"))
    local = F.from_utc_timestamp(ts, zone)
    rows = raw.where(F.col("index_code") == code).select("source_timestamp_ms", "source_value", F.to_date(ts).alias("utc_date"), F.to_date(local).alias("local_date"), F.date_add(F.to_date(ts), 1).alias("legacy_date"), ((F.hour(local) == 0) & (F.minute(local) == 0) & (F.second(local) == 0)).alias("local_midnight"))
    sessions = per_session(calendar.select("session_date", F.lit(True).alias("is_session")))
    for kind in ("local", "utc", "legacy"):
        rows = rows.join(sessions.select(F.col("session_date").alias(f"{kind}_date"), F.col("is_session").alias(f"{kind}_session")), f"{kind}_date", "left")
    return rows.fillna(False, subset=["local_session", "utc_session", "legacy_session"])


def index_validation(resolved: DataFrame) -> DataFrame:
    """One row: counts, the share of rows whose date is a session under each way to read it (UTC, local, the day after
    UTC), and the checks that an index must pass; one job."""
    ok = is_true((F.col("source_value") > 0) & (F.col("source_value") < float("inf")))
    m = resolved.agg(
        F.count("*").alias("n_rows"), F.countDistinct("source_timestamp_ms").alias("timestamps"), F.count_if(~ok).alias("bad_values"), F.count_if("local_midnight").alias("midnights"),
        F.count_if("local_session").alias("local_matches"), F.count_if("utc_session").alias("utc_matches"), F.count_if("legacy_session").alias("legacy_matches"),
        F.count_if(F.col("legacy_date") == F.col("local_date")).alias("legacy_equals_local"), F.countDistinct("local_date").alias("local_dates"),
    )
    good = (F.col("n_rows") > 0) & (F.col("timestamps") == F.col("n_rows")) & (F.col("bad_values") == 0) & (F.col("midnights") == F.col("n_rows")) & (F.col("local_matches") == F.col("n_rows")) & (F.col("utc_matches") < F.col("local_matches")) & (F.col("local_dates") == F.col("n_rows"))
    share = lambda c: F.when(F.col("n_rows") > 0, F.col(c) / F.col("n_rows"))
    ratios = {"utc_match_ratio": share("utc_matches"), "local_match_ratio": share("local_matches"), "legacy_match_ratio": share("legacy_matches"), "local_midnight_ratio": share("midnights"), "legacy_equals_local_ratio": share("legacy_equals_local")}
    return m.withColumns(ratios).withColumn("status", F.when(good, "VALIDATED").otherwise("REJECTED"))


def index_cross_check(panel: DataFrame, benchmark: DataFrame, least: int = 20) -> DataFrame:
    """By session with enough securities: median return of the securities against the index's; a diagnosis only."""
    from pyspark.sql import Window

    per = Window.partitionBy("security_id").orderBy("session_index")
    before = F.lag("close").over(per)
    rows = panel.withColumn("r", F.when(before > 0, F.col("close") / before - 1))
    days = rows.groupBy("prediction_date", "session_index").agg(F.count("r").alias("securities"), F.percentile("r", 0.5).alias("median_return")).where(F.col("securities") >= least)
    return days.join(per_session(benchmark), "prediction_date")


def largest_misses(quality: DataFrame, limit: int = 20) -> DataFrame:
    """The normal days whose nominal open lies outside the day's range, those with the widest gaps, at most ``limit``.

    Ties go by ticker and date; a row that misses a gap is last. Each task keeps its own ``limit`` rows.
    """
    misses = quality.where(F.col("normal_day") & ~F.col("nominal_open_within_range"))
    return misses.orderBy(F.col("nominal_open_range_gap").desc_nulls_last(), "ticker", "date").limit(limit)


def telemetry(attempts: DataFrame, key: str = "current_ticker") -> DataFrame:
    """By ticker over all attempts: requests, retries and how many attempts there were."""
    return attempts.groupBy(key).agg(F.coalesce(F.sum("network_request_count"), F.lit(0)).alias("network_request_count"), F.coalesce(F.sum("retry_count"), F.lit(0)).alias("retry_count"), F.count("*").alias("attempt_count"))


def same_scope(runs: DataFrame, reference: str, by: str = "run") -> DataFrame:
    """By run: rows, the digest of its rows whatever their order, and whether it is the reference run's.

    runs: the column ``by`` and those of the scope. The digest adds up the row hashes of all columns but ``by``; the
    reference run's is one row.
    """
    rows = runs.select(F.col(by).alias("__run"), row_hash(runs.drop(by)).alias("h"))
    quarter = lambda k: F.sum(F.conv(F.substring("h", 16 * k + 1, 16), 16, 10).cast("decimal(38,0)")).cast("string")
    digests = rows.groupBy("__run").agg(F.count("*").alias("n_rows"), *[quarter(k).alias(f"q{k}") for k in range(4)])
    digests = digests.select(F.col("__run").alias(by), "n_rows", F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), "q0", "q1", "q2", "q3"), 256).alias("scope_digest"))
    own = digests.where(F.col(by) == reference).select(F.col("scope_digest").alias("__wanted"))
    return digests.crossJoin(F.broadcast(own)).withColumn("scope_digest_equal", F.col("scope_digest") == F.col("__wanted")).drop("__wanted")
