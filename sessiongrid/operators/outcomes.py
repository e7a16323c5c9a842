"""Outcomes of a collection: one row for each planned period, then gaps, failures, retries and the status of securities.

The results of the sources of a planned row are one array of structs, put in the order in which their stages run and
folded from left to right, so all of an outcome comes from one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sanitized

#: Sources in the order of their stages, and what a stage is called once its table is complete (fixed values).
STAGES = {"isyatirim": ["ISYATIRIM_RAW"], "yfinance": ["YFINANCE_RAW", "YFINANCE_NOMINAL"]}
COUNTERS = ["network_request_count", "cache_hit_count", "retry_count", "timeout_count", "empty_range_count", "empty_range_cache_hit_count"]
PLAN = ["row_number", "security_id", "current_ticker", "provider_ticker", "period_start", "period_end", "collection_pass"]


def outcomes(results: DataFrame) -> DataFrame:
    """One row for each planned row (PLAN), from the results of its two sources.

    results: PLAN, source, raw_status and nominal_status (COMPLETE, PARTIAL, ..., null: no table), result (what stands for
    a status where there is none), failure_class, failure_reason, retry_recommended, COUNTERS, missing_ranges (array of
    start_date, end_date, failure_class, failure_reason, retry_recommended), elapsed_seconds. A source occurs once.
    """
    first, second = STAGES
    order = F.when(F.col("source") == first, 0).when(F.col("source") == second, 1).otherwise(2)
    result = F.struct(order.alias("place"), "source", "raw_status", "nominal_status", "result", "failure_class", "failure_reason", F.coalesce("retry_recommended", F.lit(False)).alias("retry_recommended"), "missing_ranges")
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS]
    rows = results.groupBy(*PLAN).agg(F.sort_array(F.collect_list(result)).alias("stages"), *sums, F.sum("elapsed_seconds").alias("elapsed_seconds"))

    def step(state: Column, r: Column) -> Column:
        """The last stage whose table is complete, and the last failure."""
        last = state["last_stage"]
        for source, names in STAGES.items():
            for name, status in zip(names, ("raw_status", "nominal_status")):
                last = F.when((r["source"] == source) & (r[status] == "COMPLETE"), F.lit(name)).otherwise(last)
        failed = F.coalesce(r["failure_reason"], F.lit("")) != ""
        return F.struct(
            last.alias("last_stage"), F.when(failed, F.upper(r["source"])).otherwise(state["stage"]).alias("stage"),
            F.when(failed, F.coalesce(r["failure_class"], F.lit(""))).otherwise(state["class"]).alias("class"), F.when(failed, r["failure_reason"]).otherwise(state["reason"]).alias("reason"),
        )

    none = F.lit("")
    folded = F.aggregate("stages", F.struct(none.alias("last_stage"), none.alias("stage"), none.alias("class"), none.alias("reason")), step)
    of = lambda source: F.get(F.filter("stages", lambda r: r["source"] == source), F.lit(0))
    gaps = F.flatten(F.transform("stages", lambda r: F.transform(F.coalesce(r["missing_ranges"], F.array().cast(results.schema["missing_ranges"].dataType)), lambda g: F.struct(F.upper(r["source"]).alias("provider"), g.alias("gap")))))
    rows = rows.withColumns({"folded": folded, "a": of(first), "b": of(second)})
    return rows.select(
        *PLAN, F.coalesce("a.raw_status", "a.result").alias(f"{first}_status"), F.coalesce("b.raw_status", "b.result").alias(f"{second}_status"), F.coalesce("b.nominal_status", F.lit("FAILED")).alias("nominal_status"),
        F.col("folded.last_stage").alias("last_successful_stage"), F.col("folded.stage").alias("failure_stage"), F.col("folded.class").alias("failure_class"), sanitized(F.col("folded.reason")).alias("failure_reason"),
        F.exists("stages", lambda r: r["retry_recommended"]).alias("retry_recommended"), *COUNTERS, "elapsed_seconds", gaps.alias("gaps"),
    )


def is_complete() -> Column:
    """Whether both sources and the derived table of an outcome are complete."""
    return F.forall(F.array(*[F.coalesce(F.col(f"{x}_status"), F.lit("")) for x in (*STAGES, "nominal")]), lambda s: s == "COMPLETE")


def security_status(found: DataFrame) -> DataFrame:
    """By security over its outcomes: COMPLETE if all are, NO_HISTORY if no source of any has something, FAILED if nothing
    is complete or partial, else PARTIAL; the last pass, whether a retry is recommended, and the last failure."""
    statuses = F.array(*[F.coalesce(F.col(f"{x}_status"), F.lit("")) for x in STAGES])
    some = F.exists(statuses, lambda s: s.isin("COMPLETE", "PARTIAL"))
    none = F.forall(statuses, lambda s: s == "NO_HISTORY")
    place = F.struct("collection_pass", "row_number")
    failed = F.when(F.col("failure_reason") != "", F.struct("failure_stage", "failure_class", "failure_reason"))
    rows = found.groupBy("security_id").agg(
        F.max_by("current_ticker", place).alias("current_ticker"), F.bool_and(is_complete()).alias("complete"), F.bool_and(none).alias("none"), F.bool_or(some).alias("some"),
        F.max("collection_pass").alias("last_collection_pass"), F.bool_or("retry_recommended").alias("retry_recommended"), F.max_by(failed, F.when(failed.isNotNull(), place)).alias("failed"),
        F.max_by("last_successful_stage", place).alias("last_successful_stage"), *[F.sum(c).alias(c) for c in COUNTERS],
    )
    status = F.when(F.col("complete"), "COMPLETE").when(F.col("none"), "NO_HISTORY").when(~F.col("some"), "FAILED").otherwise("PARTIAL")
    return rows.select("security_id", "current_ticker", status.alias("status"), "last_collection_pass", "retry_recommended", *[F.coalesce(f"failed.{c}", F.lit("")).alias(c) for c in ("failure_stage", "failure_class", "failure_reason")], "last_successful_stage", *COUNTERS)


def collection_gaps(status: DataFrame, found: DataFrame) -> DataFrame:
    """Every missing range of the securities that are not complete; a security without a status is UNATTEMPTED."""
    joined = found.join(status.select("security_id", "status"), "security_id", "left").withColumn("status", F.coalesce("status", F.lit("UNATTEMPTED")))
    each = joined.where("status <> 'COMPLETE'").select("*", F.explode("gaps").alias("g"))
    return each.select(
        "security_id", "current_ticker", F.col("g.provider").alias("provider"), "collection_pass", "row_number", "status", F.col("g.gap.start_date").alias("missing_start_date"), F.col("g.gap.end_date").alias("missing_end_date"),
        F.col("g.provider").alias("failure_stage"), F.col("g.gap.failure_class").alias("failure_class"), sanitized(F.col("g.gap.failure_reason")).alias("failure_reason"), "last_successful_stage",
        F.coalesce("g.gap.retry_recommended", F.lit(False)).alias("retry_recommended"), F.round("elapsed_seconds", 6).alias("elapsed_seconds"), *COUNTERS[:4],
    )


def collection_failures(status: DataFrame) -> DataFrame:
    """The securities of which there is nothing: FAILED and NO_HISTORY."""
    return status.where(F.col("status").isin("FAILED", "NO_HISTORY")).withColumnRenamed("last_collection_pass", "collection_pass")


def retries(first: DataFrame, second: DataFrame) -> DataFrame:
    """What to try once more after a first pass, and what came of it: security_id, first_status, then last_status and
    RECOVERED or REMAINING. PARTIAL ones are tried, and FAILED ones if a retry is recommended."""
    wanted = first.where((F.col("status") == "PARTIAL") | ((F.col("status") == "FAILED") & F.coalesce("retry_recommended", F.lit(False)))).select("security_id", F.col("status").alias("first_status"))
    after = wanted.join(second.select("security_id", F.col("status").alias("last_status")), "security_id", "left")
    return after.withColumn("outcome", F.when(F.col("last_status") == "COMPLETE", "RECOVERED").otherwise("REMAINING"))


def observed_status(status: DataFrame, observed: DataFrame, calendar: DataFrame) -> DataFrame:
    """status with first and last observed session, observed and missing sessions, longest inner gap, and whether the
    series begins late, ends early, or its mapping needs a look.

    observed: security_id, date; dates count once, and a gap is counted in sessions of the calendar (session_date).
    Securities that were never observed miss all sessions and are neither late nor early.
    """
    numbered = calendar.select(F.col("session_date").alias("date")).distinct().withColumn("k", F.row_number().over(Window.orderBy("date")))
    whole = numbered.agg(F.count("*").alias("sessions"), F.min("date").alias("low"), F.max("date").alias("high"))
    days = observed.select("security_id", "date").distinct().join(numbered, "date", "left")
    before = F.max("k").over(Window.partitionBy("security_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1))
    gap = F.when(F.col("k").isNotNull(), F.col("k") - before - 1)
    per = days.withColumn("gap", gap).groupBy("security_id").agg(F.min("date").alias("first_observed_date"), F.max("date").alias("last_observed_date"), F.count("*").alias("observed_session_count"), F.count("k").alias("on_calendar"), F.max("gap").alias("longest"))
    joined = status.join(per, "security_id", "left").crossJoin(F.broadcast(whole))  # one row
    late, early = F.coalesce(F.col("first_observed_date") > F.col("low"), F.lit(False)), F.coalesce(F.col("last_observed_date") < F.col("high"), F.lit(False))
    longest = F.coalesce("longest", F.lit(0)).cast("long")
    return joined.select(
        *status.columns, "first_observed_date", "last_observed_date", F.coalesce("observed_session_count", F.lit(0)).alias("observed_session_count"), (F.col("sessions") - F.coalesce("on_calendar", F.lit(0))).alias("missing_session_count"),
        longest.alias("longest_internal_gap_sessions"), late.alias("late_start"), early.alias("early_end"), (late | early | (longest > 0)).alias("mapping_review_required"),
    )


def collection_report(securities: DataFrame, status: DataFrame, found: DataFrame) -> DataFrame:
    """One row: securities by status, what the second pass recovered, and the share of the attempted ones (1 at least) whose
    source or derived table is complete in all outcomes. securities: security_id of the whole universe."""
    parts = found.groupBy("security_id").agg(*[F.bool_and(F.coalesce(F.col(f"{x}_status") == "COMPLETE", F.lit(False))).alias(x) for x in (*STAGES, "nominal")])
    rows = securities.select("security_id").distinct().join(status.select("security_id", "status", "last_collection_pass"), "security_id", "left").join(parts, "security_id", "left")
    attempted = F.col("status").isNotNull() & ~F.coalesce(F.col("status").isin("PENDING", "UNATTEMPTED"), F.lit(False))
    second = F.col("last_collection_pass") == 2
    is_ = lambda s, more=F.lit(True): F.count_if((F.col("status") == s) & more)
    n = F.greatest(F.count_if(attempted), F.lit(1))
    return rows.agg(
        F.count("*").alias("master_security_count"), F.count_if(attempted).alias("attempted_security_count"), *[is_(s).alias(f"{s.lower()}_security_count") for s in ("COMPLETE", "PARTIAL", "FAILED", "NO_HISTORY")], F.count_if(~attempted).alias("unattempted_security_count"),
        *[(F.count_if(attempted & F.col(x)) / n).alias(f"{x}_success_rate") for x in (*STAGES, "nominal")], is_("COMPLETE", F.col("last_collection_pass") == 1).alias("first_pass_complete_count"), F.count_if(second).alias("retry_pass_attempted_count"),
        is_("COMPLETE", second).alias("retry_pass_recovered_count"), is_("PARTIAL", second).alias("retry_pass_remaining_partial_count"), is_("FAILED", second).alias("retry_pass_remaining_failed_count"),
    )
