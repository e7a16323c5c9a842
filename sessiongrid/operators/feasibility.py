"""Which sessions may open the first test block, and what the windows of that fold would hold.

The panel is added up by session once; all else sees one row for each session. A session's labels count for a window
from the session on that follows the day they are known, so the growing fit window of every candidate is one running
aggregate over sessions in the order in which they become usable: sums and extremes carry over from row to row, and the
median comes from a running histogram of daily counts. The validation and test windows are short: a session is
handed to the candidates whose window holds it. No candidate meets all sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .folds import FoldConfig

#: Years of the early period (fixed values).
EARLY_YEARS = (2020, 2021)
#: Why a candidate makes no fold at all (fixed values).
NO_VALIDATION = "insufficient sessions for the validation window"
NO_FIT = "insufficient post-warm-up purged fit sessions before first validation"
NO_TEST_BLOCK = "no complete walk-forward test block can be generated"
#: Columns of the scan in their order (fixed values).
COLUMNS = [
    "candidate_first_test_date", "feasible", "failure_reason", "warmup_session_count", "fit_start_date", "fit_end_date", "fit_calendar_session_count", "fit_contract_labeled_session_count",
    "fit_purged_session_count", "fit_available_label_session_count", "fit_row_count", "fit_positive_count", "fit_negative_count", "fit_daily_row_count_min", "fit_daily_row_count_median",
    "fit_daily_row_count_max", "fit_2020_2021_session_count", "fit_2020_2021_row_count", "validation_start_date", "validation_end_date", "validation_calendar_session_count",
    "validation_contract_labeled_session_count", "validation_purged_session_count", "validation_available_label_session_count", "validation_row_count", "validation_positive_count",
    "validation_negative_count", "validation_daily_row_count_min", "validation_daily_row_count_median", "validation_daily_row_count_max", "validation_2020_2021_session_count",
    "validation_2020_2021_row_count", "test_start_date", "test_end_date", "test_calendar_session_count", "test_row_count", "test_labeled_row_count", "test_positive_count", "test_negative_count",
    "test_na_label_count", "test_daily_row_count_min", "test_daily_row_count_median", "test_daily_row_count_max", "total_complete_fold_count",
]


def daily_totals(panel: DataFrame) -> DataFrame:
    """By prediction_date, over eligible rows: usable labels (rows, positive, negative, when all are known) and the test view."""
    status, label = F.col("label_status"), F.col("label")
    usable = (status == "LABELED") & label.isin(0, 1) & F.col("label_available_date").isNotNull()
    labelled = F.coalesce(status == "LABELED", F.lit(False))
    return panel.where("prediction_eligible").groupBy("prediction_date").agg(
        F.count_if(usable).alias("n"), F.count_if(usable & (label == 1)).alias("pos"), F.count_if(usable & (label == 0)).alias("neg"), F.max(F.when(usable, F.col("label_available_date"))).alias("known"),
        F.count("*").alias("rows"), F.count_if(labelled).alias("labelled"), F.count_if(label == 1).alias("all_pos"), F.count_if(label == 0).alias("all_neg"), F.count_if(~labelled).alias("na"),
    )


def _sessions(calendar: DataFrame, config: FoldConfig) -> DataFrame:
    """Per candidate t: its date, the dates of its windows, and the number of sessions in all."""
    c, order = config, Window.orderBy("t")
    date = lambda by: F.lag("date", by).over(order) if by >= 0 else F.lead("date", -by).over(order)
    rows = calendar.select(F.col("session_index").cast("int").alias("t"), F.col("session_date").alias("date"))
    return rows.withColumns({
        "last_day": F.date_sub(F.coalesce(F.lead("date").over(order), F.date_add("date", 1)), 1),
        "fit_start": F.nth_value("date", c.history).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "fit_end": date(c.validation + 1), "validation_start": date(c.validation),
        "validation_end": date(1), "test_end": date(1 - c.test), "total": F.count("*").over(Window.partitionBy()).cast("int"),
        "warm": F.count_if(F.col("t") < c.history - 1).over(Window.partitionBy()), "held_out": F.count("*").over(order.rangeBetween(-c.validation, -1)), "tested": F.count("*").over(order.rangeBetween(0, c.test - 1)),
    })


def _window_totals(name: str, n: Column, pos: Column, neg: Column, early: Column, over=lambda x: x) -> dict[str, Column]:
    """The nine figures of a window of sessions, of those with n alone; over makes an aggregate a window function."""
    count = lambda x: F.coalesce(over(x), F.lit(0)).cast("long")
    return {
        f"{name}_available_label_session_count": count(F.count(n)), f"{name}_row_count": count(F.sum(n)), f"{name}_positive_count": count(F.sum(pos)), f"{name}_negative_count": count(F.sum(neg)),
        f"{name}_daily_row_count_min": count(F.min(n)), f"{name}_daily_row_count_median": F.coalesce(over(F.percentile(n, 0.5)), F.lit(0.0)), f"{name}_daily_row_count_max": count(F.max(n)),
        f"{name}_2020_2021_session_count": count(F.count(F.when(early, n))), f"{name}_2020_2021_row_count": count(F.sum(F.when(early, n))),
    }


def scan(panel: DataFrame, calendar: DataFrame, as_of: str, config: FoldConfig = FoldConfig()) -> DataFrame:
    """One row for each session up to as_of as first test session: the 44 COLUMNS.

    calendar: (session_date, session_index) from 0 without gaps. Dates are ISO text. Where no fold can be made,
    failure_reason says why and the figures are zero; else it lists the codes of what is amiss, joined by |.
    """
    c = config
    sessions = _sessions(calendar.where(F.col("session_date") <= F.lit(as_of).cast("date")), c)
    # By day, the first session behind it; a day behind the last session has none.
    upto = sessions.select((F.col("t") + 1).alias("behind"), F.explode(F.sequence("date", "last_day")).alias("known"))
    days = sessions.join(daily_totals(panel), F.col("date") == F.col("prediction_date"), "left").join(upto, "known", "left")
    t, usable = F.col("t"), F.greatest(F.col("t") + 1, F.col("behind"))
    early = F.year("date").isin(*EARLY_YEARS)
    measures = ("n", "pos", "neg", "rows", "labelled", "all_pos", "all_neg", "na")

    def event(kind: str, at: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("candidate"), early.alias("early"), *[F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in measures])

    def events(kind: str, first: Column, last: Column) -> Column:
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda x: event(kind, x)))

    none = F.array().cast(f"array<struct<kind:string,candidate:int,early:boolean,{','.join(f'{m}:bigint' for m in measures)}>>")
    handed = F.concat(
        F.coalesce(F.when((t >= c.history - 1) & F.col("behind").isNotNull(), F.array(event("fit", usable + c.validation))), none),
        F.coalesce(F.when(F.col("behind").isNotNull(), events("validation", usable, t + c.validation)), none),
        events("test", t - c.test + 1, t),
        F.array(event("self", t)),
    )
    each = days.select(F.inline(handed))
    of = lambda kind, x: F.when(F.col("kind") == kind, F.col(x))
    is_early = F.col("early")
    rows = of("test", "rows")
    whole = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    totals = each.groupBy("candidate").agg(
        F.max(F.col("kind") == "self").alias("real"),
        F.collect_list(F.when(F.col("kind") == "fit", F.struct("n", "pos", "neg", "early"))).alias("fit"),
        *[x.alias(name) for name, x in _window_totals("validation", of("validation", "n"), of("validation", "pos"), of("validation", "neg"), is_early).items()],
        *[whole(F.sum(of("test", m))).alias(name) for m, name in (("rows", "test_row_count"), ("labelled", "test_labeled_row_count"), ("all_pos", "test_positive_count"), ("all_neg", "test_negative_count"), ("na", "test_na_label_count"))],
        whole(F.min(rows)).alias("test_daily_row_count_min"), F.coalesce(F.percentile(rows, 0.5), F.lit(0.0)).alias("test_daily_row_count_median"), whole(F.max(rows)).alias("test_daily_row_count_max"),
    )
    others = [x for x in totals.columns if x not in ("candidate", "fit")]
    stepped = totals.select("candidate", *others, F.posexplode_outer("fit").alias("place", "day")).select("candidate", *others, "place", "day.*")
    so_far = Window.orderBy("candidate").rangeBetween(Window.unboundedPreceding, 0)
    running = stepped.withColumns(_window_totals("fit", F.col("n"), F.col("pos"), F.col("neg"), is_early, lambda x: x.over(so_far)))
    windows = running.where("real and coalesce(place, 0) = 0").drop("real", "place", "n", "pos", "neg", "early")
    return _judged(sessions.join(windows, F.col("t") == F.col("candidate"), "left"), c).select(*COLUMNS)


def _judged(rows: DataFrame, c: FoldConfig) -> DataFrame:
    t, fitted = F.col("t"), F.col("t") - c.validation - (c.history - 1)
    impossible = (
        F.when(t < c.validation, NO_VALIDATION).when(fitted - c.horizon < c.minimum_fit, NO_FIT).when(t + c.test > F.col("total"), NO_TEST_BLOCK)
    )
    made = impossible.isNull()
    text = lambda x: F.when(made, F.coalesce(F.col(x).cast("string"), F.lit(""))).otherwise("")
    long = lambda x: F.when(made, x).otherwise(0).cast("long")
    col = F.col
    lacks_class = lambda name: (col(f"{name}_positive_count") == 0) | (col(f"{name}_negative_count") == 0)
    # The codes bear the standard sizes in their names whatever the configuration says (fixed values).
    codes = F.array_compact(F.array(
        F.when(col("warm") != c.history - 1, "WARMUP_INCOMPLETE"),
        F.when(col("fit_available_label_session_count") < c.minimum_fit, "FIT_LABELED_SESSIONS_BELOW_252"),
        F.when(col("held_out") != c.validation, "VALIDATION_CALENDAR_NOT_60"),
        F.when(col("validation_available_label_session_count") != c.validation - c.horizon, "VALIDATION_AVAILABLE_LABEL_SESSIONS_NOT_57"),
        F.when(col("tested") != c.test, "TEST_CALENDAR_NOT_20"),
        F.when(lacks_class("fit"), "FIT_MISSING_BINARY_CLASS"), F.when(lacks_class("validation"), "VALIDATION_MISSING_BINARY_CLASS"),
        F.when(col("fit_row_count") == 0, "FIT_EMPTY"), F.when(col("validation_row_count") == 0, "VALIDATION_EMPTY"), F.when(col("test_row_count") == 0, "TEST_EMPTY"),
    ))
    reason = F.coalesce(impossible, F.array_join(codes, "|"))
    figures = {x: F.when(made, col(x)).otherwise(F.lit(0).cast(kind)) for x, kind in rows.dtypes if x in COLUMNS}
    return rows.withColumns(figures).withColumns({
        "candidate_first_test_date": col("date").cast("string"), "failure_reason": reason, "feasible": reason == "", "warmup_session_count": F.lit(c.history - 1).cast("long"),
        "fit_start_date": text("fit_start"), "fit_end_date": text("fit_end"), "validation_start_date": text("validation_start"), "validation_end_date": text("validation_end"), "test_start_date": text("date"), "test_end_date": text("test_end"),
        "fit_calendar_session_count": long(fitted), "fit_contract_labeled_session_count": long(fitted - c.horizon), "fit_purged_session_count": long(F.lit(c.horizon)),
        "validation_calendar_session_count": long(col("held_out")), "validation_contract_labeled_session_count": long(F.lit(c.validation - c.horizon)), "validation_purged_session_count": long(F.lit(c.horizon)),
        "test_calendar_session_count": long(col("tested")), "total_complete_fold_count": long(F.floor((F.col("total") - t) / c.test)),
    })


def recommendation(scanned: DataFrame, later: tuple[int, ...] = (20, 40, 60)) -> DataFrame:
    """One row: the earliest feasible date, the distinct feasible dates so many places behind it (or the last one), the
    recommended date, which is the earliest, and how many folds it opens. Nulls and zero where none is feasible."""
    good = scanned.where("feasible").agg(F.array_sort(F.collect_list(F.struct("candidate_first_test_date", "total_complete_fold_count"))).alias("good"))
    n = F.size("good")
    places = F.array(*[F.least(F.lit(p), n - 1) for p in later])
    others = F.when(n >= 2, F.array_distinct(F.transform(places, lambda p: F.col("good")[p]["candidate_first_test_date"])))
    first = F.get("good", F.lit(0))
    return good.select(
        first["candidate_first_test_date"].alias("earliest_feasible_date"), F.coalesce(F.array_join(others, "|"), F.lit("")).alias("alternative_dates"),
        first["candidate_first_test_date"].alias("recommended_first_test_date"), F.coalesce(first["total_complete_fold_count"], F.lit(0)).cast("long").alias("recommended_total_fold_count"),
    )
