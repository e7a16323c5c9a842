"""The 32 features of a security and session, their missing-value reasons and their quality.

Rows are the sessions on which a security was observed, with the sessions' numbers; a dense grid serves as well. Windows
are ranges of session numbers, so what lies n sessions back is found without rows for sessions that nobody observed, and a
gap is never bridged. All of them share one partitioning and order: one shuffle and one sort. What depends on the session
alone (the index and its returns) is computed once for each session. Ranks need a second shuffle, by date.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import finite, in_parts, is_true, positive, ratio, security
from .grid import per_session

#: Base features with the sessions that each needs (fixed values).
HISTORY = {
    "ret_1": 2, "ret_2": 3, "ret_3": 4, "ret_5": 6, "ret_10": 11, "ret_20": 21,
    "close_to_sma_5": 5, "close_to_sma_20": 20, "distance_from_high_20": 20, "positive_day_ratio_5": 6,
    "return_volatility_5": 6, "return_volatility_20": 21, "volatility_ratio_5_20": 21, "true_range_pct": 2, "range_expansion_5_20": 21,
    "log_median_tl_volume_20": 20, "tl_volume_ratio_5_20": 20, "tl_volume_zscore_20": 21, "tl_volume_cv_20": 20, "amihud_20": 21,
    "overnight_gap": 2, "intraday_return": 1, "close_location_value": 1, "rsi_14_sma": 15,
    "market_ret_1": 2, "relative_ret_1": 2, "relative_ret_5": 6, "relative_ret_20": 21,
}
#: Ranks within a date, and the feature that each ranks (fixed values).
RANKS = {"cs_ret_1_rank": "ret_1", "cs_ret_5_rank": "ret_5", "cs_relative_ret_5_rank": "relative_ret_5", "cs_volume_anomaly_rank": "tl_volume_zscore_20"}
BASE = list(HISTORY)
FEATURES = BASE + list(RANKS)
MIN_CROSS_SECTION = 20
USES_BENCHMARK = {"market_ret_1", "relative_ret_1", "relative_ret_5", "relative_ret_20"}
USES_VOLUME = {"log_median_tl_volume_20", "tl_volume_ratio_5_20", "tl_volume_zscore_20", "tl_volume_cv_20", "amihud_20"}
REASONS = ["warm_up", "source_missing", "invalid_math", "xu100_missing", "cross_section_insufficient", "infinite_replaced"]


#: What rows know of the index at their session.
MARKET = ["_market_1", "_market_5", "_market_20", "_no_index", "_inf_index"]


def _last(n: int):
    """The last n sessions, this one included."""
    return security().rangeBetween(1 - n, 0)


def _at(x: Column, n: int) -> Column:
    """x of the session n before; null if that was not observed."""
    return F.max(x).over(security().rangeBetween(-n, -n))


def _number(x: str) -> Column:
    return F.col(x).try_cast("double")


def _lacks(x: str) -> Column:
    return _number(x).isNull() | F.isnan(_number(x))


def _endless(x: str) -> Column:
    return is_true(F.abs(_number(x)) == float("inf"))


def with_market(rows: DataFrame, sessions=None) -> DataFrame:
    """rows, one for each session under the window ``sessions``, with the index's returns over 1, 5 and 20 sessions and
    how many sessions ago it was last missing, and last infinite."""
    sessions = sessions or Window.orderBy("session_index")
    session, past = F.col("session_index"), sessions.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_m", positive(F.col("benchmark_close")))
    made = {f"_market_{n}": ratio(F.col("_m"), F.lag("_m", n).over(sessions)) - 1 for n in (1, 5, 20)}
    ages = {f"_{kind}_index": session - F.max(F.when(test("benchmark_close"), session)).over(past) for kind, test in (("no", _lacks), ("inf", _endless))}
    return rows.withColumns(made | ages).drop("_m")


def on_sessions(observations: DataFrame, sessions: DataFrame) -> DataFrame:
    """Observations on sessions, with session_index, benchmark_close and what is known of the index; others are dropped.

    sessions: (prediction_date, session_index from 0 without gaps, benchmark_close), one row for each session.
    """
    return observations.join(per_session(with_market(sessions)), "prediction_date").withColumn("_source_row_present", F.lit(True))


def _known(rows: DataFrame) -> DataFrame:
    """rows with the columns MARKET; a dense grid without them has the index in its own rows."""
    return rows if MARKET[0] in rows.columns else with_market(rows, security())


def _own(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in MARKET]


def base_features(rows: DataFrame) -> DataFrame:
    """rows with the 28 base features; infinite ones become null."""
    return _computed(rows).select(*_own(rows), *[finite(F.col(f)).alias(f) for f in BASE])


def _computed(rows: DataFrame) -> DataFrame:
    """rows with MARKET and the 28 base features as computed."""
    rows = _known(rows)
    o, h, low, c, v = (F.col(f"_{x}") for x in ("open", "high", "low", "close", "tl_volume"))
    clean = rows.withColumns({f"_{x}": positive(F.col(x)) for x in ("open", "high", "low", "close", "tl_volume")})
    before = _at(c, 1)
    # What later windows read is computed first: one step of windows over the other, same sort.
    tr = F.when(h.isNotNull() & low.isNotNull() & before.isNotNull(), F.greatest(h - low, F.abs(h - before), F.abs(low - before)) / before)
    change = c - before
    step = clean.withColumns({
        "_before": before,
        "_r1": ratio(c, before) - 1,
        "_tr": tr,
        "_gain": F.when(change.isNotNull(), F.greatest(change, F.lit(0.0))),
        "_loss": F.when(change.isNotNull(), F.greatest(-change, F.lit(0.0))),
        "_lv": F.log1p(v),
        **{f"_r{n}": ratio(c, _at(c, n)) - 1 for n in (2, 3, 5, 10, 20)},
    })
    r1, trc, lv = F.col("_r1"), F.col("_tr"), F.col("_lv")
    prior = security().rangeBetween(-20, -1)
    # Each window aggregate is a column once; Spark does not merge equal ones inside larger expressions.
    sets = [("_close", 5), ("_close", 20), ("_high", 20), ("_up", 5), ("_r1", 5), ("_r1", 20), ("_tr", 5), ("_tr", 20), ("_tl_volume", 5), ("_tl_volume", 20), ("_illiquid", 20), ("_gain", 14), ("_loss", 14)]
    aggs = {("_close", 5): "avg", ("_close", 20): "avg", ("_high", 20): "max", ("_r1", 5): "stddev_samp", ("_r1", 20): "stddev_samp"}
    step = step.withColumns({"_up": F.when(r1.isNotNull(), (r1 > 0).cast("double")), "_illiquid": ratio(F.abs(r1), v)})
    wide = {f"_n{x}_{n}": F.count(x).over(_last(n)) for x, n in sets}
    wide |= {f"_a{x}_{n}": getattr(F, aggs.get((x, n), "avg"))(x).over(_last(n)) for x, n in sets}
    wide |= {"_s_volume_20": F.stddev_samp("_tl_volume").over(_last(20)), "_n_prior": F.count("_lv").over(prior), "_a_prior": F.avg("_lv").over(prior), "_s_prior": F.stddev_samp("_lv").over(prior)}
    wide |= {"_volumes": F.collect_list("_tl_volume").over(_last(20))}
    step = step.withColumns(wide)

    def of(x: str, n: int) -> Column:
        return F.when(F.col(f"_n{x}_{n}") == n, F.col(f"_a{x}_{n}"))

    up, down = of("_gain", 14), of("_loss", 14)
    rsi = F.when((up == 0) & (down == 0), 50.0).when(down == 0, 100.0).when(up == 0, 0.0).otherwise(100.0 - 100.0 / (1.0 + ratio(up, down)))
    ordered = F.sort_array("_volumes")
    median = F.when(F.size("_volumes") == 20, (ordered[9] + ordered[10]) / 2)
    known = F.col("_n_prior") == 20
    made = {
        **{f"ret_{n}": F.col(f"_r{n}") for n in (1, 2, 3, 5, 10, 20)},
        "close_to_sma_5": ratio(c, of("_close", 5)) - 1,
        "close_to_sma_20": ratio(c, of("_close", 20)) - 1,
        "distance_from_high_20": ratio(c, of("_high", 20)) - 1,
        "positive_day_ratio_5": of("_up", 5),
        "return_volatility_5": of("_r1", 5),
        "return_volatility_20": of("_r1", 20),
        "volatility_ratio_5_20": ratio(of("_r1", 5), of("_r1", 20)),
        "true_range_pct": trc,
        "range_expansion_5_20": ratio(of("_tr", 5), of("_tr", 20)),
        "log_median_tl_volume_20": F.log1p(median),
        "tl_volume_ratio_5_20": ratio(of("_tl_volume", 5), of("_tl_volume", 20)),
        "tl_volume_zscore_20": F.when(known, ratio(lv - F.col("_a_prior"), F.col("_s_prior"))),
        "tl_volume_cv_20": ratio(F.when(F.col("_n_tl_volume_20") == 20, F.col("_s_volume_20")), of("_tl_volume", 20)),
        "amihud_20": F.log1p(1e9 * of("_illiquid", 20)),
        "overnight_gap": ratio(o, F.col("_before")) - 1,
        "intraday_return": ratio(c, o) - 1,
        "close_location_value": ratio(2 * c - h - low, h - low),
        "rsi_14_sma": rsi,
        "market_ret_1": in_parts(F.col("_market_1")),
        **{f"relative_ret_{n}": F.col(f"_r{n}") - F.col(f"_market_{n}") for n in (1, 5, 20)},
    }
    return step.select(*rows.columns, *[made[f].alias(f) for f in BASE])


def cross_sectional(rows: DataFrame, minimum: int = MIN_CROSS_SECTION) -> DataFrame:
    """rows with the rank features: (average rank - 1) / (valid - 1) within a date, null below ``minimum`` valid values."""

    day = Window.partitionBy("prediction_date")
    n = F.count("*").over(day)

    def rank(source: str) -> Column:
        # nulls stand first; the rows equal to this one share the mean of their places: one sort for each source
        x = F.col(source)
        order = day.orderBy(x.asc_nulls_first())
        valid = F.count(x).over(day)
        average = F.rank().over(order) - (n - valid) + (F.count("*").over(order.rangeBetween(0, 0)) - 1) / 2
        return F.when(x.isNotNull() & (valid >= minimum), (average - 1) / (valid - 1))

    return rows.withColumns({name: rank(source) for name, source in RANKS.items()})


def all_features(rows: DataFrame) -> DataFrame:
    """The 32 features of the sessions that were observed; ranks see those rows alone."""
    return cross_sectional(base_features(rows).where("_source_row_present"))


#: The flags of a feature, one bit each from the lowest on.
FLAGS = ["missing", *REASONS]


def _flag(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(1 << FLAGS.index(name))) != 0


def _with_reasons(rows: DataFrame) -> DataFrame:
    """security_id, prediction_date and ``_flags`` of observed rows: an integer of flags for each of the 32 features.

    A row is within n sessions of the last bad input if the running maximum of bad sessions is: six maxima over one sort
    serve all histories. A gap before a row is bad up to the session before it. Of the ranks only the number of valid
    values of the day is needed. The flags are unfolded as integers, and taken apart in the long rows.
    """
    price, volume = ("open", "high", "low", "close"), ("tl_volume",)
    some = lambda test, names: functools.reduce(operator.or_, map(test, names))
    past = security().rowsBetween(Window.unboundedPreceding, 0)
    session = F.col("session_index")
    known = _known(rows).withColumn("_gap", is_true(session - F.lag("session_index", 1).over(security()) > 1))
    behind = F.when(F.col("_gap"), session - 1)
    last = {}
    for name, names in (("price", price), ("volume", volume)):
        last[f"_no_{name}"] = session - F.max(F.coalesce(F.when(some(_lacks, names), session), behind)).over(past)
        last[f"_inf_{name}"] = session - F.max(F.when(some(_endless, names), session)).over(past)
    age = session - F.min(F.when(F.col("_source_row_present"), session)).over(past)
    ages = [*last, "_age", "_no_index", "_inf_index"]
    made = _computed(known.withColumns(last | {"_age": age})).where("_source_row_present")
    made = made.select("security_id", "prediction_date", *ages, *[finite(F.col(f)).alias(f) for f in BASE], F.transform(F.array(*BASE), lambda x: F.abs(x) == float("inf")).alias("_endless"))
    day = Window.partitionBy("prediction_date")
    rows = made.withColumns({name: F.when(F.count(source).over(day) >= MIN_CROSS_SECTION, F.col(source)) for name, source in RANKS.items()})

    def of(f: str) -> Column:
        base = RANKS.get(f, f)
        n = HISTORY[base]
        within = lambda kind, names: functools.reduce(operator.or_, [is_true(F.col(f"_{kind}_{x}") < n) for x in names], F.lit(False))
        inputs = ["volume"] if base in USES_VOLUME else ["price"]
        if base == "amihud_20":
            inputs = ["volume", "price"]
        market = ["index"] if base in USES_BENCHMARK else []
        none = F.col(base).isNull()
        warm = none & is_true(F.col("_age") < n - 1)
        source = none & ~warm & within("no", [] if base == "market_ret_1" else inputs)
        no_index = none & ~warm & within("no", market)
        thin = ~none & F.col(f).isNull()
        replaced = is_true(F.col("_endless")[BASE.index(base)]) | (none & within("inf", inputs + market))
        found = dict(zip(FLAGS, (F.col(f).isNull(), warm, source, none & ~warm & ~source & ~no_index, no_index, thin, replaced)))
        return functools.reduce(operator.add, [F.when(c, 1 << FLAGS.index(x)).otherwise(0) for x, c in found.items()])

    return rows.select("security_id", in_parts(F.col("prediction_date")).alias("prediction_date"), F.array(*[of(f) for f in FEATURES]).alias("_flags"))


def reasons(rows: DataFrame) -> DataFrame:
    """Observed rows by feature (long form) with the reasons of a missing value.

    warm_up: fewer sessions since the security's first one than the feature needs. source_missing, xu100_missing: prices
    or volume, or the index, are null within that history. invalid_math: none of these. cross_section_insufficient: too
    few values of the day for a rank, which else has the reasons of what it ranks. infinite_replaced: the value was
    infinite, or is missing with an infinite input within its history.
    """
    name = F.array(*[F.lit(f) for f in FEATURES])[F.col("_feature")]
    long = _with_reasons(rows).select("security_id", "prediction_date", F.posexplode("_flags").alias("_feature", "_flag"))
    return long.select("security_id", "prediction_date", name.alias("feature"), *[_flag(F.col("_flag"), x).alias(x) for x in FLAGS])


def quality(rows: DataFrame) -> DataFrame:
    """One row for each of the 32 features: rows, valid and missing values, and how often each reason applies.

    The counts of all features are one aggregation of the wide rows, unfolded when they are a single row.
    """
    known = F.col("prediction_date").isNotNull()  # of every row on a session
    wide = _with_reasons(rows).agg(F.count_if(known).alias("n_rows"), *[F.count_if(_flag(F.col("_flags")[k], c)).alias(f"{f}__{c}") for k, f in enumerate(FEATURES) for c in FLAGS])
    lines = [F.struct(F.lit(f).alias("feature"), "n_rows", (F.col("n_rows") - F.col(f"{f}__missing")).alias("valid"), *[F.col(f"{f}__{c}").alias(c) for c in FLAGS]) for f in FEATURES]
    return wide.select(F.inline(F.array(*lines)))


def daily_quality(features: DataFrame) -> DataFrame:
    """Over days: least, median and largest number of securities with all base features present, and missing share."""
    complete = F.lit(True)
    missing = F.lit(0)
    for f in BASE:
        complete = complete & F.col(f).isNotNull()
        missing = missing + F.col(f).isNull().cast("int")
    days = features.groupBy("prediction_date").agg(F.count_if(complete).alias("valid"), F.sum(missing).alias("missing"), F.count("*").alias("n"))
    return days.agg(
        F.min("valid").alias("min_valid"), F.percentile("valid", 0.5).alias("median_valid"), F.max("valid").alias("max_valid"),
        F.sum("missing").cast("long").alias("missing_cells"), (F.sum("missing") / (F.sum("n") * len(BASE))).alias("missing_share"),
    )
