"""Closed forms and invariances of the features on hand-made panels."""

import datetime as dt
import math

import pytest

from sessiongrid.operators import features
from sessiongrid.operators.grid import build_calendar, densify


def panel(spark, days=30, drop=(), change=None, close=lambda i: 100.0 + i, securities=("SEC_A",)):
    rows = []
    for s in securities:
        for i in range(days):
            if i in drop:
                continue
            c = close(i)
            row = {"security_id": s, "prediction_date": dt.date(2024, 1, 1) + dt.timedelta(i), "open": c - 0.5, "high": c + 1, "low": c - 1, "close": c, "tl_volume": 1e6 + 1e4 * i, "share_volume": 1.0}
            rows.append(row | (change(i) if change else {}))
    return spark.createDataFrame(rows, "security_id string, prediction_date date, open double, high double, low double, close double, tl_volume double, share_volume double")


def computed(spark, df, days=30):
    index = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), 7000.0 + 5 * i) for i in range(days)], "prediction_date date, benchmark_close double")
    grid = densify(df, build_calendar(index), index)
    return {r["session_index"]: r for r in features.base_features(grid).where("_source_row_present").collect()}


def test_returns_and_relative_returns(spark):
    rows = computed(spark, panel(spark))
    assert rows[20]["ret_1"] == pytest.approx(120 / 119 - 1)
    assert rows[20]["ret_5"] == pytest.approx(120 / 115 - 1)
    assert rows[20]["relative_ret_5"] == pytest.approx(120 / 115 - 1 - (7100 / 7075 - 1))
    assert rows[19]["ret_20"] is None and rows[20]["ret_20"] is not None


def test_a_gap_is_not_bridged(spark):
    rows = computed(spark, panel(spark, drop=(10,)))
    assert 10 not in rows and rows[11]["ret_1"] is None and rows[12]["ret_1"] is not None
    assert rows[14]["close_to_sma_5"] is None and rows[15]["close_to_sma_5"] is not None


def test_late_listing_warms_up(spark):
    rows = computed(spark, panel(spark, drop=range(10)))
    assert rows[14]["ret_5"] is None and rows[15]["ret_5"] == pytest.approx(115 / 110 - 1)


def test_scaling_prices_changes_no_ratio(spark):
    a, b = computed(spark, panel(spark)), computed(spark, panel(spark, change=lambda i: {k: (100.0 + i + d) * 37.5 for k, d in (("open", -0.5), ("high", 1), ("low", -1), ("close", 0))}))
    for f in features.BASE:
        for i in a:
            if a[i][f] is None or b[i][f] is None:
                assert a[i][f] is b[i][f], f
            else:
                assert a[i][f] == pytest.approx(b[i][f], rel=1e-9, abs=1e-12), f


@pytest.mark.parametrize("close, want", [(lambda i: 100.0, 50.0), (lambda i: 100.0 + i, 100.0), (lambda i: 200.0 - i, 0.0)])
def test_rsi_of_flat_rising_and_falling_prices(spark, close, want):
    rows = computed(spark, panel(spark, close=close))
    assert rows[13]["rsi_14_sma"] is None and rows[20]["rsi_14_sma"] == want


def test_bad_inputs_become_missing(spark):
    rows = computed(spark, panel(spark, change=lambda i: {"high": 99.0, "low": 99.0} if i == 5 else {"tl_volume": math.inf} if i == 6 else {"close": -1.0} if i == 7 else {}))
    assert rows[5]["close_location_value"] is None and rows[7]["ret_1"] is None and rows[8]["ret_1"] is None
    assert rows[20]["log_median_tl_volume_20"] is None


def test_median_and_prior_window(spark):
    rows = computed(spark, panel(spark))
    volumes = [1e6 + 1e4 * i for i in range(30)]
    assert rows[25]["log_median_tl_volume_20"] == pytest.approx(math.log1p((volumes[15] + volumes[16]) / 2))
    logs = [math.log1p(v) for v in volumes]
    mean = sum(logs[5:25]) / 20
    sd = math.sqrt(sum((x - mean) ** 2 for x in logs[5:25]) / 19)
    assert rows[25]["tl_volume_zscore_20"] == pytest.approx((logs[25] - mean) / sd)


def test_ranks_average_ties_and_need_twenty(spark):
    rows = [(f"S{i:02d}", dt.date(2024, 1, 1), float(min(i, 18)), 1.0, None, 2.0) for i in range(20)]
    df = spark.createDataFrame(rows, "security_id string, prediction_date date, ret_1 double, ret_5 double, relative_ret_5 double, tl_volume_zscore_20 double")
    got = {r["security_id"]: r for r in features.cross_sectional(df).collect()}
    assert got["S00"]["cs_ret_1_rank"] == 0 and got["S18"]["cs_ret_1_rank"] == got["S19"]["cs_ret_1_rank"] == 18.5 / 19
    assert got["S03"]["cs_ret_5_rank"] == 0.5 and got["S03"]["cs_relative_ret_5_rank"] is None
    assert features.cross_sectional(df.where("security_id <> 'S07'")).where("cs_ret_1_rank is not null").count() == 0


def test_the_past_does_not_depend_on_the_future(spark):
    full_rows, part = computed(spark, panel(spark)), computed(spark, panel(spark, days=24))
    for i in part:
        for f in features.BASE:
            assert part[i][f] == full_rows[i][f]


def test_partitioning_changes_nothing(spark):
    df = panel(spark, securities=[f"S{i}" for i in range(5)])
    a = features.base_features(densify(df, build_calendar(df), df.groupBy("prediction_date").agg({"close": "avg"}).withColumnRenamed("avg(close)", "benchmark_close")))
    b = features.base_features(densify(df.repartition(17), build_calendar(df), df.groupBy("prediction_date").agg({"close": "avg"}).withColumnRenamed("avg(close)", "benchmark_close")))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_reasons_of_missing_values(spark):
    df = panel(spark, drop=range(3), change=lambda i: {"close": None} if i == 8 else {"high": math.inf} if i == 14 else {"open": 0.0} if i == 20 else {})
    index = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), None if i == 24 else 7000.0 + i) for i in range(30)], "prediction_date date, benchmark_close double")
    grid = densify(df, build_calendar(index), index)
    got = {}
    for r in features.reasons(grid).collect():
        got[(r["feature"], (r["prediction_date"] - dt.date(2024, 1, 1)).days)] = {x for x in features.REASONS if r[x]}
    assert got["ret_1", 3] == {"warm_up"} and got["ret_1", 4] == set()
    assert got["ret_1", 8] == got["ret_1", 9] == {"source_missing"} and got["ret_1", 10] == set()
    assert got["true_range_pct", 14] == {"invalid_math", "infinite_replaced"} and got["true_range_pct", 16] == set()
    assert got["intraday_return", 20] == {"invalid_math"} and got["overnight_gap", 21] == set()
    assert got["relative_ret_1", 24] == got["market_ret_1", 25] == {"xu100_missing"}
    assert got["relative_ret_1", 9] == {"source_missing"} and got["market_ret_1", 9] == set()
    # one security, where a rank needs 20
    assert got["cs_ret_1_rank", 5] == {"cross_section_insufficient"} and got["cs_ret_1_rank", 8] == {"source_missing"}
    counts = {r["feature"]: r for r in features.quality(grid).collect()}
    assert len(counts) == 32 and all(r["valid"] + r["missing"] == r["n_rows"] == 27 for r in counts.values())
    for f, r in counts.items():
        for x in features.REASONS:
            assert r[x] == sum(x in reasons for (name, _), reasons in got.items() if name == f), (f, x)


def holes(spark):
    """Five securities with gaps, a late one and an early one, bad prices, and an index that misses sessions."""
    parts = [panel(spark, days=60, drop=drop, change=change, close=lambda i: 100.0 + (i * 7) % 13, securities=(name,)) for name, drop, change in (
        ("A", (3, 4, 20, 41), None), ("B", range(15), lambda i: {"close": None} if i == 30 else {}), ("C", range(35, 60), lambda i: {"high": math.inf} if i == 9 else {}), ("D", (), lambda i: {"tl_volume": 0.0} if i % 19 == 5 else {}), ("E", range(1, 60, 2), None),
    )]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    index = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(i), None if i in (12, 50) else math.inf if i == 33 else 7000.0 + (i * 5) % 11) for i in range(60)], "prediction_date date, benchmark_close double")
    return df, index


def test_observed_rows_give_what_the_dense_grid_gives(spark):
    df, index = holes(spark)
    grid = densify(df, build_calendar(index), index)
    sessions = index.join(build_calendar(index).withColumnRenamed("session_date", "prediction_date"), "prediction_date")
    rows = features.on_sessions(df, sessions)
    assert rows.count() == df.count() < grid.count()
    key = ["security_id", "prediction_date"]
    as_text = lambda frame, *columns: sorted(str(tuple(r)) for r in frame.select(*key, *columns).collect())
    assert as_text(features.base_features(rows), *features.BASE) == as_text(features.base_features(grid).where("_source_row_present"), *features.BASE)
    assert as_text(features.reasons(rows), "feature", "missing", *features.REASONS) == as_text(features.reasons(grid), "feature", "missing", *features.REASONS)
    assert sorted(map(tuple, features.quality(rows).collect())) == sorted(map(tuple, features.quality(grid).collect()))


def test_the_feature_query_makes_no_grid(spark):
    from sessiongrid.plans.feature_query import feature_query

    df, _ = holes(spark)
    plan = feature_query(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_repeated_observations_fail(spark):
    from pyspark.errors import PySparkException

    df, index = holes(spark)
    with pytest.raises(PySparkException, match="repeated security_id, prediction_date: A, 2024-01-01"):
        densify(df.unionByName(df.where("security_id = 'A' and prediction_date = date'2024-01-01'")), build_calendar(index), index).count()


def test_the_panel_is_aggregated_once_for_rows_and_index(spark, sf_dir):
    """Both read the panel's rows after one shuffle: Spark finds the two aggregations equal."""
    from sessiongrid.operators import bars
    from sessiongrid.plans.feature_query import feature_query

    df = feature_query(bars.supplier_week(spark, sf_dir))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1
