"""Rules on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sessiongrid.functions.text import fold_accents, normalize_ticker, sanitized, security_id
from sessiongrid.operators import acceptance, cleaning, coverage, folds, identity, labels, metrics, nominal, ticks
from sessiongrid.sources import html

DAY = dt.date(2024, 1, 2)
SESSIONS = [dt.date(2024, 1, d) for d in (2, 3, 4, 5, 8, 9, 10)]


def test_ticker_and_identifier(spark):
    df = spark.createDataFrame([(" thyao.is ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(normalize_ticker(F.col("t"))).collect()] == ["THYAO", None, None]
    assert spark.range(1).select(security_id(F.lit("THYAO"))).first()[0] == "SEC_444a261b8b9b"
    assert spark.range(1).select(fold_accents(F.lit("İŞÇĞı"))).first()[0] == "ISCGi"


@pytest.mark.parametrize("price, day, tick", [(19.99, DAY, 0.01), (20.0, DAY, 0.02), (99.99, DAY, 0.05), (100.0, DAY, 0.1), (250.0, DAY, 0.25), (250.0, dt.date(2023, 11, 5), 0.1), (2500.0, DAY, 2.5), (0.009, DAY, None), (10.0, dt.date(2020, 3, 12), None)])
def test_tick_of_price_and_date(spark, price, day, tick):
    df = spark.createDataFrame([(price, day)], "p double, d date").withColumn("p", F.col("p").cast(ticks.PRICE))
    got = ticks.with_tick(df, ticks.tariff(spark), "p", "d").first()["tick_size"]
    assert (None if got is None else float(got)) == tick


def test_upper_limit_floors_exactly(spark):
    df = spark.createDataFrame([(10.03, DAY), (91.0, DAY), (None, DAY)], "previous_nominal_close double, date date")
    got = [r["estimated_upper_limit"] for r in ticks.upper_limits(df, ticks.tariff(spark)).collect()]
    assert got == [11.03, 100.1, None]


def test_tariff_is_valid(spark):
    assert ticks.tariff_violations(ticks.tariff(spark)).count() == 0


def test_later_splits_only(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, d), 10.0, 10.0, 10.0, 10.0, s) for d, s in ((1, 0.0), (2, 2.0), (3, None), (4, 3.0))], "ticker string, date date, open double, high double, low double, close double, stock_splits double")
    assert [r["split_factor"] for r in nominal.restore_nominal(df).orderBy("date").collect()] == [6.0, 3.0, 3.0, 1.0]


def test_identity_by_date(spark):
    schema = "security_id string, ticker string, valid_from date, valid_to date, is_current_ticker boolean"
    mapping = spark.createDataFrame([("SEC1", "ESKI", dt.date(2020, 3, 13), dt.date(2024, 1, 3), False), ("SEC1", "YENI", dt.date(2024, 1, 4), None, True)], schema)
    rows = spark.createDataFrame([("ESKI", dt.date(2024, 1, 3)), ("ESKI", dt.date(2024, 1, 4)), ("YENI", dt.date(2024, 1, 4)), ("DIGER", DAY)], "ticker string, date date")
    got = {(r["ticker"], r["date"].day): (r["mapping_status"], r["security_id"][:4], r["current_ticker"]) for r in identity.resolve(rows, mapping).collect()}
    assert got == {("ESKI", 3): ("MAPPED_HISTORICAL_TICKER", "SEC1", "YENI"), ("ESKI", 4): ("OUTSIDE_VALIDITY", "SEC1", "YENI"), ("YENI", 4): ("MAPPED_CURRENT_TICKER", "SEC1", "YENI"), ("DIGER", 2): ("AUTO_NEW_TICKER", "SEC_", "DIGER")}
    assert identity.overlaps(mapping, "security_id").count() == 0
    both = mapping.union(spark.createDataFrame([("SEC2", "YENI", dt.date(2024, 1, 2), None, True)], schema))
    with pytest.raises(Exception, match="several mapping rules for YENI on 2024-01-04"):
        identity.resolve(rows, both).collect()


def test_mapped_rows_come_before_unmapped(spark):
    rows = spark.createDataFrame([("S", DAY, "AUTO_NEW_TICKER", "A"), ("S", DAY, "MAPPED_HISTORICAL_TICKER", "Z"), ("T", DAY, "OUTSIDE_VALIDITY", "B")], "security_id string, date date, mapping_status string, ticker string")
    assert [r["ticker"] for r in identity.dedup_identity(rows).collect()] == ["Z"]


def test_issues_of_two_sources(spark):
    day = lambda d: dt.date(2024, 1, d)
    observed = spark.createDataFrame([("FULL", day(d), s) for d in (2, 3, 4, 5) for s in "AB"] + [("LATE", day(d), s) for d in (3, 5) for s in "AB"] + [("ONLY", day(d), "A") for d in (2, 3, 4, 5)], "security_id string, date date, source string")
    calendar = spark.createDataFrame([(day(d),) for d in (2, 3, 4, 5)], "session_date date")
    collected = spark.createDataFrame([("FULL", "possibly Delisted"), ("LATE", None), ("NONE", None)], "security_id string, failure_reason string")
    got = {(r["security_id"], r["issue_type"]): r["longest_gap"] for r in coverage.review_issues(observed, calendar, collected).collect()}
    assert got == {("FULL", "PROVIDER_SYMBOL_OR_REDIRECT"): 0, ("LATE", "LATE_SERIES_START"): 0, ("LATE", "INTERNAL_SESSION_GAP"): 1, ("LATE", "POSSIBLE_OLD_OR_NEW_TICKER_SIGNAL"): 0, ("ONLY", "PROVIDER_DATE_COVERAGE_MISMATCH"): 0, ("NONE", "NO_HISTORY_BOTH_PROVIDERS"): 0}


def test_acceptance_has_no_threshold(spark):
    row = lambda p, valid, none, same, split, warn: (p, valid, none, same, split, warn)
    quality = spark.createDataFrame([row("a", True, False, True, True, True), row("a", None, False, True, False, True), row("b", True, False, True, False, False), row("c", True, True, True, True, False), row("d", False, False, True, True, False), row("e", None, False, True, True, None), row("f", True, False, False, True, False), row("g", True, False, True, True, False)], "period string, valid_nominal_ohlc boolean, split_factor_unavailable boolean, nominal_conversion_consistent boolean, has_yfinance_split boolean, cross_source_price_warning boolean")
    errors = spark.createDataFrame([("g",), ("h",)], "period string")
    got = {r["period"]: (r["status"], r["reason"]) for r in acceptance.acceptance_status(quality, errors).collect()}
    assert got == {"a": ("PASS", "ACCEPTED"), "b": ("PARTIAL", "NO_SPLIT_OBSERVED"), "c": ("FAIL", "SPLIT_FACTOR_UNAVAILABLE"), "d": ("FAIL", "NO_VALID_ROW"), "e": ("FAIL", "NO_EVALUABLE_ROW"), "f": ("FAIL", "NOMINAL_CONVERSION_INCONSISTENT"), "g": ("FAIL", "PROVIDER_ERRORS"), "h": ("FAIL", "PROVIDER_ERRORS")}


def test_universe_reasons_and_instruments(spark):
    names = ["market_group", "market_name", "candidate_ticker", "company_name", "mkk_member_oid", "fund_oid"]
    rows = [("PAY PİYASASI", "YILDIZ", "AAA", "Sanayi Yatırım Ortaklığı A.Ş.", "o1", ""), ("PAY PİYASASI", "YILDIZ", "BBB", "X BORSA YATIRIM FONU", "o2", "f"), ("PAY PİYASASI", "YILDIZ", "CCC", "SANAYİ", "o3", "f"), ("PAY PİYASASI", "EMTİA PAZARI", "DDD", "SANAYİ", "o4", ""), ("TAHVİL", "YILDIZ", "EEE", "SANAYİ", "o5", ""), ("PAY PİYASASI", "YILDIZ", "", "SANAYİ", "o6", ""), ("PAY PİYASASI", "YILDIZ", "GGG", "SANAYİ", "o7", ""), ("PAY PİYASASI", "YILDIZ", "HHH", "SANAYİ", "o8", ""), ("PAY PİYASASI", "YILDIZ", "III", "X RÜÇHAN", "o9", "")]
    companies = spark.createDataFrame([("o1", "Q"), ("zz", "GGG"), ("o6", "R")], "mkk_member_oid string, ticker string")
    ended = spark.createDataFrame([("o3",), ("",)], "mkk_member_oid string")
    got = {r["mkk_member_oid"]: (r["instrument_type"], r["exclusion_reason"]) for r in html.active_universe(spark.createDataFrame(rows, names), companies, ended).collect()}
    assert got == {"o1": ("EQUITY", ""), "o2": ("ETF", "ETF"), "o3": ("FUND", "KAP_MEMBERSHIP_ENDED"), "o4": ("EQUITY", "NON_EQUITY_MARKET"), "o5": ("EQUITY", "NOT_PAY_MARKET"), "o6": ("EQUITY", "MISSING_TICKER"), "o7": ("EQUITY", ""), "o8": ("EQUITY", "NOT_ACTIVE_KAP_BIST_COMPANY"), "o9": ("RIGHTS_COUPON", "RIGHTS_COUPON")}


def test_credentials_are_hidden(spark):
    df = spark.createDataFrame([("Authorization: Bearer; x",), ("GET /p?api_key=k&b=1 token = t, Password:p",), (None,), ("x" * 2000,)], "m string")
    got = [r[0] for r in df.select(sanitized(F.col("m"))).collect()]
    assert got == ["Authorization: [REDACTED]; x", "GET /p?api_key=[REDACTED]&b=1 token = [REDACTED], Password:[REDACTED]", "", "x" * 1000]


VOLUMES = [(0.0, 0.0, "BOTH_VOLUMES_ZERO"), (None, None, "BOTH_VOLUMES_MISSING_UNRESOLVED"), (5.0, None, "SOURCE_VOLUME_CONFLICT"), (5.0, 0.0, "SOURCE_VOLUME_CONFLICT"), (-1.0, 2.0, "INVALID_VOLUME_REQUIRES_REVIEW"), (0.0, None, "VOLUME_EVIDENCE_INSUFFICIENT"), (1.0, 1.0, "POSITIVE_VOLUME_CONFIRMED")]


@pytest.mark.parametrize("a, b, flag", VOLUMES)
def test_volume_quality(spark, a, b, flag):
    df = spark.createDataFrame([(a, b)], "is_tl_volume double, yf_share_volume double")
    assert cleaning.volume_quality(df).first()["volume_quality_flag"] == flag


def bars(spark, changes=None, n=7):
    rows = []
    for k, d in enumerate(SESSIONS[:n]):
        row = {"security_id": "A", "session_index": k, "date": d, "yf_nominal_open": 100.0, "yf_nominal_high": 104.0, "yf_nominal_low": 99.0, "yf_nominal_close": 101.0, "is_tl_volume": 1000.0, "yf_share_volume": 10.0, "yf_dividends": 0.0, "is_raw_high": 104.0, "is_raw_low": 99.0, "is_raw_close": 101.0}
        rows.append(row | (changes or {}).get(k, {}))
    return spark.createDataFrame(rows, "security_id string, session_index long, date date, yf_nominal_open double, yf_nominal_high double, yf_nominal_low double, yf_nominal_close double, is_tl_volume double, yf_share_volume double, yf_dividends double, is_raw_high double, is_raw_low double, is_raw_close double")


def clean_rows(spark, changes=None):
    return {r["prediction_date"]: r for r in cleaning.clean_eligibility(bars(spark, changes), ticks.tariff(spark)).collect()}


def test_clean_rows_stop_before_the_horizon(spark):
    got = clean_rows(spark)
    assert sorted(got) == SESSIONS[:4]
    assert all(r["entry_eligible"] for r in got.values())


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"yf_nominal_open": None}, "NO_OPEN"), ({"is_tl_volume": 0.0, "yf_share_volume": 0.0}, "NO_TRADE"), ({"yf_nominal_low": 200.0}, "INVALID_OHLC"),
        ({"yf_nominal_high": 120.0}, "SPECIAL_MARGIN_OR_CORPORATE_ACTION"), ({"yf_nominal_open": 111.1, "yf_nominal_high": 111.1}, "LIMIT_OPEN"),
    ],
)
def test_entry_reasons(spark, change, reason):
    row = clean_rows(spark, {2: change})[SESSIONS[1]]
    assert row["entry_exclusion_reason"] == reason and row["entry_eligible"] is False


def test_action_window_and_first_day(spark):
    got = clean_rows(spark, {4: {"yf_dividends": 1.0}})
    assert [r["entry_exclusion_reason"] for _, r in sorted(got.items())] == [None, "CORPORATE_ACTION_WINDOW", "CORPORATE_ACTION_WINDOW", "CORPORATE_ACTION_WINDOW"]
    gone = clean_rows(spark, {0: {"yf_nominal_low": 500.0}})[SESSIONS[0]]
    assert gone["entry_exclusion_reasons"] == ["NO_PREVIOUS_CLOSE"] and gone["entry_exclusion_detail"] == "FIRST_TRADING_DAY_OR_NO_HISTORY"


def label_rows(spark, changes=None):
    rows = []
    for k in range(6):
        row = {"security_id": "A", "prediction_date": SESSIONS[k], "entry_date": SESSIONS[k + 1], "yf_nominal_open": 100.0, "yf_nominal_high": 104.0, "yf_nominal_close": 101.0, "ohlc_quality_flag": "VALID", "volume_quality_flag": "POSITIVE_VOLUME_CONFIRMED", "corporate_action_window_flag": False, "entry_eligible": True, "entry_exclusion_reasons": [], "requires_review": False}
        rows.append(row | (changes or {}).get(k, {}))
    df = spark.createDataFrame(rows, "security_id string, prediction_date date, entry_date date, yf_nominal_open double, yf_nominal_high double, yf_nominal_close double, ohlc_quality_flag string, volume_quality_flag string, corporate_action_window_flag boolean, entry_eligible boolean, entry_exclusion_reasons array<string>, requires_review boolean")
    return [r for r in labels.three_session_labels(df, ticks.tariff(spark)).orderBy("prediction_date").collect()]


def test_labels_hit_and_miss(spark):
    got = label_rows(spark, {2: {"yf_nominal_high": 105.0}})
    assert [r["label"] for r in got] == [1, 1, 1, 0, None, None]
    assert [r["target_hit_horizon"] for r in got[:3]] == [3, 2, 1]
    assert got[0]["target_price"] == 105.0 and got[0]["gross_return"] == pytest.approx(0.05) and got[3]["gross_return"] == pytest.approx(0.01)
    assert got[5]["label_na_reason"] == "INCOMPLETE_HORIZON"


@pytest.mark.parametrize(
    "change, reason",
    [
        ({0: {"entry_exclusion_reasons": ["LIMIT_OPEN"]}}, "LIMIT_OPEN"), ({0: {"requires_review": True}}, "REQUIRES_REVIEW"), ({0: {"entry_eligible": None}}, "ENTRY_NOT_ELIGIBLE"), ({0: {"yf_nominal_open": 0.0}}, "NO_OPEN"),
        ({0: {"yf_nominal_open": 0.005}}, "TARGET_TICK_SIZE_UNAVAILABLE"), ({1: {"volume_quality_flag": "NO_TRADE"}}, "HORIZON_NO_TRADE"), ({0: {"yf_nominal_high": 200.0}, 2: {"ohlc_quality_flag": "INVALID_OHLC"}}, "INVALID_HORIZON_PRICE"), ({2: {"yf_nominal_close": None}}, "MISSING_T3_CLOSE"),
    ],
)
def test_label_reasons(spark, change, reason):
    first = label_rows(spark, change)[0]
    assert first["label"] is None and first["label_na_reason"] == reason


def test_missing_horizon_row(spark):
    rows = label_rows(spark)
    assert rows[0]["label"] == 0
    one = spark.createDataFrame([("B", SESSIONS[0], SESSIONS[1])] + [("A", SESSIONS[k], SESSIONS[k + 1]) for k in range(6)], "security_id string, prediction_date date, entry_date date")
    full = one.select("*", F.lit(100.0).alias("yf_nominal_open"), F.lit(104.0).alias("yf_nominal_high"), F.lit(101.0).alias("yf_nominal_close"), F.lit("VALID").alias("ohlc_quality_flag"), F.lit("X").alias("volume_quality_flag"), F.lit(False).alias("corporate_action_window_flag"), F.lit(True).alias("entry_eligible"), F.array().cast("array<string>").alias("entry_exclusion_reasons"), F.lit(False).alias("requires_review"))
    assert labels.three_session_labels(full, ticks.tariff(spark)).where("security_id = 'B'").first()["label_na_reason"] == "MISSING_HORIZON_ROW"


def test_folds_are_purged_and_complete(spark):
    calendar = spark.range(375).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("session_date"), F.col("id").alias("session_index"))
    got = folds.folds(calendar).orderBy("fold_id").collect()
    assert [r["fold_id"] for r in got] == ["fold_001", "fold_002"]
    start = dt.date(2023, 1, 2)
    assert got[0]["test_start_date"] == start + dt.timedelta(335) and got[0]["fit_labeled_sessions"] == 252 and got[0]["validation_labeled_sessions"] == 57
    with pytest.raises(ValueError):
        folds.folds(calendar, first_test_index=100)


def test_precision_does_not_replace_unlabelled_picks(spark):
    rows = [("b", DAY, 0.9, True, None), ("a", DAY, 0.9, True, 1), ("c", DAY, 0.8, True, 0), ("d", DAY, 0.95, False, 1), ("e", DAY, 0.1, True, 1)]
    df = spark.createDataFrame(rows, "security_id string, prediction_date date, probability double, prediction_eligible boolean, label int")
    day = metrics.precision_at_k(df, 3).first()
    assert (day["selected"], day["valid_labels"], day["positive"], day["precision_at_k"]) == (3, 2, 1, 0.5)
    assert metrics.roc_auc(df.where("label = 1")).first()["roc_auc"] is None
    assert metrics.classification(df.where("label is null")).first()["n_rows"] == 0


def test_gaps_of_covered_ranges(spark):
    d = lambda m, k: dt.date(2024, m, k)
    want = spark.createDataFrame([("A", d(1, 1), d(1, 31)), ("B", d(1, 1), d(1, 5))], "key string, start date, end date")
    have = spark.createDataFrame([("A", d(1, 5), d(1, 8)), ("A", d(1, 7), d(1, 10)), ("A", d(1, 11), d(1, 12)), ("A", d(1, 30), d(2, 9))], "key string, start date, end date")
    got = sorted((r["key"], r["gap_start"].day, r["gap_end"].day) for r in coverage.gaps(want, have, "key").collect())
    assert got == [("A", 1, 4), ("A", 13, 29), ("B", 1, 5)]


def test_a_key_keeps_the_request_that_no_range_meets_and_far_ranges_go_before_the_shuffle(spark):
    d = lambda k: dt.date(2024, 1, k)
    want = spark.createDataFrame([("a", d(5), d(9)), ("a", d(20), d(22)), (None, d(6), d(7))], "key string, start date, end date")
    have = spark.createDataFrame([("a", d(6), d(7)), ("a", d(1), d(2)), ("a", d(25), d(28)), ("b", d(5), d(9))], "key string, start date, end date")
    found = coverage.gaps(want, have, "key")
    got = [(r["key"], r["gap_start"].day, r["gap_end"].day) for r in found.collect()]
    assert sorted(got, key=str) == [("a", 20, 22), ("a", 5, 5), ("a", 8, 9), (None, 6, 7)]
    assert "__high" in found._jdf.queryExecution().optimizedPlan().toString()
