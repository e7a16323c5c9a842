"""Hand-made cases of coverage, equality, periods, outcomes, quality, payloads, fail-closed checks and experiments."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sessiongrid.functions import checks
from sessiongrid.operators import coverage, equality, folds, identity, outcomes, periods, security_quality
from sessiongrid.operators.features import FEATURES, RANKS
from sessiongrid.plans import experiments, modeling
from sessiongrid.plans.guards import ExpectationError
from sessiongrid.plans.training import training_plan
from sessiongrid.queries import all_queries, all_sql
from sessiongrid.sources import html


def day(k: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(k)


ENTRY = "key string, start date, end date, is_current boolean, readable boolean, result string"


def covered(spark, entries, request=(0, 30)):
    rows = spark.createDataFrame([("K", day(a), day(b), current, readable, result) for a, b, current, readable, result in entries], ENTRY)
    asked = spark.createDataFrame([("K", day(request[0]), day(request[1]))], "key string, start date, end date")
    got = coverage.versioned_coverage(asked, rows, "key").collect()
    return sorted((r["kind"], (r["from_date"] - day(0)).days, (r["to_date"] - day(0)).days, r["is_current"]) for r in got)


def test_stored_ranges_serve_and_leave_gaps(spark):
    ok = "DATA"
    assert covered(spark, []) == [("GAP", 0, 30, None)]
    assert covered(spark, [(3, 9, True, True, ok), (8, 12, True, True, coverage.NO_DATA), (20, 40, False, True, ok)]) == [("EMPTY_HIT", 8, 12, True), ("GAP", 0, 2, None), ("GAP", 13, 19, None), ("HIT", 3, 9, True), ("HIT", 20, 30, False)]
    # of two that say the same, the current one serves; one within another does not
    assert covered(spark, [(0, 30, False, True, ok), (0, 30, True, True, ok), (5, 9, True, True, ok)]) == [("HIT", 0, 30, True)]


def test_an_unreadable_current_range_opens_a_gap_under_an_older_one(spark):
    older = (0, 20, False, True, "DATA")
    assert covered(spark, [older, (21, 30, True, True, "DATA")]) == [("HIT", 0, 20, False), ("HIT", 21, 30, True)]
    assert covered(spark, [older, (18, 19, True, False, "DATA"), (21, 30, True, True, "DATA")]) == [("GAP", 0, 20, None), ("HIT", 21, 30, True)]
    assert covered(spark, [older, (18, 19, False, False, "DATA"), (21, 30, True, True, "DATA")]) == [("HIT", 0, 20, False), ("HIT", 21, 30, True)]
    # one that only touches the request's outside blocks a range that reaches there
    assert covered(spark, [(25, 50, True, True, "DATA"), (45, 60, True, False, "DATA")]) == [("GAP", 0, 30, None)]


def test_repeated_rows_and_moved_columns_are_told_apart(spark):
    schema = "a int, b string, x double"
    left = spark.createDataFrame([(1, "p", 0.0), (1, "p", 0.0), (2, None, None), (3, "q", float("nan"))], schema)
    right = spark.createDataFrame([(1, "p", -0.0), (2, "", None), (3, "q", None), (3, "q", None)], schema)
    got = {(r["difference"], json.loads(r["content"])["a"], r["n_left"], r["n_right"]) for r in equality.differences(left, right).collect()}
    assert got == {("MORE_LEFT", "1", 2, 1), ("ONLY_LEFT", "2", 1, 0), ("ONLY_RIGHT", "2", 0, 1), ("MORE_RIGHT", "3", 1, 2)}
    assert equality.differences(left, left.select("x", "b", "a").repartition(3)).count() == 0
    assert equality.column_differences(left, left.select("x", "b", F.col("a").cast("long").alias("a"), F.lit(1).alias("z"))) == [("MOVED", "a"), ("MOVED", "x"), ("ONLY_RIGHT", "z"), ("RETYPED", "a")]
    assert equality.assert_same(left, left, "t").first()["n_different"] == 0
    with pytest.raises(PySparkException, match="rows that differ: 4"):
        equality.assert_same(left, right, "t").collect()
    with pytest.raises(ValueError, match="columns differ"):
        equality.assert_same(left, right.drop("b"), "t")
    plan = equality.differences(left, right)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_dates_in_overlapping_periods(spark):
    rows = spark.createDataFrame([("A", day(0), "x"), ("A", day(500), "y"), ("B", day(0), "z"), (None, day(0), "n"), ("A", None, "m")], "ticker string, date date, periods string")
    spans = [(2, "late", ["A"], day(-900), day(0)), (1, "all", ["A", "A", "B"], day(-3), day(900)), (3, "one", ["A"], day(500), day(500)), (4, "none", ["A"], day(9), day(0))]
    found = periods.with_periods(rows, spark.createDataFrame(spans, "place int, period string, tickers array<string>, start date, end date"))
    assert sorted((str(r["ticker"]), r["date"], r["periods"]) for r in found.collect() if r["date"]) == [("A", day(0), "all;late"), ("A", day(500), "all;one"), ("B", day(0), "all"), ("None", day(0), "")]
    assert found.columns == ["ticker", "date", "periods"] and found.where("date is null").first()["periods"] == ""
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


GAPS = "array<struct<start_date:date,end_date:date,failure_class:string,failure_reason:string,retry_recommended:boolean>>"
RESULT = f"row_number long, security_id string, current_ticker string, provider_ticker string, period_start date, period_end date, collection_pass int, source string, raw_status string, nominal_status string, result string, failure_class string, failure_reason string, retry_recommended boolean, {', '.join(f'{c} long' for c in outcomes.COUNTERS)}, missing_ranges {GAPS}, elapsed_seconds double"


def results(spark, rows):
    plan = lambda n, s, p: (n, s, f"T{s}", "P", day(0), day(9), p)
    return spark.createDataFrame([(*plan(n, s, p), source, raw, nominal, result, cls, reason, retry, 1, 0, 2, None, 0, 0, gaps, 0.5) for n, s, p, source, raw, nominal, result, cls, reason, retry, gaps in rows], RESULT)


def test_outcomes_fold_their_stages(spark):
    gap = [(day(1), day(2), "G", "token: abc", True)]
    found = outcomes.outcomes(results(spark, [
        (1, "S", 1, "yfinance", "COMPLETE", "PARTIAL", "x", None, None, False, None), (1, "S", 1, "isyatirim", "COMPLETE", None, "x", "C", "password=1", None, gap),
        (2, "S", 2, "isyatirim", None, None, "FAILED", "C1", "first", False, []), (2, "S", 2, "yfinance", None, None, "NO_HISTORY", "C2", "last", True, gap + gap),
        (3, "T", 1, "isyatirim", "COMPLETE", None, "x", None, "", False, None), (3, "T", 1, "yfinance", "COMPLETE", "COMPLETE", "x", None, None, False, None),
        (4, "U", 1, "isyatirim", None, None, "NO_HISTORY", None, None, False, None), (4, "U", 1, "yfinance", None, None, "NO_HISTORY", None, None, None, None),
    ]))
    rows = {r["row_number"]: r for r in found.collect()}
    assert [rows[k]["last_successful_stage"] for k in (1, 2, 3, 4)] == ["YFINANCE_RAW", "", "YFINANCE_NOMINAL", ""]
    assert (rows[1]["failure_stage"], rows[1]["failure_reason"]) == ("ISYATIRIM", "password=[REDACTED]") and (rows[2]["failure_stage"], rows[2]["failure_class"]) == ("YFINANCE", "C2")
    assert rows[2]["isyatirim_status"] == "FAILED" and rows[2]["nominal_status"] == "FAILED" and rows[2]["retry_recommended"] and not rows[4]["retry_recommended"]
    assert rows[1]["network_request_count"] == 2 and rows[1]["timeout_count"] == 0 and rows[1]["elapsed_seconds"] == 1.0
    status = outcomes.security_status(found)
    assert {r["security_id"]: (r["status"], r["last_collection_pass"]) for r in status.collect()} == {"S": ("PARTIAL", 2), "T": ("COMPLETE", 1), "U": ("NO_HISTORY", 1)}
    listed = outcomes.collection_gaps(status.where("security_id <> 'S'"), found).collect()
    assert len(listed) == 3 and {r["status"] for r in listed} == {"UNATTEMPTED"} and {r["failure_reason"] for r in listed} == {"token: [REDACTED]"}
    assert [r["security_id"] for r in outcomes.collection_failures(status).collect()] == ["U"]
    first = spark.createDataFrame([("A", "PARTIAL", False), ("B", "FAILED", True), ("C", "FAILED", None), ("D", "COMPLETE", True), ("E", "PARTIAL", None)], "security_id string, status string, retry_recommended boolean")
    second = spark.createDataFrame([("A", "COMPLETE"), ("B", "FAILED"), ("C", "COMPLETE")], "security_id string, status string")
    assert sorted((r["security_id"], r["outcome"]) for r in outcomes.retries(first, second).collect()) == [("A", "RECOVERED"), ("B", "REMAINING"), ("E", "REMAINING")]


def test_observed_status(spark):
    calendar = spark.createDataFrame([(day(k),) for k in range(0, 20, 2)], "session_date date")
    seen = [("A", day(k)) for k in range(0, 20, 2)] + [("B", day(4)), ("B", day(4)), ("B", day(12)), ("B", day(13))]
    status = spark.createDataFrame([("A",), ("B",), ("C",)], "security_id string")
    got = {r["security_id"]: tuple(r)[1:] for r in outcomes.observed_status(status, spark.createDataFrame(seen, "security_id string, date date"), calendar).collect()}
    assert got["A"] == (day(0), day(18), 10, 0, 0, False, False, False)
    assert got["B"] == (day(4), day(13), 3, 8, 3, True, True, True)
    assert got["C"] == (None, None, 0, 10, 0, False, False, False)


def feature_rows(spark, rows):
    return spark.createDataFrame([(s, d, *[x] * len(FEATURES)) for s, d, x in rows], f"security_id string, prediction_date date, {', '.join(f'{f} double' for f in FEATURES)}")


def test_panel_summary(spark):
    calendar = spark.createDataFrame([(day(k),) for k in range(4)], "session_date date")
    index = spark.createDataFrame([(day(k),) for k in (0, 0, 2, 9)], "prediction_date date")
    rows = feature_rows(spark, [("A", day(0), 1.0), ("B", day(0), float("inf")), ("A", day(1), None), ("B", day(1), float("nan"))])
    got = security_quality.panel_summary(rows, calendar, index).first()
    assert tuple(got) == (4, 2 * 32, 32, 2, 0, 1.0, 2, 4, 0.5)
    with pytest.raises(PySparkException, match="repeated security_id, prediction_date: A"):
        security_quality.panel_summary(feature_rows(spark, [("A", day(0), 1.0)] * 2), calendar, index).collect()
    assert tuple(security_quality.panel_summary(feature_rows(spark, []), calendar.limit(0), index).first()) == (0, 0, 0, 0, 0, 0.0, 0, 0, 0.0)
    assert set(RANKS) < set(FEATURES)


def test_quality_of_securities_shuffles_once(spark, sf_dir):
    status = spark.createDataFrame([("A", "TA", 0, 0, True), ("Z", "TZ", 1, 2, False)], "security_id string, current_ticker string, missing_session_count long, longest_internal_gap_sessions long, collection_complete boolean")
    prices = spark.createDataFrame([("A", 1.0, 2.0, 0.5, 1.5), ("A", 1.0, 0.9, 0.5, 1.5), ("A", 0.0, 2.0, 0.5, 1.5), ("A", None, 2.0, 0.5, 1.5), ("A", 1.0, float("inf"), 0.5, 1.5)], "security_id string, yf_nominal_open double, yf_nominal_high double, yf_nominal_low double, yf_nominal_close double")
    volumes = spark.createDataFrame([("A", None, 0.0), ("A", 1.0, None), ("A", None, None)], "security_id string, is_tl_volume double, yf_share_volume double")
    clean = spark.createDataFrame([("A", True, True, None), ("A", None, False, True)], "security_id string, cross_source_price_warning boolean, entry_eligible boolean, requires_review boolean")
    labels = spark.createDataFrame([("A", 1, "LABELED"), ("A", 0, "LABELED"), ("A", None, "NA"), ("A", None, None)], "security_id string, label int, label_status string")
    calendar = spark.range(10)
    found = security_quality.by_security(status, prices, volumes, clean, labels, calendar)
    rows = {r["security_id"]: tuple(r)[2:] for r in found.collect()}
    assert len(found.columns) == 16
    assert rows["A"] == (5, 0.5, 0, 0, 4, 1, 2, 1, 1, 1, 1, 1, 2, True) and rows["Z"] == (0, 0.0, 1, 2, *[0] * 9, False)


def test_checks_survive_pruning(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for use in (lambda df: df.select("k").collect(), lambda df: df.count(), lambda df: df.agg(F.max("k")).collect()):
        with pytest.raises(PySparkException, match="v does not resolve for 2"):
            use(checks.resolved(rows, "v", "k"))
        with pytest.raises(PySparkException, match="repeated v: a"):
            use(checks.unique(spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), ["v"]))
    assert checks.unique(checks.resolved(rows.where("k = 1"), "v", "k"), ["k"]).columns == ["k", "v"]


def test_two_rules_in_force_fail_whatever_is_read(spark):
    rows = spark.createDataFrame([("AAA", day(5))], "ticker string, date date")
    rule = ("SEC1", "AAA", day(0), None, True)
    mapping = spark.createDataFrame([rule, ("SEC2", "AAA", day(3), None, False)], "security_id string, ticker string, valid_from date, valid_to date, is_current_ticker boolean")
    for use in (lambda df: df.select("security_id").collect(), lambda df: df.count(), lambda df: df.collect()):
        with pytest.raises(PySparkException, match="several mapping rules for AAA"):
            use(identity.resolve(rows, mapping))
    assert identity.resolve(rows, mapping.where("security_id = 'SEC1'")).first()["security_id"] == "SEC1"


def test_the_training_plan_fails_closed(spark):
    key = "security_id string, prediction_date date"
    universe = spark.createDataFrame([("A", day(0), True)], f"{key}, prediction_eligible boolean")
    feats = spark.createDataFrame([("A", day(0), 1.0)], f"{key}, ret_1 double")
    labels = spark.createDataFrame([("A", day(0), 1, "LABELED")], f"{key}, label int, label_status string")
    calendar = spark.createDataFrame([(day(k), k) for k in range(5)], "session_date date, session_index long")
    assert training_plan(universe, feats, labels, calendar, "2024-02-01").first()["model_row"]
    with pytest.raises(PySparkException, match="repeated security_id, prediction_date"):
        training_plan(universe, feats.union(feats), labels, calendar, "2024-02-01").count()
    with pytest.raises(ExpectationError, match="target_price"):
        training_plan(universe, feats.withColumn("target_price", F.lit(1)), labels, calendar, "2024-02-01")


def page_of(*documents: str) -> str:
    return "".join(f"<script>self.__next_f.push({json.dumps([1, f'7:{d}'])})</script>" for d in documents)


def test_exactly_one_payload(spark):
    good = '[{"code":"A","content":[{"mkkMemberOid":"o1","kapMemberTitle":"T"}]}]'
    schema = "array<struct<code:string,content:array<struct<mkkMemberOid:string,kapMemberTitle:string,stockCode:string,cityName:string,kapMemberType:string>>>>"

    def found(*htmls):
        pages = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
        return html.only_payload(pages, ["code", "content"], schema)

    nested = f'{{"a":[1,null,{{"b":[[{good}]]}}],"c":[{{"code":1}}]}}'
    assert [r["record"][0]["code"] for r in found(page_of(nested), page_of("[]", good, "nothing")).collect()] == ["A", "A"]
    assert html.company_rows(found(page_of(good))).first()["mkk_member_oid"] == "o1"
    for bad, n in ((page_of("[1]"), 0), (page_of(good, good), 2), (page_of(f'{{"a":{good},"b":[{good}]}}'), 2), ("<p></p>", 0), (None, 0)):
        with pytest.raises(PySparkException, match=f"found {n} in page 1"):
            found(page_of(good), bad).count()
    with pytest.raises(PySparkException, match="more than 12 levels"):
        found(page_of("[" * 30 + good + "]" * 30)).count()
    with pytest.raises(PySparkException, match="incomplete company"):
        html.company_rows(found(page_of(good.replace("o1", " ")))).count()


def test_experiments_are_written_once_and_torn_ones_are_invisible(spark, tmp_path):
    days = [day(k) for k in range(30)]
    calendar = spark.createDataFrame([(d, k) for k, d in enumerate(days)], "session_date date, session_index long")
    rows = [(f"S{s}", days[k], True, (k + s) % 2, "LABELED", days[k + 1] if k < 29 else None, float((k + s) % 2)) for k in range(30) for s in range(3)]
    panel = spark.createDataFrame(rows, "security_id string, prediction_date date, prediction_eligible boolean, label int, label_status string, label_available_date date, a double")
    config = folds.FoldConfig(validation=6, test=5, minimum_fit=10, horizon=1, history=2)
    store, learner = experiments.ExperimentStore(spark, f"file://{tmp_path}/models"), modeling.Learner(features=("a",), penalties=(0.1,))
    torn = modeling.Learner(features=("a",), penalties=(0.1,))
    with pytest.raises(ZeroDivisionError):
        store.save("f0", {}, {"t": panel}, models={"m": lambda path: 1 / 0})
    assert store.find("f0") is None
    one = experiments.run(store, panel, calendar, config, "2024-02-01", {"code": "c1"}, learner)
    assert one.created and one.metadata["folds"] == "2" and store.read(one, "fold_metrics").count() == 2
    scores = store.read(one, "predictions")
    assert scores.count() == 30 and modeling.PipelineModel.load(f"{one.path}/models/fold_001").stages
    again = experiments.run(store, panel.where("1 / 0 = 1"), calendar, config, "2024-02-01", {"code": "c1"}, torn)  # nothing is computed
    assert not again.created and again.path == one.path
    other = experiments.run(store, panel, calendar, config, "2024-02-01", {"code": "c2"}, learner)
    assert other.created and other.path != one.path and store.registry().count() == 2
    path, fs = store._path(f"{other.path.removeprefix(store.root + '/')}/config.json")
    fs.delete(path, False)
    with pytest.raises(ValueError, match="config.json"):
        store.find(other.fingerprint)


def test_queries_of_this_file_are_registered():
    names = {"versioned_coverage", "table_differences", "actions_in_periods", "collection_outcomes", "security_status", "collection_gaps", "collection_failures", "collection_retries", "observed_status", "security_quality_report", "panel_quality_summary", "kap_companies", "fold_recommendation"}
    assert names <= set(all_queries()) and names <= set(all_sql())
