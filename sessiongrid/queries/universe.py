"""Queries of the prediction universe, training panel, folds, metrics, coverage, snapshots, acceptance and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_ticker, sanitized, security_id
from ..operators import acceptance, bars, coverage, feasibility, folds, labels, metrics, ticks, universe
from ..operators.bars import table
from ..plans import modeling
from ..plans.feature_query import feature_query
from ..plans.training import training_plan
from ..sources import html, snapshots
from . import daily, sql
from .registry import Registry

registry = Registry()
query, QUERIES, SQL = registry.query, registry.queries, registry.sql


# Universe and training panel ----------------------------------------------------------------------------------------

#: The features of the panel that the universe asks for: observed rows on two thirds of the sessions.
_HAS_FEATURE = "k % 17 <> 4"
_HAS_INDEX = "k % 59 <> 8"


def _inputs(spark, sf_dir) -> tuple[DataFrame, ...]:
    obs = daily.observed(spark, sf_dir).withColumn("prediction_date", F.col("date"))
    calendar = obs.select(F.col("date").alias("session_date"), "session_index").distinct()
    k = F.col("session_index")
    feats = obs.where(k % 17 != 4).select("security_id", "prediction_date", (F.col("yf_nominal_close") / 100).alias("feature_1"))
    index = calendar.select(F.col("session_date").alias("prediction_date"), F.when(k % 59 != 8, 100.0).alias("benchmark_close"))
    master = obs.where("s % 6 <> 5").select("security_id").distinct()
    seen = obs.select("security_id", "prediction_date", *[f"yf_nominal_{c}" for c in ("open", "high", "low", "close")], "is_tl_volume", "yf_share_volume")
    return master, seen, feats, calendar, index


def _universe(spark, sf_dir) -> DataFrame:
    return universe.prediction_universe(*_inputs(spark, sf_dir))


_UNIVERSE = f"""{daily.OBSERVED},
cal AS (SELECT DISTINCT k, date FROM obs),
ukeys AS (SELECT security_id, date FROM (SELECT DISTINCT security_id FROM obs WHERE s % 6 <> 5) CROSS JOIN cal UNION SELECT security_id, date FROM obs),
u0 AS (
  SELECT ukeys.security_id, ukeys.date, cal.k, CAST(substr(ukeys.security_id, 2, 3) AS INT) % 6 <> 5 AS in_master, obs.security_id IS NOT NULL AS seen, no, nh, nl, nc, tl, sh, obs.security_id IS NOT NULL AND cal.{_HAS_FEATURE} AS has_feature, cal.{_HAS_INDEX} AS has_index
  FROM ukeys JOIN cal USING (date) LEFT JOIN obs ON obs.security_id = ukeys.security_id AND obs.date = ukeys.date),
u1 AS (
  SELECT *, k - min(CASE WHEN seen THEN k END) OVER (PARTITION BY security_id) + 1 AS hist, coalesce(no > 0 AND nh > 0 AND nl > 0 AND nc > 0 AND nh >= greatest(no, nc) AND nl <= least(no, nc), false) AS okbar,
         coalesce(tl > 0, false) OR coalesce(sh > 0, false) AS traded, coalesce(tl >= 0, false) AND coalesce(sh >= 0, false) AS both_known
  FROM u0),
uni AS (
  SELECT security_id, date AS prediction_date, hist AS available_history_sessions,
         CASE WHEN NOT in_master THEN 'NOT_IN_MASTER_UNIVERSE' WHEN NOT seen THEN 'NO_T_OBSERVATION' WHEN NOT okbar THEN 'INVALID_T_OHLC' WHEN both_known AND NOT traded THEN 'NO_TRADE_ON_T' WHEN NOT traded THEN 'MISSING_TRADE_EVIDENCE'
              WHEN hist < 21 THEN 'INSUFFICIENT_HISTORY' WHEN NOT has_feature THEN 'MISSING_FEATURE_ROW' WHEN NOT has_index THEN 'MISSING_XU100_SESSION' END AS prediction_exclusion_reason
  FROM u1)"""


@query(f"WITH {_UNIVERSE}\nSELECT *, prediction_exclusion_reason IS NULL AS prediction_eligible FROM uni", dates=("prediction_date", "available_history_sessions"))
def universe_eligibility(spark, sf_dir) -> DataFrame:
    return _universe(spark, sf_dir)


@query(f"""WITH {_UNIVERSE}
SELECT prediction_date, count(DISTINCT security_id) AS securities, count(*) FILTER (prediction_exclusion_reason IS NULL) AS eligible, coalesce(any_value(o.n), 0) AS observed, coalesce(any_value(o.f), 0) AS features
FROM uni LEFT JOIN (SELECT date, count(*) AS n, count(*) FILTER ({_HAS_FEATURE}) AS f FROM obs GROUP BY 1) o ON o.date = prediction_date GROUP BY 1""")
def universe_daily(spark, sf_dir) -> DataFrame:
    _, seen, feats, _, _ = _inputs(spark, sf_dir)
    return universe.daily_universe(_universe(spark, sf_dir), seen, feats)


@query(f"""WITH {_UNIVERSE}
SELECT d.prediction_date, r.prediction_exclusion_reason, count(u.security_id) AS n
FROM (SELECT DISTINCT prediction_date FROM uni) d CROSS JOIN (SELECT DISTINCT prediction_exclusion_reason FROM uni WHERE prediction_exclusion_reason IS NOT NULL) r
LEFT JOIN uni u ON u.prediction_date = d.prediction_date AND u.prediction_exclusion_reason = r.prediction_exclusion_reason GROUP BY 1, 2""")
def universe_exclusions(spark, sf_dir) -> DataFrame:
    return universe.daily_exclusions(_universe(spark, sf_dir))


AS_OF = "2026-06-30"


def labelled(spark, sf_dir) -> DataFrame:
    return labels.three_session_labels(daily.clean(spark, sf_dir), ticks.tariff(spark)).select("security_id", "prediction_date", "label", "label_status")


def _panel(spark, sf_dir) -> DataFrame:
    _, _, feats, calendar, _ = _inputs(spark, sf_dir)
    return training_plan(_universe(spark, sf_dir), feats, labelled(spark, sf_dir), calendar, AS_OF)


_PANEL = f"""{daily.LABELS},
{_UNIVERSE[len(daily.OBSERVED) + 2:]},
panel3 AS (
  SELECT u.security_id, u.prediction_date, u.prediction_exclusion_reason IS NULL AS prediction_eligible, l.label, l.label_status, a.date AS label_available_date, c.k,
         coalesce(u.prediction_exclusion_reason IS NULL AND l.label_status = 'LABELED' AND l.label IN (0, 1) AND a.date <= DATE '{AS_OF}', false) AS model_row
  FROM uni u LEFT JOIN labels3 l ON l.security_id = u.security_id AND l.prediction_date = u.prediction_date LEFT JOIN cal c ON c.date = u.prediction_date LEFT JOIN cal a ON a.k = c.k + 3)"""


@query(f"WITH {_PANEL}\nSELECT security_id, prediction_date, prediction_eligible, label, label_status, label_available_date, model_row FROM panel3", dates=("prediction_date", "label", "label_available_date"))
def training_panel(spark, sf_dir) -> DataFrame:
    return _panel(spark, sf_dir).select("security_id", "prediction_date", "prediction_eligible", "label", "label_status", "label_available_date", "model_row")


# Folds --------------------------------------------------------------------------------------------------------------

#: Blocks that fit the panel's 357 sessions several times.
SMALL = folds.FoldConfig(validation=40, test=20, minimum_fit=100, horizon=3, history=21)
_FIRST = SMALL.history - 1 + SMALL.minimum_fit + SMALL.horizon + SMALL.validation
_FOLDS = f"""blocks AS (SELECT unnest(range({_FIRST}, (SELECT CAST(count(*) AS INT) FROM cal) - {SMALL.test} + 1, {SMALL.test})) AS t),
folds AS (
  SELECT printf('fold_%03d', CAST((t - {_FIRST}) // {SMALL.test} + 1 AS INT)) AS fold_id, a.date AS training_start_date, b.date AS training_end_date, c.date AS validation_start_date, d.date AS validation_end_date, e.date AS test_start_date, f.date AS test_end_date,
         CAST(t - {SMALL.validation} - {SMALL.history - 1} - {SMALL.horizon} AS BIGINT) AS fit_labeled_sessions, CAST({SMALL.validation - SMALL.horizon} AS BIGINT) AS validation_labeled_sessions, CAST({SMALL.test} AS BIGINT) AS test_sessions
  FROM blocks JOIN cal a ON a.k = {SMALL.history - 1} JOIN cal b ON b.k = t - {SMALL.validation} - 1 JOIN cal c ON c.k = t - {SMALL.validation} JOIN cal d ON d.k = t - 1 JOIN cal e ON e.k = t JOIN cal f ON f.k = t + {SMALL.test} - 1)"""


def _calendar(spark, sf_dir) -> DataFrame:
    return _inputs(spark, sf_dir)[3]


@query(f"WITH {daily.OBSERVED},\ncal AS (SELECT DISTINCT k, date FROM obs),\n{_FOLDS}\nSELECT * FROM folds", dates=("training_start_date", "training_end_date", "validation_start_date", "validation_end_date", "test_start_date", "test_end_date"))
def walk_forward_folds(spark, sf_dir) -> DataFrame:
    return folds.folds(_calendar(spark, sf_dir), SMALL)


@query(f"""WITH {_PANEL},
{_FOLDS},
parts AS (
  SELECT fold_id, prediction_date, label, CASE WHEN prediction_date BETWEEN training_start_date AND training_end_date AND ok AND label_available_date < validation_start_date THEN 'fit'
              WHEN prediction_date BETWEEN validation_start_date AND validation_end_date AND ok AND label_available_date < test_start_date THEN 'validation' WHEN prediction_date BETWEEN test_start_date AND test_end_date THEN 'test' END AS part
  FROM (SELECT *, coalesce(label_status = 'LABELED' AND label IN (0, 1), false) AS ok FROM panel3 WHERE prediction_eligible) CROSS JOIN folds)
SELECT fold_id, part, count(*) AS n_rows, count(DISTINCT prediction_date) AS sessions, count(*) FILTER (label = 1) AS positive, count(*) FILTER (label = 0) AS negative FROM parts WHERE part IS NOT NULL GROUP BY 1, 2""", dates=())
def fold_split_counts(spark, sf_dir) -> DataFrame:
    return folds.split_counts(_panel(spark, sf_dir), folds.folds(_calendar(spark, sf_dir), SMALL))


_V, _T, _H, _M = SMALL.validation, SMALL.test, SMALL.history - 1, SMALL.minimum_fit


def _window_sql(name: str, cond: str) -> str:
    return f"""count(n) FILTER ({cond}) AS {name}_available_label_session_count, {", ".join(f"CAST(coalesce(sum({x}) FILTER ({cond}), 0) AS BIGINT) AS {name}_{y}_count" for x, y in (("n", "row"), ("pos", "positive"), ("neg", "negative")))},
         coalesce(min(n) FILTER ({cond}), 0) AS {name}_daily_row_count_min, coalesce(quantile_cont(n, 0.5) FILTER ({cond}), 0) AS {name}_daily_row_count_median, coalesce(max(n) FILTER ({cond}), 0) AS {name}_daily_row_count_max,
         count(n) FILTER ({cond} AND early) AS {name}_2020_2021_session_count, CAST(coalesce(sum(n) FILTER ({cond} AND early), 0) AS BIGINT) AS {name}_2020_2021_row_count"""


_TEST_SUMS = ", ".join(f"CAST(sum({x}) FILTER (test) AS BIGINT) AS test_{y}" for x, y in (("el", "row_count"), ("lb", "labeled_row_count"), ("ap", "positive_count"), ("an", "negative_count"), ("el - lb", "na_label_count")))
_MADE_COUNTS = [c for c in feasibility.COLUMNS[6:] if not c.endswith("_date") and c.split("_", 1)[1] not in ("calendar_session_count", "contract_labeled_session_count", "purged_session_count") and c != "total_complete_fold_count"]
_FEASIBLE = f"""{_PANEL},
cut AS (SELECT k, date FROM cal WHERE date <= DATE '{AS_OF}'),
days AS (
  SELECT cut.k, cut.date, year(cut.date) IN (2020, 2021) AS early, nullif(count(*) FILTER (lab), 0) AS n, count(*) FILTER (lab AND label = 1) AS pos, count(*) FILTER (lab AND label = 0) AS neg, max(CASE WHEN lab THEN label_available_date END) AS av,
         count(*) FILTER (prediction_eligible) AS el, count(*) FILTER (prediction_eligible AND label_status = 'LABELED') AS lb, count(*) FILTER (prediction_eligible AND label = 1) AS ap, count(*) FILTER (prediction_eligible AND label = 0) AS an
  FROM cut LEFT JOIN (SELECT *, coalesce(prediction_eligible AND label_status = 'LABELED' AND label IN (0, 1) AND label_available_date IS NOT NULL, false) AS lab FROM panel3) p ON p.k = cut.k GROUP BY 1, 2),
cand AS (SELECT c.k AS t, c.date AS cdate, v.date AS vdate, (SELECT count(*) FROM cut) AS total FROM cut c LEFT JOIN cut v ON v.k = c.k - {_V}),
wide AS (
  SELECT t, cdate, total, days.*, coalesce(days.k BETWEEN {_H} AND t - {_V} - 1 AND av < vdate, false) AS fit, coalesce(days.k BETWEEN t - {_V} AND t - 1 AND av < cdate, false) AS val, days.k BETWEEN t AND t + {_T} - 1 AS test
  FROM cand JOIN days ON days.k < t + {_T}),
stats AS (
  SELECT t, cdate, total, {_window_sql('fit', 'fit')}, {_window_sql('validation', 'val')}, {_TEST_SUMS}, min(el) FILTER (test) AS test_daily_row_count_min, quantile_cont(el, 0.5) FILTER (test) AS test_daily_row_count_median, max(el) FILTER (test) AS test_daily_row_count_max
  FROM wide GROUP BY ALL),
why AS (
  SELECT *, CASE WHEN t < {_V} THEN 'insufficient sessions for the validation window' WHEN t - {_V} - 3 - {_H} < {_M} THEN 'insufficient post-warm-up purged fit sessions before first validation' WHEN t + {_T} > total THEN 'no complete walk-forward test block can be generated' END AS broken,
         concat_ws('|', CASE WHEN fit_available_label_session_count < {_M} THEN 'FIT_LABELED_SESSIONS_BELOW_252' END, CASE WHEN validation_available_label_session_count <> {_V - 3} THEN 'VALIDATION_AVAILABLE_LABEL_SESSIONS_NOT_57' END, CASE WHEN fit_positive_count = 0 OR fit_negative_count = 0 THEN 'FIT_MISSING_BINARY_CLASS' END,
           CASE WHEN validation_positive_count = 0 OR validation_negative_count = 0 THEN 'VALIDATION_MISSING_BINARY_CLASS' END, CASE WHEN fit_row_count = 0 THEN 'FIT_EMPTY' END, CASE WHEN validation_row_count = 0 THEN 'VALIDATION_EMPTY' END, CASE WHEN test_row_count = 0 THEN 'TEST_EMPTY' END) AS codes
  FROM stats),
feas AS (
  SELECT CAST(cdate AS VARCHAR) AS candidate_first_test_date, coalesce(broken, codes) = '' AS feasible, coalesce(broken, codes) AS failure_reason, CAST({_H} AS BIGINT) AS warmup_session_count,
         {", ".join(f"CASE WHEN broken IS NULL THEN coalesce(CAST((SELECT date FROM cut WHERE k = {k}) AS VARCHAR), '') ELSE '' END AS {name}" for name, k in (('fit_start_date', _H), ('fit_end_date', f't - {_V} - 1'), ('validation_start_date', f't - {_V}'), ('validation_end_date', 't - 1'), ('test_start_date', 't'), ('test_end_date', f't + {_T} - 1')))},
         {", ".join(f"CAST(CASE WHEN broken IS NULL THEN {x} ELSE 0 END AS BIGINT) AS {name}" for name, x in (('fit_calendar_session_count', f't - {_V} - {_H}'), ('fit_contract_labeled_session_count', f't - {_V} - {_H} - 3'), ('fit_purged_session_count', 3), ('validation_calendar_session_count', _V), ('validation_contract_labeled_session_count', _V - 3), ('validation_purged_session_count', 3), ('test_calendar_session_count', _T), ('total_complete_fold_count', f'(total - t) // {_T}')))},
         {", ".join(f"CASE WHEN broken IS NULL THEN {x} ELSE 0 END AS {x}" for x in _MADE_COUNTS)}
  FROM why)"""


def _scan(spark, sf_dir) -> DataFrame:
    return feasibility.scan(_panel(spark, sf_dir), _calendar(spark, sf_dir), AS_OF, SMALL)


@query(f"WITH {_FEASIBLE}\nSELECT * FROM feas", dates=())
def fold_feasibility(spark, sf_dir) -> DataFrame:
    return _scan(spark, sf_dir)


@query(f"""WITH {_FEASIBLE},
good AS (SELECT candidate_first_test_date AS d, total_complete_fold_count AS f, row_number() OVER (ORDER BY candidate_first_test_date) - 1 AS r, count(*) OVER () AS n FROM feas WHERE feasible),
other AS (SELECT string_agg(DISTINCT d, '|' ORDER BY d) AS a FROM good WHERE n >= 2 AND r IN (least(20, n - 1), least(40, n - 1), least(60, n - 1)))
SELECT max(d) FILTER (r = 0) AS earliest_feasible_date, coalesce((SELECT a FROM other), '') AS alternative_dates, max(d) FILTER (r = 0) AS recommended_first_test_date, CAST(coalesce(max(f) FILTER (r = 0), 0) AS BIGINT) AS recommended_total_fold_count FROM good""", dates=())
def fold_recommendation(spark, sf_dir) -> DataFrame:
    return feasibility.recommendation(_scan(spark, sf_dir))


# Metrics on a deterministic score -----------------------------------------------------------------------------------


def scores(spark, sf_dir) -> DataFrame:
    """Line items as scored rows: coarse probabilities with ties, some without a label."""
    x = table(spark, sf_dir, "lineitem")
    prob = F.floor((F.col("l_partkey") * 37 + F.col("l_suppkey") * 11 + F.col("l_linenumber")) % 1000) / 1000.0
    label = F.when(F.col("l_orderkey") % 13 != 0, F.when((F.col("l_partkey") * 37 + F.col("l_suppkey") * 11) % 1000 + F.col("l_orderkey") % 400 > 700, 1).otherwise(0))
    return x.select(F.format_string("%d-%d-%d-%.2f", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").alias("security_id"), F.to_date("l_shipdate").alias("prediction_date"), prob.alias("probability"), (F.col("l_orderkey") % 7 != 3).alias("prediction_eligible"), label.alias("label")).distinct()


_SCORES = """scores AS (
  SELECT DISTINCT printf('%d-%d-%d-%.2f', l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS security_id, CAST(l_shipdate AS DATE) AS prediction_date, ((l_partkey * 37 + l_suppkey * 11 + l_linenumber) % 1000) / 1000.0 AS probability,
         l_orderkey % 7 <> 3 AS prediction_eligible, CASE WHEN l_orderkey % 13 <> 0 THEN CASE WHEN (l_partkey * 37 + l_suppkey * 11) % 1000 + l_orderkey % 400 > 700 THEN 1 ELSE 0 END END AS label FROM lineitem)"""


@query(f"WITH {_SCORES}\nSELECT security_id, prediction_date, probability, row_number() OVER (PARTITION BY prediction_date ORDER BY probability DESC, security_id) AS daily_rank FROM scores")
def daily_rank(spark, sf_dir) -> DataFrame:
    return metrics.daily_rank(scores(spark, sf_dir)).select("security_id", "prediction_date", "probability", F.col("daily_rank").cast("long").alias("daily_rank"))


_PK = f"""{_SCORES},
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prediction_date ORDER BY probability DESC, security_id) AS r FROM scores WHERE prediction_eligible) WHERE r <= 10),
pk AS (SELECT prediction_date, count(*) AS selected, count(label) AS valid_labels, count(*) FILTER (label = 1) AS positive FROM picked GROUP BY 1)"""


@query(f"WITH {_PK}\nSELECT *, round(positive / nullif(valid_labels, 0), 6) AS precision_at_k, round(valid_labels / selected, 6) AS label_coverage_at_k FROM pk")
def precision_at_k(spark, sf_dir) -> DataFrame:
    days = metrics.precision_at_k(scores(spark, sf_dir), 10)
    return days.withColumns({c: F.round(c, 6) for c in ("precision_at_k", "label_coverage_at_k")})


@query(f"WITH {_PK}\nSELECT count(*) AS days, round(avg(positive / nullif(valid_labels, 0)), 6) AS macro_precision, round(sum(positive) / sum(valid_labels), 6) AS pooled_precision, CAST(sum(valid_labels) AS BIGINT) AS valid_labels FROM pk", dates=())
def precision_summary(spark, sf_dir) -> DataFrame:
    out = metrics.precision_summary(metrics.precision_at_k(scores(spark, sf_dir), 10))
    return out.withColumns({c: F.round(c, 6) for c in ("macro_precision", "pooled_precision")})


@query(f"""WITH {_SCORES}, m AS (SELECT count(*) AS n_rows, count(*) FILTER (label = 1 AND probability >= 0.5) AS tp, count(*) FILTER (label = 0 AND probability >= 0.5) AS fp, count(*) FILTER (label = 1 AND probability < 0.5) AS fn, count(*) FILTER (label = 0 AND probability < 0.5) AS tn, avg((probability - label) * (probability - label)) AS b FROM scores WHERE label IS NOT NULL)
SELECT n_rows, tp, fp, fn, tn, round((tp + tn) / n_rows, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + fn) / n_rows, 6) AS positive_rate, round((tp + fp) / n_rows, 6) AS predicted_rate, round(b, 6) AS brier FROM m""", dates=())
def classification_metrics(spark, sf_dir) -> DataFrame:
    out = metrics.classification(scores(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1", "positive_rate", "predicted_rate", "brier")})


@query(f"""WITH {_SCORES}, r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS ar FROM scores WHERE label IS NOT NULL)
SELECT round((sum(ar) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) AS roc_auc, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM r""", dates=())
def roc_auc(spark, sf_dir) -> DataFrame:
    return metrics.roc_auc(scores(spark, sf_dir)).withColumn("roc_auc", F.round("roc_auc", 6))


@query(f"""WITH {_SCORES}, t AS (SELECT probability, count(*) FILTER (label = 1) AS pos, count(*) AS n FROM scores WHERE label IS NOT NULL GROUP BY 1),
c AS (SELECT pos, sum(pos) OVER (ORDER BY probability DESC) AS tp, sum(n) OVER (ORDER BY probability DESC) AS k FROM t)
SELECT round(sum(pos * tp / k) / sum(pos), 6) AS average_precision FROM c""", dates=())
def average_precision(spark, sf_dir) -> DataFrame:
    return metrics.average_precision(scores(spark, sf_dir)).withColumn("average_precision", F.round("average_precision", 6))


REPORT_SQL = f"""WITH {_SCORES}, m AS (SELECT count(*) AS n_rows, count(*) FILTER (label = 1 AND probability >= 0.5) AS tp, count(*) FILTER (label = 0 AND probability >= 0.5) AS fp, count(*) FILTER (label = 1 AND probability < 0.5) AS fn, count(*) FILTER (label = 0 AND probability < 0.5) AS tn, avg((probability - label) * (probability - label)) AS b FROM scores WHERE label IS NOT NULL),
r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS ar FROM scores WHERE label IS NOT NULL),
t AS (SELECT probability, count(*) FILTER (label = 1) AS pos, count(*) AS n FROM scores WHERE label IS NOT NULL GROUP BY 1),
c AS (SELECT pos, sum(pos) OVER (ORDER BY probability DESC) AS tp, sum(n) OVER (ORDER BY probability DESC) AS k FROM t)
SELECT n_rows, tp, fp, fn, tn, round((tp + tn) / n_rows, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + fn) / n_rows, 6) AS positive_rate, round((tp + fp) / n_rows, 6) AS predicted_rate, round(b, 6) AS brier,
       (SELECT round((sum(ar) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 6) FROM r) AS roc_auc, (SELECT round(sum(pos * tp / k) / sum(pos), 6) FROM c) AS average_precision FROM m"""


@query(f"""WITH {_SCORES}, b AS (SELECT *, ntile(10) OVER (ORDER BY probability, security_id, prediction_date) AS bin FROM scores WHERE label IS NOT NULL)
SELECT CAST(bin AS INT) AS bin, count(*) AS n_rows, round(avg(probability), 6) AS mean_prediction, round(avg(label), 6) AS observed_rate, round(abs(avg(probability) - avg(label)), 6) AS gap FROM b GROUP BY 1""", dates=())
def calibration_bins(spark, sf_dir) -> DataFrame:
    return metrics.calibration(scores(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mean_prediction", "observed_rate", "gap")})


@query(f"""WITH {_SCORES}, b AS (SELECT *, ntile(10) OVER (ORDER BY probability, security_id, prediction_date) AS bin FROM scores WHERE label IS NOT NULL),
bins AS (SELECT count(*) AS n, abs(avg(probability) - avg(label)) AS gap FROM b GROUP BY bin)
SELECT 10 AS requested_bins, count(*) AS effective_bins, CAST(sum(n) AS BIGINT) AS n_rows, round(sum(n * gap) / sum(n), 6) AS weighted_gap FROM bins""", dates=())
def calibration_gap(spark, sf_dir) -> DataFrame:
    return metrics.calibration_gap(scores(spark, sf_dir)).withColumn("weighted_gap", F.round("weighted_gap", 6))


@query()
def walk_forward_model(spark, sf_dir) -> DataFrame:
    """Out-of-sample scores of a logistic regression on the 32 features in walk-forward folds (a trained model; no SQL).

    The more trades a nation's week has, the fewer labels are left and of one class alone (sf0.1); such folds get base rates.
    """
    master, seen, _, calendar, index = _inputs(spark, sf_dir)
    rows = daily.observed(spark, sf_dir)
    prices = rows.select("security_id", F.col("date").alias("prediction_date"), *[F.col(f"yf_nominal_{c}").alias(c) for c in bars.BAR[:4]], F.col("is_tl_volume").alias("tl_volume"), F.col("yf_share_volume").alias("share_volume"))
    feats = feature_query(prices).drop("session_index")
    eligible = universe.prediction_universe(master, seen, feats, calendar, index)
    panel = training_plan(eligible, feats, labelled(spark, sf_dir), calendar, AS_OF)
    config = folds.FoldConfig(validation=40, test=60, minimum_fit=100, horizon=3, history=21)
    return modeling.walk_forward(panel, calendar, config, AS_OF, base_rate=True)


# Ranges and collection ----------------------------------------------------------------------------------------------


@query("""SELECT s_suppkey, CAST(c AS INT) AS chunk, CAST(start_date + to_months(CAST(3 * c AS INT)) AS DATE) AS chunk_start, least(CAST(start_date + to_months(CAST(3 * c + 3 AS INT)) AS DATE) - 1, end_date) AS chunk_end
FROM (SELECT *, unnest(range(0, 40)) AS c FROM (SELECT s_suppkey, DATE '1996-01-01' + CAST(s_suppkey % 28 AS INT) AS start_date, DATE '1998-01-31' + CAST(s_suppkey * 7 % 300 AS INT) AS end_date FROM supplier))
WHERE start_date + to_months(CAST(3 * c AS INT)) <= end_date""", dates=("chunk_start", "chunk_end"))
def range_chunks(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey").cast("int")
    requests = table(spark, sf_dir, "supplier").select("s_suppkey", F.date_add(F.lit("1996-01-01").cast("date"), k % 28).alias("start"), F.date_add(F.lit("1998-01-31").cast("date"), k * 7 % 300).alias("end"))
    return coverage.range_chunks(requests, 3).select("s_suppkey", "chunk", "chunk_start", "chunk_end")


@query("""WITH days AS (SELECT s_suppkey AS key, unnest(range(DATE '1998-01-01', DATE '1998-12-31' + 1, INTERVAL 1 DAY)) AS d FROM supplier),
have AS (SELECT DISTINCT o_custkey % (SELECT count(*) FROM supplier) + 1 AS key, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INT) AS e FROM orders),
free AS (SELECT key, CAST(d AS DATE) AS d FROM days WHERE NOT EXISTS (SELECT 1 FROM have WHERE have.key = days.key AND days.d BETWEEN s AND e)),
islands AS (SELECT key, d, d - CAST(row_number() OVER (PARTITION BY key ORDER BY d) AS INT) AS g FROM free)
SELECT key, min(d) AS gap_start, max(d) AS gap_end FROM islands GROUP BY key, g""", dates=("gap_start", "gap_end"))
def calendar_coverage(spark, sf_dir) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    n = suppliers.agg(F.count("*").alias("n"))
    requests = suppliers.select(F.col("s_suppkey").alias("key"), F.lit("1998-01-01").cast("date").alias("start"), F.lit("1998-12-31").cast("date").alias("end"))
    orders = table(spark, sf_dir, "orders").crossJoin(F.broadcast(n))
    day = F.to_date("o_orderdate")
    covered = orders.select((F.col("o_custkey") % F.col("n") + 1).alias("key"), day.alias("start"), F.date_add(day, (F.col("o_orderkey") % 9).cast("int")).alias("end"))
    return coverage.gaps(requests, covered, "key")


_RESULTS = """results AS (
  SELECT printf('C%06d', o_custkey) AS security_id, o_orderpriority AS source, CASE WHEN o_custkey % 11 = 0 THEN 'NO_HISTORY' WHEN o_custkey % 7 = 0 AND o_orderpriority LIKE '1%' THEN 'FAILED' WHEN o_custkey % 5 = 0 AND o_orderpriority LIKE '2%' THEN 'PARTIAL' ELSE 'COMPLETE' END AS status,
         count(*) AS n_rows, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders GROUP BY 1, 2, 3)"""


def _results(spark, sf_dir) -> DataFrame:
    k, p = F.col("o_custkey"), F.col("o_orderpriority")
    status = F.when(k % 11 == 0, "NO_HISTORY").when((k % 7 == 0) & p.startswith("1"), "FAILED").when((k % 5 == 0) & p.startswith("2"), "PARTIAL").otherwise("COMPLETE")
    rows = table(spark, sf_dir, "orders").select(F.format_string("C%06d", "o_custkey").alias("security_id"), p.alias("source"), status.alias("status"), F.to_date("o_orderdate").alias("d"))
    return rows.groupBy("security_id", "source", "status").agg(F.count("*").alias("n_rows"), F.min("d").alias("first_date"), F.max("d").alias("last_date"))


_STATUS = f"""{_RESULTS},
st AS (
  SELECT security_id, CASE WHEN bool_and(status = 'COMPLETE') THEN 'COMPLETE' WHEN bool_and(status = 'NO_HISTORY') THEN 'NO_HISTORY' WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'PARTIAL' END AS status,
         CAST(sum(n_rows) AS BIGINT) AS n_rows, min(first_date) AS first_date, max(last_date) AS last_date, arg_max(source, row(n_rows, source)) AS main_source, string_agg(DISTINCT source, '|' ORDER BY source) AS sources FROM results GROUP BY 1)"""


@query(f"WITH {_STATUS}\nSELECT * FROM st", dates=("first_date", "last_date"))
def collection_status(spark, sf_dir) -> DataFrame:
    return coverage.collection_status(_results(spark, sf_dir))


@query(f"WITH {_STATUS}\nSELECT count(*) AS attempted, count(*) FILTER (status = 'COMPLETE') AS complete, count(*) FILTER (status = 'PARTIAL') AS partial, count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'NO_HISTORY') AS no_history, round(count(*) FILTER (status = 'COMPLETE') / count(*), 6) AS complete_rate FROM st", dates=())
def collection_summary(spark, sf_dir) -> DataFrame:
    return coverage.collection_summary(coverage.collection_status(_results(spark, sf_dir))).withColumn("complete_rate", F.round("complete_rate", 6))


# Snapshots ----------------------------------------------------------------------------------------------------------


def _versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").where("o_orderkey % 17 <> 2")
    new = table(spark, sf_dir, "orders").where("o_orderkey % 19 <> 5").select("o_orderkey", F.when(F.col("o_orderkey") % 23 == 1, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 29 != 3, F.col("o_totalprice")).alias("o_totalprice"))
    return old, new


@query("""WITH o AS (SELECT o_orderkey, o_orderstatus AS a, o_totalprice AS b FROM orders WHERE o_orderkey % 17 <> 2),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 23 = 1 THEN 'X' ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 29 <> 3 THEN o_totalprice END AS b FROM orders WHERE o_orderkey % 19 <> 5),
j AS (SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderkey IS NULL AS added, n.o_orderkey IS NULL AS removed, o.a IS DISTINCT FROM n.a AS ca, o.b IS DISTINCT FROM n.b AS cb FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey)
SELECT o_orderkey, CAST(1 AS INT) AS copy, CASE WHEN added THEN 'ADDED' WHEN removed THEN 'REMOVED' ELSE 'CHANGED' END AS change, CASE WHEN NOT added AND NOT removed THEN concat_ws('|', CASE WHEN ca THEN 'o_orderstatus' END, CASE WHEN cb THEN 'o_totalprice' END) END AS columns FROM j WHERE added OR removed OR ca OR cb""", dates=())
def snapshot_diff(spark, sf_dir) -> DataFrame:
    return snapshots.diff(*_versions(spark, sf_dir), ["o_orderkey"])


@query("""WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}') AS h FROM orders),
q AS (SELECT count(*) AS n_rows, sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)) AS a, sum(CAST('0x' || substr(h, 17, 16) AS UBIGINT)) AS b, sum(CAST('0x' || substr(h, 33, 16) AS UBIGINT)) AS c, sum(CAST('0x' || substr(h, 49, 16) AS UBIGINT)) AS d FROM h)
SELECT n_rows, sha256(concat_ws(':', n_rows, a, b, c, d)) AS content_hash FROM q""", dates=())
def content_checksum(spark, sf_dir) -> DataFrame:
    return snapshots.content_hash(table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_custkey", "o_orderpriority").repartition(5))


# Acceptance and index -----------------------------------------------------------------------------------------------

_CMP = f"""{sql.PN.replace('panel AS', 'ref AS')},
cmp AS (
  SELECT security_id AS ticker, prediction_date, CAST(year(prediction_date) AS VARCHAR) AS period, open, high, low, close, CAST(substr(security_id, 2) AS INT) AS s, dayofyear(prediction_date) % 9 <> 0 AS has_other,
         CASE WHEN dayofyear(prediction_date) % 9 <> 0 THEN CASE WHEN dayofyear(prediction_date) % 11 = 3 THEN close + 0.25 ELSE close END END AS oc, CASE WHEN dayofyear(prediction_date) % 9 <> 0 THEN CASE WHEN dayofyear(prediction_date) % 13 = 3 THEN high * 2 ELSE open END END AS oo
  FROM ref),
cmp2 AS (SELECT *, abs(close - oc) AS gap, abs(close - oc) / close * 100 AS pct, oo BETWEEN low AND high AS inr, coalesce(abs(close - oc) > 1e-8, false) AS conflict FROM cmp)"""


def _compared(spark, sf_dir) -> DataFrame:
    ref = bars.nation_week(spark, sf_dir)
    d = F.dayofyear("prediction_date")
    other = ref.where(d % 9 != 0).select("security_id", "prediction_date", F.when(d % 13 == 3, F.col("high") * 2).otherwise(F.col("open")).alias("open"), "high", "low", F.when(d % 11 == 3, F.col("close") + 0.25).otherwise(F.col("close")).alias("close"))
    rows = acceptance.compare_sources(ref, other, ["security_id", "prediction_date"])
    return rows.withColumn("period", F.year("prediction_date").cast("string")).withColumnRenamed("security_id", "ticker")


@query(f"""WITH {_CMP}
SELECT period, CASE WHEN grouping(ticker) = 1 THEN '__ALL__' ELSE ticker END AS ticker, count(*) AS n_rows, count(*) FILTER (has_other) AS matched, round(count(*) FILTER (has_other) / count(*), 6) AS match_rate, count(*) FILTER (conflict) AS conflicts, count(*) FILTER (inr) AS open_in_range,
       round(quantile_cont(pct, 0.5), 6) AS median_gap_pct, round(quantile_cont(pct, 0.95), 6) AS p95_gap_pct, round(max(pct), 6) AS max_gap_pct
FROM cmp2 GROUP BY GROUPING SETS ((period, ticker), (period))""", dates=())
def acceptance_metrics(spark, sf_dir) -> DataFrame:
    return acceptance.acceptance_metrics(_compared(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("match_rate", "median_gap_pct", "p95_gap_pct", "max_gap_pct")})


@query(f"""WITH {_CMP}, each AS (SELECT *, unnest(list_filter(['all_days', CASE WHEN conflict THEN 'conflict_days' END, CASE WHEN NOT conflict AND has_other THEN 'agreeing_days' END, CASE WHEN NOT has_other THEN 'unmatched_days' END], lambda x: x IS NOT NULL)) AS day_group FROM cmp2)
SELECT period, day_group, count(*) AS n_rows, count(DISTINCT ticker) AS tickers, round(avg(pct), 6) AS mean_gap_pct FROM each GROUP BY 1, 2""", dates=())
def scale_metrics(spark, sf_dir) -> DataFrame:
    return acceptance.scale_metrics(_compared(spark, sf_dir)).withColumn("mean_gap_pct", F.round("mean_gap_pct", 6))


@query(f"""WITH {_CMP}, q AS (SELECT period, CASE WHEN has_other THEN inr END AS valid, period = '1997' AND s % 7 = 2 AS nofactor, NOT (period = '1998' AND s % 5 = 1) AS consistent, period <> '1999' AND s % 3 = 1 AS split, conflict FROM cmp2),
m AS (SELECT period, bool_or(nofactor) AS nofactor, bool_and(consistent) AS consistent, bool_or(split) AS split, count(*) FILTER (valid IS NULL) AS missing_rows, count(*) FILTER (NOT valid) AS invalid_rows, count(*) FILTER (conflict) AS warning_rows FROM q GROUP BY 1),
e AS (SELECT '2000' AS period, count(*) AS errors FROM region UNION ALL SELECT '1980', count(*) FROM region),
r AS (SELECT period, coalesce(errors, 0) AS errors, coalesce(missing_rows, 0) AS missing_rows, coalesce(invalid_rows, 0) AS invalid_rows, coalesce(warning_rows, 0) AS warning_rows,
        CASE WHEN errors > 0 THEN 'PROVIDER_ERRORS' WHEN nofactor THEN 'SPLIT_FACTOR_UNAVAILABLE' WHEN NOT consistent THEN 'NOMINAL_CONVERSION_INCONSISTENT' WHEN NOT split THEN 'NO_SPLIT_OBSERVED' ELSE 'ACCEPTED' END AS reason
      FROM m FULL JOIN e USING (period))
SELECT *, CASE reason WHEN 'ACCEPTED' THEN 'PASS' WHEN 'NO_SPLIT_OBSERVED' THEN 'PARTIAL' ELSE 'FAIL' END AS status FROM r""", dates=())
def acceptance_verdict(spark, sf_dir) -> DataFrame:
    s, p = F.substring("ticker", 2, 3).cast("int"), F.col("period")
    quality = _compared(spark, sf_dir).select("period", F.when(F.col("has_other"), F.col("open_in_range")).alias("valid_nominal_ohlc"), ((p == "1997") & (s % 7 == 2)).alias("split_factor_unavailable"), (~((p == "1998") & (s % 5 == 1))).alias("nominal_conversion_consistent"), ((p != "1999") & (s % 3 == 1)).alias("has_yfinance_split"), F.col("price_conflict").alias("cross_source_price_warning"))
    errors = table(spark, sf_dir, "region").select(F.explode(F.array(F.lit("2000"), F.lit("1980"))).alias("period"))
    return acceptance.acceptance_status(quality, errors)


_RAW_INDEX = "SELECT CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) - 3 * 3600000 AS ms, sum(value) AS v FROM events GROUP BY 1"


def _index(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    raw = events.groupBy((F.unix_millis(F.date_trunc("day", F.col("ts").cast("timestamp"))) - 3 * 3600000).alias("source_timestamp_ms")).agg(F.sum("value").alias("source_value")).withColumn("index_code", F.lit("XU100"))
    calendar = events.select(F.to_date("ts").alias("session_date")).distinct()
    return raw, calendar


@query(f"""WITH raw AS ({_RAW_INDEX}), cal AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT ms AS source_timestamp_ms, CAST(make_timestamp(ms * 1000) AS DATE) AS utc_date, CAST(make_timestamp((ms + 10800000) * 1000) AS DATE) AS local_date, true AS local_midnight, true AS local_session, EXISTS (SELECT 1 FROM cal WHERE d = CAST(make_timestamp(ms * 1000) AS DATE)) AS utc_session FROM raw""", dates=("utc_date", "local_date"))
def index_date_resolution(spark, sf_dir) -> DataFrame:
    raw, calendar = _index(spark, sf_dir)
    return acceptance.index_dates(raw, calendar, "XU100").select("source_timestamp_ms", "utc_date", "local_date", "local_midnight", "local_session", "utc_session")


@query(f"""WITH raw AS ({_RAW_INDEX}), cal AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), vs AS (SELECT unnest(['kept', 'late', 'gone']) AS variant),
x AS (SELECT variant, CASE WHEN variant = 'late' THEN ms + 3600000 ELSE ms END AS ms, v FROM raw, vs),
y AS (SELECT *, CAST(make_timestamp(ms * 1000) AS DATE) AS ud, CAST(make_timestamp((ms + 10800000) * 1000) AS DATE) AS ld, make_timestamp((ms + 10800000) * 1000) AS lt FROM x),
z AS (SELECT *, EXISTS (SELECT 1 FROM cal WHERE d = ud AND NOT (variant = 'gone' AND day(d) = 9)) AS us, EXISTS (SELECT 1 FROM cal WHERE d = ld AND NOT (variant = 'gone' AND day(d) = 9)) AS ls, EXISTS (SELECT 1 FROM cal WHERE d = ud + 1 AND NOT (variant = 'gone' AND day(d) = 9)) AS gs, hour(lt) = 0 AND minute(lt) = 0 AND second(lt) = 0 AS mid FROM y),
m AS (SELECT variant, count(*) AS n_rows, count(DISTINCT ms) AS timestamps, count(*) FILTER (NOT v > 0) AS bad_values, count(*) FILTER (mid) AS midnights, count(*) FILTER (ls) AS local_matches, count(*) FILTER (us) AS utc_matches, count(*) FILTER (gs) AS legacy_matches, count(*) FILTER (ud + 1 = ld) AS legacy_equals_local, count(DISTINCT ld) AS local_dates FROM z GROUP BY 1)
SELECT *, utc_matches / n_rows AS utc_match_ratio, local_matches / n_rows AS local_match_ratio, legacy_matches / n_rows AS legacy_match_ratio, midnights / n_rows AS local_midnight_ratio, legacy_equals_local / n_rows AS legacy_equals_local_ratio,
       CASE WHEN timestamps = n_rows AND bad_values = 0 AND midnights = n_rows AND local_matches = n_rows AND utc_matches < local_matches AND local_dates = n_rows THEN 'VALIDATED' ELSE 'REJECTED' END AS status FROM m""", dates=())
def index_validation(spark, sf_dir) -> DataFrame:
    """The index as it is, an hour late, and with a calendar that lacks the ninth of each month."""
    raw, calendar = _index(spark, sf_dir)
    out = None
    for variant, rows, days in (("kept", raw, calendar), ("late", raw.withColumn("source_timestamp_ms", F.col("source_timestamp_ms") + 3600000), calendar), ("gone", raw, calendar.where("day(session_date) <> 9"))):
        one = acceptance.index_validation(acceptance.index_dates(rows, days, "XU100")).withColumn("variant", F.lit(variant))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {sql.PN},\n{sql.GRID}, ret AS (SELECT prediction_date, session_index, m, CASE WHEN lag(c) OVER w > 0 THEN c / lag(c) OVER w - 1 END AS r FROM grid WINDOW w AS (PARTITION BY security_id ORDER BY session_index))
SELECT prediction_date, session_index, count(r) AS securities, round(quantile_cont(r, 0.5), 6) AS median_return, round(any_value(m), 6) AS benchmark_close FROM ret GROUP BY 1, 2 HAVING count(r) >= 20""")
def index_cross_check(spark, sf_dir) -> DataFrame:
    from ..plans.feature_query import dense

    grid = dense(bars.nation_week(spark, sf_dir))
    index = grid.groupBy("prediction_date").agg(F.max("benchmark_close").alias("benchmark_close"))
    out = acceptance.index_cross_check(grid, index)
    return out.select("prediction_date", "session_index", "securities", F.round("median_return", 6).alias("median_return"), F.round("benchmark_close", 6).alias("benchmark_close"))


# Pages and text -----------------------------------------------------------------------------------------------------


@query("""SELECT page_id, CAST(place - 1 AS INT) AS place, hrefs[place] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS place FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages))""", dates=())
def html_links(spark, sf_dir) -> DataFrame:
    return html.links(table(spark, sf_dir, "pages")).select("page_id", "place", "href")


_VISIBLE = r"""trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'))"""


@query(f"SELECT page_id, length({_VISIBLE}) AS n_chars, sha256({_VISIBLE}) AS text_sha256 FROM pages", dates=())
def html_text(spark, sf_dir) -> DataFrame:
    text = html.visible_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


@query("""SELECT url, page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages""", dates=())
def html_hosts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages").select("url", "page_id", F.expr("parse_url(url, 'HOST')").alias("host"))


@query(r"""SELECT c_custkey, nullif(regexp_replace(trim(upper('  ' || replace(c_name, '#', '') || CASE WHEN c_custkey % 3 = 0 THEN '.is ' ELSE '' END)), '\.IS$', ''), '') AS ticker FROM customer""", dates=())
def ticker_normalize(spark, sf_dir) -> DataFrame:
    raw = F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("")), F.when(F.col("c_custkey") % 3 == 0, ".is ").otherwise(""))
    return table(spark, sf_dir, "customer").select("c_custkey", normalize_ticker(raw).alias("ticker"))


@query("SELECT c_custkey, 'SEC_' || substr(sha256('BIST:EQUITY:' || c_name), 1, 12) AS security_id FROM customer", dates=())
def security_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", security_id(F.col("c_name")).alias("security_id"))


@query(r"""SELECT page_id, substr(regexp_replace(regexp_replace(regexp_replace('failed: ' || url || '?api_key=k1&x=1 Authorization: abc123, token = t;1 secret:s', '(?i)(authorization\s*[:=]\s*)[^\s,;]+', '\1[REDACTED]', 'g'),
  '(?i)((?:api[_-]?key|token|password|secret)\s*[:=]\s*)[^\s,;&]+', '\1[REDACTED]', 'g'), '(?i)([?&](?:api[_-]?key|token|password|secret)=)[^&\s]+', '\1[REDACTED]', 'g'), 1, 1000) AS message FROM pages""", dates=())
def error_sanitizer(spark, sf_dir) -> DataFrame:
    text = F.concat(F.lit("failed: "), F.col("url"), F.lit("?api_key=k1&x=1 Authorization: abc123, token = t;1 secret:s"))
    return table(spark, sf_dir, "pages").select("page_id", sanitized(text).alias("message"))


_LISTED = """listed AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 3 THEN 'BORÇLANMA ARAÇLARI PİYASASI' ELSE 'PAY PİYASASI' END AS market_group, CASE WHEN c_custkey % 23 = 0 THEN 'EMTİA PAZARI' ELSE c_mktsegment END AS market_name,
         CASE WHEN c_custkey % 17 = 0 THEN '' ELSE 'T' || printf('%07d', c_custkey) END AS candidate_ticker,
         CASE c_custkey % 7 WHEN 1 THEN 'ABC YATIRIM ORTAKLIĞI A.Ş.' WHEN 2 THEN 'XYZ BORSA YATIRIM FONU' WHEN 3 THEN 'abc varant' WHEN 4 THEN '' ELSE 'SANAYİ A.Ş.' END AS company_name, 'oid' || c_custkey AS mkk_member_oid, CASE WHEN c_custkey % 31 = 0 THEN 'f1' ELSE '' END AS fund_oid
  FROM customer),
uni AS (SELECT *, CASE WHEN company_name LIKE '%BORSA YATIRIM FONU%' THEN 'ETF' WHEN company_name LIKE '%varant%' THEN 'WARRANT' WHEN fund_oid <> '' THEN 'FUND' ELSE 'EQUITY' END AS instrument_type FROM listed),
au AS (
  SELECT *, CASE WHEN k % 41 = 0 THEN 'KAP_MEMBERSHIP_ENDED' WHEN market_group <> 'PAY PİYASASI' THEN 'NOT_PAY_MARKET' WHEN market_name = 'EMTİA PAZARI' THEN 'NON_EQUITY_MARKET' WHEN instrument_type <> 'EQUITY' THEN instrument_type
                 WHEN candidate_ticker = '' THEN 'MISSING_TICKER' WHEN k % 5 = 0 AND k % 10 <> 0 THEN 'NOT_ACTIVE_KAP_BIST_COMPANY' ELSE '' END AS exclusion_reason FROM uni)"""


#: Scripts that are no payload, and lists that lack a key or the group of share markets.
_DECOYS = r"""<html><script>var x = [1];</script><script>self.__next_f.push([1,broken)</script><script>self.__next_f.push([1,"2:[{\\"title\\":\\"PAY PİYASASI\\"}]"])</script><script>self.__next_f.push([1,"3:{\\"d\\":[{\\"title\\":\\"x\\",\\"contents\\":[]}]}"])</script>"""


def _market_pages(spark, sf_dir) -> DataFrame:
    """A page for each nation; its script pushes groups of markets with their lists."""
    k = F.col("c_custkey")
    group = F.when(k % 10 == 3, "BORÇLANMA ARAÇLARI PİYASASI").otherwise("PAY PİYASASI")
    market = F.when(k % 23 == 0, "EMTİA PAZARI").otherwise(F.col("c_mktsegment"))
    title = F.when(k % 7 == 1, "ABC YATIRIM ORTAKLIĞI A.Ş.").when(k % 7 == 2, "XYZ BORSA YATIRIM FONU").when(k % 7 == 3, "abc varant").when(k % 7 != 4, "SANAYİ A.Ş.")
    item = F.struct(F.when(k % 17 != 0, F.format_string(" t%07d.is ", k)).alias("stockCode"), title.alias("title"), F.lit("T").alias("types"), F.concat(F.lit("oid"), k).alias("mkkMemberOid"), F.when(k % 31 == 0, "f1").alias("fundOid"))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey", group.alias("g"), market.alias("m")).agg(F.collect_list(item).alias("list"))
    markets = F.struct(F.concat(F.lit("fm"), "m").alias("financialMarketOid"), F.col("m").alias("marketName"), F.concat(F.lit("mo"), "m").alias("marketOid"), F.col("list").alias("marketDetailContentList"))
    groups = rows.groupBy("c_nationkey", "g").agg(F.collect_list(markets).alias("contents"))
    data = groups.groupBy("c_nationkey").agg(F.struct(F.collect_list(F.struct(F.col("g").alias("title"), "contents")).alias("data")).alias("record"))
    pushed = F.to_json(F.array(F.lit("1"), F.concat(F.lit("15:"), F.to_json("record"))))
    return data.select(F.col("c_nationkey").cast("long").alias("page_id"), F.concat(F.lit(_DECOYS + "<script>self.__next_f.push("), pushed, F.lit(")</script></html>")).alias("html"))


MARKETS_SCHEMA = "array<struct<title:string,contents:array<struct<financialMarketOid:string,marketName:string,marketOid:string,marketDetailContentList:array<struct<stockCode:string,title:string,types:string,mkkMemberOid:string,fundOid:string>>>>>>"


def _markets(spark, sf_dir) -> DataFrame:
    found = html.only_payload(_market_pages(spark, sf_dir), ["title", "contents"], MARKETS_SCHEMA, ("title", html.SHARE_MARKETS))
    return html.market_rows(found.select("page_id", F.struct(F.col("record").alias("data")).alias("record")))


@query(f"WITH {_LISTED}\nSELECT market_group, 'fm' || market_name AS financial_market_oid, market_name, 'mo' || market_name AS market_oid, company_name, 'T' AS types, mkk_member_oid, fund_oid, candidate_ticker FROM listed", dates=())
def kap_markets(spark, sf_dir) -> DataFrame:
    return _markets(spark, sf_dir)


def _active(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    # of each tenth customer the ticker is known and not the member
    companies = customers.where((k % 5 != 0) | (k % 10 == 0)).select(F.concat(F.lit("oid"), F.when(k % 10 == 0, -k).otherwise(k)).alias("mkk_member_oid"), F.format_string("T%07d", k).alias("ticker"))
    ended = customers.where(k % 41 == 0).select(F.concat(F.lit("oid"), k).alias("mkk_member_oid"))
    return html.active_universe(_markets(spark, sf_dir), companies, ended)


@query(f"""WITH {_LISTED}
SELECT candidate_ticker, company_name, mkk_member_oid, market_name, instrument_type, exclusion_reason, exclusion_reason = '' AS include_in_v1, CASE WHEN exclusion_reason = '' THEN 'SEC_' || substr(sha256('BIST:EQUITY:' || candidate_ticker), 1, 12) ELSE '' END AS security_id FROM au""", dates=())
def active_universe(spark, sf_dir) -> DataFrame:
    return _active(spark, sf_dir).select("candidate_ticker", "company_name", "mkk_member_oid", "market_name", "instrument_type", "exclusion_reason", "include_in_v1", "security_id")


@query(f"""WITH {_LISTED}
SELECT 'market_name' AS dimension, market_name AS value, count(*) AS n FROM au GROUP BY 2 UNION ALL SELECT 'instrument_type', instrument_type, count(*) FROM au GROUP BY 2 UNION ALL SELECT 'exclusion_reason', CASE WHEN exclusion_reason = '' THEN 'NONE' ELSE exclusion_reason END, count(*) FROM au GROUP BY 2""", dates=())
def active_universe_summary(spark, sf_dir) -> DataFrame:
    return html.universe_summary(_active(spark, sf_dir))


@query(r"SELECT page_id, strip_accents(lower(" + _VISIBLE + r")) LIKE '%the%' AND strip_accents(lower(" + _VISIBLE + r")) LIKE '%of%' AS mentions FROM pages", dates=())
def html_mentions(spark, sf_dir) -> DataFrame:
    return html.mentions(table(spark, sf_dir, "pages"), ["the", "of"])
