"""Queries of stored coverage, equality of tables, periods, collection outcomes, quality and embedded payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import filled
from ..operators import acceptance, bars, cleaning, coverage, equality, features, grid, labels, metrics, outcomes, periods, security_quality, ticks
from ..operators.bars import table
from ..plans.feature_query import dense, feature_query
from ..sources import html, snapshots
from . import daily, sql, universe
from .registry import Registry

registry = Registry()
query, QUERIES, SQL = registry.query, registry.queries, registry.sql


# Stored ranges ------------------------------------------------------------------------------------------------------

_ENTRIES = """entries AS (
  SELECT o_custkey % (SELECT count(*) FROM supplier) + 1 AS key, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS e, o_orderkey % 3 <> 0 AS is_current, o_orderkey % 23 <> 5 AS readable, CASE WHEN o_orderkey % 4 = 1 THEN 'NO_DATA_IN_RANGE' ELSE 'DATA' END AS result FROM orders),
usable AS (SELECT * FROM entries x WHERE readable AND NOT EXISTS (SELECT 1 FROM entries b WHERE b.key = x.key AND NOT b.readable AND b.is_current AND b.s <= x.e AND b.e >= x.s)),
asked AS (SELECT s_suppkey AS key, DATE '1997-01-01' + CAST(s_suppkey % 90 AS INT) AS q1, DATE '1998-06-30' AS q2 FROM supplier),
swept AS (
  SELECT *, coalesce(max(hi) OVER w + 1, q1) AS cursor, row_number() OVER (PARTITION BY key ORDER BY s, e, NOT is_current, result) AS r
  FROM (SELECT asked.*, s, e, is_current, result, greatest(q1, s) AS lo, least(q2, e) AS hi FROM asked JOIN usable USING (key) WHERE s <= q2 AND e >= q1)
  WINDOW w AS (PARTITION BY key ORDER BY s, e, NOT is_current, result ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
days AS (SELECT key, CAST(unnest(range(q1, q2 + 1, INTERVAL 1 DAY)) AS DATE) AS d FROM asked),
free AS (SELECT key, d, d - CAST(row_number() OVER (PARTITION BY key ORDER BY d) AS INT) AS g FROM days WHERE NOT EXISTS (SELECT 1 FROM usable u WHERE u.key = days.key AND d BETWEEN s AND e))"""


@query(f"""WITH {_ENTRIES}
SELECT key, CASE WHEN result = 'NO_DATA_IN_RANGE' THEN 'EMPTY_HIT' ELSE 'HIT' END AS kind, lo AS from_date, hi AS to_date, is_current FROM swept WHERE hi >= cursor AND cursor <= q2
UNION ALL SELECT key, 'GAP', min(d), max(d), NULL FROM free GROUP BY key, g""", dates=("from_date", "to_date", "is_current"))
def versioned_coverage(spark, sf_dir) -> DataFrame:
    """Orders as stored ranges of two versions, some unreadable; each supplier asks for one and a half years."""
    suppliers = table(spark, sf_dir, "supplier")
    n = suppliers.agg(F.count("*").alias("n"))  # one row
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    entries = table(spark, sf_dir, "orders").crossJoin(F.broadcast(n)).select(
        (F.col("o_custkey") % F.col("n") + 1).alias("key"), day.alias("start"), F.date_add(day, (k % 40).cast("int")).alias("end"), (k % 3 != 0).alias("is_current"), (k % 23 != 5).alias("readable"),
        F.when(k % 4 == 1, coverage.NO_DATA).otherwise("DATA").alias("result"),
    )
    asked = suppliers.select(F.col("s_suppkey").alias("key"), F.date_add(F.lit("1997-01-01").cast("date"), (F.col("s_suppkey") % 90).cast("int")).alias("start"), F.lit("1998-06-30").cast("date").alias("end"))
    return coverage.versioned_coverage(asked, entries, "key").select("key", "kind", "from_date", "to_date", "is_current")


# Equality of tables -------------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT o_custkey % 200 AS c, o_orderstatus AS s, o_orderpriority AS p FROM orders WHERE o_orderkey % 37 <> 2),
r AS (SELECT o_custkey % 200 AS c, CASE WHEN o_orderkey % 41 = 1 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 43 <> 3 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 37 <> 9),
n AS (SELECT c, s, p, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right FROM (SELECT *, 1 AS l, 0 AS r FROM l UNION ALL SELECT *, 0, 1 FROM r) GROUP BY 1, 2, 3)
SELECT '{"bucket":"' || c || '","priority":' || coalesce('"' || p || '"', 'null') || ',"status":"' || s || '"}' AS content, n_left, n_right,
       CASE WHEN n_right = 0 THEN 'ONLY_LEFT' WHEN n_left = 0 THEN 'ONLY_RIGHT' WHEN n_left > n_right THEN 'MORE_LEFT' ELSE 'MORE_RIGHT' END AS difference FROM n WHERE n_left <> n_right""", dates=())
def table_differences(spark, sf_dir) -> DataFrame:
    """Two versions of a multiset of orders, as many rows repeat in each."""
    orders, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    bucket, status, priority = (F.col("o_custkey") % 200).alias("bucket"), F.col("o_orderstatus"), F.col("o_orderpriority")
    left = orders.where(k % 37 != 2).select(bucket, status.alias("status"), priority.alias("priority"))
    right = orders.where(k % 37 != 9).select(F.when(k % 43 != 3, priority).alias("priority"), bucket, F.when(k % 41 == 1, "X").otherwise(status).alias("status"))
    return equality.differences(left, right)


# Periods ------------------------------------------------------------------------------------------------------------


@query("""WITH q AS (SELECT printf('S%06d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS date, bool_or(l_linenumber % 3 = 0) AS signal FROM lineitem GROUP BY 1, 2),
p AS (SELECT n_nationkey AS place, 'P' || n_nationkey AS period, DATE '1995-03-01' + 80 * n_nationkey AS a, DATE '1995-03-01' + 80 * n_nationkey + 30 * (n_nationkey % 9) AS b, n_nationkey AS n FROM nation)
SELECT ticker, date, string_agg(period, ';' ORDER BY place) AS periods FROM q JOIN p ON date BETWEEN a AND b AND CAST(substr(ticker, 2) AS INT) % 5 IN (n % 5, (n + 2) % 5) WHERE signal GROUP BY 1, 2""", dates=("date",))
def actions_in_periods(spark, sf_dir) -> DataFrame:
    """Days of suppliers with a signal, and the periods (one of each nation) that hold them."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.format_string("S%06d", "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date")).agg(F.bool_or(F.col("l_linenumber") % 3 == 0).alias("has_any_corporate_action_signal"))
    n, k = F.col("n_nationkey"), F.col("s_suppkey")
    start = F.date_add(F.lit("1995-03-01").cast("date"), (80 * n).cast("int"))
    wanted = table(spark, sf_dir, "supplier").select(F.format_string("S%06d", k).alias("t"), (k % 5).cast("int").alias("m"))
    spans = table(spark, sf_dir, "nation").select(n.cast("int").alias("place"), F.concat(F.lit("P"), n).alias("period"), start.alias("start"), F.date_add(start, (30 * (n % 9)).cast("int")).alias("end"), F.explode(F.array(n % 5, (n + 2) % 5)).alias("m"))
    listed = spans.join(wanted, "m").groupBy("place", "period", "start", "end").agg(F.collect_list("t").alias("tickers"))
    return periods.actions_in_periods(rows, listed).select("ticker", "date", "periods")


# Collection outcomes ------------------------------------------------------------------------------------------------

_RESULTS = """results AS (
  SELECT o_orderkey AS k, printf('C%06d', o_custkey) AS security_id, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey % 2 + 1 AS INT) AS pass,
         CASE WHEN o_custkey % 13 = 0 OR o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN 'PARTIAL' ELSE 'COMPLETE' END AS ra, CASE WHEN o_orderkey % 14 = 0 OR o_custkey % 26 = 0 THEN 'NO_HISTORY' ELSE 'FAILED' END AS xa,
         CASE WHEN o_custkey % 13 = 0 OR o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'PARTIAL' ELSE 'COMPLETE' END AS rb, CASE WHEN o_custkey % 13 <> 0 AND o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 11 = 3 THEN 'PARTIAL' ELSE 'COMPLETE' END END AS nb, CASE WHEN o_orderkey % 10 = 0 OR o_custkey % 26 = 0 THEN 'NO_HISTORY' ELSE 'FAILED' END AS xb FROM orders),
outs AS (
  SELECT k AS row_number, security_id, 'T' || substr(security_id, 2) AS current_ticker, d, pass AS collection_pass, coalesce(ra, xa) AS isyatirim_status, coalesce(rb, xb) AS yfinance_status, coalesce(nb, 'FAILED') AS nominal_status,
         CASE WHEN nb = 'COMPLETE' THEN 'YFINANCE_NOMINAL' WHEN rb = 'COMPLETE' THEN 'YFINANCE_RAW' WHEN ra = 'COMPLETE' THEN 'ISYATIRIM_RAW' ELSE '' END AS last_successful_stage,
         CASE WHEN rb IS DISTINCT FROM 'COMPLETE' THEN 'YFINANCE' WHEN ra IS DISTINCT FROM 'COMPLETE' THEN 'ISYATIRIM' ELSE '' END AS failure_stage, CASE WHEN rb IS DISTINCT FROM 'COMPLETE' THEN 'SOURCE_ERROR' WHEN ra IS DISTINCT FROM 'COMPLETE' THEN 'TIMEOUT' ELSE '' END AS failure_class,
         CASE WHEN rb IS DISTINCT FROM 'COMPLETE' THEN 'failed with api_key=[REDACTED]' WHEN ra IS DISTINCT FROM 'COMPLETE' THEN 'timeout of ' || k ELSE '' END AS failure_reason, k % 14 = 7 OR k % 10 = 5 AS retry_recommended,
         2 * (k % 4) + 1 AS network_request_count, 2 * (k % 3) + 1 AS cache_hit_count, 2 * (k % 2) + 1 AS retry_count, CAST(k % 7 = 0 AS BIGINT) AS timeout_count, k % 6 AS empty_range_count, k % 9 AS empty_range_cache_hit_count, (k % 100) / 8.0 + 0.5 AS elapsed_seconds,
         CASE WHEN ra = 'PARTIAL' THEN [{'p': 'ISYATIRIM', 's': d, 'e': d + 5, 'c': 'GAP_A', 'r': 'gap a', 't': true}] ELSE [] END || CASE WHEN rb = 'PARTIAL' THEN [{'p': 'YFINANCE', 's': d + 1, 'e': d + 2, 'c': 'GAP_B', 'r': 'token=[REDACTED]', 't': false}, {'p': 'YFINANCE', 's': d + 10, 'e': d + 20, 'c': 'GAP_B', 'r': '', 't': true}] ELSE [] END AS gaps
  FROM results),
stat AS (
  SELECT security_id, max(current_ticker) AS current_ticker, CASE WHEN bool_and(isyatirim_status = 'COMPLETE' AND yfinance_status = 'COMPLETE' AND nominal_status = 'COMPLETE') THEN 'COMPLETE' WHEN bool_and(isyatirim_status = 'NO_HISTORY' AND yfinance_status = 'NO_HISTORY') THEN 'NO_HISTORY'
              WHEN NOT bool_or(isyatirim_status IN ('COMPLETE', 'PARTIAL') OR yfinance_status IN ('COMPLETE', 'PARTIAL')) THEN 'FAILED' ELSE 'PARTIAL' END AS status,
         max(collection_pass) AS last_collection_pass, bool_or(retry_recommended) AS retry_recommended,
         coalesce(arg_max(failure_stage, row(collection_pass, row_number)) FILTER (failure_reason <> ''), '') AS failure_stage, coalesce(arg_max(failure_class, row(collection_pass, row_number)) FILTER (failure_reason <> ''), '') AS failure_class, coalesce(arg_max(failure_reason, row(collection_pass, row_number)) FILTER (failure_reason <> ''), '') AS failure_reason,
         arg_max(last_successful_stage, row(collection_pass, row_number)) AS last_successful_stage, CAST(sum(network_request_count) AS BIGINT) AS network_request_count, CAST(sum(cache_hit_count) AS BIGINT) AS cache_hit_count, CAST(sum(retry_count) AS BIGINT) AS retry_count, CAST(sum(timeout_count) AS BIGINT) AS timeout_count,
         CAST(sum(empty_range_count) AS BIGINT) AS empty_range_count, CAST(sum(empty_range_cache_hit_count) AS BIGINT) AS empty_range_cache_hit_count
  FROM outs {where} GROUP BY 1)"""


def _outcomes(spark, sf_dir) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    security = F.format_string("C%06d", "o_custkey")
    kind = "array<struct<start_date:date,end_date:date,failure_class:string,failure_reason:string,retry_recommended:boolean>>"
    gone, empty_handed = F.col("o_custkey") % 13 == 0, F.col("o_custkey") % 26 == 0
    status = lambda n: F.when(~gone & (k % n == 1), "PARTIAL").when(~gone & (k % n != 0), "COMPLETE")
    missing = lambda *ranges: F.array(*[F.struct(F.date_add(d, a).alias("start_date"), F.date_add(d, b).alias("end_date"), F.lit(c).alias("failure_class"), F.lit(r).alias("failure_reason"), F.lit(t).alias("retry_recommended")) for a, b, c, r, t in ranges]).cast(kind)
    none = F.lit(None).cast("string")

    def result(source, raw, nominal, otherwise, failure, reason, retry, extra, timeouts, empty, cached, gaps):
        return F.struct(
            F.lit(source).alias("source"), raw.alias("raw_status"), nominal.alias("nominal_status"), F.when(otherwise, "NO_HISTORY").otherwise("FAILED").alias("result"), F.when(~F.coalesce(raw == "COMPLETE", F.lit(False)), failure).alias("failure_class"),
            F.when(~F.coalesce(raw == "COMPLETE", F.lit(False)), reason).alias("failure_reason"), retry.alias("retry_recommended"), (k % 4 + extra).alias("network_request_count"), (k % 3 + extra).alias("cache_hit_count"), (k % 2 + extra).alias("retry_count"),
            timeouts.cast("long").alias("timeout_count"), empty.cast("long").alias("empty_range_count"), cached.cast("long").alias("empty_range_cache_hit_count"), F.when(raw == "PARTIAL", gaps).alias("missing_ranges"), ((k % 100) / 16.0 + 0.25).alias("elapsed_seconds"),
        )

    first = result("isyatirim", status(7), none, (k % 14 == 0) | empty_handed, F.lit("TIMEOUT"), F.concat(F.lit("timeout of "), k), k % 14 == 7, F.lit(0), (k % 7 == 0).cast("int"), k % 6, F.lit(0), missing((0, 5, "GAP_A", "gap a", True)))
    nominal = F.when(~gone & (k % 5 != 0), F.when(k % 11 == 3, "PARTIAL").otherwise("COMPLETE"))
    second = result("yfinance", status(5), nominal, (k % 10 == 0) | empty_handed, F.lit("SOURCE_ERROR"), F.lit("failed with api_key=k1"), k % 10 == 5, F.lit(1), F.lit(0), F.lit(0), k % 9, missing((1, 2, "GAP_B", "token=abc", False), (10, 20, "GAP_B", "", True)))
    plan = [k.alias("row_number"), security.alias("security_id"), F.concat(F.lit("T"), F.substring(security, 2, 20)).alias("current_ticker"), F.concat(F.lit("T"), k).alias("provider_ticker"), d.alias("period_start"), F.date_add(d, 30).alias("period_end"), (k % 2 + 1).cast("int").alias("collection_pass")]
    each = table(spark, sf_dir, "orders").select(*plan, F.explode(F.array(second, first)).alias("r")).select(*outcomes.PLAN, "r.*")
    return outcomes.outcomes(each)


_OUTS = _RESULTS.replace("{where}", "")
_OUT_COLUMNS = ["row_number", "security_id", "current_ticker", "collection_pass", "isyatirim_status", "yfinance_status", "nominal_status", "last_successful_stage", "failure_stage", "failure_class", "failure_reason", "retry_recommended", *outcomes.COUNTERS, "elapsed_seconds"]


@query(f"WITH {_OUTS}\nSELECT {', '.join(_OUT_COLUMNS)}, len(gaps) AS n_gaps FROM outs", dates=())
def collection_outcomes(spark, sf_dir) -> DataFrame:
    return _outcomes(spark, sf_dir).select(*_OUT_COLUMNS, F.size("gaps").cast("long").alias("n_gaps"))


@query(f"WITH {_OUTS}\nSELECT * FROM stat", dates=())
def security_status(spark, sf_dir) -> DataFrame:
    return outcomes.security_status(_outcomes(spark, sf_dir))


@query(f"""WITH {_OUTS}, g AS (SELECT outs.*, status, unnest(gaps) AS g FROM outs JOIN stat USING (security_id) WHERE status <> 'COMPLETE')
SELECT security_id, current_ticker, g.p AS provider, collection_pass, row_number, status, g.s AS missing_start_date, g.e AS missing_end_date, g.p AS failure_stage, g.c AS failure_class, g.r AS failure_reason, last_successful_stage, g.t AS retry_recommended,
       round(elapsed_seconds, 6) AS elapsed_seconds, network_request_count, cache_hit_count, retry_count, timeout_count FROM g""".replace("outs.*", "outs.* EXCLUDE (failure_stage, failure_class, failure_reason, retry_recommended)"), dates=("missing_start_date", "missing_end_date"))
def collection_gaps(spark, sf_dir) -> DataFrame:
    found = _outcomes(spark, sf_dir)
    return outcomes.collection_gaps(outcomes.security_status(found), found)


@query(f"WITH {_OUTS}\nSELECT * EXCLUDE (last_collection_pass), last_collection_pass AS collection_pass FROM stat WHERE status IN ('FAILED', 'NO_HISTORY')", dates=())
def collection_failures(spark, sf_dir) -> DataFrame:
    return outcomes.collection_failures(outcomes.security_status(_outcomes(spark, sf_dir)))


_FIRST_PASS = _RESULTS[_RESULTS.index("stat AS (") :].replace("{where}", "WHERE row_number % 3 = 0").replace("stat AS", "first_pass AS")


@query(f"""WITH {_OUTS}, {_FIRST_PASS}
SELECT f.security_id, f.status AS first_status, stat.status AS last_status, CASE WHEN stat.status = 'COMPLETE' THEN 'RECOVERED' ELSE 'REMAINING' END AS outcome FROM first_pass f LEFT JOIN stat USING (security_id) WHERE f.status = 'PARTIAL' OR (f.status = 'FAILED' AND f.retry_recommended)""", dates=())
def collection_retries(spark, sf_dir) -> DataFrame:
    """A third of the planned rows as first pass, all of them as second."""
    found = _outcomes(spark, sf_dir)
    return outcomes.retries(outcomes.security_status(found.where("row_number % 3 = 0")), outcomes.security_status(found))


@query(f"""WITH {sql.PW}, cal AS (SELECT prediction_date AS d, row_number() OVER (ORDER BY prediction_date) AS k FROM (SELECT DISTINCT prediction_date FROM panel)),
seen AS (SELECT security_id, d, k, k - lag(k) OVER (PARTITION BY security_id ORDER BY k) - 1 AS gap FROM panel JOIN cal ON d = prediction_date WHERE CAST(substr(security_id, 2) AS INT) % 9 <> 4 OR k BETWEEN 60 AND 250),
per AS (SELECT security_id, min(d) AS a, max(d) AS b, count(*) AS n, coalesce(max(gap), 0) AS g FROM seen GROUP BY 1),
s AS (SELECT printf('S%06d', s_suppkey) AS security_id, 'PARTIAL' AS status FROM supplier UNION ALL SELECT printf('X%06d', s_suppkey), 'FAILED' FROM supplier WHERE s_suppkey % 10 = 0),
j AS (SELECT s.*, a, b, coalesce(n, 0) AS n, coalesce(g, 0) AS g, coalesce(a > (SELECT min(d) FROM cal), false) AS late, coalesce(b < (SELECT max(d) FROM cal), false) AS early FROM s LEFT JOIN per USING (security_id))
SELECT security_id, status, a AS first_observed_date, b AS last_observed_date, n AS observed_session_count, (SELECT count(*) FROM cal) - n AS missing_session_count, g AS longest_internal_gap_sessions, late AS late_start, early AS early_end, late OR early OR g > 0 AS mapping_review_required FROM j""", dates=("first_observed_date", "last_observed_date"))
def observed_status(spark, sf_dir) -> DataFrame:
    """Suppliers by week, of which each ninth begins late and ends early, and some that were never observed."""
    return _observed_status(spark, sf_dir)


def _observed_status(spark, sf_dir) -> DataFrame:
    panel = bars.supplier_week(spark, sf_dir).select("security_id", F.col("prediction_date").alias("date"))
    calendar = grid.build_calendar(panel, date="date")
    k = F.col("session_index") + 1
    seen = panel.join(grid.per_session(calendar.withColumnRenamed("session_date", "date")), "date").where((F.substring("security_id", 2, 6).cast("int") % 9 != 4) | k.between(60, 250))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"))
    status = suppliers.select(F.format_string("S%06d", "s").alias("security_id"), F.lit("PARTIAL").alias("status")).unionByName(suppliers.where("s % 10 = 0").select(F.format_string("X%06d", "s").alias("security_id"), F.lit("FAILED").alias("status")))
    return outcomes.observed_status(status, seen.select("security_id", "date"), calendar)


# Quality ------------------------------------------------------------------------------------------------------------


@query(f"""WITH {daily.LABELS},
ident AS (SELECT security_id, count(*) AS n, count(*) FILTER (NOT coalesce(no > 0 AND nh > 0 AND nl > 0 AND nc > 0 AND nh >= greatest(no, nc) AND nl <= least(no, nc), false)) AS bad, count(*) FILTER (coalesce(no <= 0 OR nh <= 0 OR nl <= 0 OR nc <= 0, false)) AS low, count(*) FILTER (NOT coalesce(tl > 0, false) AND NOT coalesce(sh > 0, false)) AS novol FROM obs GROUP BY 1),
cl AS (SELECT security_id, count(*) FILTER (pw) AS warn, count(*) FILTER (eligible) AS el, count(*) FILTER (rev) AS rv FROM clean GROUP BY 1),
lb AS (SELECT security_id, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q, count(*) FILTER (label_status <> 'LABELED') AS na FROM labels3 GROUP BY 1),
st AS (SELECT printf('N%03d', n_nationkey) AS security_id, n_name AS current_ticker, CAST(n_nationkey AS BIGINT) AS missing_session_count, CAST(n_nationkey % 4 AS BIGINT) AS longest_internal_gap_sessions, n_nationkey % 3 <> 0 AS collection_complete FROM nation UNION ALL SELECT 'NONE', 'NONE', 7, 7, false)
SELECT security_id, current_ticker, coalesce(n, 0) AS observed_session_count, round(coalesce(n, 0) / (SELECT count(DISTINCT k) FROM obs), 6) AS observed_session_ratio, missing_session_count, longest_internal_gap_sessions, coalesce(bad, 0) AS invalid_or_missing_ohlc_count, coalesce(low, 0) AS non_positive_price_count,
       coalesce(novol, 0) AS both_volumes_missing_or_zero_count, coalesce(warn, 0) AS cross_source_warning_count, coalesce(el, 0) AS entry_eligible_count, coalesce(rv, 0) AS requires_review_count, coalesce(p, 0) AS positive_label_count, coalesce(q, 0) AS negative_label_count, coalesce(na, 0) AS na_label_count, collection_complete
FROM st LEFT JOIN ident USING (security_id) LEFT JOIN cl USING (security_id) LEFT JOIN lb USING (security_id)""", dates=())
def security_quality_report(spark, sf_dir) -> DataFrame:
    observed = daily.observed(spark, sf_dir)
    clean = daily.clean(spark, sf_dir)
    found = universe.labelled(spark, sf_dir)
    n = F.col("n_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.format_string("N%03d", n).alias("security_id"), F.col("n_name").alias("current_ticker"), n.cast("long").alias("missing_session_count"), (n % 4).cast("long").alias("longest_internal_gap_sessions"), (n % 3 != 0).alias("collection_complete"))
    unseen = table(spark, sf_dir, "region").agg(F.lit("NONE").alias("security_id"), F.lit("NONE").alias("current_ticker"), F.lit(7).cast("long").alias("missing_session_count"), F.lit(7).cast("long").alias("longest_internal_gap_sessions"), F.lit(False).alias("collection_complete"))
    out = security_quality.by_security(nations.unionByName(unseen), observed, observed, clean, found, observed.select("session_index").distinct())
    return out.withColumn("observed_session_ratio", F.round("observed_session_ratio", 6))


_WHOLE = " AND ".join(f"{f} IS NOT NULL" for f in features.FEATURES)
_NONE = " + ".join(f"CAST({f} IS NULL AS INT)" for f in features.FEATURES)
_RANKED_SQL = f"ranked AS (SELECT *, {', '.join(f'{sql.rank(x)} AS {n}' for n, x in sql.RANK_SQL.items())} FROM features)"


@query(f"""WITH {sql.PN},\n{sql.BASE_CTES},\n{_RANKED_SQL},
day AS (SELECT prediction_date, count(*) AS n, count(*) FILTER ({_WHOLE}) AS valid, sum({_NONE}) AS missing, {" AND ".join(f"count({r}) > 0" for r in features.RANKS)} AS ranked FROM ranked GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS feature_rows, CAST(sum(missing) AS BIGINT) AS feature_nan_count, CAST(0 AS BIGINT) AS infinite_feature_value_count, count(*) FILTER (ranked) AS cross_sectional_rank_date_count, min(valid) AS daily_valid_min, quantile_cont(valid, 0.5) AS daily_valid_median, max(valid) AS daily_valid_max,
       (SELECT count(*) FROM calendar) AS global_calendar_session_count, round((SELECT count(*) FROM bench WHERE prediction_date IN (SELECT prediction_date FROM calendar WHERE session_index % 59 <> 8)) / (SELECT count(*) FROM calendar), 6) AS index_calendar_match_ratio FROM day""", dates=())
def panel_quality_summary(spark, sf_dir) -> DataFrame:
    """The 32 features of nations by week; the index lacks some sessions."""
    rows = feature_query(bars.nation_week(spark, sf_dir))
    calendar = rows.select(F.col("prediction_date").alias("session_date"), "session_index").distinct()
    index = calendar.where("session_index % 59 <> 8").select(F.col("session_date").alias("prediction_date"))
    out = security_quality.panel_summary(rows.drop("session_index"), calendar, index)
    return out.withColumn("index_calendar_match_ratio", F.round("index_calendar_match_ratio", 6))


# Embedded payloads --------------------------------------------------------------------------------------------------

COMPANIES_SCHEMA = "array<struct<code:string,content:array<struct<mkkMemberOid:string,kapMemberTitle:string,stockCode:string,cityName:string,kapMemberType:string>>>>"


def _company_pages(spark, sf_dir) -> DataFrame:
    """A page for each nation: its customers in groups of one letter, three levels deep, among scripts that look like it."""
    k = F.col("c_custkey")
    item = F.struct(F.concat(F.lit(" oid"), k).alias("mkkMemberOid"), F.concat(F.col("c_name"), F.lit(" ")).alias("kapMemberTitle"), F.when(k % 5 != 0, F.concat(F.lit("T"), k)).alias("stockCode"), F.col("c_mktsegment").alias("cityName"), F.lit("IGS").alias("kapMemberType"))
    twice = F.explode(F.when(k % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.substring("c_mktsegment", 1, 1).alias("g"), item.alias("item"), twice.alias("t"))
    groups = rows.groupBy("c_nationkey", "g").agg(F.collect_list("item").alias("content")).groupBy("c_nationkey").agg(F.collect_list(F.struct(F.col("g").alias("code"), "content")).alias("list"))
    wrapped = F.concat(F.lit('[{"tag":"$"},{"children":'), F.to_json(F.struct(F.lit("x").alias("title"), F.col("list").alias("data"))), F.lit("}]"))
    pushed = F.to_json(F.array(F.lit("1"), F.concat(F.lit("15:"), wrapped)))
    decoys = """<script>var a = [1];</script><script>self.__next_f.push([1,"3:[{\\"code\\":\\"x\\"},{\\"content\\":[]}]"])</script><script>self.__next_f.push([1,broken)</script><script>self.__next_f.push([1,"no colon"])</script><script>self.__next_f.push([0])</script><script>self.__next_f.push([1,7])</script>"""
    page = F.concat(F.lit(f"<html>{decoys}<script async>\n self.__next_f.push("), pushed, F.lit(") \n</script></html>"))
    return groups.select(F.col("c_nationkey").cast("long").alias("page_id"), page.alias("html"))


@query("""SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS page_id, 'oid' || c_custkey AS mkk_member_oid, trim(c_name) AS company_name, CASE WHEN c_custkey % 5 <> 0 THEN 'T' || c_custkey ELSE '' END AS stock_code, c_mktsegment AS city_name, 'IGS' AS kap_member_type FROM customer""", dates=())
def kap_companies(spark, sf_dir) -> DataFrame:
    return html.company_rows(html.only_payload(_company_pages(spark, sf_dir), ["code", "content"], COMPANIES_SCHEMA))


# Totals and small reports -------------------------------------------------------------------------------------------

_HELD = ", ".join(f"count(*) FILTER (list_contains(reasons, '{r}')) AS {r}" for r in ("NO_OPEN", "NO_TRADE", "INVALID_OHLC", "NO_PREVIOUS_CLOSE", "LIMIT_OPEN", "SPECIAL_MARGIN_OR_CORPORATE_ACTION", "CORPORATE_ACTION_WINDOW", "PRICE_STEP_UNAVAILABLE"))


@query(f"""WITH {daily.CLEAN}
SELECT count(*) AS row_count, count(*) FILTER (eligible) AS entry_eligible_true, count(*) FILTER (NOT eligible) AS entry_eligible_false, count(*) FILTER (eligible IS NULL) AS entry_eligible_unresolved, count(*) FILTER (rev) AS requires_review, {_HELD},
       count(*) FILTER (NOT nolim AND NOT noprev) AS price_step_resolution_resolved, count(*) FILTER (nolim OR noprev) AS price_step_resolution_unavailable, count(*) FILTER (vflag = 'BOTH_VOLUMES_MISSING_UNRESOLVED') AS both_volumes_missing, count(*) FILTER (vflag = 'SOURCE_VOLUME_CONFLICT') AS one_volume_conflict,
       count(*) FILTER (awin) AS corporate_action_window_rows, count(*) FILTER (pw) AS cross_source_warning FROM clean""", dates=())
def clean_totals(spark, sf_dir) -> DataFrame:
    return cleaning.clean_totals(daily.clean(spark, sf_dir))


@query(f"""WITH {daily.CLEAN}
SELECT security_id, prediction_date, eligible AS entry_eligible, rev AS requires_review, pw AS cross_source_price_warning FROM clean WHERE eligible IS NOT TRUE OR rev OR pw ORDER BY security_id, prediction_date LIMIT 50""", dates=("prediction_date", "entry_eligible", "cross_source_price_warning"))
def clean_exceptions(spark, sf_dir) -> DataFrame:
    found = cleaning.exceptions(daily.clean(spark, sf_dir), 50)
    return found.select("security_id", "prediction_date", "entry_eligible", "requires_review", F.coalesce("cross_source_price_warning", F.lit(False)).alias("cross_source_price_warning"))


@query(f"""WITH {daily.LABELS}, n AS (SELECT why, count(*) AS n FROM labels3x WHERE label_status = 'NA' GROUP BY 1)
SELECT count(*) AS row_count, count(*) FILTER (label = 1) AS label_positive, count(*) FILTER (label = 0) AS label_negative, count(*) FILTER (label IS NULL) AS label_na, count(*) FILTER (target_hit_horizon = 1) AS target_hit_t1, count(*) FILTER (target_hit_horizon = 2) AS target_hit_t2, count(*) FILTER (target_hit_horizon = 3) AS target_hit_t3,
       (SELECT string_agg(why || '=' || n, '|' ORDER BY why) FROM n) AS na_reasons FROM labels3""".replace("labels3x", "(SELECT *, label_na_reason AS why FROM labels3)"), dates=())
def label_totals(spark, sf_dir) -> DataFrame:
    return labels.label_totals(labels.three_session_labels(daily.clean(spark, sf_dir), ticks.tariff(spark)))


@query(f"""WITH {daily.CLEAN} SELECT security_id, prediction_date FROM clean WHERE prediction_date >= DATE '2020-03-13'""")
def from_model_start(spark, sf_dir) -> DataFrame:
    return cleaning.from_model_start(daily.clean(spark, sf_dir)).select("security_id", "prediction_date")


@query(universe.REPORT_SQL, dates=())
def classification_report(spark, sf_dir) -> DataFrame:
    out = metrics.classification_report(universe.scores(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1", "positive_rate", "predicted_rate", "brier", "roc_auc", "average_precision")})


@query("""WITH q AS (SELECT printf('S%06d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS date, sum(l_extendedprice) AS gap, bool_and(l_linenumber <> 2) AS normal_day, bool_or(l_returnflag = 'R') AS inside FROM lineitem GROUP BY 1, 2)
SELECT ticker, date, round(gap, 2) AS nominal_open_range_gap FROM q WHERE normal_day AND NOT inside ORDER BY gap DESC, ticker, date LIMIT 20""", dates=("date",))
def largest_misses(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.format_string("S%06d", "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"))
    quality = rows.agg(F.sum("l_extendedprice").alias("nominal_open_range_gap"), F.bool_and(F.col("l_linenumber") != 2).alias("normal_day"), F.bool_or(F.col("l_returnflag") == "R").alias("nominal_open_within_range"))
    return acceptance.largest_misses(quality).select("ticker", "date", F.round("nominal_open_range_gap", 2).alias("nominal_open_range_gap"))


@query(f"WITH {_OUTS}\nSELECT current_ticker, CAST(sum(network_request_count) AS BIGINT) AS network_request_count, CAST(sum(retry_count) AS BIGINT) AS retry_count, count(*) AS attempt_count FROM outs GROUP BY 1", dates=())
def collection_telemetry(spark, sf_dir) -> DataFrame:
    return acceptance.telemetry(_outcomes(spark, sf_dir))


_SCOPE_HASH = """'{"o_custkey":' || o_custkey || ',"o_orderpriority":"' || o_orderpriority || '","status":"' || s || '"}'"""


@query(f"""WITH x AS (SELECT 'one' AS run, o_custkey, o_orderpriority, o_orderstatus AS s FROM orders UNION ALL SELECT 'two', o_custkey, o_orderpriority, o_orderstatus FROM orders UNION ALL SELECT 'three', o_custkey, o_orderpriority, CASE WHEN o_orderkey % 97 = 1 THEN 'X' ELSE o_orderstatus END FROM orders),
h AS (SELECT run, sha256({_SCOPE_HASH}) AS h FROM x),
q AS (SELECT run, count(*) AS n_rows, sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)) AS a, sum(CAST('0x' || substr(h, 17, 16) AS UBIGINT)) AS b, sum(CAST('0x' || substr(h, 33, 16) AS UBIGINT)) AS c, sum(CAST('0x' || substr(h, 49, 16) AS UBIGINT)) AS d FROM h GROUP BY 1),
r AS (SELECT run, n_rows, sha256(concat_ws(':', n_rows, a, b, c, d)) AS scope_digest FROM q)
SELECT *, scope_digest = (SELECT scope_digest FROM r WHERE run = 'one') AS scope_digest_equal FROM r""", dates=())
def scope_equivalence(spark, sf_dir) -> DataFrame:
    """Three runs over the orders: the second the same in another order, the third with changes."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.col("o_orderstatus").alias("status"), "o_orderkey")
    runs = orders.withColumn("run", F.lit("one")).unionByName(orders.repartition(7, "o_custkey").withColumn("run", F.lit("two"))).unionByName(orders.withColumns({"run": F.lit("three"), "status": F.when(F.col("o_orderkey") % 97 == 1, "X").otherwise(F.col("status"))}))
    return acceptance.same_scope(runs.drop("o_orderkey"), "one")


@query(f"""WITH {sql.PW}, cal AS (SELECT DISTINCT prediction_date AS d FROM panel WHERE CAST(substr(security_id, 2) AS INT) % 2 = 0 AND dayofyear(prediction_date) % 5 <> 0),
o AS (SELECT DISTINCT security_id, prediction_date + CAST(CAST(substr(security_id, 2) AS INT) % 3 AS INT) AS date FROM panel)
SELECT security_id, date, CASE WHEN date BETWEEN (SELECT min(d) FROM cal) AND (SELECT max(d) FROM cal) THEN 'YFINANCE_NON_SESSION_WITHIN_VERIFIED_CALENDAR_BOUNDS' ELSE 'OUTSIDE_CALENDAR_BOUNDS' END AS exclusion_reason FROM o WHERE date NOT IN (SELECT d FROM cal)""", dates=("date",))
def outside_calendar(spark, sf_dir) -> DataFrame:
    """Suppliers by week, moved by a day or two for some, against a calendar that lacks sessions."""
    panel, s = bars.supplier_week(spark, sf_dir), F.substring("security_id", 2, 6).cast("int")
    calendar = grid.build_calendar(panel.where((s % 2 == 0) & (F.dayofyear("prediction_date") % 5 != 0)))
    observed = panel.select("security_id", F.date_add("prediction_date", s % 3).alias("date")).distinct()
    return grid.outside_calendar(observed, calendar, "date").select("security_id", "date", "exclusion_reason")


@query(f"""WITH {sql.PW},\n{sql.GRID}, x AS (SELECT security_id, session_index, CASE WHEN present AND session_index % 9 = 4 THEN c END AS v FROM grid)
SELECT security_id, session_index, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY session_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(v IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY session_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM x""", dates=())
def filled_constants(spark, sf_dir) -> DataFrame:
    rows = dense(bars.supplier_week(spark, sf_dir))
    value = F.when(F.col("_source_row_present") & (F.col("session_index") % 9 == 4), F.col("close"))
    return rows.withColumn("v", value).select("security_id", "session_index", filled(F.col("v")).alias("filled"))


@query(f"""WITH {_OUTS}, p AS (SELECT security_id, bool_and(isyatirim_status = 'COMPLETE') AS a, bool_and(yfinance_status = 'COMPLETE') AS b, bool_and(nominal_status = 'COMPLETE') AS c FROM outs GROUP BY 1),
u AS (SELECT printf('C%06d', c_custkey) AS security_id FROM customer), j AS (SELECT u.security_id, status, last_collection_pass AS l, a, b, c FROM u LEFT JOIN stat USING (security_id) LEFT JOIN p USING (security_id))
SELECT count(*) AS master_security_count, count(status) AS attempted_security_count, count(*) FILTER (status = 'COMPLETE') AS complete_security_count, count(*) FILTER (status = 'PARTIAL') AS partial_security_count, count(*) FILTER (status = 'FAILED') AS failed_security_count, count(*) FILTER (status = 'NO_HISTORY') AS no_history_security_count,
       count(*) FILTER (status IS NULL) AS unattempted_security_count, round(count(*) FILTER (a) / greatest(count(status), 1), 6) AS isyatirim_success_rate, round(count(*) FILTER (b) / greatest(count(status), 1), 6) AS yfinance_success_rate, round(count(*) FILTER (c) / greatest(count(status), 1), 6) AS nominal_success_rate,
       count(*) FILTER (status = 'COMPLETE' AND l = 1) AS first_pass_complete_count, count(*) FILTER (l = 2) AS retry_pass_attempted_count, count(*) FILTER (status = 'COMPLETE' AND l = 2) AS retry_pass_recovered_count, count(*) FILTER (status = 'PARTIAL' AND l = 2) AS retry_pass_remaining_partial_count, count(*) FILTER (status = 'FAILED' AND l = 2) AS retry_pass_remaining_failed_count FROM j""", dates=())
def collection_report(spark, sf_dir) -> DataFrame:
    found = _outcomes(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select(F.format_string("C%06d", "c_custkey").alias("security_id"))
    out = outcomes.collection_report(customers, outcomes.security_status(found), found)
    return out.withColumns({f"{x}_success_rate": F.round(f"{x}_success_rate", 6) for x in ("isyatirim", "yfinance", "nominal")})


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS a, o_totalprice AS b FROM orders WHERE o_orderkey % 17 <> 2),
n AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 23 = 1 THEN 'X' ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 29 <> 3 THEN o_totalprice END AS b FROM orders WHERE o_orderkey % 19 <> 5),
j AS (SELECT coalesce(o.d, n.d) AS d, o.k IS NULL AS added, n.k IS NULL AS removed, o.k IS NOT NULL AND n.k IS NOT NULL AND o.a IS DISTINCT FROM n.a AS ca, o.k IS NOT NULL AND n.k IS NOT NULL AND o.b IS DISTINCT FROM n.b AS cb FROM o FULL JOIN n ON o.k = n.k AND o.d = n.d)
SELECT count(*) FILTER (ca OR cb) AS changed_row_count, CAST(sum(CASE WHEN ca OR cb THEN CAST(ca AS INT) + CAST(cb AS INT) + 1 ELSE 0 END) AS BIGINT) AS changed_cell_count, 'note|o_orderstatus|o_totalprice' AS changed_columns,
       (SELECT string_agg(DISTINCT CAST(d AS VARCHAR), '|' ORDER BY CAST(d AS VARCHAR)) FROM j WHERE added) AS added_dates, (SELECT string_agg(DISTINCT CAST(d AS VARCHAR), '|' ORDER BY CAST(d AS VARCHAR)) FROM j WHERE removed) AS removed_dates FROM j""", dates=())
def snapshot_revision(spark, sf_dir) -> DataFrame:
    """Two versions of the orders; the new one has a column more."""
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"), "o_orderstatus", "o_totalprice")
    new = orders.where(k % 19 != 5).select("o_orderkey", "date", F.when(k % 23 == 1, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(k % 29 != 3, F.col("o_totalprice")).alias("o_totalprice"), F.lit("n").alias("note"))
    return snapshots.revision(orders.where(k % 17 != 2), new, ["o_orderkey", "date"], "date")
