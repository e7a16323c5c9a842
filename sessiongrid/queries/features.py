"""Feature queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import bars, coverage, features, grid
from ..plans.feature_query import dense, feature_query, observed
from . import sql
from .registry import Registry

registry = Registry()
query, QUERIES, SQL = registry.query, registry.queries, registry.sql


def r(name: str) -> Column:
    return (F.round(name, 6) + F.lit(0.0)).alias(name)


GROUPS = {
    "feat_returns": features.BASE[:6],
    "feat_trend": features.BASE[6:10],
    "feat_volatility": features.BASE[10:15],
    "feat_volume": features.BASE[15:20],
    "feat_intraday": features.BASE[20:23],
    "feat_rsi": features.BASE[23:24],
    "feat_relative": features.BASE[24:28],
}
for _name, _columns in GROUPS.items():

    def _run(spark, sf_dir, columns=_columns) -> DataFrame:
        rows = features.base_features(observed(bars.nation_week(spark, sf_dir)))
        return rows.select("security_id", "prediction_date", *[r(c) for c in columns])

    query(f"WITH {sql.PN},\n{sql.BASE_CTES}\nSELECT security_id, prediction_date, {sql.rounded(_columns)} FROM features", _name)(_run)

_RANKED = f"ranked AS (SELECT *, {', '.join(f'{sql.rank(x)} AS {n}' for n, x in sql.RANK_SQL.items())} FROM features)"


@query(f"WITH {sql.PN},\n{sql.BASE_CTES},\n{_RANKED}\nSELECT security_id, prediction_date, {sql.rounded(list(sql.RANK_SQL))} FROM ranked")
def feat_cross_section(spark, sf_dir) -> DataFrame:
    return feature_query(bars.nation_week(spark, sf_dir)).select("security_id", "prediction_date", *[r(c) for c in features.RANKS])


@query(f"WITH {sql.PN},\n{sql.BASE_CTES},\n{_RANKED}\nSELECT security_id, prediction_date, session_index, {sql.rounded(features.FEATURES)} FROM ranked")
def feat_all_32(spark, sf_dir) -> DataFrame:
    return feature_query(bars.nation_week(spark, sf_dir)).select("security_id", "prediction_date", "session_index", *[r(c) for c in features.FEATURES])


@query(f"WITH {sql.PW},\n{sql.BASE_CTES},\n{_RANKED}\nSELECT security_id, prediction_date, session_index, {sql.rounded(features.FEATURES)} FROM ranked")
def feat_all_32_suppliers(spark, sf_dir) -> DataFrame:
    return feature_query(bars.supplier_week(spark, sf_dir)).select("security_id", "prediction_date", "session_index", *[r(c) for c in features.FEATURES])


@query(f"WITH {sql.PE},\n{sql.BASE_CTES}\nSELECT security_id, prediction_date, {sql.rounded(['ret_1', 'return_volatility_5', 'overnight_gap', 'close_location_value'])} FROM features")
def feat_user_days(spark, sf_dir) -> DataFrame:
    rows = features.base_features(observed(bars.user_day(spark, sf_dir)))
    return rows.select("security_id", "prediction_date", *[r(c) for c in ("ret_1", "return_volatility_5", "overnight_gap", "close_location_value")])


@query(f"WITH {sql.PN},\n{sql.GRID}\nSELECT prediction_date AS session_date, session_index FROM calendar", dates=("session_date",))
def calendar_build(spark, sf_dir) -> DataFrame:
    return grid.build_calendar(bars.nation_week(spark, sf_dir))


@query(f"WITH {sql.PN}\nSELECT security_id, prediction_date, open, high, low, close, {sql.rounded(bars.BAR[4:])} FROM panel")
def panel_bars_week(spark, sf_dir) -> DataFrame:
    return bars.nation_week(spark, sf_dir).select("security_id", "prediction_date", *bars.BAR[:4], *[r(c) for c in bars.BAR[4:]])


@query(f"WITH {sql.PW},\n{sql.GRID}\nSELECT security_id, prediction_date, session_index, present, c AS close, round(m, 6) AS benchmark_close FROM grid")
def grid_densify(spark, sf_dir) -> DataFrame:
    return dense(bars.supplier_week(spark, sf_dir)).select("security_id", "prediction_date", "session_index", F.col("_source_row_present").alias("present"), "close", r("benchmark_close"))


def _reason_sql() -> str:
    parts, frames = [], {}

    def near(names: list[str], n: int) -> str:
        for x in names:
            frames[f"{x}_{n}"] = f"max({x}) OVER (PARTITION BY security_id ORDER BY session_index ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = 1"
        return " OR ".join(f"{x}_{n}" for x in names) or "false"

    for f in features.FEATURES:
        base = sql.RANK_SQL.get(f, f)
        n = features.HISTORY[base]
        source = {"market_ret_1": [], "amihud_20": ["no_volume", "no_price"]}.get(base, ["no_volume"] if base in features.USES_VOLUME else ["no_price"])
        index = near(["no_index"], n) if base in features.USES_BENCHMARK else "false"
        parts.append(f"SELECT security_id, prediction_date, '{f}' AS feature, {f} IS NULL AS missing, {base} IS NULL AS none, age < {n - 1} AS warm, ({near(source, n)}) AS src, ({index}) AS idx FROM ranked")
    raw = "SELECT *, CAST(o IS NULL OR h IS NULL OR l IS NULL OR c IS NULL AS INT) AS no_price, CAST(v IS NULL AS INT) AS no_volume, CAST(m IS NULL AS INT) AS no_index FROM base"
    aged = f"aged AS (SELECT *, session_index - min(CASE WHEN present THEN session_index END) OVER (PARTITION BY security_id) AS age, {', '.join(f'{e} AS {x}' for x, e in frames.items())} FROM ({raw}))"
    ranked = f"ranked AS (SELECT *, {', '.join(f'{sql.rank(x)} AS {n}' for n, x in sql.RANK_SQL.items())} FROM aged WHERE present)"
    flags = "flags AS (SELECT security_id, prediction_date, feature, missing, none AND warm AS warm_up, none AND NOT warm AND src AS source_missing, none AND NOT warm AND NOT src AND NOT idx AS invalid_math, none AND NOT warm AND idx AS xu100_missing, missing AND NOT none AS cross_section_insufficient, false AS infinite_replaced FROM (" + " UNION ALL ".join(parts) + "))"
    return f"WITH {sql.PW},\n{sql.BASE_CTES},\n{aged},\n{ranked},\n{flags}\n"


_COUNTS = ", ".join(f"CAST(sum(CAST({x} AS INT)) AS BIGINT) AS {x}" for x in ("missing", *features.REASONS))


@query(f"{_reason_sql()}SELECT feature, {_COUNTS}, count(*) AS n_rows, CAST(sum(CAST(NOT missing AS INT)) AS BIGINT) AS valid FROM flags GROUP BY feature", dates=())
def feat_quality(spark, sf_dir) -> DataFrame:
    return features.quality(observed(bars.supplier_week(spark, sf_dir)))


@query(_reason_sql() + "SELECT * FROM flags")
def feat_reason_masks(spark, sf_dir) -> DataFrame:
    return features.reasons(observed(bars.supplier_week(spark, sf_dir)))


_ALL = " AND ".join(f"{f} IS NOT NULL" for f in features.BASE)
_MISS = " + ".join(f"CAST({f} IS NULL AS INT)" for f in features.BASE)


@query(f"WITH {sql.PN},\n{sql.BASE_CTES},\ndays AS (SELECT prediction_date, count(*) FILTER ({_ALL}) AS valid, sum({_MISS}) AS missing, count(*) AS n FROM features GROUP BY 1)\nSELECT min(valid) AS min_valid, quantile_cont(valid, 0.5) AS median_valid, max(valid) AS max_valid, CAST(sum(missing) AS BIGINT) AS missing_cells, round(sum(missing) / (sum(n) * {len(features.BASE)}), 6) AS missing_share FROM days", dates=())
def feat_daily_quality(spark, sf_dir) -> DataFrame:
    rows = features.base_features(observed(bars.nation_week(spark, sf_dir)))
    return features.daily_quality(rows).withColumn("missing_share", F.round("missing_share", 6))


_GAPS = """SELECT security_id, min(prediction_date) AS first_observed, max(prediction_date) AS last_observed, count(*) AS observed_sessions,
       CAST(sum(gap) AS BIGINT) AS missing_sessions, CAST(max(gap) AS BIGINT) AS longest_gap
FROM (SELECT security_id, prediction_date, coalesce(lead(session_index) OVER (PARTITION BY security_id ORDER BY session_index) - session_index - 1, 0) AS gap FROM grid WHERE present)
GROUP BY 1"""


@query(f"WITH {sql.PW},\n{sql.GRID}\n{_GAPS}", dates=("first_observed", "last_observed"))
def internal_gaps(spark, sf_dir) -> DataFrame:
    panel = bars.supplier_week(spark, sf_dir)
    return grid.internal_gaps(panel, grid.build_calendar(panel))


@query("""WITH o AS (SELECT DISTINCT printf('S%06d', l_suppkey) AS security_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS d, l_linenumber > 4 AS b FROM lineitem WHERE l_suppkey % 10 <> 3 OR l_linenumber <= 4),
cal AS (SELECT d, row_number() OVER (ORDER BY d) AS k FROM (SELECT DISTINCT d FROM o)),
days AS (SELECT security_id, d, k, bool_or(NOT b) AS a, bool_or(b) AS b FROM o JOIN cal USING (d) GROUP BY ALL),
per AS (SELECT security_id, min(d) AS first_observed, max(d) AS last_observed, bool_or(b) AS has_b, bool_or(a <> b) AS mismatch FROM days GROUP BY 1),
g AS (SELECT security_id, coalesce(sum(miss), 0) AS gaps, coalesce(max(miss), 0) AS longest FROM (SELECT security_id, k - lag(k) OVER (PARTITION BY security_id ORDER BY k) - 1 AS miss FROM days JOIN per USING (security_id) WHERE days.b OR NOT has_b) GROUP BY 1),
c AS (SELECT printf('S%06d', s_suppkey) AS security_id, s_suppkey % 9 = 0 AS symbol FROM supplier UNION ALL SELECT printf('X%06d', s_suppkey), false FROM supplier WHERE s_suppkey % 10 = 0),
i AS (
  SELECT security_id, first_observed, last_observed, gaps, longest, unnest(list_filter([CASE WHEN first_observed IS NULL THEN 'NO_HISTORY_BOTH_PROVIDERS' END, CASE WHEN first_observed > lo THEN 'LATE_SERIES_START' END, CASE WHEN last_observed < hi THEN 'EARLY_SERIES_END' END, CASE WHEN gaps > 0 THEN 'INTERNAL_SESSION_GAP' END,
         CASE WHEN mismatch THEN 'PROVIDER_DATE_COVERAGE_MISMATCH' END, CASE WHEN symbol THEN 'PROVIDER_SYMBOL_OR_REDIRECT' END, CASE WHEN first_observed > lo OR last_observed < hi OR gaps > 0 THEN 'POSSIBLE_OLD_OR_NEW_TICKER_SIGNAL' END], lambda x: x IS NOT NULL)) AS issue_type
  FROM c FULL JOIN per USING (security_id) LEFT JOIN g USING (security_id), (SELECT min(d) AS lo, max(d) AS hi FROM cal))
SELECT security_id, issue_type, first_observed, last_observed, CASE WHEN issue_type = 'INTERNAL_SESSION_GAP' THEN gaps ELSE 0 END AS gap_sessions, CASE WHEN issue_type = 'INTERNAL_SESSION_GAP' THEN longest ELSE 0 END AS longest_gap FROM i""", dates=("first_observed", "last_observed"))
def mapping_review(spark, sf_dir) -> DataFrame:
    """Two sources of supplier weeks: the lines 1 to 4 of orders and those from 5 on, of which each tenth supplier has none."""
    items = bars.table(spark, sf_dir, "lineitem").where("l_suppkey % 10 <> 3 or l_linenumber <= 4")
    observed = items.select(F.format_string("S%06d", "l_suppkey").alias("security_id"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("date"), F.when(F.col("l_linenumber") > 4, "B").otherwise("A").alias("source"))
    k = F.col("s_suppkey")
    reason = F.when(k % 9 == 0, "Symbol NOT found").when(k % 9 == 1, "timeout")
    suppliers = bars.table(spark, sf_dir, "supplier")
    collected = suppliers.select(F.format_string("S%06d", k).alias("security_id"), reason.alias("failure_reason")).unionByName(suppliers.where(k % 10 == 0).select(F.format_string("X%06d", k).alias("security_id"), F.lit(None).cast("string").alias("failure_reason")))
    return coverage.review_issues(observed, observed.select(F.col("date").alias("session_date")), collected)


@query(f"WITH {sql.PN},\n{sql.GRID}\nSELECT p.prediction_date, c.session_index, l.prediction_date AS label_available_date FROM calendar p JOIN calendar c USING (prediction_date) LEFT JOIN calendar l ON l.session_index = c.session_index + 3", dates=("prediction_date", "label_available_date"))
def label_available(spark, sf_dir) -> DataFrame:
    calendar = grid.build_calendar(bars.nation_week(spark, sf_dir))
    rows = calendar.withColumnRenamed("session_date", "prediction_date")
    return grid.shift_sessions(rows, calendar, 3, "label_available_date").select("prediction_date", "session_index", "label_available_date")
