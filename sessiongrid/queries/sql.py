"""Pieces of DuckDB SQL that the oracles share."""

from __future__ import annotations


def bars(name: str, entity: str, unit: str, join: str = "") -> str:
    order = "row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)"
    return f"""{name} AS (
  SELECT {entity} AS security_id, CAST(date_trunc('{unit}', l_shipdate) AS DATE) AS prediction_date,
         arg_min(l_extendedprice / l_quantity, {order}) AS open, max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low, arg_max(l_extendedprice / l_quantity, {order}) AS close,
         sum(l_extendedprice) AS tl_volume, sum(l_quantity) AS share_volume
  FROM lineitem {join} GROUP BY 1, 2)"""


PN = bars("panel", "printf('N%03d', s_nationkey)", "week", "JOIN supplier ON s_suppkey = l_suppkey")
PW = bars("panel", "printf('S%06d', l_suppkey)", "week")
PE = """panel AS (
  SELECT printf('U%06d', user_id) AS security_id, CAST(ts AS DATE) AS prediction_date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, sum(value) AS tl_volume, CAST(count(*) AS DOUBLE) AS share_volume
  FROM events WHERE value > 0 GROUP BY 1, 2)"""

GRID = """calendar AS (
  SELECT prediction_date, CAST(row_number() OVER (ORDER BY prediction_date) - 1 AS BIGINT) AS session_index FROM (SELECT DISTINCT prediction_date FROM panel)),
bench AS (SELECT prediction_date, CAST(sum(CAST(close AS DECIMAL(28, 8))) AS DOUBLE) / count(close) AS m FROM panel GROUP BY 1),
grid AS (
  SELECT s.security_id, c.prediction_date, c.session_index, p.open AS o, p.high AS h, p.low AS l, p.close AS c, p.tl_volume AS v, p.share_volume, b.m,
         p.security_id IS NOT NULL AS present
  FROM (SELECT DISTINCT security_id FROM panel) s CROSS JOIN calendar c
  LEFT JOIN panel p USING (security_id, prediction_date) LEFT JOIN bench b USING (prediction_date))"""


def full(x: str, n: int, agg: str) -> str:
    """agg (with {} for x) over n rows, null if one is missing."""
    frame = f"(PARTITION BY security_id ORDER BY session_index ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {frame} = {n} THEN {agg.format(x)} OVER {frame} END"


def prior(x: str, n: int, agg: str) -> str:
    frame = f"(PARTITION BY security_id ORDER BY session_index ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) OVER {frame} = {n} THEN {agg.format(x)} OVER {frame} END"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER (PARTITION BY security_id ORDER BY session_index)"


def sdiv(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) END"


_AVG, _STD, _MED, _MAX = "avg({})", "stddev_samp({})", "quantile_cont({}, 0.5)", "max({})"

STEP = f"""step AS (
  SELECT *, {lag('c')} AS pc, {sdiv('c', lag('c'))} - 1 AS r1, c - {lag('c')} AS chg, ln(1 + v) AS lv,
         {sdiv('m', lag('m'))} - 1 AS m1, {sdiv('m', lag('m', 5))} - 1 AS m5, {sdiv('m', lag('m', 20))} - 1 AS m20
  FROM grid),
step2 AS (
  SELECT *, CASE WHEN h IS NOT NULL AND l IS NOT NULL AND pc IS NOT NULL THEN greatest(h - l, abs(h - pc), abs(l - pc)) / pc END AS tr,
         CASE WHEN r1 IS NOT NULL THEN CAST(r1 > 0 AS INT)::DOUBLE END AS up_day,
         CASE WHEN chg IS NOT NULL THEN greatest(chg, 0.0) END AS gain, CASE WHEN chg IS NOT NULL THEN greatest(-chg, 0.0) END AS loss,
         {sdiv('abs(r1)', 'v')} AS illiq
  FROM step)"""

_UP, _DOWN = full("gain", 14, _AVG), full("loss", 14, _AVG)
FEATURE_SQL = {
    "ret_1": "r1",
    **{f"ret_{n}": f"{sdiv('c', lag('c', n))} - 1" for n in (2, 3, 5, 10, 20)},
    "close_to_sma_5": f"c / {full('c', 5, _AVG)} - 1".replace("c / CASE", "c / (CASE").replace("END - 1", "END) - 1"),
    "close_to_sma_20": f"c / ({full('c', 20, _AVG)}) - 1",
    "distance_from_high_20": f"c / ({full('h', 20, _MAX)}) - 1",
    "positive_day_ratio_5": full("up_day", 5, _AVG),
    "return_volatility_5": full("r1", 5, _STD),
    "return_volatility_20": full("r1", 20, _STD),
    "volatility_ratio_5_20": sdiv(full("r1", 5, _STD), full("r1", 20, _STD)),
    "true_range_pct": "tr",
    "range_expansion_5_20": sdiv(full("tr", 5, _AVG), full("tr", 20, _AVG)),
    "log_median_tl_volume_20": f"ln(1 + ({full('v', 20, _MED)}))",
    "tl_volume_ratio_5_20": sdiv(full("v", 5, _AVG), full("v", 20, _AVG)),
    "tl_volume_zscore_20": sdiv(f"lv - ({prior('lv', 20, _AVG)})", prior("lv", 20, _STD)),
    "tl_volume_cv_20": sdiv(full("v", 20, _STD), full("v", 20, _AVG)),
    "amihud_20": f"ln(1 + 1e9 * ({full('illiq', 20, _AVG)}))",
    "overnight_gap": f"{sdiv('o', 'pc')} - 1",
    "intraday_return": f"{sdiv('c', 'o')} - 1",
    "close_location_value": sdiv("2 * c - h - l", "h - l"),
    "rsi_14_sma": f"CASE WHEN ({_UP}) = 0 AND ({_DOWN}) = 0 THEN 50.0 WHEN ({_DOWN}) = 0 THEN 100.0 WHEN ({_UP}) = 0 THEN 0.0 ELSE 100.0 - 100.0 / (1.0 + ({_UP}) / ({_DOWN})) END",
    "market_ret_1": "m1",
    "relative_ret_1": "r1 - m1",
    "relative_ret_5": f"{sdiv('c', lag('c', 5))} - 1 - m5",
    "relative_ret_20": f"{sdiv('c', lag('c', 20))} - 1 - m20",
}
RANK_SQL = {"cs_ret_1_rank": "ret_1", "cs_ret_5_rank": "ret_5", "cs_relative_ret_5_rank": "relative_ret_5", "cs_volume_anomaly_rank": "tl_volume_zscore_20"}


def rank(x: str) -> str:
    n = f"count({x}) OVER (PARTITION BY prediction_date)"
    avg = f"rank() OVER (PARTITION BY prediction_date, {x} IS NULL ORDER BY {x}) + (count(*) OVER (PARTITION BY prediction_date, {x}) - 1) / 2.0"
    return f"CASE WHEN {x} IS NOT NULL AND {n} >= 20 THEN ({avg} - 1) / ({n} - 1) END"


#: features: every observed row with the 28 base features.
BASE_CTES = f"{GRID},\n{STEP},\nbase AS (SELECT security_id, prediction_date, session_index, present, o, h, l, c, v, m, {', '.join(f'{e} AS {f}' for f, e in FEATURE_SQL.items())} FROM step2),\nfeatures AS (SELECT * FROM base WHERE present)"


def rounded(names: list[str]) -> str:
    return ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)
