"""An equity-like daily frame from the nation-week panel, in DataFrame and in SQL.

Prices move within a few percent of a base that covers several tick bands; missing opens, broken bars, odd volumes,
splits, dividends and factor changes sit on fixed sessions. Dates move by 25 years so that both tick regimes occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import bars, cleaning, nominal, ticks
from ..operators.grid import build_calendar, per_session
from . import sql

DAYS = 9131


def _price(x: Column, base: Column) -> Column:
    return F.floor(base * (1.0 + x / 100000.0) * 10000.0 + 0.5) / 10000.0


def observed(spark, sf_dir) -> DataFrame:
    """Observed rows: keys, nominal prices, volumes, actions and the other source's prices."""
    panel = bars.nation_week(spark, sf_dir)
    calendar = build_calendar(panel).withColumnRenamed("session_date", "prediction_date")
    rows = panel.join(per_session(calendar), "prediction_date")
    s, k = F.substring("security_id", 2, 3).cast("int"), F.col("session_index")
    rows = rows.withColumn("s", s).withColumn("date", F.date_add("prediction_date", DAYS))
    base = F.element_at(F.array(F.lit(9.0), F.lit(60.0), F.lit(300.0), F.lit(1500.0)), F.col("s") % 4 + 1)
    p = {c: _price(F.col(c), base) for c in ("open", "high", "low", "close")}
    rows = rows.withColumns({f"p_{c}": x for c, x in p.items()})
    m = lambda n, r: k % n == r
    return rows.select(
        "security_id", F.col("security_id").alias("ticker"), "session_index", "date", "s",
        F.when(~m(53, 7), F.col("p_open")).alias("yf_nominal_open"),
        F.when(m(61, 5), F.col("p_low") / 2).otherwise(F.col("p_high")).alias("yf_nominal_high"),
        F.col("p_low").alias("yf_nominal_low"), F.col("p_close").alias("yf_nominal_close"),
        F.when(m(41, 3), 0.0).when(~m(37, 4), F.col("tl_volume")).alias("is_tl_volume"),
        F.when(m(41, 3) & (F.col("s") % 2 == 0), 0.0).when(m(43, 9), -1.0).when(~(m(37, 4) & (F.col("s") % 3 == 0)), F.col("share_volume")).alias("yf_share_volume"),
        F.when(m(97, 13), 2.0).otherwise(0.0).alias("yf_stock_splits"), F.when(m(71, 20), 1.5).otherwise(0.0).alias("yf_dividends"),
        F.col("p_high").alias("is_raw_high"), F.when(~m(31, 2), F.col("p_low")).alias("is_raw_low"), (F.col("p_close") + F.when(m(29, 0), 0.5).otherwise(0.0)).alias("is_raw_close"),
        (F.col("p_close") * F.when(k < 150, 0.8).otherwise(1.0)).alias("is_adjusted_close"),
    )


def daily_grid(spark, sf_dir) -> DataFrame:
    """observed on every session of every security."""
    rows = nominal.factor_changes(observed(spark, sf_dir)).drop("ticker")
    calendar = rows.select("session_index", "date").distinct()
    grid = rows.select("security_id").distinct().crossJoin(per_session(calendar))
    return grid.join(rows.withColumn("present", F.lit(True)), ["security_id", "session_index", "date"], "left")


def clean(spark, sf_dir) -> DataFrame:
    return cleaning.clean_eligibility(daily_grid(spark, sf_dir), ticks.tariff(spark))


OBSERVED = f"""{sql.PN},
{sql.GRID},
priced AS (
  SELECT security_id, session_index AS k, prediction_date + {DAYS} AS date, CAST(substr(security_id, 2, 3) AS INT) AS s, tl_v, share_volume,
         floor(base * (1.0 + o / 100000.0) * 10000.0 + 0.5) / 10000.0 AS po, floor(base * (1.0 + h / 100000.0) * 10000.0 + 0.5) / 10000.0 AS ph,
         floor(base * (1.0 + l / 100000.0) * 10000.0 + 0.5) / 10000.0 AS pl, floor(base * (1.0 + c / 100000.0) * 10000.0 + 0.5) / 10000.0 AS pc
  FROM (SELECT *, v AS tl_v, CAST(CASE CAST(substr(security_id, 2, 3) AS INT) % 4 WHEN 0 THEN 9.0 WHEN 1 THEN 60.0 WHEN 2 THEN 300.0 ELSE 1500.0 END AS DOUBLE) AS base FROM grid WHERE present)),
obs0 AS (
  SELECT security_id, k, date, s,
         CASE WHEN k % 53 <> 7 THEN po END AS no, CASE WHEN k % 61 = 5 THEN pl / 2 ELSE ph END AS nh, pl AS nl, pc AS nc,
         CASE WHEN k % 41 = 3 THEN 0.0 WHEN k % 37 <> 4 THEN tl_v END AS tl,
         CASE WHEN k % 41 = 3 AND s % 2 = 0 THEN 0.0 WHEN k % 43 = 9 THEN -1.0 WHEN NOT (k % 37 = 4 AND s % 3 = 0) THEN share_volume END AS sh,
         CASE WHEN k % 97 = 13 THEN 2.0 ELSE 0.0 END AS split, CASE WHEN k % 71 = 20 THEN 1.5 ELSE 0.0 END AS dividend,
         ph AS rh, CASE WHEN k % 31 <> 2 THEN pl END AS rl, pc + CASE WHEN k % 29 = 0 THEN 0.5 ELSE 0.0 END AS rc, pc * CASE WHEN k < 150 THEN CAST(0.8 AS DOUBLE) ELSE 1.0 END AS adj
  FROM priced),
obs1 AS (SELECT *, CASE WHEN rc > 0 THEN adj / rc END AS fac FROM obs0),
obs AS (SELECT *, coalesce(abs(fac - pfac) > 5e-5 + 1e-4 * abs(pfac), false) AS changed FROM (SELECT *, lag(fac) OVER (PARTITION BY security_id ORDER BY date) AS pfac FROM obs1))"""

#: By session: classification, signals and windows, previous valid close and upper limit (prices as integers of 1e-4).
FRAME = f"""{OBSERVED},
dg AS (SELECT g.security_id, g.k, g.date, obs.* EXCLUDE (security_id, k, date) FROM (SELECT security_id, k, date FROM (SELECT DISTINCT security_id FROM obs) CROSS JOIN (SELECT DISTINCT k, date FROM obs)) g LEFT JOIN obs USING (security_id, k)),
q AS (
  SELECT *, coalesce(no > 0, false) AS has_open,
         CASE WHEN coalesce(no > 0, false) THEN coalesce(no > 0 AND nh > 0 AND nl > 0 AND nc > 0 AND nl <= no AND no <= nh AND nl <= nc AND nc <= nh, false) END AS ok,
         coalesce(tl = 0 AND sh = 0, false) AS vzero, tl IS NULL AND sh IS NULL AS vgone, coalesce(tl > 0, false) OR coalesce(sh > 0, false) AS vup,
         (tl IS NULL) <> (sh IS NULL) OR coalesce(tl = 0 AND sh > 0, false) OR coalesce(sh = 0 AND tl > 0, false) AS vodd, coalesce(tl < 0, false) OR coalesce(sh < 0, false) AS vneg,
         coalesce(split, 0) <> 0 OR coalesce(dividend, 0) <> 0 AS yfa, coalesce(changed, false) AS isa
  FROM dg),
q2 AS (
  SELECT *, CASE WHEN NOT has_open THEN 'NO_OPEN' WHEN NOT ok THEN 'INVALID_OHLC' ELSE 'VALID' END AS oflag,
         CASE WHEN vzero THEN 'BOTH_VOLUMES_ZERO' WHEN vgone THEN 'BOTH_VOLUMES_MISSING_UNRESOLVED' WHEN vup AND vodd THEN 'SOURCE_VOLUME_CONFLICT' WHEN vneg THEN 'INVALID_VOLUME_REQUIRES_REVIEW'
              WHEN NOT vup THEN 'VOLUME_EVIDENCE_INSUFFICIENT' ELSE 'POSITIVE_VOLUME_CONFIRMED' END AS vflag,
         vgone OR vneg OR (NOT vzero AND NOT vgone AND NOT vup) AS review, yfa OR isa AS action,
         coalesce(abs(rh - nh) > 1e-8, false) OR coalesce(abs(rl - nl) > 1e-8, false) OR coalesce(abs(rc - nc) > 1e-8, false) AS pw,
         abs(rh - nh) IS NOT NULL OR abs(rl - nl) IS NOT NULL OR abs(rc - nc) IS NOT NULL AS pk
  FROM q),
q3 AS (
  SELECT *, coalesce(max(CAST(action AS INT)) OVER w = 1, false) AS awin, count(*) OVER w = 3 AS acomplete,
         last_value(CASE WHEN oflag = 'VALID' THEN nc END IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM q2 WINDOW w AS (PARTITION BY security_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)),
q4 AS (SELECT *, CAST(round(prev * 10000) AS BIGINT) * 11 AS raw5 FROM q3),
q5 AS (
  SELECT *, CASE WHEN raw5 < 1000 THEN NULL WHEN raw5 < 2000000 THEN 1000 WHEN raw5 < 5000000 THEN 2000 WHEN raw5 < 10000000 THEN 5000
                 WHEN date <= DATE '2023-11-05' THEN 10000
                 WHEN raw5 < 25000000 THEN 10000 WHEN raw5 < 50000000 THEN 25000 WHEN raw5 < 100000000 THEN 50000 WHEN raw5 < 250000000 THEN 100000 ELSE 250000 END AS tick5
  FROM q4 WHERE true),
q6 AS (SELECT * REPLACE (CASE WHEN date >= DATE '2020-03-13' THEN tick5 END AS tick5) FROM q5),
daily AS (SELECT *, raw5 / 100000.0 AS raw_limit, tick5 / 100000.0 AS tick, raw5 // tick5 * tick5 / 100000.0 AS lim FROM q6)"""

_CLOSE = "abs({0} - e.lim) <= greatest(1e-12 * greatest(abs({0}), abs(e.lim)), 1e-8)"
CLEAN = f"""{FRAME},
pair AS (
  SELECT d.security_id, d.date AS prediction_date, e.date AS entry_date, d.awin, e.* EXCLUDE (security_id, date, k, awin, acomplete),
         e.prev IS NULL AS noprev, e.prev IS NOT NULL AND e.lim IS NULL AS nolim,
         coalesce(e.prev IS NOT NULL AND e.lim IS NOT NULL AND e.no IS NOT NULL AND e.nh IS NOT NULL AND ((e.no > e.lim AND NOT {_CLOSE.format('e.no')}) OR (e.nh > e.lim AND NOT {_CLOSE.format('e.nh')})), false) AS special,
         coalesce({_CLOSE.format('e.no')}, false) AS atlim
  FROM daily d JOIN daily e ON e.security_id = d.security_id AND e.k = d.k + 1 WHERE d.acomplete),
reasoned AS (
  SELECT *, list_filter([CASE WHEN NOT has_open THEN 'NO_OPEN' END, CASE WHEN vzero THEN 'NO_TRADE' END, CASE WHEN oflag = 'INVALID_OHLC' THEN 'INVALID_OHLC' END,
                         CASE WHEN noprev THEN 'NO_PREVIOUS_CLOSE' END, CASE WHEN special THEN 'SPECIAL_MARGIN_OR_CORPORATE_ACTION' END,
                         CASE WHEN NOT noprev AND NOT nolim AND NOT special AND atlim THEN 'LIMIT_OPEN' END, CASE WHEN awin THEN 'CORPORATE_ACTION_WINDOW' END,
                         CASE WHEN nolim THEN 'PRICE_STEP_UNAVAILABLE' END], lambda x: x IS NOT NULL) AS reasons
  FROM pair),
clean AS (
  SELECT *, review OR noprev OR nolim OR special AS rev,
         CASE WHEN len(list_filter(reasons, lambda x: x <> 'PRICE_STEP_UNAVAILABLE')) > 0 THEN false WHEN NOT (review OR noprev OR nolim OR special) THEN true END AS eligible
  FROM reasoned)"""

LABELS = f"""{CLEAN},
succ AS (SELECT DISTINCT prediction_date AS a, entry_date AS b FROM clean),
hor AS (
  SELECT c.*, s2.b AS d2, s3.b AS d3, b2.security_id AS has2, b3.security_id AS has3, b2.nh AS h2, b3.nh AS h3, b2.oflag AS f2, b3.oflag AS f3, b2.vflag AS v2, b3.vflag AS v3, b3.nc AS c3
  FROM clean c LEFT JOIN succ s2 ON s2.a = c.entry_date LEFT JOIN succ s3 ON s3.a = s2.b
  LEFT JOIN clean b2 ON b2.security_id = c.security_id AND b2.entry_date = s2.b LEFT JOIN clean b3 ON b3.security_id = c.security_id AND b3.entry_date = s3.b),
tgt0 AS (SELECT *, CASE WHEN no > 0 THEN CAST(round(no * 10000) AS BIGINT) * 105 END AS raw6 FROM hor),
tgt1 AS (
  SELECT *, CASE WHEN entry_date < DATE '2020-03-13' OR raw6 < 10000 THEN NULL WHEN raw6 < 20000000 THEN 10000 WHEN raw6 < 50000000 THEN 20000 WHEN raw6 < 100000000 THEN 50000
                 WHEN entry_date <= DATE '2023-11-05' THEN 100000 WHEN raw6 < 250000000 THEN 100000 WHEN raw6 < 500000000 THEN 250000 WHEN raw6 < 1000000000 THEN 500000 WHEN raw6 < 2500000000 THEN 1000000 ELSE 2500000 END AS tick6
  FROM tgt0),
tgt AS (SELECT *, (raw6 + tick6 - 1) // tick6 * tick6 AS t6 FROM tgt1),
lab0 AS (
  SELECT *, CASE WHEN len(reasons) > 0 THEN reasons[1] WHEN rev THEN 'REQUIRES_REVIEW' WHEN eligible IS NOT TRUE THEN 'ENTRY_NOT_ELIGIBLE' WHEN raw6 IS NULL THEN 'NO_OPEN' END AS early,
         CASE WHEN tick6 IS NULL THEN 'TARGET_TICK_SIZE_UNAVAILABLE' END AS notick,
         CASE WHEN d2 IS NULL OR d3 IS NULL THEN 'INCOMPLETE_HORIZON' WHEN has2 IS NULL OR has3 IS NULL THEN 'MISSING_HORIZON_ROW'
              WHEN oflag <> 'VALID' OR nh IS NULL OR f2 <> 'VALID' OR h2 IS NULL OR f3 <> 'VALID' OR h3 IS NULL THEN 'INVALID_HORIZON_PRICE' END AS late,
         CASE WHEN CAST(round(nh * 10000) AS BIGINT) * 100 >= t6 THEN 1 WHEN CAST(round(h2 * 10000) AS BIGINT) * 100 >= t6 THEN 2 WHEN CAST(round(h3 * 10000) AS BIGINT) * 100 >= t6 THEN 3 END AS hit0
  FROM tgt),
lab1 AS (SELECT *, coalesce(early, notick, late) AS why0 FROM lab0),
lab2 AS (SELECT *, CASE WHEN why0 IS NULL THEN hit0 END AS hit, CASE WHEN why0 IS NULL AND hit0 IS NULL AND c3 IS NULL THEN 'MISSING_T3_CLOSE' ELSE why0 END AS why FROM lab1),
labels3 AS (
  SELECT security_id, prediction_date, entry_date, CASE WHEN why IS NULL THEN CAST(hit IS NOT NULL AS INT) END AS label, CASE WHEN why IS NULL THEN 'LABELED' ELSE 'NA' END AS label_status, why AS label_na_reason,
         hit AS target_hit_horizon, CASE WHEN early IS NULL THEN no END AS entry_price, CASE WHEN early IS NULL AND notick IS NULL THEN t6 / 1000000.0 END AS target_price,
         CASE WHEN why IS NULL THEN CASE WHEN hit IS NOT NULL THEN t6 / 1000000.0 ELSE c3 END END AS exit_price
  FROM lab2)"""
