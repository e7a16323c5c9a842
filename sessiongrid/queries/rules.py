"""Queries of identity, ticks, cleaning and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bars, cleaning, identity, labels, nominal, providers, ticks
from ..operators.bars import table
from . import daily
from .registry import Registry

registry = Registry()
query, QUERIES, SQL = registry.query, registry.queries, registry.sql


# Splits and identity ------------------------------------------------------------------------------------------------

_PM = "SELECT printf('S%06d', l_suppkey) AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low FROM lineitem GROUP BY 1, 2"


@query(f"""WITH p AS ({_PM}), s AS (
  SELECT *, CASE WHEN CAST(substr(ticker, 2) AS INT) % 7 = month(date) % 7 AND year(date) % 2 = 0 THEN 2.0 WHEN month(date) = 5 THEN 0.0 WHEN month(date) = 6 THEN -1.0 ELSE 1.0 END AS split FROM p)
SELECT ticker, date, split > 0 AS split_valid, NOT split > 0 AND split <> 0 AS split_ignored,
       coalesce(product(CASE WHEN split > 0 THEN split ELSE 1.0 END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1.0) AS split_factor,
       high * coalesce(product(CASE WHEN split > 0 THEN split ELSE 1.0 END) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1.0) AS yf_nominal_high
FROM s""", dates=("date",))
def nominal_split_factor(spark, sf_dir) -> DataFrame:
    rows = bars.supplier_month(spark, sf_dir).select(F.col("security_id").alias("ticker"), F.col("prediction_date").alias("date"), "open", "high", "low", "close")
    s = F.substring("ticker", 2, 6).cast("int")
    split = F.when((s % 7 == F.month("date") % 7) & (F.year("date") % 2 == 0), 2.0).when(F.month("date") == 5, 0.0).when(F.month("date") == 6, -1.0).otherwise(1.0)
    return nominal.restore_nominal(rows.withColumn("stock_splits", split)).select("ticker", "date", "split_valid", "split_ignored", "split_factor", "yf_nominal_high")


_MAP = """mapping AS (
  SELECT printf('SEC%04d', s_suppkey) AS security_id, printf('S%06d', s_suppkey) AS ticker, DATE '1996-01-01' + CAST(s_suppkey % 50 AS INT) AS valid_from, CASE WHEN s_suppkey % 3 = 0 THEN DATE '1999-06-30' END AS valid_to, s_suppkey % 3 <> 0 AS is_current
  FROM supplier WHERE s_suppkey % 4 <> 0
  UNION ALL SELECT printf('SEC%04d', s_suppkey), printf('S%06d', s_suppkey + 1), DATE '1999-06-30' + 1, NULL, true FROM supplier WHERE s_suppkey % 12 = 3)"""


def mapping(spark, sf_dir) -> DataFrame:
    """A mapping with open, closed and renamed tickers, from the supplier keys."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    ident = F.format_string("SEC%04d", "k")
    first = s.where("k % 4 <> 0").select(ident.alias("security_id"), F.format_string("S%06d", "k").alias("ticker"), F.date_add(F.lit("1996-01-01").cast("date"), (F.col("k") % 50).cast("int")).alias("valid_from"), F.when(F.col("k") % 3 == 0, F.lit("1999-06-30").cast("date")).alias("valid_to"), (F.col("k") % 3 != 0).alias("is_current_ticker"))
    second = s.where("k % 12 = 3").select(ident, F.format_string("S%06d", F.col("k") + 1), F.lit("1999-07-01").cast("date"), F.lit(None).cast("date"), F.lit(True))
    return first.union(second)


_RESOLVED = f"""rows AS (SELECT DISTINCT printf('S%06d', l_suppkey) AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem), {_MAP},
now AS (SELECT security_id, arg_max(ticker, row(is_current, valid_from, ticker)) AS current FROM mapping GROUP BY 1),
resolved AS (
  SELECT r.ticker, r.date, CASE WHEN count(m.ticker) = 0 THEN 'AUTO_NEW_TICKER' WHEN count(m.ticker) FILTER (live) = 0 THEN 'OUTSIDE_VALIDITY' WHEN bool_or(is_current) FILTER (live) THEN 'MAPPED_CURRENT_TICKER' ELSE 'MAPPED_HISTORICAL_TICKER' END AS mapping_status,
         CASE WHEN count(m.ticker) = 0 THEN 'SEC_' || substr(sha256('BIST:EQUITY:' || r.ticker), 1, 12) ELSE min(m.security_id) END AS security_id, coalesce(min(current), r.ticker) AS current_ticker, CAST(count(m.ticker) FILTER (live) AS INT) AS effective_rules
  FROM rows r LEFT JOIN (SELECT * FROM mapping JOIN now USING (security_id)) m ON m.ticker = r.ticker, LATERAL (SELECT coalesce(m.valid_from <= r.date AND r.date <= coalesce(m.valid_to, DATE '9999-12-31'), false) AS live)
  GROUP BY 1, 2)"""


def _resolved(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.format_string("S%06d", "l_suppkey").alias("ticker"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("date")).distinct()
    return identity.resolve(rows, mapping(spark, sf_dir))


@query(f"WITH {_RESOLVED}\nSELECT * FROM resolved", dates=("date",))
def identity_resolve(spark, sf_dir) -> DataFrame:
    return _resolved(spark, sf_dir).select("ticker", "date", "mapping_status", "security_id", "current_ticker", "effective_rules")


@query(f"""WITH {_RESOLVED}, twice AS (
  SELECT *, sha256('{{"date":"' || date || '","mapping_status":"' || mapping_status || '","note":"' || note || '","security_id":"' || security_id || '","ticker":"' || ticker || '"}}') AS h
  FROM (SELECT date, mapping_status, unnest(CASE WHEN CAST(substr(ticker, 2) AS INT) % 2 = 0 THEN ['a', 'b', 'c'] ELSE ['a'] END) AS note, security_id, ticker FROM resolved) WHERE mapping_status <> 'OUTSIDE_VALIDITY')
SELECT security_id, date, arg_min(ticker, row(mapping_status = 'AUTO_NEW_TICKER', h)) AS ticker, arg_min(note, row(mapping_status = 'AUTO_NEW_TICKER', h)) AS note, count(*) - 1 AS dropped FROM twice GROUP BY 1, 2""", dates=("date",))
def identity_dedup(spark, sf_dir) -> DataFrame:
    notes = F.when(F.substring("ticker", 2, 6).cast("int") % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a")))
    rows = _resolved(spark, sf_dir).select("ticker", "date", "mapping_status", "security_id", F.explode(notes).alias("note"))
    n = rows.where("mapping_status <> 'OUTSIDE_VALIDITY'").groupBy("security_id", "date").agg((F.count("*") - 1).alias("dropped"))
    return identity.dedup_identity(rows).join(n, ["security_id", "date"]).select("security_id", "date", "ticker", "note", "dropped")


@query(f"""WITH {_MAP}, sec AS (SELECT printf('SEC%04d', s_suppkey) AS security_id, printf('S%06d', s_suppkey) AS ticker FROM supplier)
SELECT DISTINCT security_id, coalesce(m.ticker, sec.ticker) AS ticker, CASE WHEN m.ticker IS NULL THEN DATE '1996-01-20' ELSE greatest(DATE '1996-01-20', valid_from) END AS start, CASE WHEN m.ticker IS NULL THEN DATE '2001-01-31' ELSE least(DATE '2001-01-31', coalesce(valid_to, DATE '2001-01-31')) END AS "end"
FROM sec LEFT JOIN mapping m USING (security_id)
WHERE m.ticker IS NULL OR greatest(DATE '1996-01-20', valid_from) <= least(DATE '2001-01-31', coalesce(valid_to, DATE '2001-01-31'))""", dates=("start", '"end"'))
def mapping_plan(spark, sf_dir) -> DataFrame:
    securities = table(spark, sf_dir, "supplier").select(F.format_string("SEC%04d", "s_suppkey").alias("security_id"), F.format_string("S%06d", "s_suppkey").alias("ticker"))
    return identity.collection_plan(securities, mapping(spark, sf_dir), "1996-01-20", "2001-01-31")


#: The mapping, and for some securities a second rule that begins a month before the first ends, or on the same day.
_OVER = f"""{_MAP},
over_map AS (SELECT * FROM mapping UNION ALL SELECT 'SEC9' || substr(security_id, 5), ticker, CASE WHEN valid_to IS NULL THEN valid_from ELSE valid_to - 30 END, DATE '2001-12-31', false FROM mapping WHERE CAST(substr(security_id, 4) AS INT) % 5 = 1)"""


@query(f"""WITH {_OVER}, o AS (SELECT *, max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY ticker ORDER BY valid_from, valid_to NULLS FIRST, security_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier_end FROM over_map)
SELECT security_id, ticker, valid_from, earlier_end FROM o WHERE valid_from <= earlier_end""", dates=("valid_from", "earlier_end"))
def mapping_overlaps(spark, sf_dir) -> DataFrame:
    rules = mapping(spark, sf_dir)
    second = rules.where(F.substring("security_id", 4, 9).cast("int") % 5 == 1)
    begin = F.when(F.col("valid_to").isNull(), F.col("valid_from")).otherwise(F.date_sub("valid_to", 30))
    second = second.select(F.concat(F.lit("SEC9"), F.substring("security_id", 5, 20)).alias("security_id"), "ticker", begin.alias("valid_from"), F.lit("2001-12-31").cast("date").alias("valid_to"), F.lit(False).alias("is_current_ticker"))
    return identity.overlaps(rules.union(second), "ticker").select("security_id", "ticker", "valid_from", "earlier_end")


@query("""WITH m AS (SELECT printf('C%06d', o_custkey) AS security_id, 'T' || o_orderkey AS provider_ticker, CAST(o_orderdate AS DATE) AS period_start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 2 AS INT) AS period_end FROM orders),
b AS (SELECT *, lag(period_end) OVER (PARTITION BY security_id ORDER BY period_start, period_end, provider_ticker) AS before FROM m)
SELECT security_id, provider_ticker, period_start, period_end, unnest(list_filter([CASE WHEN period_start < DATE '1995-03-01' OR period_end > DATE '2001-06-30' THEN 'OUTSIDE_RANGE' END, CASE WHEN period_start > period_end THEN 'START_AFTER_END' END, CASE WHEN period_start <= before THEN 'OVERLAP' END], lambda x: x IS NOT NULL)) AS issue FROM b""", dates=("period_start", "period_end"))
def manifest_periods(spark, sf_dir) -> DataFrame:
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    manifest = table(spark, sf_dir, "orders").select(F.format_string("C%06d", "o_custkey").alias("security_id"), F.concat(F.lit("T"), k).alias("provider_ticker"), day.alias("period_start"), F.date_add(day, (k % 40 - 2).cast("int")).alias("period_end"))
    return identity.period_violations(manifest, "1995-03-01", "2001-06-30")


# Providers ----------------------------------------------------------------------------------------------------------

_RAW_ROW = "row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)"
_LAST_ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def _raw_lines(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.withColumns({"ticker": F.format_string(" s%06d.is ", "l_suppkey"), "price": F.col("l_extendedprice") / F.col("l_quantity")})


@query(f"""WITH r AS (SELECT printf('S%06d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS p, *, {_RAW_ROW} AS o FROM lineitem),
k AS (SELECT ticker, date, arg_max(p, o) AS p, arg_max(l_extendedprice, o) AS v, arg_max(l_linenumber, o) AS n, arg_max(l_quantity, o) AS q FROM r GROUP BY 1, 2)
SELECT ticker, date, p * 1.5 AS is_raw_high, CASE WHEN n <> 3 THEN p / 2 END AS is_raw_low, p AS is_raw_close, p AS is_raw_weighted_average, p AS is_adjusted_high, p AS is_adjusted_low, p * 0.5 AS is_adjusted_close, p AS is_adjusted_weighted_average, v AS is_tl_volume, v + 1 AS is_raw_tl_volume,
       q AS is_market_cap_try, CAST(NULL AS DOUBLE) AS is_market_cap_usd, CAST(NULL AS DOUBLE) AS is_free_float_market_cap_try, CAST(NULL AS DOUBLE) AS is_free_float_market_cap_usd FROM k""", dates=("date",))
def provider_equity_history(spark, sf_dir) -> DataFrame:
    p, v = F.col("price"), F.col("l_extendedprice")
    names = {"HGDG_TARIH": F.col("l_shipdate"), "HGDG_KAPANIS": p * 0.5, "HGDG_AOF": p, "HGDG_MIN": p, "HGDG_MAX": p, "HGDG_HACIM": v, "HG_KAPANIS": p, "HG_AOF": p, "HG_MIN": F.when(F.col("l_linenumber") != 3, p / 2), "HG_MAX": p * 1.5, "HG_HACIM": v + 1, "PD": F.col("l_quantity")}
    return providers.equity_history(_raw_lines(spark, sf_dir).withColumns(names), _LAST_ROW)


@query(f"""WITH r AS (SELECT printf('S%06d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS date, *, {_RAW_ROW} AS o FROM lineitem),
k AS (SELECT ticker, date, arg_max(row(l_quantity, l_tax, l_discount, l_linenumber, l_returnflag), o) AS x FROM r GROUP BY 1, 2)
SELECT ticker, date, x[1] AS yf_share_volume, x[2] AS yf_dividends, 0.0::DOUBLE AS yf_stock_splits, 0.0::DOUBLE AS yf_capital_gains, abs(0 - x[3]) + CAST(x[4] AS DOUBLE) AS yf_other_action_value FROM k""", dates=("date",))
def provider_auxiliary(spark, sf_dir) -> DataFrame:
    """Prices are there and left out; a negative discount and a line number in text are columns that nobody knows."""
    raw = _raw_lines(spark, sf_dir).select("ticker", F.col("l_shipdate").alias("date"), *_LAST_ROW, F.col("price").alias("Close"), F.col("l_quantity").alias("Volume"), F.col("l_tax").alias("Dividends"), (-F.col("l_discount")).alias("Fee"), F.col("l_linenumber").cast("string").alias("Note"), F.col("l_returnflag").alias("Mark"))
    return providers.auxiliary(raw, _LAST_ROW)


@query(f"""WITH p AS ({_PM}), c AS (SELECT *, CASE WHEN month(date) = 6 THEN 2.0 WHEN month(date) = 9 THEN -1.0 ELSE 0.0 END AS split, CASE WHEN year(date) % 2 = 0 THEN high END AS close FROM p)
SELECT ticker, date, low AS yf_provider_open, high AS yf_provider_high, low AS yf_provider_low, close AS yf_provider_close, CAST(NULL AS DOUBLE) AS yf_provider_adjusted_close, month(date) * 10.0::DOUBLE AS yf_share_volume, 0.0::DOUBLE AS yf_dividends, split AS yf_stock_splits, 0.0::DOUBLE AS yf_capital_gains, abs(low - high) AS yf_other_action_value,
       coalesce(product(CASE WHEN split > 0 THEN split ELSE 1.0 END) OVER w, 1.0) AS split_factor, close * coalesce(product(CASE WHEN split > 0 THEN split ELSE 1.0 END) OVER w, 1.0) AS yf_nominal_close
FROM c WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""", dates=("date",))
def provider_quotes(spark, sf_dir) -> DataFrame:
    months = bars.supplier_month(spark, sf_dir)
    month = F.month("prediction_date")
    raw = months.select(
        F.lower("security_id").alias("ticker"), F.col("prediction_date").cast("timestamp").alias("date"), F.col("low").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"), F.when(F.year("prediction_date") % 2 == 0, F.col("high")).alias("Close"),
        (month * 10).alias("Volume"), F.when(month == 6, 2.0).when(month == 9, -1.0).otherwise(0.0).alias("Stock Splits"), (F.col("low") - F.col("high")).alias("Range"), F.lit("text").alias("Note"),
    )
    return providers.quotes(raw).drop("split_valid", "split_ignored", "yf_nominal_open", "yf_nominal_high", "yf_nominal_low")


# Ticks --------------------------------------------------------------------------------------------------------------

_TICK5 = "CASE WHEN d < DATE '2020-03-13' OR p < 0.01 THEN NULL WHEN p < 20 THEN 0.01 WHEN p < 50 THEN 0.02 WHEN p < 100 THEN 0.05 WHEN d <= DATE '2023-11-05' OR p < 250 THEN 0.1 WHEN p < 500 THEN 0.25 WHEN p < 1000 THEN 0.5 WHEN p < 2500 THEN 1.0 ELSE 2.5 END"


@query(f"""WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 9131 AS d, floor(o_totalprice) / 100.0 AS p FROM orders)
SELECT o_orderkey, d AS trade_date, p AS price, CAST({_TICK5} AS DOUBLE) AS tick FROM t""", dates=("trade_date",))
def tick_resolve(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 9131).alias("trade_date"), (F.floor("o_totalprice") / 100.0).alias("price"))
    rows = rows.withColumn("exact", F.col("price").cast(ticks.PRICE))
    return ticks.with_tick(rows, ticks.tariff(spark), "exact", "trade_date").select("o_orderkey", "trade_date", "price", F.col("tick_size").cast("double").alias("tick"))


@query("""WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) + 9131 AS d, CAST(floor(o_totalprice) AS BIGINT) AS c FROM orders),
r AS (SELECT *, c * 110 AS raw4 FROM t),
k AS (SELECT *, CASE WHEN d < DATE '2020-03-13' OR raw4 < 100 THEN NULL WHEN raw4 < 200000 THEN 100 WHEN raw4 < 500000 THEN 200 WHEN raw4 < 1000000 THEN 500 WHEN d <= DATE '2023-11-05' OR raw4 < 2500000 THEN 1000 WHEN raw4 < 5000000 THEN 2500 WHEN raw4 < 10000000 THEN 5000 WHEN raw4 < 25000000 THEN 10000 ELSE 25000 END AS t4 FROM r)
SELECT o_orderkey, raw4 / 10000.0 AS raw_upper_limit, t4 / 10000.0 AS tick_size, raw4 // t4 * t4 / 10000.0 AS estimated_upper_limit, CASE WHEN t4 IS NULL THEN 'UNAVAILABLE' ELSE 'RESOLVED' END AS status FROM k""", dates=())
def upper_limit(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 9131).alias("date"), (F.floor("o_totalprice") / 100.0).alias("previous_nominal_close"))
    return ticks.upper_limits(rows, ticks.tariff(spark)).select("o_orderkey", "raw_upper_limit", "tick_size", "estimated_upper_limit", F.col("price_step_resolution_status").alias("status"))


_RULES = """rules AS (
  SELECT 'R' || n_nationkey AS rule_set_id, 'I' || n_regionkey AS instrument_type, DATE '2020-01-01' + 100 * (n_nationkey % 5) AS a, CASE WHEN n_nationkey % 5 < 4 OR n_nationkey % 3 = 0 THEN DATE '2020-01-01' + 100 * (n_nationkey % 5) + CASE WHEN n_nationkey % 7 = 3 THEN 90 ELSE 99 END END AS b,
         CAST(CASE WHEN band = 0 AND n_nationkey % 6 = 1 THEN 0.05 ELSE [0.01, 20, 50][band + 1] END AS DOUBLE) AS lo, CASE WHEN band = 2 AND n_nationkey % 8 <> 5 THEN NULL WHEN band = 0 AND n_nationkey % 4 = 2 THEN 19.5 ELSE [20.0, 50.0, 100.0][band + 1] END AS hi,
         CASE WHEN n_nationkey % 9 = 4 AND band = 1 THEN 'other' WHEN n_nationkey % 10 = 7 THEN '' ELSE 'office' END AS name, CASE WHEN n_nationkey % 11 = 2 THEN 'abc' WHEN band = 1 THEN upper(sha256(n_name)) ELSE sha256(n_name) END AS checksum
  FROM nation, (SELECT unnest([0, 1, 2]) AS band))"""


@query(f"""WITH {_RULES},
bands AS (SELECT *, lag(hi) OVER w AS before, row_number() OVER w AS rn, lead(lo) OVER w AS nxt FROM rules WINDOW w AS (PARTITION BY rule_set_id, instrument_type ORDER BY lo)),
sets AS (SELECT instrument_type, rule_set_id, min(a) AS a, max(b) AS b, count(*) FILTER (b IS NULL) AS open, count(DISTINCT name || lower(checksum)) AS sources, bool_or(name = '') AS lacking, bool_or(name <> '' AND NOT regexp_matches(lower(checksum), '^[0-9a-f]{{64}}$')) AS odd FROM rules GROUP BY 1, 2),
sets2 AS (SELECT *, lead(a) OVER (PARTITION BY instrument_type ORDER BY a, rule_set_id) AS nxt FROM sets)
SELECT rule_set_id, lo AS price_min, CASE WHEN rn = 1 AND lo <> 0.01 THEN 'FIRST_BAND_NOT_0.01' WHEN rn > 1 AND before IS DISTINCT FROM lo THEN 'BAND_GAP' ELSE 'LAST_BAND_CLOSED' END AS issue FROM bands WHERE (rn = 1 AND lo <> 0.01) OR (rn > 1 AND before IS DISTINCT FROM lo) OR (nxt IS NULL AND hi IS NOT NULL)
UNION ALL SELECT rule_set_id, NULL, unnest(list_filter([CASE WHEN lacking THEN 'METADATA_MISSING' END, CASE WHEN sources > 1 THEN 'INCONSISTENT_METADATA' END, CASE WHEN odd THEN 'CHECKSUM_NOT_SHA256' END,
  CASE WHEN nxt IS NOT NULL AND (open > 0 OR b + 1 <> nxt) THEN 'REGIME_GAP' WHEN nxt IS NULL AND open = 0 THEN 'LAST_REGIME_CLOSED' END], lambda x: x IS NOT NULL)) FROM sets2""", dates=())
def tariff_validate(spark, sf_dir) -> DataFrame:
    """A rule set for each nation, three bands each, with faults of every kind; nations of a region follow each other."""
    n, band = F.col("n_nationkey"), F.col("band")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("band"))
    start = F.date_add(F.lit("2020-01-01").cast("date"), (100 * (n % 5)).cast("int"))
    end = F.when((n % 5 < 4) | (n % 3 == 0), F.date_add(start, F.when(n % 7 == 3, 90).otherwise(99)))
    low = F.when((band == 0) & (n % 6 == 1), F.lit("0.05")).otherwise(F.element_at(F.array(F.lit("0.01"), F.lit("20"), F.lit("50")), band + 1))
    high = F.when((band == 2) & (n % 8 != 5), F.lit(None)).when((band == 0) & (n % 4 == 2), F.lit("19.5")).otherwise(F.element_at(F.array(F.lit("20"), F.lit("50"), F.lit("100")), band + 1))
    digest = F.sha2("n_name", 256)
    rules = nations.select(
        F.concat(F.lit("R"), n).alias("rule_set_id"), F.concat(F.lit("I"), F.col("n_regionkey")).alias("instrument_type"), start.alias("effective_from"), end.alias("effective_to"), low.cast(ticks.PRICE).alias("price_min"), high.cast(ticks.PRICE).alias("price_max"),
        F.when((n % 9 == 4) & (band == 1), "other").when(n % 10 == 7, "").otherwise("office").alias("official_source_name"), F.when(n % 11 == 2, "abc").when(band == 1, F.upper(digest)).otherwise(digest).alias("source_checksum"),
    )
    return ticks.tariff_violations(rules)


# Cleaning and labels ------------------------------------------------------------------------------------------------

_KEY = "security_id, date"


@query(f"WITH {daily.FRAME}\nSELECT {_KEY}, has_open, ok AS valid_nominal_ohlc, oflag AS ohlc_quality_flag FROM daily", dates=("date", "valid_nominal_ohlc"))
def ohlc_quality(spark, sf_dir) -> DataFrame:
    return cleaning.ohlc_quality(daily.daily_grid(spark, sf_dir)).select("security_id", "date", "has_open", "valid_nominal_ohlc", "ohlc_quality_flag")


@query(f"WITH {daily.FRAME}\nSELECT {_KEY}, vflag AS volume_quality_flag, review AS volume_requires_review, vup AND vodd AS volume_source_conflict FROM daily", dates=("date",))
def volume_quality(spark, sf_dir) -> DataFrame:
    return cleaning.volume_quality(daily.daily_grid(spark, sf_dir)).select("security_id", "date", "volume_quality_flag", "volume_requires_review", "volume_source_conflict")


@query(f"""WITH {daily.FRAME}
SELECT {_KEY}, action AS corporate_action_flag, CASE WHEN isa AND yfa THEN 'both' WHEN isa THEN 'isyatirim_only' WHEN yfa THEN 'yfinance_only' ELSE 'none' END AS corporate_action_source,
       CAST(isa AS INT) + CAST(yfa AS INT) AS corporate_action_source_count, CASE WHEN isa AND yfa THEN 'BOTH_SOURCES' WHEN isa OR yfa THEN 'SINGLE_SOURCE' ELSE 'NO_SIGNAL' END AS agreement,
       concat_ws('|', CASE WHEN isa THEN 'isyatirim_adjustment_factor' END, CASE WHEN yfa THEN 'yfinance_actions' END) AS sources FROM daily""", dates=("date",))
def action_signals(spark, sf_dir) -> DataFrame:
    rows = cleaning.action_signals(daily.daily_grid(spark, sf_dir))
    return rows.select("security_id", "date", "corporate_action_flag", "corporate_action_source", "corporate_action_source_count", F.col("corporate_action_source_agreement").alias("agreement"), F.concat_ws("|", "corporate_action_signal_sources").alias("sources"))


@query(f"WITH {daily.OBSERVED}\nSELECT {_KEY}, fac AS adjustment_factor, pfac AS previous_adjustment_factor, changed AS adjustment_factor_changed FROM obs", dates=("date",))
def adj_factor_change(spark, sf_dir) -> DataFrame:
    return nominal.factor_changes(daily.observed(spark, sf_dir)).select("security_id", "date", "adjustment_factor", "previous_adjustment_factor", "adjustment_factor_changed")


@query(f"""WITH {daily.FRAME}
SELECT {_KEY}, awin AS flag, acomplete AS complete,
       coalesce(string_agg(CASE WHEN action THEN CAST(date AS VARCHAR) END, '|') OVER w, '') AS dates
FROM daily WINDOW w AS (PARTITION BY security_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""", dates=("date",))
def action_window(spark, sf_dir) -> DataFrame:
    rows = cleaning.action_windows(cleaning.action_signals(daily.daily_grid(spark, sf_dir)))
    return rows.select("security_id", "date", F.col("corporate_action_window_flag").alias("flag"), F.col("corporate_action_window_complete").alias("complete"), F.array_join(F.transform("corporate_action_window_dates", lambda d: d.cast("string")), "|").alias("dates"))


@query(f"WITH {daily.FRAME}\nSELECT {_KEY}, CASE WHEN pk THEN pw END AS cross_source_price_warning, round(abs(rc - nc), 6) AS close_difference FROM daily", dates=("date", "cross_source_price_warning"))
def cross_source_warning(spark, sf_dir) -> DataFrame:
    return cleaning.cross_source_warning(daily.daily_grid(spark, sf_dir)).select("security_id", "date", "cross_source_price_warning", F.round("nominal_close_absolute_difference", 6).alias("close_difference"))


@query(f"WITH {daily.FRAME}\nSELECT {_KEY}, prev AS previous_nominal_close FROM daily", dates=("date",))
def prev_valid_close(spark, sf_dir) -> DataFrame:
    return cleaning.previous_valid_close(cleaning.ohlc_quality(daily.daily_grid(spark, sf_dir))).select("security_id", "date", "previous_nominal_close")


@query(f"""WITH {daily.CLEAN}
SELECT security_id, prediction_date, entry_date, no AS yf_nominal_open, prev AS previous_nominal_close, raw_limit AS raw_upper_limit, tick AS tick_size, lim AS estimated_upper_limit, oflag AS ohlc_quality_flag, vflag AS volume_quality_flag,
       array_to_string(reasons, '|') AS reasons, reasons[1] AS entry_exclusion_reason, eligible AS entry_eligible, rev AS requires_review, CASE WHEN noprev THEN 'FIRST_TRADING_DAY_OR_NO_HISTORY' END AS entry_exclusion_detail FROM clean""", dates=("prediction_date", "entry_date", "entry_eligible"))
def clean_eligibility(spark, sf_dir) -> DataFrame:
    rows = daily.clean(spark, sf_dir)
    return rows.select("security_id", "prediction_date", "entry_date", "yf_nominal_open", "previous_nominal_close", "raw_upper_limit", "tick_size", "estimated_upper_limit", "ohlc_quality_flag", "volume_quality_flag", F.array_join("entry_exclusion_reasons", "|").alias("reasons"), "entry_exclusion_reason", "entry_eligible", "requires_review", "entry_exclusion_detail")


@query(f"""WITH {daily.CLEAN}, each AS (SELECT unnest(list_concat(['ALL'], reasons)) AS reason, eligible, rev, awin FROM clean)
SELECT reason, count(*) AS n_rows, count(*) FILTER (eligible) AS eligible, count(*) FILTER (NOT eligible) AS excluded, count(*) FILTER (eligible IS NULL) AS undecided, count(*) FILTER (rev) AS review, count(*) FILTER (awin) AS in_action_window FROM each GROUP BY 1""", dates=())
def clean_summary(spark, sf_dir) -> DataFrame:
    return cleaning.clean_summary(daily.clean(spark, sf_dir))


@query(f"WITH {daily.LABELS}\nSELECT *, round(exit_price / entry_price - 1, 6) AS gross_return FROM labels3", dates=("prediction_date", "entry_date", "label", "target_hit_horizon"))
def labels_3session(spark, sf_dir) -> DataFrame:
    rows = labels.three_session_labels(daily.clean(spark, sf_dir), ticks.tariff(spark))
    return rows.drop("target_hit").withColumn("gross_return", F.round("gross_return", 6))


@query(f"WITH {daily.LABELS}\nSELECT CASE WHEN label_status = 'NA' THEN 'NA:' || label_na_reason WHEN label = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS outcome, count(*) AS n_rows, count(DISTINCT security_id) AS securities FROM labels3 GROUP BY 1", dates=())
def label_summary(spark, sf_dir) -> DataFrame:
    return labels.label_summary(labels.three_session_labels(daily.clean(spark, sf_dir), ticks.tariff(spark)))


# Deduplication and unions -------------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) AS r FROM lineitem) WHERE r = 1""", dates=())
def keep_last_dedup(spark, sf_dir) -> DataFrame:
    return nominal.keep_last(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_extendedprice", "l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("""SELECT coalesce(o.k, l.k, c.k) AS k, o.k IS NOT NULL AS has_history, l.k IS NOT NULL AS has_nominal, c.k IS NOT NULL AS has_auxiliary, coalesce(o.n, 0) AS orders, coalesce(l.n, 0) AS items
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) o FULL JOIN (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) l ON l.k = o.k FULL JOIN (SELECT s_suppkey AS k FROM supplier) c ON c.k = coalesce(o.k, l.k)""", dates=())
def source_merge(spark, sf_dir) -> DataFrame:
    history = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    nominal_ = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.count("*").alias("items"))
    auxiliary = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    return nominal.merge_sources(history, nominal_, auxiliary, ["k"]).select("k", "has_history", "has_nominal", "has_auxiliary", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("items", F.lit(0)).alias("items"))
