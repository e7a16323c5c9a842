"""Date-effective security identity: who a ticker was on a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.checks import require
from ..functions.text import normalize_ticker, security_id

FAR = "9999-12-31"


def resolve(rows: DataFrame, mapping: DataFrame, date: str = "date") -> DataFrame:
    """rows (ticker, date) with security_id, mapping_status, current_ticker and the number of effective rules.

    mapping: security_id, ticker, valid_from, valid_to (null: open; both ends inclusive), is_current_ticker. A ticker
    without rules gets an identifier of its own (AUTO_NEW_TICKER); with rules but none in force it is OUTSIDE_VALIDITY
    under the smallest candidate. Two rules in force at once fail the query, whatever columns it reads, as no choice between them is right.
    Mapping tables are small: Spark broadcasts them by its own size estimate. One pass: all rules of a ticker come as
    an array, so rows are not multiplied.
    """
    rules = mapping.select(normalize_ticker(F.col("ticker")).alias("ticker"), "security_id", "valid_from", F.coalesce("valid_to", F.lit(FAR).cast("date")).alias("valid_to"), F.coalesce("is_current_ticker", F.lit(False)).alias("is_current"))
    # the current ticker of a security: the one marked so, else the last to begin
    current = rules.groupBy("security_id").agg(F.max_by("ticker", F.struct("is_current", "valid_from", "ticker")).alias("current"))
    rules = rules.join(current, "security_id").select("ticker", F.struct("security_id", "valid_from", "valid_to", "is_current", "current").alias("rule"))
    rules = rules.groupBy("ticker").agg(F.array_sort(F.collect_list("rule")).alias("rules"))
    joined = rows.withColumn("ticker", normalize_ticker(F.col("ticker"))).join(rules, "ticker", "left")
    live = F.filter("rules", lambda r: (r["valid_from"] <= F.col(date)) & (F.col(date) <= r["valid_to"]))
    several = F.concat(F.lit("several mapping rules for "), F.col("ticker"), F.lit(" on "), F.col(date).cast("string"))
    joined = require(joined.withColumn("__live", live), F.coalesce(F.size("__live"), F.lit(0)) <= 1, several)
    chosen = F.get("__live", F.lit(0))
    mapped = F.when(chosen["is_current"], "MAPPED_CURRENT_TICKER").otherwise("MAPPED_HISTORICAL_TICKER")
    status = F.when(F.col("rules").isNull(), "AUTO_NEW_TICKER").when(F.size("__live") == 0, "OUTSIDE_VALIDITY").otherwise(mapped)
    first = F.get("rules", F.lit(0))  # rules are sorted by security_id
    known = F.coalesce(chosen, first)
    ident = F.when(F.col("rules").isNull(), security_id(F.col("ticker"))).otherwise(known["security_id"])
    now = F.when(F.col("rules").isNull(), F.col("ticker")).otherwise(known["current"])
    n = F.when(F.col("rules").isNotNull(), F.size("__live")).otherwise(0)
    return joined.withColumns({"security_id": ident, "mapping_status": status, "current_ticker": now, "effective_rules": n}).drop("rules", "__live")


def dedup_identity(rows: DataFrame, date: str = "date") -> DataFrame:
    """Drop rows outside validity, then one row for each security and date: mapped before unmapped, then by the row's hash."""
    inside = rows.where(F.col("mapping_status") != "OUTSIDE_VALIDITY")
    content = F.sha2(F.to_json(F.struct(*sorted(inside.columns))), 256)
    unmapped = (F.col("mapping_status") == "AUTO_NEW_TICKER").cast("int")
    w = Window.partitionBy("security_id", date).orderBy(unmapped, content)
    return inside.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def collection_plan(securities: DataFrame, mapping: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals to collect: each mapping period clipped to the request; securities without a mapping whole."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    mapped = mapping.select("security_id", F.col("ticker").alias("mapped_ticker"), F.greatest(lo, F.col("valid_from")).alias("m_start"), F.least(hi, F.coalesce("valid_to", hi)).alias("m_end"))
    joined = securities.join(mapped, "security_id", "left")
    plan = joined.select("security_id", F.coalesce("mapped_ticker", "ticker").alias("ticker"), F.when(F.col("mapped_ticker").isNull(), lo).otherwise(F.col("m_start")).alias("start"), F.when(F.col("mapped_ticker").isNull(), hi).otherwise(F.col("m_end")).alias("end"))
    return plan.where("start <= end").distinct()


def overlaps(mapping: DataFrame, by: str) -> DataFrame:
    """Periods that begin before an earlier one of the same ``by`` has ended."""
    w = Window.partitionBy(by).orderBy("valid_from", "valid_to", "security_id", "ticker")
    reach = F.max(F.coalesce("valid_to", F.lit(FAR).cast("date"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return mapping.withColumn("earlier_end", reach).where(F.col("valid_from") <= F.col("earlier_end"))


def period_violations(manifest: DataFrame, start: str, end: str) -> DataFrame:
    """What is wrong with the planned periods of securities: outside the collection's range, ending before they begin, or
    beginning before an earlier one of the security has ended (an open end is the range's)."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    w = Window.partitionBy("security_id").orderBy("period_start", "period_end", "provider_ticker")
    before = F.lag("period_end").over(w)
    issues = F.array_compact(F.array(
        F.when((F.col("period_start") < lo) | (F.col("period_end") > hi), "OUTSIDE_RANGE"), F.when(F.col("period_start") > F.col("period_end"), "START_AFTER_END"), F.when(F.col("period_start") <= F.col("before"), "OVERLAP"),
    ))
    return manifest.withColumn("before", before).select("security_id", "provider_ticker", "period_start", "period_end", F.explode(issues).alias("issue"))
