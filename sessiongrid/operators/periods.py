"""Dates in overlapping periods: an interval join by bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a bin. A period is written once for each bin that it meets, a date stands in one.
BIN_DAYS = 64


def _bin(date: Column) -> Column:
    return F.floor(F.unix_date(date) / BIN_DAYS)


def with_periods(rows: DataFrame, periods: DataFrame, key: str = "ticker", date: str = "date", name: str = "periods") -> DataFrame:
    """rows (unique by key and date) with the names of the periods that hold their date, joined by ; in the periods' order.

    periods: place (their order), period, tickers (array), start, end, both ends inclusive. Rows in none have an empty
    text. Each ticker of a period is taken once. Periods and dates meet by equal key and bin, then by the exact bounds;
    the lists are put together by key and date.
    """
    bins = F.explode(F.sequence(_bin(F.col("start")), _bin(F.col("end"))))
    spread = periods.where("start <= end").select("place", "period", "start", "end", F.explode(F.array_distinct("tickers")).alias("__key")).withColumn("__bin", bins)
    dated = rows.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{date}`").alias("__date")).where("__date is not null").distinct().withColumn("__bin", _bin(F.col("__date")))
    met = dated.join(spread, ["__key", "__bin"]).where("__date between start and end")
    lists = met.groupBy("__key", "__date").agg(F.array_sort(F.collect_list(F.struct("place", "period"))).alias("__held"))
    joined = rows.join(lists, (F.col(f"`{key}`") == F.col("__key")) & (F.col(f"`{date}`") == F.col("__date")), "left")
    held = F.coalesce(F.array_join("__held.period", ";"), F.lit(""))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c != name], held.alias(name))


def actions_in_periods(quality: DataFrame, periods: DataFrame, signal: str = "has_any_corporate_action_signal") -> DataFrame:
    """The rows with a signal that lie in a period at least, with the list of their periods."""
    return with_periods(quality.where(F.col(signal)), periods).where("periods <> ''")
