"""Bars of entities by session from raw trades: the panels that the queries run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BAR = ["open", "high", "low", "close", "tl_volume", "share_volume"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(trades: DataFrame, order: list[str]) -> DataFrame:
    """security_id, prediction_date and a bar, from trades with price, amount and quantity.

    One hash aggregation with a partial step before the shuffle; first and last follow the total order given.
    """
    place = F.struct(*order)
    return trades.groupBy("security_id", "prediction_date").agg(
        F.min_by("price", place).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", place).alias("close"),
        F.sum("amount").alias("tl_volume"),
        F.sum("quantity").alias("share_volume"),
    )


def line_trades(spark: SparkSession, sf_dir: str, entity: Column, unit: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    session = F.to_date(F.date_trunc(unit, "l_shipdate"))
    return items.select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        session.alias("prediction_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"),
    ).withColumn("security_id", entity)


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


def nation_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel of nations by week; the supplier table is broadcast if it is small, by Spark's own estimate."""
    trades = line_trades(spark, sf_dir, F.lit(None).cast("string"), "week").drop("security_id")
    nations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.format_string("N%03d", "s_nationkey").alias("security_id"))
    return bars(trades.join(nations, "l_suppkey"), LINE_ORDER)


def supplier_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(line_trades(spark, sf_dir, F.format_string("S%06d", "l_suppkey"), "week"), LINE_ORDER)


def supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(line_trades(spark, sf_dir, F.format_string("S%06d", "l_suppkey"), "month"), LINE_ORDER)


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("value > 0")
    trades = events.select(F.format_string("U%06d", "user_id").alias("security_id"), F.to_date("ts").alias("prediction_date"), F.col("value").alias("price"), F.col("value").alias("amount"), F.lit(1.0).alias("quantity"), "ts")
    return bars(trades, ["ts"])


def benchmark(panel: DataFrame, *more: Column) -> DataFrame:
    """The panel's own index: mean close by session; and more aggregates, if asked for.

    Closes are added up as exact decimals, so the mean does not depend on the order in which rows arrive.
    """
    total = F.sum(F.col("close").cast("decimal(28,8)")).cast("double")
    return panel.groupBy("prediction_date").agg((total / F.count("close")).alias("benchmark_close"), *more)
