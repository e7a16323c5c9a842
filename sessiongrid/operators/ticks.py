"""Tick sizes by date and price band, price limits and targets in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PRICE, TICK, RATE = "decimal(26,18)", "decimal(6,2)", "decimal(3,2)"
INSTRUMENT = "EQUITY"
#: The equity tariff: regime, its first and last day, and (least price, price below, tick) of its bands (fixed values).
TARIFF = [
    ("2020-03-13", "2023-11-05", [("0.01", "20", "0.01"), ("20", "50", "0.02"), ("50", "100", "0.05"), ("100", None, "0.10")]),
    ("2023-11-06", None, [("0.01", "20", "0.01"), ("20", "50", "0.02"), ("50", "100", "0.05"), ("100", "250", "0.10"), ("250", "500", "0.25"), ("500", "1000", "0.50"), ("1000", "2500", "1.00"), ("2500", None, "2.50")]),
]


def tariff(spark: SparkSession) -> DataFrame:
    """rule_set_id, instrument_type, effective_from, effective_to, price_min, price_max, tick_size."""
    rows = [(f"RULES_{k}", INSTRUMENT, a, b, low, high, tick) for k, (a, b, bands) in enumerate(TARIFF, 1) for low, high, tick in bands]
    raw = spark.createDataFrame(rows, "rule_set_id string, instrument_type string, effective_from string, effective_to string, price_min string, price_max string, tick_size string")
    return raw.select("rule_set_id", "instrument_type", F.to_date("effective_from").alias("effective_from"), F.to_date("effective_to").alias("effective_to"), F.col("price_min").cast(PRICE).alias("price_min"), F.col("price_max").cast(PRICE).alias("price_max"), F.col("tick_size").cast(TICK).alias("tick_size"))


def with_tick(rows: DataFrame, rules: DataFrame, price: str, date: str) -> DataFrame:
    """rows with the rule in force for price (decimal) and date: equality on the instrument, range as residual."""
    rows = rows if "instrument_type" in rows.columns else rows.withColumn("instrument_type", F.lit(INSTRUMENT))
    r = rules.withColumnRenamed("instrument_type", "__instrument")
    p, d = F.col(price), F.col(date)
    on = (F.col("instrument_type") == F.col("__instrument")) & (d >= F.col("effective_from")) & (F.col("effective_to").isNull() | (d <= F.col("effective_to"))) & (p >= F.col("price_min")) & (F.col("price_max").isNull() | (p < F.col("price_max")))
    return rows.join(r, on, "left").drop("__instrument", "price_min", "price_max")


def floor_to_tick(price: Column, tick: Column) -> Column:
    return (F.floor(price / tick) * tick).cast(PRICE)


def ceil_to_tick(price: Column, tick: Column) -> Column:
    return (F.ceil(price / tick) * tick).cast(PRICE)


def scaled(price: Column, rate: str) -> Column:
    """price (double) times rate, exactly."""
    return (price.cast(PRICE) * F.lit(rate).cast(RATE)).cast(PRICE)


def upper_limits(rows: DataFrame, rules: DataFrame, previous_close: str = "previous_nominal_close", date: str = "date", margin: str = "1.10") -> DataFrame:
    """rows with raw_upper_limit, tick_size, estimated_upper_limit and price_step_resolution_status."""
    usable = (F.col(previous_close) > 0) & (F.col(previous_close) < float("inf"))
    raw = rows.withColumn("__raw", F.when(usable, scaled(F.col(previous_close), margin)))
    found = with_tick(raw, rules, "__raw", date)
    limit = floor_to_tick(F.col("__raw"), F.col("tick_size"))
    return (
        found.withColumn("raw_upper_limit", F.col("__raw").cast("double"))
        .withColumn("estimated_upper_limit", limit.cast("double"))
        .withColumn("price_step_resolution_status", F.when(F.col("tick_size").isNull(), "UNAVAILABLE").otherwise("RESOLVED"))
        .withColumn("tick_size", F.col("tick_size").cast("double"))
        .drop("__raw")
    )


#: What every rule of a set must say alike about its source.
METADATA = ["official_source_name", "official_document_number", "official_document_date", "official_effective_date", "official_source_url", "source_checksum"]


def tariff_violations(rules: DataFrame) -> DataFrame:
    """What is wrong with a tariff, by rule set (price_min where a band is meant, else null).

    Bands must begin at 0.01, follow each other without gap or overlap, and the last be open; the dates of a set must be
    one pair, and the next set of an instrument begin the day after; the last must be open. Where rules bear METADATA, each
    must be there, be the same throughout a set (checksums in any case), and the checksum be 64 hexadecimal digits.
    """
    band = Window.partitionBy("rule_set_id", "instrument_type").orderBy("price_min")
    bands = rules.withColumn("before", F.lag("price_max").over(band)).withColumn("first", F.row_number().over(band) == 1).withColumn("last", F.lead("price_min").over(band).isNull())
    issue = F.when(F.col("first") & (F.col("price_min") != F.lit("0.01").cast(PRICE)), "FIRST_BAND_NOT_0.01").when(~F.col("first") & ~F.col("before").eqNullSafe(F.col("price_min")), "BAND_GAP").when(F.col("last") & F.col("price_max").isNotNull(), "LAST_BAND_CLOSED")
    found = bands.select("rule_set_id", F.col("price_min").cast("double").alias("price_min"), issue.alias("issue")).where("issue is not null")
    known = [c for c in METADATA if c in rules.columns]
    text = lambda c: F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c == "source_checksum" else F.coalesce(F.col(c).cast("string"), F.lit(""))
    lacking = F.lit(False)
    for c in known:
        lacking = lacking | (text(c) == "")
    odd = ~text("source_checksum").rlike("^[0-9a-f]{64}$") if "source_checksum" in known else F.lit(False)
    sets = rules.groupBy("instrument_type", "rule_set_id").agg(
        F.min("effective_from").alias("a"), F.max("effective_to").alias("b"), F.count_if(F.col("effective_to").isNull()).alias("open"), F.size(F.collect_set(F.struct("effective_from", F.coalesce("effective_to", F.lit("9999-12-31").cast("date"))))).alias("dates"),
        F.size(F.collect_set(F.struct(*[text(c).alias(c) for c in known], F.lit(1).alias("one")))).alias("sources"), F.bool_or(lacking).alias("lacking"), F.bool_or(~lacking & odd).alias("odd"),
    )
    following = F.lead("a").over(Window.partitionBy("instrument_type").orderBy("a", "rule_set_id"))
    sets = sets.withColumn("next", following)
    issues = F.array_compact(F.array(
        F.when(F.col("dates") > 1, "INCONSISTENT_DATES"), F.when(F.col("lacking"), "METADATA_MISSING"), F.when(F.col("sources") > 1, "INCONSISTENT_METADATA"), F.when(F.col("odd"), "CHECKSUM_NOT_SHA256"),
        F.when(F.col("next").isNotNull() & ((F.col("open") > 0) | (F.date_add("b", 1) != F.col("next"))), "REGIME_GAP").when(F.col("next").isNull() & (F.col("open") == 0), "LAST_REGIME_CLOSED"),
    ))
    return found.unionByName(sets.select("rule_set_id", F.lit(None).cast("double").alias("price_min"), F.explode(issues).alias("issue")))
