"""Reference CSVs and deterministic reports."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_ticker

TARIFF_COLUMNS = "rule_set_id string, instrument_type string, effective_from string, effective_to string, price_min_inclusive string, price_max_exclusive string, tick_size string"
MAPPING_COLUMNS = "security_id string, ticker string, valid_from string, valid_to string, is_current_ticker string, mapping_status string"


def read_tariff(spark: SparkSession, path: str) -> DataFrame:
    """A tick tariff from CSV, typed field by field; bad fields become null and show in the validation."""
    raw = spark.read.csv(path, header=True, schema=TARIFF_COLUMNS, enforceSchema=False)
    d = lambda c: F.expr(f"try_cast(nullif(trim({c}), '') as date)").alias(c)
    n = lambda c, to, t: F.expr(f"try_cast(nullif(trim({c}), '') as {t})").alias(to)
    return raw.select("rule_set_id", "instrument_type", d("effective_from"), d("effective_to"), n("price_min_inclusive", "price_min", "decimal(26,18)"), n("price_max_exclusive", "price_max", "decimal(26,18)"), n("tick_size", "tick_size", "decimal(6,2)"))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A ticker mapping from CSV with normalised tickers and dates."""
    raw = spark.read.csv(path, header=True, schema=MAPPING_COLUMNS, enforceSchema=False)
    return raw.select("security_id", normalize_ticker(F.col("ticker")).alias("ticker"), F.expr("try_cast(valid_from as date)").alias("valid_from"), F.expr("try_cast(nullif(trim(valid_to), '') as date)").alias("valid_to"), (F.lower("is_current_ticker") == "true").alias("is_current_ticker"), "mapping_status")


def write_csv(df: DataFrame, path: str, keys: list[str]) -> None:
    """One sorted CSV file with a header in a folder; for reports, whose size is that of an aggregate."""
    df.coalesce(1).sortWithinPartitions(*keys).write.mode("overwrite").csv(path, header=True)


def write_text(path: str, text: str) -> None:
    """A driver-side report: written beside its place, flushed, then renamed over it."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)


def write_json(path: str, value: object) -> None:
    write_text(path, json.dumps(value, sort_keys=True, ensure_ascii=False, indent=2, default=str) + "\n")


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("security_id string, prediction_date date, probability double, prediction_eligible boolean, label int").json(path)
