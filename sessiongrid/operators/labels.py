"""Three-session target labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import is_true, positive
from .ticks import ceil_to_tick, scaled, with_tick

TARGET = "1.05"
BARS = ["yf_nominal_high", "yf_nominal_close", "ohlc_quality_flag", "volume_quality_flag"]


def three_session_labels(clean: DataFrame, rules: DataFrame) -> DataFrame:
    """clean (one row for each security and entry date) with label, label_status and why a label is missing.

    The first failing check wins. The days T+1..T+3 are the entry dates that follow each other over all securities; a
    security's rows on them are looked up by equality, since a missing row is not a shifted one.
    """
    days = clean.groupBy("prediction_date").agg(F.min("entry_date").alias("entry_date"), F.max("entry_date").alias("last"))
    several = F.raise_error(F.concat(F.lit("several entry dates of "), F.col("prediction_date").cast("string"))).cast("date")
    successor = days.select("prediction_date", F.when(F.col("entry_date") == F.col("last"), F.col("entry_date")).when(F.col("last").isNotNull(), several).alias("entry_date"))
    after = lambda n, a, b: successor.select(F.col("prediction_date").alias(a), F.col("entry_date").alias(b))
    rows = clean.join(after(2, "entry_date", "date_2"), "entry_date", "left").join(after(3, "date_2", "date_3"), "date_2", "left")
    bar = clean.select("security_id", F.col("entry_date"), F.struct(*BARS).alias("bar"))
    for k in (2, 3):
        rows = rows.join(bar.select("security_id", F.col("entry_date").alias(f"date_{k}"), F.col("bar").alias(f"bar_{k}")), ["security_id", f"date_{k}"], "left")
    rows = rows.withColumn("bar_1", F.struct(*BARS))
    price = positive(F.col("yf_nominal_open"))
    rows = rows.withColumn("__raw", scaled(price, TARGET))
    rows = rows.drop("tick_size")
    rows = with_tick(rows, rules, "__raw", "entry_date").withColumn("__target", ceil_to_tick(F.col("__raw"), F.col("tick_size")))
    clean_reason = F.when(is_true(F.size("entry_exclusion_reasons") > 0), F.element_at("entry_exclusion_reasons", 1)).when(is_true(F.col("corporate_action_window_flag")), "CORPORATE_ACTION_WINDOW")
    steps = [
        F.when(clean_reason.isNotNull(), clean_reason),
        F.when(is_true(F.col("requires_review")), "REQUIRES_REVIEW"),
        F.when(~is_true(F.col("entry_eligible")), "ENTRY_NOT_ELIGIBLE"),
        F.when(price.isNull(), "NO_OPEN"),
        F.when(F.col("tick_size").isNull(), "TARGET_TICK_SIZE_UNAVAILABLE"),
        F.when(F.col("date_2").isNull() | F.col("date_3").isNull(), "INCOMPLETE_HORIZON"),
        F.when(F.col("bar_2").isNull() | F.col("bar_3").isNull(), "MISSING_HORIZON_ROW"),
    ]
    for k in (1, 2, 3):
        b = F.col(f"bar_{k}")
        steps.append(F.when(is_true(b["volume_quality_flag"] == "NO_TRADE"), "HORIZON_NO_TRADE").when(~is_true(b["ohlc_quality_flag"] == "VALID") | b["yf_nominal_high"].isNull(), "INVALID_HORIZON_PRICE"))
    reason = F.coalesce(*steps)
    rows = rows.withColumn("__reason", reason)
    hit = F.coalesce(*[F.when(is_true(F.col(f"bar_{k}")["yf_nominal_high"].cast("decimal(26,18)") >= F.col("__target")), F.lit(k)) for k in (1, 2, 3)])
    rows = rows.withColumn("__hit", F.when(F.col("__reason").isNull(), hit))
    last = F.col("bar_3")["yf_nominal_close"]
    no_close = F.col("__reason").isNull() & F.col("__hit").isNull() & last.isNull()
    rows = rows.withColumn("label_na_reason", F.when(no_close, "MISSING_T3_CLOSE").otherwise(F.col("__reason")))
    labelled = F.col("label_na_reason").isNull()
    # the entry price is known once the checks up to the open have passed, the target once a tick is found
    to_price = F.coalesce(*steps[:4]).isNull()
    to_target = F.coalesce(*steps[:5]).isNull()
    exit_price = F.when(labelled, F.when(F.col("__hit").isNotNull(), F.col("__target").cast("double")).otherwise(last))
    # compare exactly, then leave the decimals
    out = rows.withColumns({
        "entry_price": F.when(to_price, price),
        "target_price": F.when(to_target, F.col("__target").cast("double")),
        "label_status": F.when(labelled, "LABELED").otherwise("NA"),
        "label": F.when(labelled, F.col("__hit").isNotNull().cast("int")),
        "target_hit": F.when(labelled, F.col("__hit").isNotNull()),
        "target_hit_horizon": F.col("__hit").cast("int"),
        "exit_price": exit_price,
    })
    out = out.withColumn("gross_return", F.col("exit_price") / F.col("entry_price") - 1)
    return out.select("security_id", "prediction_date", "entry_date", "label", "label_status", "label_na_reason", "target_hit", "target_hit_horizon", "entry_price", "target_price", "exit_price", "gross_return")


def label_summary(labels: DataFrame) -> DataFrame:
    """Counts of labels by outcome and, for missing ones, by reason."""
    kind = F.when(F.col("label_status") == "NA", F.concat(F.lit("NA:"), "label_na_reason")).when(F.col("label") == 1, "POSITIVE").otherwise("NEGATIVE")
    return labels.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n_rows"), F.countDistinct("security_id").alias("securities"))


def label_totals(labels: DataFrame) -> DataFrame:
    """One row: labels by outcome, hits by session, and the reasons of missing labels with their counts, in order of name."""
    label, hit = F.col("label"), F.col("target_hit_horizon")
    reason = F.when(F.col("label_status") == "NA", F.col("label_na_reason"))
    by_reason = labels.groupBy(reason.alias("reason")).agg(
        F.count("*").alias("n"), F.count_if(label == 1).alias("p"), F.count_if(label == 0).alias("q"), F.count_if(label.isNull()).alias("na"), *[F.count_if(hit == k).alias(f"t{k}") for k in (1, 2, 3)],
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "n")))), lambda r: F.concat_ws("=", r["reason"], r["n"].cast("string")))
    return by_reason.agg(
        total("n")("row_count"), total("p")("label_positive"), total("q")("label_negative"), total("na")("label_na"), total("t1")("target_hit_t1"), total("t2")("target_hit_t2"), total("t3")("target_hit_t3"), F.array_join(listed, "|").alias("na_reasons"),
    )
