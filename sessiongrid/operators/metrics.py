"""Ranking, classification and calibration metrics of scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_rank(scores: DataFrame) -> DataFrame:
    """rank from 1 within a day: higher probability first, then the smaller security_id."""
    w = Window.partitionBy("prediction_date").orderBy(F.desc("probability"), "security_id")
    return scores.withColumn("daily_rank", F.row_number().over(w))


def precision_at_k(scores: DataFrame, k: int) -> DataFrame:
    """Per day: the first k eligible rows, their usable labels and how many are positive; picks are not replaced."""
    if k < 1:
        raise ValueError("k must be positive")
    picked = daily_rank(scores.where("prediction_eligible")).where(F.col("daily_rank") <= k)
    usable = F.col("label").isin(0, 1)
    days = picked.groupBy("prediction_date").agg(F.count("*").alias("selected"), F.count_if(usable).alias("valid_labels"), F.count_if(F.col("label") == 1).alias("positive"))
    return days.select("*", F.when(F.col("valid_labels") > 0, F.col("positive") / F.col("valid_labels")).alias("precision_at_k"), (F.col("valid_labels") / F.col("selected")).alias("label_coverage_at_k"))


def precision_summary(days: DataFrame) -> DataFrame:
    """Mean over the days that have usable labels, and pooled over all picks."""
    return days.agg(F.count("*").alias("days"), F.avg("precision_at_k").alias("macro_precision"), F.when(F.sum("valid_labels") > 0, F.sum("positive") / F.sum("valid_labels")).alias("pooled_precision"), F.sum("valid_labels").alias("valid_labels"))


def classification(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: confusion matrix, accuracy, precision, recall, F1, rates and Brier score of labelled rows."""
    rows = scores.where(F.col("label").isin(0, 1)).select("label", "probability", (F.col("probability") >= threshold).cast("int").alias("p"))
    y, p = F.col("label"), F.col("p")
    m = rows.agg(
        F.count("*").alias("n_rows"), F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.avg((F.col("probability") - y) * (F.col("probability") - y)).alias("brier"),
    )
    n, tp, fp, fn, tn = (F.col(c) for c in ("n_rows", "tp", "fp", "fn", "tn"))
    share = lambda a, b: F.when(b > 0, a / b)
    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    return m.select(
        "n_rows", "tp", "fp", "fn", "tn", share(tp + tn, n).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).alias("f1"), share(tp + fn, n).alias("positive_rate"), share(tp + fp, n).alias("predicted_rate"), "brier",
    )


#: Ranges of a value whose totals are added up in one place; a power of two.
RANGES = 1024


def _bounds(rows: DataFrame, by: str) -> DataFrame:
    """One row: at most RANGES - 1 values of ``by`` that cut rows into parts of about the same size, from a sketch of them."""
    shares = F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)])
    return rows.agg(F.array_sort(F.array_distinct(F.percentile_approx(by, shares, 20 * RANGES))).alias("__bounds"))


def _range_of(value: Column) -> Column:
    """The number of bounds at or below value, by halving."""
    bounds = F.coalesce("__bounds", F.array().cast("array<double>"))
    widths = F.array(*[F.lit(RANGES >> k) for k in range(1, RANGES.bit_length())])
    return F.aggregate(widths, F.lit(0), lambda low, w: F.when((low + w <= F.size(bounds)) & (F.get(bounds, low + w - 1) <= value), low + w).otherwise(low))


def running_totals(counts: DataFrame, rows: DataFrame, by: str, columns: list[str], descending: bool = False) -> DataFrame:
    """counts (unique by ``by``, a double) with NAME_before for each column: its total over all values that come before.

    rows: what the bounds of the ranges are taken from, so that each range holds about as many of them, wherever the
    values lie. The totals of at most RANGES ranges are added up in one place and sent to all tasks; the rest is added up
    within a range, so no window sees all values.
    """
    ranged = counts.crossJoin(F.broadcast(_bounds(rows, by))).withColumn("__range", _range_of(F.col(by))).drop("__bounds")  # one row
    way = F.desc if descending else F.asc
    above = Window.orderBy(way("__range")).rowsBetween(Window.unboundedPreceding, -1)
    coarse = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    coarse = coarse.select("__range", *[F.coalesce(F.sum(f"__{c}").over(above), F.lit(0)).alias(f"__{c}_above") for c in columns])
    inner = Window.partitionBy("__range").orderBy(way(by)).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(F.broadcast(coarse), "__range")  # RANGES rows at most
    return joined.select(*counts.columns, *[(F.col(f"__{c}_above") + F.coalesce(F.sum(c).over(inner), F.lit(0))).alias(f"{c}_before") for c in columns])


def _by_score(scores: DataFrame) -> DataFrame:
    """Positives and negatives of each distinct score with the totals at or above it."""
    rows = scores.where(F.col("label").isin(0, 1) & F.col("probability").isNotNull()).select("probability", "label")
    counts = rows.groupBy("probability").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    totals = running_totals(counts, rows, "probability", ["pos", "neg"], descending=True)
    return totals.select("probability", "pos", "neg", (F.col("pos_before") + F.col("pos")).alias("tp"), (F.col("neg_before") + F.col("neg")).alias("fp"))


def roc_auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve, ties counting half; null where a class is missing."""
    pairs = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2))
    sums = _by_score(scores).agg(pairs.alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("wins") / (F.col("p") * F.col("n"))).alias("roc_auc"), "p", "n")


def average_precision(scores: DataFrame) -> DataFrame:
    """Sum over distinct thresholds of recall gained times precision."""
    gain = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    sums = _by_score(scores).agg(gain.alias("gain"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("gain") / F.col("p")).alias("average_precision"))


def calibration(scores: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-count bins by probability (ties by key): mean prediction, observed rate and their gap.

    A row's place is the number of rows with a smaller probability (running_totals), those of smaller securities with its
    own, and those of its security before it: no task ranks all rows, nor all rows of one probability.
    """
    rows = scores.where(F.col("label").isin(0, 1) & F.col("probability").isNotNull()).select("security_id", "prediction_date", "label", "probability")
    per_security = rows.groupBy("probability", "security_id").agg(F.count("*").alias("n"))
    counts = per_security.groupBy("probability").agg(F.sum("n").alias("n"))
    before = running_totals(counts, rows, "probability", ["n"]).select("probability", "n_before")
    smaller = Window.partitionBy("probability").orderBy("security_id").rowsBetween(Window.unboundedPreceding, -1)
    held = per_security.join(before, "probability").select("probability", "security_id", (F.col("n_before") + F.coalesce(F.sum("n").over(smaller), F.lit(0))).alias("before"))
    total = rows.agg(F.count("*").alias("total"))  # one row
    place = F.col("before") + F.row_number().over(Window.partitionBy("probability", "security_id").orderBy("prediction_date")) - 1
    joined = rows.join(held, ["probability", "security_id"]).crossJoin(F.broadcast(total))
    rows = joined.withColumn("place", place).withColumn("k", F.least(F.lit(bins), F.col("total")))
    # the first total % k bins hold one row more
    size, more = F.floor(F.col("total") / F.col("k")), F.col("total") % F.col("k")
    big = more * (size + 1)
    number = F.when(F.col("place") < big, F.floor(F.col("place") / (size + 1))).otherwise(more + F.floor((F.col("place") - big) / size)) + 1
    out = rows.groupBy(number.cast("int").alias("bin")).agg(F.count("*").alias("n_rows"), F.avg("probability").alias("mean_prediction"), F.avg("label").alias("observed_rate"))
    return out.withColumn("gap", F.abs(F.col("mean_prediction") - F.col("observed_rate")))


def calibration_gap(scores: DataFrame, bins: int = 10) -> DataFrame:
    """One row: requested and effective bins, labelled rows, and the bins' gaps weighted by their rows."""
    size = F.sum("n_rows")
    return calibration(scores, bins).agg(F.lit(bins).alias("requested_bins"), F.count("*").alias("effective_bins"), size.cast("long").alias("n_rows"), (F.sum(F.col("n_rows") * F.col("gap")) / size).alias("weighted_gap"))


def classification_report(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row with all of it: classification, area under the ROC curve and average precision; no labelled row gives nulls."""
    area, gain = roc_auc(scores).select("roc_auc"), average_precision(scores)
    return classification(scores, threshold).crossJoin(F.broadcast(area)).crossJoin(F.broadcast(gain))  # one row each
