"""Fitting, scoring and recording walk-forward models with Spark's own learners.

The learner is an interface: anything whose ``fit(fit, validation)`` gives a function that scores rows. The default is
a logistic regression of spark.ml on the 32 features, imputed; boosted trees are the other choice. Results are not those of other
libraries' boosters.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import number
from ..operators import folds as fold_ops
from ..operators import metrics
from ..operators.features import FEATURES


def model_matrix(rows: DataFrame, features: tuple[str, ...] = tuple(FEATURES)) -> DataFrame:
    """rows with the features as doubles in their fixed order behind all other columns; what is no number is null."""
    missing = sorted(set(features) - set(rows.columns))
    if missing:
        raise ValueError(f"features are missing: {missing}")
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in features], *[number(F.col(f)).alias(f) for f in features])


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline: preparation and classifier."""

    pipeline: PipelineModel
    features: tuple[str, ...]
    made: tuple[str, ...]

    def __call__(self, rows: DataFrame) -> DataFrame:
        """rows with their probability."""
        scored = self.pipeline.transform(model_matrix(rows, self.features))
        return scored.withColumn("probability", vector_to_array("probability")[1]).drop(*self.made)

    def save(self, path: str) -> None:
        self.pipeline.write().save(path)


@dataclass(frozen=True)
class Learner:
    """Median imputation, assembly and a classifier of spark.ml whose complexity the validation rows choose.

    trees: boosting stops when the validation loss no longer falls. logistic: of the penalties, the one with the least
    validation log loss.
    """

    kind: str = "logistic"
    features: tuple[str, ...] = tuple(FEATURES)
    penalties: tuple[float, ...] = (0.1, 0.01, 0.001)

    def fit(self, fit: DataFrame, validation: DataFrame) -> Fitted:
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import GBTClassifier, LogisticRegression
        from pyspark.ml.feature import Imputer, VectorAssembler

        both = model_matrix(fit.withColumn("__held", F.lit(False)).unionByName(validation.withColumn("__held", F.lit(True))), self.features)
        both = both.withColumn("label", F.col("label").cast("double"))
        counts = both.groupBy("__held").agg(F.countDistinct("label").alias("classes"), *[F.count(f"`{f}`").alias(f) for f in self.features])
        seen = {r["__held"]: r for r in counts.collect()}
        if len(seen) < 2 or any(r["classes"] != 2 for r in seen.values()):
            raise ValueError("fit and validation rows must each hold both classes")
        used = [f for f in self.features if seen[False][f]]
        filled = [f"__{f}" for f in used]
        prepare = Pipeline(stages=[Imputer(inputCols=used, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="features")]).fit(both.where(~F.col("__held")))
        ready = prepare.transform(both).select("__held", "label", "features").persist()
        try:
            if self.kind == "trees":
                model = GBTClassifier(labelCol="label", maxIter=100, maxDepth=4, seed=42, validationIndicatorCol="__held").fit(ready)
            else:
                probability = F.least(F.greatest(vector_to_array("probability")[1], F.lit(1e-15)), F.lit(1 - 1e-15))
                loss = F.avg(-F.when(F.col("label") == 1, F.log(probability)).otherwise(F.log(1 - probability)))
                models = [LogisticRegression(labelCol="label", regParam=x, maxIter=30).fit(ready.where(~F.col("__held"))) for x in self.penalties]
                losses = [m.transform(ready.where("__held")).agg(loss.alias("loss")).first()["loss"] for m in models]
                model = models[losses.index(min(losses))]
        finally:
            ready.unpersist()
        return Fitted(PipelineModel([*prepare.stages, model]), self.features, ("features", "rawPrediction", "prediction", *filled))


def _untrained(parts: DataFrame) -> dict[str, float | None]:
    """The folds whose fit or validation rows lack a class, with the share of label 1 among their fit rows (null: no rows)."""
    of = lambda part, test: F.count_if((F.col("part") == part) & test)
    label = F.col("label")
    sides = [of(part, label == x).alias(f"{part}_{x}") for part in ("fit", "validation") for x in (0, 1)]
    found = parts.groupBy("fold_id").agg(*sides).where(" or ".join(f"{part}_{x} = 0" for part in ("fit", "validation") for x in (0, 1)))
    share = F.when(F.col("fit_0") + F.col("fit_1") > 0, F.col("fit_1") / (F.col("fit_0") + F.col("fit_1")))
    return {r["fold_id"]: r["share"] for r in found.select("fold_id", share.alias("share")).collect()}  # one row a fold


def walk_forward(panel: DataFrame, calendar: DataFrame, config: fold_ops.FoldConfig, as_of: str, learner: Learner | None = None, threshold: float = 0.5, keep: dict[str, Fitted] | None = None, base_rate: bool = False) -> DataFrame:
    """Out-of-sample scores of every fold's test rows, with daily ranks within each fold.

    fold_id, security_id, prediction_date, prediction_eligible, label, label_status, probability, predicted_class (1 from
    the threshold on). Labels that were not available as of the date are blanked (status NA). A fold learns from fit
    and validation rows alone; one fit for each fold: the driver iterates over folds (tens), never over rows. The split
    panel is a checkpoint, if the session has a folder for them, so no fold computes it again. keep: gets the fitted model
    of each fold.

    A fold whose fit or validation rows lack a class cannot be learned from and is refused. base_rate: such a fold's test
    rows get the share of label 1 among its fit rows instead (null, if none is labelled), and a column ``trained`` tells
    which folds have a model.
    """
    learner = learner or Learner()
    table = fold_ops.folds(calendar, config)
    parts = fold_ops.split(panel, table)
    if panel.sparkSession.sparkContext.getCheckpointDir():
        parts = parts.checkpoint()
    known = F.coalesce(F.col("label_available_date") <= F.lit(as_of).cast("date"), F.lit(False))
    shares = _untrained(parts) if base_rate else {}
    out = None
    for row in table.select("fold_id").orderBy("fold_id").collect():
        own = parts.where(F.col("fold_id") == row["fold_id"])
        trained = row["fold_id"] not in shares
        if trained:
            score = learner.fit(own.where("part = 'fit'"), own.where("part = 'validation'"))
            if keep is not None:
                keep[row["fold_id"]] = score
            scored = score(own.where("part = 'test'"))
        else:
            scored = own.where("part = 'test'").withColumn("probability", F.lit(shares[row["fold_id"]]).cast("double"))
        test = scored.select(
            "fold_id", "security_id", "prediction_date", "prediction_eligible", F.when(known, F.col("label").cast("int")).alias("label"),
            F.when(known, F.col("label_status")).otherwise("NA").alias("label_status"), "probability", (F.col("probability") >= threshold).cast("int").alias("predicted_class"),
            *([F.lit(trained).alias("trained")] if base_rate else []),
        )
        out = test if out is None else out.unionByName(test)
    if out is None:
        raise ValueError("the calendar holds no complete fold")
    return metrics.daily_rank(out)


def fingerprint(**fields: object) -> str:
    """SHA-256 over canonical JSON of what determines a training run."""
    return hashlib.sha256(json.dumps(fields, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()
