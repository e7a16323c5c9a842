"""Experiments written once: models, metrics and scores of a walk-forward run under the fingerprint of what determines it.

Commit is in two phases. All files of an attempt go to a folder of its own name; the manifest, a single file under the
fingerprint's name that is created only if it is not there, names the attempt and comes last. Readers start at the
manifest, so a torn attempt is invisible, a second run finds the first one's results, and of two runs at the same time
one commits and the other takes over its results. Nothing is renamed, so stores without atomic renames do as well.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import folds as fold_ops
from ..operators import metrics
from . import modeling


@dataclass(frozen=True)
class Experiment:
    """A committed experiment; created is true for the run that committed it."""

    fingerprint: str
    path: str
    metadata: dict
    created: bool = False


class ExperimentStore:
    """Experiments below a root that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _create(self, name: str, text: str) -> bool:
        """Write a file that is not there yet; false if it is."""
        path, fs = self._path(name)
        if fs.exists(path):
            return False
        try:
            out = fs.create(path, False)
        except Exception as e:
            if "already exists" in str(e) or "FileAlreadyExists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def find(self, fingerprint: str) -> Experiment | None:
        """The committed experiment of a fingerprint; an error if files that its manifest lists are gone."""
        path, fs = self._path(f"manifests/{fingerprint}.json")
        if not fs.exists(path):
            return None
        text = "\n".join(r["value"] for r in self.spark.read.text(f"{self.root}/manifests/{fingerprint}.json").collect())  # one small file
        manifest = json.loads(text)
        missing = [f for f in manifest["files"] if not fs.exists(self._path(f"{manifest['attempt']}/{f}")[0])]
        if missing:
            raise ValueError(f"experiment {fingerprint} lacks {missing}")
        return Experiment(fingerprint, f"{self.root}/{manifest['attempt']}", manifest["metadata"])

    def save(self, fingerprint: str, metadata: dict, tables: dict[str, DataFrame], documents: dict[str, object] | None = None, models: dict[str, Callable[[str], None]] | None = None) -> Experiment:
        """Write tables (Parquet), documents (JSON files) and models (name -> a function that saves to a path), then commit."""
        if found := self.find(fingerprint):
            return found
        attempt = f"attempts/{fingerprint}-{uuid.uuid4().hex[:12]}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{attempt}/{name}")
        for name, write in (models or {}).items():
            write(f"{self.root}/{attempt}/models/{name}")
        for name, document in (documents or {}).items():
            self._create(f"{attempt}/{name}.json", json.dumps(document, sort_keys=True, default=str))
        files = [f"{t}/_SUCCESS" for t in tables] + [f"{d}.json" for d in documents or {}] + [f"models/{m}" for m in models or {}]
        manifest = {"attempt": attempt, "files": sorted(files), "metadata": metadata}
        created = self._create(f"manifests/{fingerprint}.json", json.dumps(manifest, sort_keys=True, default=str))
        found = self.find(fingerprint)
        return Experiment(found.fingerprint, found.path, found.metadata, created)

    def read(self, experiment: Experiment, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{experiment.path}/{table}")

    def registry(self) -> DataFrame:
        """The manifests of all committed experiments."""
        return self.spark.read.schema("attempt string, files array<string>, metadata map<string,string>").option("multiLine", True).json(f"{self.root}/manifests")


def run(store: ExperimentStore, panel: DataFrame, calendar: DataFrame, config: fold_ops.FoldConfig, as_of: str, provenance: dict, learner: modeling.Learner | None = None) -> Experiment:
    """Train, score and commit, unless an experiment of the same fingerprint is there: then nothing is trained.

    provenance: checksums and versions of the inputs. Tables: folds, predictions, fold_metrics. Models: one for each fold.
    """
    learner = learner or modeling.Learner()
    fingerprint = modeling.fingerprint(**provenance, config=vars(config), as_of=as_of, learner=vars(learner))
    if found := store.find(fingerprint):
        return found
    models: dict[str, modeling.Fitted] = {}
    scored = modeling.walk_forward(panel, calendar, config, as_of, learner, keep=models)
    path = f"{store.root}/scratch/{uuid.uuid4().hex}"
    scored.write.parquet(path)
    scored = store.spark.read.schema(scored.schema).parquet(path)  # models score once
    per_fold = None
    for fold in sorted(models):
        one = metrics.classification(scored.where(scored["fold_id"] == fold)).selectExpr(f"'{fold}' AS fold_id", "*")
        per_fold = one if per_fold is None else per_fold.unionByName(one)
    documents = {"config": vars(config), "feature_schema": {"features": list(learner.features)}, "provenance": provenance}
    tables = {"folds": fold_ops.folds(calendar, config), "predictions": scored, "fold_metrics": per_fold}
    metadata = {"fingerprint": fingerprint, "as_of": as_of, "learner": learner.kind, "folds": str(len(models))}
    return store.save(fingerprint, metadata, tables, documents, {name: model.save for name, model in models.items()})
