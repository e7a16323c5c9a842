"""Toxicity and quality: held-out accuracy, and odd inputs."""

import pytest
from pyspark.sql import functions as F

from sessiongrid.llm import quality, toxicity
from sessiongrid.llm.common import held_out
from sessiongrid.llm.queries import QUERIES

ODD = [(1, "You idiot. Fine day."), (1, "You idiot. Fine day."), (2, None), (3, ""), (4, "x" * 300_000), (None, "moron"), (5, "...!?\n\n")]


def trained_rows(spark):
    """A corpus in which few words make the class."""
    words = ["river", "stone", "cloud", "garden", "table", "window", "paper", "street"]
    rows = []
    for i in range(400):
        bad = i % 3 == 0
        text = " ".join(words[(i * 7 + k * (k + 3)) % 8] for k in range(30)) + ". " + ("you idiot moron. " if bad else "good morning all. ") + " ".join(words[(i + k) % 8] for k in range(10))
        rows.append((i, text, int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    return df.select("doc_id", "text"), df.select("doc_id", F.col("y").alias("toxic"), (1 - F.col("y")).alias("quality"))


def held_out_accuracy(scored, labels, label, at):
    rows = scored.join(labels, "doc_id").where(held_out()).select((F.col("score") >= at).cast("int").alias("p"), label).collect()
    return sum(r["p"] == r[label] for r in rows) / len(rows)


def test_toxicity_learns_and_locates(spark):
    docs, labels = trained_rows(spark)
    model = toxicity.train(docs, labels)
    scored = toxicity.score_documents(docs.withColumn("score", F.lit("clash")), model)
    assert held_out_accuracy(scored, labels, "toxic", 0.3) >= 0.95
    row = scored.where("doc_id = 3").first()
    spans = [row["text"][s["start"] : s["end"]].strip() for s in row["offending"]]
    assert spans == ["you idiot moron"]
    odd = toxicity.score_documents(spark.createDataFrame(ODD, "doc_id long, text string"), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert [r["score"] for r in odd if not r["text"]] == [0.0, 0.0]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0


def test_toxicity_without_labels(spark):
    docs, labels = trained_rows(spark)
    model = toxicity.train(docs, labels.limit(0))
    assert toxicity.score_documents(docs, model).agg(F.max("score")).first()[0] < 0.3


def test_quality_learns_by_ftrl(spark):
    docs, labels = trained_rows(spark)
    weights = quality.train(docs, labels)
    assert (weights == 0).mean() > 0.99
    assert held_out_accuracy(quality.score_documents(docs, weights), labels, "quality", 0.7) >= 0.95
    odd = quality.score_documents(spark.createDataFrame(ODD, "doc_id long, text string"), weights).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    untrained = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_documents(docs, untrained).collect()} == {0.5}


def test_repeats_and_shapes_are_features():
    import re

    f = quality.features("Aa Aa Aa BB 12 ***", quality._Tokens(), re.compile(quality.TOKEN))
    assert list(f).count(quality.SAME) == 2 and f[0] == quality.BIAS
    assert [quality.shape(t) for t in ("aa", "Aa", "AA", "12", "***")] == [quality.LOW, quality.CAPITAL, quality.UPPER, quality.DIGIT, quality.MARK]


@pytest.mark.parametrize("name", ["op1_toxicity", "op6_quality"])
def test_queries_keep_the_contract(spark, sf_dir, texts, name):
    import zlib

    got = QUERIES[name](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    at = 0.3 if name == "op1_toxicity" else 0.7
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= at)


def test_the_bound_keeps_the_ratio_of_classes(spark):
    """Of ten documents with the same words one is bad; the scores say so with the cap as without."""
    from sessiongrid.llm.learning import training_sample

    rows = [(i, f"the same words. {'a b c d e f g h'[i % 8 * 2 :]}", int(i % 10 == 0)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "toxic", (1 - F.col("toxic")).alias("quality"))
    sample = training_sample(docs, labels, "toxic", 200).agg(F.count("*"), F.avg("label")).first()
    assert sample[0] == 400 and abs(sample[1] - 0.1) < 0.05
    for kind, label, share in ((toxicity, "toxic", 0.1), (quality, "quality", 0.9)):
        means = [kind.score_documents(docs, kind.train(docs, labels, per_class)).agg(F.avg("score")).first()[0] for per_class in (200, 3000)]
        assert all(abs(m - share) < 0.07 for m in means), (label, means)


def test_the_sample_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    from sessiongrid.llm import learning

    rows = [(1, f"text {k}") for k in range(50)] + [(k, "x" * 100) for k in range(2, 40)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    whole = learning.training_sample(docs, labels, "toxic").collect()
    assert len(whole) == len({r["doc_id"] for r in whole}) and {1, 2} & {r["doc_id"] for r in whole}
    assert len(learning.training_sample(docs, labels, "toxic", per_class=2).collect()) <= 4
    monkeypatch.setattr(learning, "SAMPLE_BYTES", 1000)
    some = learning.training_sample(docs, labels, "toxic").collect()
    assert 5 <= len(some) < len(whole) and sum(len(r["text"]) for r in some) <= 1000
    text_ids = learning.training_sample(docs.withColumn("doc_id", docs.doc_id.cast("string")), labels, "toxic")
    assert {r["doc_id"] for r in text_ids.collect()} <= {str(r["doc_id"]) for r in whole}


def test_scores_equal_slow_ones(spark, texts):
    """The document score is the noisy-or of its sentences, a quality score the logistic of a sum over its features."""
    import math
    import re

    import numpy as np

    from sessiongrid.llm import toxicity

    some = sorted(texts.items())[:60] + [(-1, ""), (-2, None), (-3, "...")]
    weights = np.random.default_rng(3).normal(0, 0.1, toxicity.BUCKETS).astype(np.float32)
    model = toxicity.ToxicityModel(weights, -2.0)
    df = spark.createDataFrame(some, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(df, model).collect()}
    for k, t in some:
        none = 1.0
        for m in re.finditer(toxicity.SENTENCE, t or ""):
            z = sum(float(weights[b]) for w in re.findall(toxicity.WORD, m[0].lower()) for b in toxicity.buckets_of(w)) - 2.0
            none *= 1 - 1 / (1 + math.exp(-min(30, max(-30, z))))
        assert abs(got[k] - (1 - none)) < 1e-5
