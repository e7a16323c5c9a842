"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in hashed words and word stems; a document's score is
the noisy-or of its sentences, 1 - prod(1 - p). Only documents have labels: the likelihood of the bag trains the
sentence model, which then locates the offending sentences.

Null and empty texts have no sentences and score 0. Repeated rows score alike. Documents without an id are scored but
never learnt from. Without labelled rows the model knows nothing and scores every text near 0. The outputs replace
columns of the same names; other columns pass through ``score_documents``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .learning import SAMPLE_PER_CLASS, training_sample

BUCKETS = 1 << 19
SENTENCE, WORD = r"[^.!?\n]+", r"\w+"
#: Lengths of the beginnings of longer words that count as stems.
STEMS = (3, 4, 5, 6, 7)
#: A sentence is offending from this score on.
OFFENDING = 0.5
START_BIAS = -5.0
#: Documents of the sample that a bucket must occur in, and the L1 penalty of its weight.
MIN_DOCS, L1 = 4, 1e-4


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # float32, one for each bucket
    bias: float


def buckets_of(word: str) -> list[int]:
    """A word's own bucket and those of its stems, the beginnings that it goes beyond."""
    crc = lambda mark, x: zlib.crc32(mark + x.encode("utf-8", "surrogatepass")) % BUCKETS
    return [crc(b"", word), *(crc(b"^", word[:k]) for k in STEMS if k < len(word))]


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, feature buckets, where sentences begin) of each document that has words."""
    sentence, word = re.compile(SENTENCE), re.compile(WORD)
    seen: dict[str, list[int]] = {}
    for batch in batches:
        ys, feats, starts = [], [], []
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f, s = [], []
            for part in sentence.findall(text.lower()):
                if words := word.findall(part):
                    s.append(len(f))
                    for w in words:
                        if w not in seen:
                            seen[w] = buckets_of(w)
                        f.extend(seen[w])
            if s:
                ys.append(y)
                feats.append(f)
                starts.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(ys, pa.int32()), pa.array(feats, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32()))], names=["label", "features", "starts"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, epochs: int = 20, rate: float = 0.3, batch_docs: int = 128) -> ToxicityModel:
    """Fit by Adagrad on the bounded sample of labelled documents (numpy on the driver)."""
    sample = training_sample(docs, labels, "toxic", per_class).orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "label")
    got = sample.mapInArrow(_bags, "label int, features array<int>, starts array<int>").toArrow().combine_chunks()
    weights, bias = np.zeros(BUCKETS, np.float64), START_BIAS
    squares, bias_square = np.full(BUCKETS, 1e-3), 1e-3
    y_all = got.column("label").to_numpy().astype(float)
    feats = [x.values.to_numpy() for x in got.column("features")]
    starts = [x.values.to_numpy() for x in got.column("starts")]
    if len(y_all):
        # What few documents have in common is chance; only buckets of several documents may carry weight.
        seen_in = np.bincount(np.concatenate([np.unique(f) for f in feats]), minlength=BUCKETS)
        useful = seen_in >= MIN_DOCS
    order = np.random.default_rng(42)
    for _ in range(epochs if len(y_all) else 0):
        shuffled = order.permutation(len(y_all))
        for lo in range(0, len(shuffled), batch_docs):
            some = shuffled[lo : lo + batch_docs]
            f = np.concatenate([feats[i] for i in some])
            sizes = np.array([len(feats[i]) for i in some])
            begin = np.concatenate([starts[i] + at for i, at in zip(some, np.cumsum(sizes) - sizes)])
            of_doc = np.repeat(np.arange(len(some)), [len(starts[i]) for i in some])
            length = np.diff(np.concatenate([begin, [len(f)]]))
            z = np.clip(np.add.reduceat(weights[f], begin) + bias, -30, 30)
            p = 1 / (1 + np.exp(-z))
            none = np.exp(np.bincount(of_doc, weights=np.log1p(-p), minlength=len(some)))  # no sentence is toxic
            y = y_all[some]
            slope = np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0)[of_doc] * p / len(some)
            grad = np.bincount(f, weights=np.repeat(slope, length), minlength=BUCKETS)
            hit = np.flatnonzero((grad != 0) & useful)
            squares[hit] += grad[hit] ** 2
            step = rate / np.sqrt(squares[hit])
            moved = weights[hit] - step * grad[hit]
            weights[hit] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
            bias_square += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(bias_square)
    return ToxicityModel(weights.astype(np.float32), float(bias))


class _Weights(dict):
    """Summed weights by word, looked up in the hashed table once for each distinct word."""

    LIMIT = 100_000

    def __init__(self, table: np.ndarray):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        value = float(sum(self.table[b] for b in buckets_of(word)))
        if len(self) < self.LIMIT:
            self[word] = value
        return value


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """docs with ``score`` and ``offending``: start, end (code points) and score of each offending sentence."""
    spark = docs.sparkSession
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "offending")])
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("offending", T.ArrayType(span))])
    shared, bias = spark.sparkContext.broadcast(model.weights), model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentence, word = re.compile(SENTENCE), re.compile(WORD)
        weight = _Weights(shared.value)
        look = weight.__getitem__
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(batch.schema.get_field_index(text_col)):
                text = value.as_py() or ""
                places, z = [], []
                for m in sentence.finditer(text):
                    places.append(m.span())
                    z.append(sum(map(look, word.findall(m[0].lower()))))
                p = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=float) + bias, -30, 30)))
                scores.append(float(-np.expm1(np.log1p(-p).sum())))
                spans.append([{"start": a, "end": b, "score": float(s)} for (a, b), s in zip(places, p) if s >= OFFENDING] if len(p) and p.max() >= OFFENDING else [])
            fields = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, fields)], names=schema.names)

    return kept.mapInArrow(run, schema)
