"""Quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a document are the distinct hashed word unigrams and bigrams, the bigrams of word shapes, and one bucket
for a word that repeats its predecessor. The L1 term of the FTRL-proximal updates leaves few weights; scoring is a
sparse dot product.

Null and empty texts have the bias feature alone. Repeated rows score alike; documents without an id are scored but
never learnt from; with no labelled rows every score is 0.5. ``score_documents`` keeps other columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .learning import SAMPLE_PER_CLASS, training_sample

BUCKETS = 1 << 20
TOKEN = r"\w+|[^\w\s]+"
#: FTRL-proximal parameters.
ALPHA, BETA, L1, L2 = 0.1, 1.0, 1.0, 1.0
LOW, CAPITAL, UPPER, DIGIT, MARK = range(5)
#: Buckets with a fixed meaning: bias and a repeated word.
BIAS, SAME = 0, 1


def shape(token: str) -> int:
    if token.isdigit():
        return DIGIT
    if not (token[0].isalnum() or token[0] == "_"):
        return MARK
    if token.isupper():
        return UPPER
    return CAPITAL if token[0].isupper() else LOW


class _Tokens(dict):
    """Hash and shape of each distinct token, packed into one integer."""

    LIMIT = 400_000

    def __missing__(self, token: str) -> int:
        value = zlib.crc32(token.encode("utf-8", "surrogatepass")) << 3 | shape(token)
        if len(self) < self.LIMIT:
            self[token] = value
        return value


def features(text: str, tokens: _Tokens, pattern: re.Pattern) -> np.ndarray:
    """Buckets of all n-grams, repeats included; the bias is bucket 0."""
    found = pattern.findall(text)
    packed = np.fromiter(map(tokens.__getitem__, found), np.uint64, len(found))
    word, kind = packed >> np.uint64(3), packed & np.uint64(7)
    mix = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(BUCKETS - 8) + np.uint64(8)
    pair = np.where(word[1:] == word[:-1], np.uint64(SAME), mix(word[:-1] * np.uint64(31) + word[1:] + np.uint64(1 << 40)))
    shapes = mix(kind[:-1] * np.uint64(8) + kind[1:] + np.uint64(1 << 50))
    return np.concatenate([np.array([BIAS], np.uint64), mix(word), pair, shapes]).astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, pattern = _Tokens(), re.compile(TOKEN)
    for batch in batches:
        feats = [np.unique(features(t, tokens, pattern)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(feats, pa.list_(pa.int32()))], names=["label", "features"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, epochs: int = 3) -> np.ndarray:
    """Weights by bucket, from one FTRL-proximal update for each document and epoch of the bounded sample."""
    sample = training_sample(docs, labels, "quality", per_class).orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "label")
    got = sample.mapInArrow(_rows, "label int, features array<int>").toArrow().combine_chunks()
    y = got.column("label").to_numpy()
    feats = [x.values.to_numpy() for x in got.column("features")]
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    order = np.random.default_rng(42)
    for _ in range(epochs):
        for i in order.permutation(len(y)):
            f = feats[i]
            w = _leader(z[f], n[f])
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[i]
            z[f] += g - (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / ALPHA * w
            n[f] += g * g
    return _leader(z, n).astype(np.float32)


def _leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the sums of gradients lead to; exactly 0 within the L1 term."""
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def score_documents(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """docs with ``score``, the probability of good quality."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "score"])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, pattern, w = _Tokens(), re.compile(TOKEN), shared.value
        for batch in batches:
            scores = []
            for value in batch.column(batch.schema.get_field_index(text_col)):
                f = features(value.as_py() or "", tokens, pattern)
                f = np.unique(f[w[f] != 0])
                scores.append(float(1 / (1 + np.exp(-np.clip(w[f].sum(dtype=float), -30, 30)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return kept.mapInArrow(run, schema)
