"""Quality classifier by supervised subword embeddings.

Every word and every character n-gram of a word has a learned vector in a hashed table; a document is the
average of its words' vectors, a softmax layer gives the class. A word said again right away has the vector
of repetition instead of its own, and five zero vectors keep very short texts near the prior. Trained by stochastic gradient descent in
numpy on a bounded sample of labelled rows (``max_rows``, expected number); every row is scored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.llm.common import fold_of, kept
from moneyflow.llm.subword import WordScores, feature_table, in_order, sampled

SIZES, BITS, SEED = (2, 3), 16, 11
SHAPE = {"pad": 5, "repeats": True}


def as_is(word: str) -> str:
    """Case and signs tell much about quality, so words stay as they are."""
    return word


@dataclass
class QualityModel:
    vectors: np.ndarray  # buckets x dimensions
    output: np.ndarray  # dimensions x 2
    bias: np.ndarray  # 2

    def direction(self) -> np.ndarray:
        """Each bucket's share in the difference of the two logits."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float64)[:, None]


def train(rows: list[tuple], dimensions: int = 16, epochs: int = 12, rate: float = 0.5, seed: int = SEED) -> QualityModel:
    """Stochastic gradient descent over (label, buckets, weights); without rows of both classes it stays neutral."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (1 << BITS, dimensions)).astype(np.float32)
    output, bias = np.zeros((dimensions, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    output[:, 1] = rng.normal(0, 0.1, dimensions)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            label, at, weight = rows[k]
            step = rate * (1 - done / steps)
            own = vectors[at]
            hidden = weight @ own
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[int(label)] -= 1
            back = output @ p
            output -= step * np.outer(hidden, p)
            bias -= 0.1 * step * p
            # a weight is about 1 / features of the document; without the factor the table would hardly move
            vectors[at] = own - (step * 20) * np.outer(weight, back)
            done += 1
    return QualityModel(vectors, output, bias)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = 6000, seed: int = SEED) -> QualityModel:
    """Fit on about ``max_rows`` rows that are labelled and for which ``learn`` (over doc_id) holds.

    Of several labels of a document the least counts. One task of an executor trains; the driver gets the model only.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    total = known.count()
    known = known.where(sampled(F.col("doc_id"), min(1.0, max_rows / max(total, 1)), seed)).groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    sample = feature_table(rows, "label", as_is, SIZES, BITS, **SHAPE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = train(in_order([x for b in batches for x in zip(b["label"], b["at"], b["weight"], strict=True)]), seed=seed)
        yield pd.DataFrame({k: [v.tobytes()] for k, v in vars(model).items()})

    models = sample.coalesce(1).mapInPandas(run, "vectors binary, output binary, bias binary").collect()
    if not models:  # no partition
        return train([], seed=seed)
    vectors, output, bias = (np.frombuffer(x, dtype=np.float32) for x in models[0])
    return QualityModel(vectors.reshape(1 << BITS, -1), output.reshape(-1, 2), bias)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of class 1, in place of any column of that name.

    Texts without words get the bias's probability.
    """
    docs = docs.drop("score")
    weights = docs.sparkSession.sparkContext.broadcast((model.direction(), float(model.bias[1] - model.bias[0])))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        direction, bias = weights.value
        scores = kept(("quality", key), lambda: WordScores(direction, as_is, SIZES, BITS, **SHAPE))
        for b in batches:
            mean, _ = scores.means(["" if t is None else t for t in b[text_col]])
            yield b.assign(score=1 / (1 + np.exp(-(mean[:, 0] + bias))))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double"
    return docs.mapInPandas(run, ddl)


def learning_rows() -> Column:
    return fold_of(F.col("doc_id"), 3) != 1
