"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a sample of all text, toxic or not, is unlabelled. The risk of
a classifier g with class prior pi is  pi R_p(+) + max(0, R_u(-) - pi R_p(-))  (Kiryo et al., 2017): what the
unlabelled text holds of the positive class is taken out of its negative risk, and the difference is not let
below zero. g is linear over the distinct words of a document and their prefixes, trained in numpy.

Both samples are bounded (``max_positive``, ``max_unlabelled``: expected numbers); every row is scored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.llm.common import fold_of, kept
from moneyflow.llm.subword import MAX_FEATURES, STEP_CHARS, K, bounded_sample, code_points, mixed, sampled

BITS, SEED, PREFIXES = 18, 5, (4, 5, 6, 7)
SIGNS = re.compile(r"[\W\d_]+")


def folded(word: str) -> str:
    """Case-folded and without signs and digits."""
    w = word.lower()
    return w if w.isalpha() else SIGNS.sub("", w)


def word_features(words: list[str]) -> np.ndarray:
    """Buckets of folded, non-empty words: a row for each word, the word first, then its prefixes (-1: too short)."""
    points, n = code_points(words)
    starts, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
    place = np.arange(len(points)) - starts[owner]
    with np.errstate(over="ignore"):
        sums = np.cumsum(mixed(points * K[0] + place.astype(np.uint64) * K[1]), dtype=np.uint64)
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        columns = [mixed(sums[starts + n - 1] - before)]
        for size in PREFIXES:
            prefix = sums[starts + np.minimum(size, n) - 1] - before
            columns.append(mixed(prefix + K[4]))
    out = (np.stack(columns, axis=1) & np.uint64((1 << BITS) - 1)).astype(np.int32)
    for k, size in enumerate(PREFIXES, 1):
        out[n < size, k] = -1
    return out


def text_features(text: str) -> np.ndarray:
    """Distinct buckets of a whole text."""
    words = sorted({x for w in set(text.split()) if (x := folded(w))})
    if not words:
        return np.zeros(0, dtype=np.int32)
    out = np.unique(word_features(words))
    return out[out >= 0]


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by bucket
    bias: float


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, features: int = 96, steps: int = 300, l1: float = 0.05) -> ToxicityModel:
    """The non-negative estimator with the logistic loss, by proximal Adam steps; neutral without both samples.

    Weights go to the ``features`` words and prefixes that are most over-represented among the positives, by
    the z-score of the difference in document rates: in long texts, many weak features would add up to noise.
    """
    weights = np.zeros(1 << BITS, dtype=np.float32)
    if not positive or not unlabelled:
        return ToxicityModel(weights, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))

    def counts(sets: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(sets), minlength=1 << BITS).astype(float)

    p, u = counts(positive), counts(unlabelled)
    rate_p, rate_u = (p + 0.5) / (len(positive) + 1), (u + 0.5) / (len(unlabelled) + 1)
    spread = np.sqrt(rate_u * (1 - rate_u) * (1 / len(positive) + 1 / len(unlabelled)))
    z = np.where(p + u >= 5, (rate_p - rate_u) / spread, 0)
    chosen = np.argsort(-z, kind="stable")[:features]
    chosen = chosen[z[chosen] > 4]
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))

    def matrix(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(chosen)), dtype=np.float32)
        for row, s in zip(out, sets, strict=True):
            at = place[s]
            row[at[at >= 0]] = 1
        return out

    xp, xu = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(chosen), dtype=np.float64), -1.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):
        sp, su = 1 / (1 + np.exp(-np.clip(xp @ w + b, -30, 30))), 1 / (1 + np.exp(-np.clip(xu @ w + b, -30, 30)))
        negative = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
        up, uu = prior * (sp - 1) / len(sp), np.zeros(len(su))  # slope of pi R_p(+)
        minus_p, minus_u = -prior * sp / len(sp), su / len(su)  # slope of R_u(-) - pi R_p(-)
        # below zero the difference is over-fitted, and its slope is followed backwards alone
        up, uu = (up + minus_p, uu + minus_u) if negative >= 0 else (-minus_p, -minus_u)
        grad = np.concatenate((up @ xp + uu @ xu, [up.sum() + uu.sum()]))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - 0.05 * l1, 0)
    weights[chosen] = w
    return ToxicityModel(weights, float(b))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_positive: int = 3000, max_unlabelled: int = 6000, seed: int = SEED, max_features: int = MAX_FEATURES) -> ToxicityModel:
    """Fit on rows for which ``learn`` (over doc_id) holds; the prior is the share of toxic rows among labelled ones.

    A document with labels of both kinds is toxic.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    n, n_toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(F.col("doc_id").isNotNull() & learn)
    total = texts.select("doc_id").count()
    confirmed = known.where((F.col("toxic") == 1) & sampled(F.col("doc_id"), min(1.0, max_positive / max(n_toxic, 1)), seed)).select("doc_id").distinct()
    positive = texts.join(F.broadcast(confirmed), "doc_id").select(F.lit(1).alias("kind"), "text")
    unlabelled = texts.where(sampled(F.col("doc_id"), min(1.0, max_unlabelled / max(total, 1)), seed + 1)).select(F.lit(0).alias("kind"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"kind": b["kind"], "at": [text_features(t).tobytes() for t in b["text"]]})

    rows = [r for part, share in ((positive, 3), (unlabelled, 1)) for r in bounded_sample(part.mapInPandas(run, "kind int, at binary"), max_features * share // 4)]
    sets = sorted((r["kind"], bytes(r["at"])) for r in rows)
    own = lambda kind: [np.frombuffer(x, dtype=np.int32) for k, x in sets if k == kind]
    return train(own(1), own(0), n_toxic / max(n, 1))


class WordWeights:
    """word -> ((feature, weight), ...) for its features with a weight; computed for all new words of a batch at once."""

    def __init__(self, model: ToxicityModel, room: int = 500_000):
        self.model, self.room = model, room
        self.known: dict[str, tuple] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > self.room:
            self.known = {}
        new = sorted(words.difference(self.known))
        self.known.update(dict.fromkeys(new, ()))
        clean = [(w, x) for w in new if (x := folded(w))]
        if clean:
            found = word_features([x for _, x in clean])
            weight = np.where(found >= 0, self.model.weights[found], 0)
            for k in np.flatnonzero((weight != 0).any(axis=1)).tolist():
                self.known[clean[k][0]] = tuple((int(f), float(x)) for f, x in zip(found[k], weight[k], strict=True) if x)

    def sums(self, texts: list[str]) -> list[float]:
        """Sum of the weights of each text's distinct features."""
        out, at = [], 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= STEP_CHARS):
                size, to = size + len(texts[to]), to + 1
            sets = [set(t.split()) for t in texts[at:to]]
            self.learn(set().union(*sets))
            known = self.known
            for words in sets:
                out.append(sum(dict(x for w in words if (got := known[w]) for x in got).values()))
            at = to
        return out


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability that a text is toxic, in place of any column of that name.

    Null and empty texts get the bias's probability.
    """
    docs = docs.drop("score")
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = kept(("toxicity", key), lambda: WordWeights(shared.value))
        for b in batches:
            total = np.array(words.sums([t or "" for t in b[text_col]]), dtype=float) + shared.value.bias
            yield b.assign(score=1 / (1 + np.exp(-np.clip(total, -30, 30))))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double"
    return docs.mapInPandas(run, ddl)


def learning_rows() -> Column:
    return fold_of(F.col("doc_id"), 5) != 0
