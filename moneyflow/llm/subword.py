"""Hashed subword features, additive over words: what the linear text models of this subpackage share.

A document's features are the mean over its words of the mean over a word's features. A linear model's
score is then the mean of one number a word, which is computed once for each distinct word and kept; whole
texts are scored at the speed of a dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.llm.common import stash

#: Text of one scoring step, in characters.
STEP_CHARS = 1 << 20


K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mixed(x: np.ndarray) -> np.ndarray:
    """An invertible scrambling of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * K[3]
        return x ^ (x >> np.uint64(29))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all words as numbers, and the words' lengths."""
    n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64), n


def buckets_of(words: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the word) for every word itself and its n-grams between boundary signs."""
    points, n = code_points([f"<{w}>" for w in words])
    starts, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
    place, left = np.arange(len(points)) - starts[owner], n[owner]
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mixed(points * K[0] + place.astype(np.uint64) * K[1]), starts)
        out, owners = [mixed(whole)], [np.arange(len(n))]
        for size in sizes:
            at = np.flatnonzero(place + size <= left)
            h = np.full(len(at), size, dtype=np.uint64) * K[4]
            for k in range(size):
                h = mixed(h + points[at + k] * K[0])
            out.append(h)
            owners.append(owner[at])
    return (np.concatenate(out) & np.uint64((1 << bits) - 1)).astype(np.int64), np.concatenate(owners)


#: Stands for a word that is one of the two words before it, where repeats count.
REPEAT = "\x01"


def document_features(
    text: str, clean: Callable[[str], str], sizes: tuple[int, ...], bits: int, pad: int = 0, repeats: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, weight) of a whole text: sparse, never longer than the number of buckets; empty without words.

    The mean is taken over the words and ``pad`` words without features, which keeps short texts near
    nothing. With ``repeats``, a word that is one of the two before it counts as the word REPEAT.
    """
    words: dict[str, int] = {}
    before = last = None
    for raw in text.split():
        w = REPEAT if repeats and raw in (last, before) else clean(raw)
        before, last = last, raw
        if w:
            words[w] = words.get(w, 0) + 1
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    bucket, owner = buckets_of(list(words), sizes, bits)
    share = np.array(list(words.values())) / ((sum(words.values()) + pad) * np.bincount(owner))
    dense = np.bincount(bucket, weights=share[owner], minlength=1 << bits)
    at = np.flatnonzero(dense)
    return at.astype(np.int32), dense[at].astype(np.float32)


#: Features of a sample that come to the driver at most, of eight bytes each.
MAX_FEATURES = 1 << 24


def bounded(rows: DataFrame, max_features: int) -> DataFrame:
    """Rows with ``at`` (the buckets as bytes), staged, in the order of a hash of these, as long as they hold
    ``max_features`` in all. Rows that are alike in ``at`` go or stay together."""
    rows = stash(rows.withColumn("place", F.xxhash64("at")), "features")
    sizes = sorted((r["place"], r["n"]) for r in rows.select("place", (F.length("at") / 4).cast("long").alias("n")).collect())  # two numbers a row
    total, last = 0, None
    for k, (place, n) in enumerate(sizes):
        total += n
        if total > max_features:
            break
        if k + 1 == len(sizes) or sizes[k + 1][0] != place:
            last = place
    return rows.where(F.col("place") <= F.lit(last).cast("long")).drop("place")


def bounded_sample(rows: DataFrame, max_features: int) -> list:
    """The ``bounded`` rows; the driver gets no more bytes than that."""
    return bounded(rows, max_features).collect()


def feature_table(
    docs: DataFrame, label: str, clean: Callable, sizes: tuple[int, ...], bits: int, pad: int = 0, repeats: bool = False, max_features: int = MAX_FEATURES
) -> DataFrame:
    """(label, at, weight) of the rows of a bounded sample, made on the executors; buckets and weights as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [document_features(t, clean, sizes, bits, pad, repeats) for t in b["text"]]
            yield pd.DataFrame({"label": b["label"], "at": [x.tobytes() for x, _ in got], "weight": [y.tobytes() for _, y in got]})

    out = docs.select(F.col(label).cast("string").alias("label"), F.coalesce("text", F.lit("")).alias("text"))
    return bounded(out.mapInPandas(run, "label string, at binary, weight binary"), max_features)


def in_order(rows: list[tuple]) -> list[tuple]:
    """(label, buckets, weights) of rows with bytes, in the same order whatever the partitions."""
    rows.sort()
    return [(label, np.frombuffer(at, dtype=np.int32), np.frombuffer(weight, dtype=np.float32)) for label, at, weight in rows]


def feature_rows(docs: DataFrame, label: str, clean: Callable, sizes: tuple[int, ...], bits: int, **how) -> list[tuple]:
    """(label, buckets, weights) of the rows of a ``feature_table``."""
    rows = feature_table(docs, label, clean, sizes, bits, **how).collect()
    return in_order([(r["label"], bytes(r["at"]), bytes(r["weight"])) for r in rows])


def sampled(key: Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the rows, by a hash of the key."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int(fraction * (1 << 30))


class WordScores:
    """Scores of words, computed for all new words of a step at once and kept while there is room."""

    def __init__(
        self, weights: np.ndarray, clean: Callable[[str], str], sizes: tuple[int, ...], bits: int, room: int = 400_000, pad: int = 0, repeats: bool = False
    ):
        self.weights, self.clean, self.sizes, self.bits, self.room, self.pad, self.repeats = weights, clean, sizes, bits, room, pad, repeats
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, self.weights.shape[1] + 1))  # sums of the models' weights; whether the word counts

    def _learn(self, new: list[str]) -> None:
        first = len(self.place)
        while first + len(new) > len(self.rows):
            self.rows = np.concatenate((self.rows, np.zeros_like(self.rows)))
        cleaned = [self.clean(w) for w in new]
        some = np.array([k for k, w in enumerate(cleaned) if w], dtype=np.int64)
        if len(some):
            bucket, owner = buckets_of([cleaned[k] for k in some], self.sizes, self.bits)
            n = np.bincount(owner)
            for m in range(self.weights.shape[1]):
                self.rows[first + some, m] = np.bincount(owner, weights=self.weights[bucket, m]) / n
            self.rows[first + some, -1] = 1
        self.place.update(zip(new, range(first, first + len(new)), strict=True))

    def means(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean word scores of each text (zeros without words), and its number of words."""
        out = np.zeros((len(texts), self.rows.shape[1]))
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to]) <= STEP_CHARS):
                size, to = size + len(texts[to]), to + 1
            words = [t.split() for t in texts[at:to]]
            n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            flat = [w for x in words for w in x]
            if len(self.place) > self.room:
                self._forget()
            new = set(flat).difference(self.place)
            if new:
                self._learn(sorted(new))
            index = np.fromiter(map(self.place.__getitem__, flat), dtype=np.int64, count=len(flat))
            if self.repeats:
                if REPEAT not in self.place:
                    self._learn([REPEAT])
                text = np.repeat(np.arange(len(n)), n)
                again = np.zeros(len(index), dtype=bool)
                for lag in (1, 2):
                    again[lag:] |= (index[lag:] == index[:-lag]) & (text[lag:] == text[:-lag])
                index[again] = self.place[REPEAT]
            some = np.flatnonzero(n)
            if len(some):
                starts = np.concatenate(([0], np.cumsum(n)[:-1]))[some]
                out[at + some] = np.add.reduceat(self.rows[index], starts, axis=0)
            at = to
        count = out[:, -1]
        return out[:, :-1] / np.maximum(count + self.pad, 1)[:, None], count
