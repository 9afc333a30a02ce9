"""Language identification in two steps: the family first, then the language within it.

Both steps are linear support vector machines, one against one, over hashed words and letter n-grams. The
machines of the first step tell families apart; those within a family tell its languages apart. Fitted by
subgradient descent on the hinge loss in numpy, on a bounded sample of rows a language
(``max_rows_a_language``, expected number); a logistic curve on each machine's margin gives the score.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.llm.common import kept
from moneyflow.llm.subword import WordScores, feature_rows, sampled

SIZES, BITS, SEED = (1, 2, 3), 16, 7
#: Families of languages by ISO 639-1 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sd si ur",
    "semitic": "am ar he mt ti",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else NOT_LETTERS.sub("", word.lower())


@dataclass
class Machine:
    """Positive margins speak for ``yes``; ``slope`` and ``shift`` turn a margin into a probability."""

    yes: str
    no: str
    weights: np.ndarray
    slope: float
    shift: float


@dataclass
class LanguageModel:
    languages: list[str]
    families: dict[str, list[str]]
    first: list[Machine]
    second: dict[str, list[Machine]]

    def machines(self) -> list[Machine]:
        return [*self.first, *(m for f in sorted(self.second) for m in self.second[f])]


def train_machine(yes: str, no: str, rows: list[tuple], sign: np.ndarray, epochs: int = 8, seed: int = SEED) -> Machine:
    """Subgradient descent with averaging; classes weigh the same whatever their size."""
    rng = np.random.default_rng(seed)
    w, total = np.zeros(1 << BITS, dtype=np.float32), np.zeros(1 << BITS, dtype=np.float64)
    share = {s: len(sign) / (2 * max(1, int((sign == s).sum()))) for s in (1, -1)}
    norms = np.array([max(float(np.sqrt((v * v).sum())), 1e-6) for _, _, v in rows])
    done = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(rows)):
            _, at, v = rows[k]
            if sign[k] * float(w[at] @ v) / norms[k] < 1:
                w[at] += (0.5 / (1 + epoch)) * share[int(sign[k])] * sign[k] * v / norms[k]
            done += 1
        w *= 0.999
        total += w
    w = total / epochs
    margin = np.array([float(w[at] @ v) for _, at, v in rows])
    slope, shift, y = 1 / max(float(np.abs(margin).mean()), 1e-9), 0.0, (sign > 0).astype(float)
    scale = slope
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        slope -= 0.5 * scale * float(((p - y) * margin * scale).mean())
        shift -= 0.5 * float((p - y).mean())
    return Machine(yes, no, w, max(slope, 1e-9), shift)


def train(rows: list[tuple], seed: int = SEED) -> LanguageModel:
    """From (language, buckets, weights)."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    families: dict[str, list[str]] = defaultdict(list)
    for code in languages:
        families[FAMILY_OF.get(code, f"other:{code}")].append(code)
    family_of = {code: f for f, codes in families.items() for code in codes}

    def pairs(classes: list[str], of) -> list[Machine]:
        out = []
        for a, b in itertools.combinations(classes, 2):
            own = [r for r in rows if of(r[0]) in (a, b)]
            out.append(train_machine(a, b, own, np.array([1 if of(r[0]) == a else -1 for r in own]), seed=seed))
        return out

    second = {f: pairs(codes, lambda x: x) for f, codes in families.items() if len(codes) > 1}
    return LanguageModel(languages, dict(families), pairs(sorted(families), family_of.get), second)


def fit(docs: DataFrame, learn: Column, max_rows_a_language: int = 1500, seed: int = SEED) -> LanguageModel:
    """Fit on the rows with a language and a text for which ``learn`` (over doc_id) holds."""
    own = docs.select(F.col("doc_id"), "text", F.col("lang").alias("label")).where(F.col("label").isNotNull() & F.col("text").isNotNull() & learn)
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    chosen = F.lit(False)
    for code, n in sorted(counts.items()):
        chosen = chosen | ((F.col("label") == code) & sampled(F.col("doc_id"), min(1.0, max_rows_a_language / n), seed))
    return train(feature_rows(own.where(chosen), "label", letters, SIZES, BITS), seed)


def _vote(classes: list[str], machines: list[tuple[Machine, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the class with most wins for each row (ties: larger sum of probabilities), and its mean probability."""
    if len(classes) == 1:
        return np.zeros(n, dtype=np.int64), np.ones(n)
    wins, prob = np.zeros((n, len(classes))), np.zeros((n, len(classes)))
    for m, margin in machines:
        p = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30)))
        a, b = classes.index(m.yes), classes.index(m.no)
        wins[:, a] += margin >= 0
        wins[:, b] += margin < 0
        prob[:, a] += p
        prob[:, b] += 1 - p
    best = (wins + prob / (2 * len(classes))).argmax(axis=1)
    return best, prob[np.arange(n), best] / (len(classes) - 1)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, in place of any columns of those names.

    Null texts and texts without a letter are ``und`` with score 0.
    """
    docs = docs.drop("lang_pred", "score")
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        machines = model.machines()
        weights = np.stack([m.weights for m in machines], axis=1) if machines else np.zeros((1 << BITS, 1))
        words = kept(("langid", key), lambda: WordScores(weights, letters, SIZES, BITS))
        families = sorted(model.families)
        for b in batches:
            texts = ["" if t is None else t for t in b[text_col]]
            mean, _ = words.means(texts)
            known = np.array([LETTER.search(t) is not None for t in texts], dtype=bool) & bool(model.languages)
            lang, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if known.any():
                own = mean[known]
                columns = dict(zip([(m.yes, m.no) for m in machines], own.T, strict=False))
                best, p = _vote(families, [(m, columns[m.yes, m.no]) for m in model.first], len(own))
                found, chance = np.full(len(own), "", dtype=object), np.zeros(len(own))
                for k, f in enumerate(families):
                    here = best == k
                    codes = model.families[f]
                    which, q = _vote(codes, [(m, columns[m.yes, m.no][here]) for m in model.second.get(f, [])], int(here.sum()))
                    found[here], chance[here] = np.array(codes, dtype=object)[which], p[here] * q
                lang[known], score[known] = found, chance
            yield b.assign(lang_pred=lang, score=score)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, score double"
    return docs.mapInPandas(run, ddl)
