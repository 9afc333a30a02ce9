"""Every row of the scoring queries against plain Python: one word, one n-gram, one machine at a time."""

import math
import re
from functools import cache

import numpy as np

from moneyflow.llm import decontam, langid, quality, subword, toxicity
from moneyflow.llm.common import fold_of, table
from moneyflow.llm.queries import op6_decontam, op7_toxicity, op8_langid, op10_quality
from pyspark.sql import functions as F

SF, M = "/root/testdata/sf0.001", (1 << 64) - 1
K = [int(k) for k in subword.K]


def mix(x):
    x = (x ^ x >> 32) * K[3] & M
    return x ^ x >> 29


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


@cache
def buckets(word, sizes, bits):
    c = [ord(x) for x in f"<{word}>"]
    out = [mix(sum(mix(x * K[0] + i * K[1] & M) for i, x in enumerate(c)) & M)]
    for n in sizes:
        for i in range(len(c) - n + 1):
            h = n * K[4] & M
            for x in c[i : i + n]:
                h = mix(h + x * K[0] & M)
            out.append(h)
    return [h & (1 << bits) - 1 for h in out]


def mean_scores(text, weights, clean, sizes, bits, pad=0, repeats=False):
    """A number a model: the mean over words of the mean over their features."""
    total, n, words = np.zeros(weights.shape[1]), 0, text.split()
    for k, raw in enumerate(words):
        w = subword.REPEAT if repeats and raw in words[max(0, k - 2) : k] else clean(raw)
        if w:
            got = buckets(w, sizes, bits)
            total, n = total + weights[got].sum(axis=0) / len(got), n + 1
    return total / max(n + pad, 1)


def texts(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}


def test_quality_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, SF, "labels"), quality.learning_rows())
    direction, bias = model.direction(), float(model.bias[1] - model.bias[0])
    own = texts(spark)
    rows = op10_quality(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(own)
    for r in rows:
        want = sigmoid(mean_scores(own[r.doc_id], direction, quality.as_is, quality.SIZES, quality.BITS, **quality.SHAPE)[0] + bias)
        assert abs(r.score - want) < 1e-6 and r.predicted == (r.score >= 0.5)


def test_toxicity_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, SF, "labels"), toxicity.learning_rows())
    own = texts(spark)

    @cache
    def features(word):
        w = re.sub(r"[\W\d_]+", "", word.lower())
        c = [ord(x) for x in w]
        prefix = lambda n: sum(mix(x * K[0] + i * K[1] & M) for i, x in enumerate(c[:n])) & M
        hashes = [mix(prefix(len(c)))] + [mix(prefix(n) + K[4] & M) for n in toxicity.PREFIXES if n <= len(c)]
        return {h & (1 << toxicity.BITS) - 1 for h in hashes} if w else set()

    rows = op7_toxicity(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(own)
    for r in rows:
        seen = set().union(*(features(w) for w in own[r.doc_id].split()))
        assert abs(r.score - sigmoid(model.bias + sum(float(model.weights[f]) for f in seen))) < 1e-5


def test_language_rows(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs, fold_of(F.col("doc_id"), 3) != 1)
    own = texts(spark)

    def vote(classes, machines, text):
        if len(classes) == 1:
            return classes[0], 1.0
        wins, prob = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0)
        for m in machines:
            margin = mean_scores(text, m.weights.astype(float)[:, None], langid.letters, langid.SIZES, langid.BITS)[0]
            p = sigmoid(m.slope * margin + m.shift)
            wins[m.yes if margin >= 0 else m.no] += 1
            prob[m.yes] += p
            prob[m.no] += 1 - p
        best = max(classes, key=lambda c: (wins[c] + prob[c] / (2 * len(classes)), -classes.index(c)))
        return best, prob[best] / (len(classes) - 1)

    rows = op8_langid(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(own)
    for r in rows[:120]:
        text = own[r.doc_id]
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        family, p = vote(sorted(model.families), model.first, text)
        code, q = vote(model.families[family], model.second.get(family, []), text)
        assert r.lang_pred == code and abs(r.score - p * q) < 1e-5


def test_language_scores_are_calibrated(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    held = [(r.score, r.lang_pred == truth[r.doc_id]) for r in op8_langid(spark, sf).collect() if r.held_out and r.lang_pred != "und"]
    assert abs(np.mean([s for s, _ in held]) - np.mean([ok for _, ok in held])) < 0.1
    low, high = ([ok for s, ok in held if (s >= 0.9) == sure] for sure in (False, True))
    assert not low or np.mean(low) <= np.mean(high)


def test_contamination_rows(spark):
    """All documents against all items by the bit-parallel distance over whole texts, which other tests hold against dynamic programming."""
    items = [(r.item_id, decontam.normal(r.text or "")) for r in table(spark, SF, "benchmark").collect()]
    want = {}
    for r in table(spark, SF, "documents").collect():
        t = decontam.normal(r.text or "")
        for name, text in items:
            item = decontam.make_item(name, text, decontam.RATE)
            if text and len(text) >= decontam.MIN_CHARS and (best := decontam.best_match(item, t)[0]) <= item.budget:
                want[r.doc_id, name] = best
    got = {(r.doc_id, r.item_id): r.distance for r in op6_decontam(spark, SF).collect()}
    assert got == want and want


def test_edited_items_are_found_in_tables(spark):
    import random

    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(n))
    items = [(k, say(20)) for k in range(6)] + [(99, "ten chars!")]
    rows, want = [], set()
    for i in range(60):
        k, text = rng.choice(items[:6])
        chars, budget = list(text), int(decontam.RATE * len(text))
        edits = rng.choice([0, 1, budget, budget + 12])
        for at in rng.sample(range(len(chars)), edits):
            chars[at] = "#"
        t = f"{say(15)} {''.join(chars)} {say(15)}" + (" Ten  CHARS!" if i % 7 == 0 else " tten chars!!")
        rows.append((i, t))
        for name, x in items[:6]:
            item = decontam.make_item(name, x, decontam.RATE)
            if (d := decontam.best_match(item, decontam.normal(t))[0]) <= item.budget:
                want.add((i, name, d))
        if i % 7 == 0:
            want.add((i, 99, 0))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.distance) for r in decontam.contaminations(docs, bench).collect()} == want and any(d for _, _, d in want)
    big = spark.createDataFrame([(1, say(40_000) + " " + items[0][1] + " " + say(40_000)), (2, "z" * 2_000_000)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.distance) for r in decontam.contaminations(big, bench).collect()} >= {(1, 0, 0)}
