"""Held-out accuracy of the three classifiers, the risk estimator, and edge cases."""

import zlib

import numpy as np
import pytest

from moneyflow.llm import langid, quality, subword, toxicity
from moneyflow.llm.queries import op7_toxicity, op8_langid, op10_quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    return docs, {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def accuracy(rows, label):
    known = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    return np.mean([a == b for a, b in known]), len(known)


def test_quality(spark, truth):
    rows = op10_quality(spark, SF).collect()
    assert len(rows) == len(truth[0]) and all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    share, n = accuracy(rows, {i: r.quality for i, r in truth[1].items()})
    assert n > 80 and share > 0.9


def test_toxicity(spark, truth):
    rows = op7_toxicity(spark, SF).collect()
    assert len(rows) == len(truth[0]) and all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    share, n = accuracy(rows, {i: r.toxic for i, r in truth[1].items()})
    assert n > 50 and share > 0.85


def test_language(spark, truth):
    rows = op8_langid(spark, SF).collect()
    held = [(r.lang_pred, truth[0][r.doc_id].lang) for r in rows if r.held_out]
    assert len(rows) == len(truth[0]) and np.mean([a == b for a, b in held]) > 0.97


def test_hashed_features_are_additive():
    text = "Some words, some MORE words; straße ñandú"
    w = np.random.default_rng(1).normal(size=(1 << 16, 2))
    got, n = subword.WordScores(w, langid.letters, (1, 2, 3), 16, room=3).means([text, "", "123 --", text])
    at, v = subword.document_features(text, langid.letters, (1, 2, 3), 16)
    assert np.allclose(got[0], w[at].T @ v, atol=1e-5) and (got[0] == got[3]).all() and n.tolist() == [7, 0, 0, 7] and (got[1:3] == 0).all()
    assert abs(v.sum() - 1) < 1e-5
    text = "go go go on, on and on\nand on"
    got, n = subword.WordScores(w, quality.as_is, (2, 3), 16, **quality.SHAPE).means(["go", text, "x"])
    at, v = subword.document_features(text, quality.as_is, (2, 3), 16, **quality.SHAPE)
    assert np.allclose(got[1], w[at].T @ v, atol=1e-5) and abs(v.sum() - 9 / 14) < 1e-5


def test_non_negative_risk_ignores_positives_among_unlabelled():
    rng = np.random.default_rng(3)

    def docs(n, toxic):
        return [np.unique(np.concatenate((rng.integers(100, 2000, 40), [7, 8] if t else []))).astype(np.int32) for t in toxic[:n]]

    unl = rng.random(2000) < 0.2
    m = toxicity.train(docs(400, np.ones(400, bool)), docs(2000, unl), 0.2)
    test = rng.random(500) < 0.3
    got = [m.bias + m.weights[d].sum() > 0 for d in docs(500, test)]
    assert np.mean(got == test) > 0.97
    assert not toxicity.train([], docs(5, unl), 0.2).weights.any()


def test_word_weights_equal_text_features():
    m = toxicity.ToxicityModel(np.random.default_rng(0).normal(size=1 << toxicity.BITS).astype(np.float32), 0.5)
    texts = ["Some idiot, some IDIOT! idiotic", "", "1 2 3", "ab abc abcd abcdefghij"]
    for t, got in zip(texts, toxicity.WordWeights(m).sums(texts), strict=True):
        assert abs(got - float(m.weights[toxicity.text_features(t)].sum())) < 1e-4


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 34", "x"), (None, "word " * 50_000, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for rows in (
        quality.score(docs, quality.fit(docs, labels, quality.learning_rows())),
        toxicity.score(docs, toxicity.fit(docs, labels.where("false"), toxicity.learning_rows())),
        langid.predict(docs, langid.fit(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "1 AS label"), quality.learning_rows())),
    ):
        got = rows.collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
        assert "lang_pred" not in rows.columns or {r.lang_pred for r in got} == {"und"}
    model = langid.train([("en", *subword.document_features(t, langid.letters, langid.SIZES, langid.BITS)) for t in ("the and", "of the")])
    assert [r.lang_pred for r in langid.predict(docs.where("doc_id IS NOT NULL").orderBy("doc_id"), model).collect()] == ["und", "und", "und"]
    assert quality.score(docs.where("false"), quality.train([])).count() == 0
