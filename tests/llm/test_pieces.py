"""Lossless, reproducible, and drawn with the lattice's probabilities."""

from collections import Counter

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings, strategies as st

from moneyflow.llm import pieces
from moneyflow.llm.queries import op5_pieces

PATH = P.path("piece_bpe_32k.model")
SAMPLER = pieces.PieceSampler(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab ▁\n日é😀\t", max_size=60), st.integers(-(2**63), 2**63 - 1))
def test_lossless_and_reproducible(text, key):
    ids = SAMPLER.encode(text, key, 1)
    assert SAMPLER.decode(ids) == text
    SAMPLER.forget()
    assert (SAMPLER.encode(text, key, 1) == ids).all()


def test_batches_do_not_matter(monkeypatch):
    texts = [f"the thing number {k} is " + "other " * (k % 9) for k in range(60)]
    one = SAMPLER.encode_all(texts, list(range(60)), 3)
    monkeypatch.setattr(pieces, "STEP_CHARS", 50)
    assert all((a == b).all() for a, b in zip(one, SAMPLER.encode_all(texts, list(range(60)), 3), strict=True))
    assert (SAMPLER.encode(" ".join(texts), 5, 1) == pieces.PieceSampler(PATH).encode(" ".join(texts), 5, 1)).all()


def paths(chunk):
    """Every segmentation of a chunk with its probability, by brute force over the weights."""
    w = chunk.replace(" ", pieces.SIGN)
    out = []

    def walk(at, ids, p):
        if at == len(w):
            out.append((tuple(ids), p))
        for end in range(at + 1, len(w) + 1):
            if got := SAMPLER.weights.get(w[at:end]):
                walk(end, [*ids, got[0]], p * got[1])

    walk(0, [], 1.0)
    total = sum(p for _, p in out)
    return {ids: p / total for ids, p in out}


def test_draws_follow_the_lattice():
    n, want = 20_000, paths(" thing")
    got = Counter(tuple(int(i) for i in SAMPLER.encode("thing", k, 9)) for k in range(n))
    assert set(got) <= set(want)
    assert all(abs(got[ids] / n - p) < 0.015 for ids, p in want.items())


def test_dense_and_plain_lattices_agree():
    chunks = [" thing", " thntatwh", "bleon", " a", "ing", " ß", "   x"]
    SAMPLER.forget()
    SAMPLER._learn(chunks)
    for c in chunks:
        for j, arcs in enumerate(SAMPLER.arcs(c)):
            at = SAMPLER.first_arc.data[SAMPLER.ends[c] - len(c) + 1 + j]
            up = SAMPLER.up.data[at : at + len(arcs)]
            p = np.diff(np.concatenate(([0], np.minimum(up, 1))))
            got = sorted((int(SAMPLER.token.data[at + k]), round(float(x), 3)) for k, x in enumerate(p))
            assert up[-1] == 2 and np.allclose([x for _, x in got], [x for _, x in sorted((ids[0], p) for p, _, ids in arcs)], atol=2e-3)


def test_long_chunks_do_not_underflow():
    text = "q" * 5000 + " " + "x" * 20_000
    assert SAMPLER.decode(SAMPLER.encode(text, 1, 1)) == text


def test_long_chunks_go_window_by_window(monkeypatch):
    """Windows draw by the lattice's exact probabilities, and long texts without a space stay small in memory."""
    import random
    import tracemalloc
    from collections import Counter

    rng = random.Random(5)
    chunk = "the" * 3
    want = Counter()

    def spread(end, p, ids):
        if end == 0:
            want[ids] += p
            return
        for q, start, own in SAMPLER.arcs(chunk)[end - 1]:
            spread(start, p * q, own + ids)

    spread(len(chunk), 1.0, ())
    monkeypatch.setattr(pieces, "WINDOW", 4)
    n = 4000
    got = Counter(tuple(SAMPLER._sample_long(chunk, np.uint64(rng.getrandbits(64))).tolist()) for _ in range(n))
    for ids, p in want.items():
        assert abs(got[ids] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-3
    monkeypatch.setattr(pieces, "WINDOW", 1 << 12)
    text = "".join(rng.choice("abcdefgh漢字仮名𝛼0123") for _ in range(60_000))
    assert SAMPLER.decode(SAMPLER.encode(text, 1, 1)) == text
    assert (SAMPLER.encode(text, 1, 1) == SAMPLER.encode_all([text, "x"], [1, 2], 1)[0]).all()
    tracemalloc.start()
    SAMPLER.encode(text, 1, 1)
    assert tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.stop()


def test_query(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op5_pieces(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) and r.n_tokens == len(r.ids)
        assert SAMPLER.decode(np.array(r.ids)) == docs[r.doc_id]


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "x y", 2), (1, "", 3), (1, "x y", 4), (0, "x y", 5)], "doc_id long, text string, ids int")
    rows = pieces.decode(pieces.encode(df, PATH), PATH).collect()
    assert sorted(r.text for r in rows) == ["", "", "x y", "x y", "x y"]
    same = [r.ids for r in rows if r.doc_id in (None, 0)]
    assert same[0] == same[1]
    assert pieces.encode(df.where("false"), PATH).count() == 0
