"""The similarity join against all pairs."""

import random

import numpy as np
from hypothesis import given, settings, strategies as st

from moneyflow.llm import jaccard as J, simhash as S
from tests.llm.test_simhash import union_find


def alike(a, b, words=5, similarity=0.8):
    s, t = S.shingle_set(a, words), S.shingle_set(b, words)
    return len(s & t) >= similarity * len(s | t)


def kept(texts):
    """Places of the texts that stay, by all pairs."""
    return sorted(set(union_find(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], texts[j])])))


def stay(spark, texts):
    return sorted(r.doc_id for r in S.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.random()}"
    return " ".join(out)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.sampled_from([0.5, 0.8, 1.0]))
def test_forest_connects_what_similar_pairs_connect(seed, n, similarity):
    rng = np.random.default_rng(seed)
    bases = rng.integers(0, 60, (3, 12))
    sets = [np.unique(np.where(rng.random(12) < 0.12, rng.integers(0, 60, 12), bases[rng.integers(3)])) for _ in range(n)]
    near = lambda i, j: len(np.intersect1d(sets[i], sets[j])) >= similarity * len(np.union1d(sets[i], sets[j]))
    pairs = [(i, j) for i in range(n) for j in range(i) if near(i, j)]
    got = J.forest(sets, similarity)
    assert all(near(i, j) for i, j in got) and union_find(n, got) == union_find(n, pairs)
    for i, j in pairs:
        p, q = J.first(len(sets[i]), similarity), J.first(len(sets[j]), similarity)
        more = [s[: J.first(len(s), similarity) + J.further(len(s), similarity) - 1] for s in (sets[i], sets[j])]
        need = max(J.further(J.least_common(len(s), similarity), similarity) for s in (sets[i], sets[j]))
        assert np.intersect1d(sets[i][:p], sets[j][:q]).size and np.intersect1d(*more).size >= need


def test_group_of_edited_copies(spark):
    rng = random.Random(7)
    texts = []
    for g in range(3):
        base = [f"g{g}w{k}" for k in range(200)]
        texts += [" ".join(base)] + [edited(rng, base, 3) for _ in range(300)]
    assert stay(spark, texts) == kept(texts)


def test_over_full_buckets_are_dealt_in_blocks(spark, monkeypatch):
    """With groups of 16 texts at most: chains, near copies of the least text, and copies of others than it."""
    monkeypatch.setattr(J, "GROUP_TEXTS", 16)
    rng = random.Random(11)
    base, texts = [f"w{k}" for k in range(200)], []
    for _ in range(4):  # variants that are hardly alike, each with copies of its own
        variant = edited(rng, base, 9).split()
        texts += [edited(rng, variant, 2) for _ in range(25)]
    chain = [f"c{k}" for k in range(100)]
    for _ in range(25):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 1).split()
    assert stay(spark, texts) == kept(texts) and len(kept(texts)) < len(texts) / 4


def test_pairs_of_many_differing_bits(spark):
    rng = random.Random(3)
    texts = []
    for g in range(60):
        base = [f"p{g}w{k}" for k in range(200)]
        texts += [" ".join(base), edited(rng, base, 4)]
    bits = [(S.fingerprint(texts[k], 5) ^ S.fingerprint(texts[k + 1], 5)).bit_count() for k in range(0, 120, 2)]
    assert max(bits) > 8 and stay(spark, texts) == kept(texts) == list(range(0, 120, 2))


def test_equal_fingerprints_need_similarity(spark):
    phrase = " ".join(f"f0x{k}" for k in range(11))
    texts = [" ".join([phrase] * 60 + [f"s0o{j}n{k}" for k in range(400)]) for j in range(2)]
    assert S.fingerprint(texts[0], 5) == S.fingerprint(texts[1], 5) and not alike(*texts)
    assert stay(spark, [*texts, texts[0].upper(), "", "  "]) == [0, 1, 3]


def test_links_within_the_budget_come_from_the_trie_and_are_verified(spark, monkeypatch):
    """With the exact join giving nothing, near copies within 4 bits still go, and unlike texts of one fingerprint stay."""
    rng = random.Random(9)
    base = [f"t{k}" for k in range(2000)]
    texts = [" ".join(base)] + [edited(rng, base, 1) for _ in range(8)]
    near = [j for j in range(9) if (S.fingerprint(texts[0], 5) ^ S.fingerprint(texts[j], 5)).bit_count() <= 4]
    phrase = " ".join(f"f0x{k}" for k in range(11))
    texts += [" ".join([phrase] * 60 + [f"s0o{j}n{k}" for k in range(400)]) for j in range(2)]
    asked = []

    def none(rows, words, similarity, roots):
        asked.append({r.node: r.root for r in roots.collect()})
        return spark.createDataFrame([], "a long, b long")

    monkeypatch.setattr(S, "similar_links", none)
    got = stay(spark, texts)
    assert len(near) > 2 and not set(near[1:]) & set(got) and {9, 10} < set(got)
    assert len(asked) == 1 and len(asked[0]) >= len(near)


def test_forest_leaves_out_what_is_connected_already():
    sets = [np.arange(10), np.arange(10), np.arange(1, 10)]
    assert len(J.forest(sets, 0.8)) == 2 and len(J.forest(sets, 0.8, [5, 5, 7])) == 1 and not J.forest(sets, 0.8, [5, 5, 5])
