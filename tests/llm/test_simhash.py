"""The trie join against all pairs, components against union-find, near-duplicates on a fixture."""

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from moneyflow.llm import simhash as S
from moneyflow.llm.graph import components


def brute_fingerprint(text, n):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abÄÖ \t\n\x0b ", max_size=80), st.integers(1, 5))
def test_fingerprint(text, n):
    assert S.fingerprint(text, n) == brute_fingerprint(text, n)


def union_find(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 120), st.integers(0, 8), st.integers(1, 3))
def test_trie_forest_connects_what_pairs_connect(seed, n, budget, groups):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = np.zeros(n, dtype=np.uint64)
    for _ in range(6):
        flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    fp, g = rng.choice(base, n) ^ flips, rng.integers(0, groups, n)
    both = np.unique(np.stack([g.astype(np.uint64), fp]), axis=1)
    g, fp = both[0].astype(np.int64), both[1]
    near = lambda i, j: int(fp[i] ^ fp[j]).bit_count() <= budget
    want = union_find(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if g[i] == g[j] and near(i, j)])
    i, j = S.trie_forest(g, fp, budget)
    assert all(near(a, b) and g[a] == g[b] for a, b in zip(i, j, strict=True)) and len(i) < max(len(fp), 1)
    assert union_find(len(fp), zip(i, j, strict=True)) == want


def test_linked_fingerprints_share_two_blocks():
    rng = np.random.default_rng(5)
    for budget in (4, 8):
        masks = S.block_masks(0, budget)
        for _ in range(300):
            x = int(rng.integers(0, 1 << 63))
            y = x
            for b in rng.choice(64, budget, replace=False):
                y ^= 1 << int(b)
            assert any(x & m == y & m for m in masks)


def pairs_of(fps, budget):
    return [(i, j) for i in range(len(fps)) for j in range(i) if int(np.uint64(fps[i]) ^ np.uint64(fps[j])).bit_count() <= budget]


def test_over_full_buckets_are_dealt_anew(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP_LIMIT", 8)
    rng = np.random.default_rng(1)
    fps = sorted({int(x) for x in rng.integers(0, 1 << 12, 300)} | {int(x) << 40 for x in rng.integers(0, 1 << 12, 100)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    over = S._bucket_pass(df.selectExpr("1L AS mask", "0L AS key", "fp"), 4).where("mask != 0")
    assert sorted(r.a for r in over.collect()) == fps
    found = S.links(df, 4).collect()
    place = {x: k for k, x in enumerate(fps)}
    got = union_find(len(fps), [(place[r.a], place[r.b]) for r in found])
    assert got == union_find(len(fps), pairs_of(fps, 4))


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(400, 440)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(500, edges)
    assert got == {x: want[x] for e in edges for x in e if e[0] != e[1]} | {k: v for k, v in got.items() if k in {a for a, b in edges if a == b}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


WORDS = [f"w{k}" for k in range(400)]


def test_query_columns_and_groups(spark):
    text = " ".join(WORDS)
    rows = [(1, text), (2, text.upper()), (3, text.replace("w7 ", "x7 ")), (4, None), (5, ""), (6, "   "), (7, "short one"), (8, "short  ONE"), (9, " ".join(WORDS[::-1])), (2, text), (None, text)]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 4).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.component_id for r in got}
    assert by[1] == by[2] == by[None] == 1 and by[4] == by[5] == by[6] == 4 and by[7] == by[8] == 7 and by[9] == 9
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 4, 4).count() == 0


def test_op2_equals_all_pairs(spark):
    from moneyflow.llm.queries import op2_simhash

    sf = "/root/testdata/sf0.001"
    got = sorted(op2_simhash(spark, sf).collect())
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(docs)
    fps = [brute_fingerprint(docs[i] or "", 4) for i in ids]
    roots = union_find(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert [(r.doc_id, r.fingerprint, r.component_id) for r in got] == [(i, f"{f:016x}", ids[r]) for i, f, r in zip(ids, fps, roots, strict=True)]


def test_drop_keeps_one_and_needs_similarity(spark):
    base = " ".join(WORDS)
    rows = [(1, base, "s"), (2, base, "s"), (3, base.replace("w9 ", "q9 "), "s"), (4, " ".join(WORDS[200:]) + " other", "s"), (5, None, "s"), (6, "", "s"), (7, "unlike", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = S.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 4, 5, 7]
