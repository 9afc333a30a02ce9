"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are 64-bit majorities over the XXH64 (seed 42) of word shingles. Two fingerprints link at
``budget`` or fewer differing bits. The join walks pairs of trie nodes together, adds up the bits in which
their paths differ, and leaves a pair as soon as the budget is exceeded.

To spread the walk over tasks, the free bits are cut into ``budget + 2`` blocks. Two linked fingerprints
agree in at least two blocks, so each fingerprint goes to one bucket for each pair of blocks, and a bucket
is one trie. A bucket of more than ``GROUP_LIMIT`` fingerprints is not walked but dealt out anew over
blocks of its remaining bits; every step fixes more bits, and below 13 free bits a bucket cannot hold more
than the limit, so every link is found and no task gets an unbounded group. A bucket gives back a spanning
forest of its links, at most one row for each fingerprint, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import bounded_batches, discard, split, stash, unused
from moneyflow.llm.graph import components
from moneyflow.llm.jaccard import similar_links, verified

GROUP_LIMIT = 1 << 13
CHUNK = 1 << 15


def fingerprint(text: str, words: int) -> int:
    """The fingerprint of one text: ASCII-lowered, split at ASCII white space; zero without words."""
    import xxhash

    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = [digest(b" ".join(tokens), 42)]
    else:
        joined = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[: -words] + 1))
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    h = np.array(hashes, dtype="<u8")
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long. Null texts count as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text_hash": b["text_hash"], "fp": fp})

    return rows.mapInPandas(run, "doc_id long, text_hash long, fp long")


def trie_forest(group: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links within groups: places (i, j) of linked rows that connect all that is linked.

    ``fp`` is unsigned; rows are sorted by (group, fp) and distinct in both.
    """
    parent, taken = np.arange(len(fp)), [np.zeros((2, 0), dtype=np.int64)]

    def union(pairs: np.ndarray) -> None:
        while pairs.shape[1]:
            roots = parent[pairs]
            apart = roots[0] != roots[1]
            pairs, roots = pairs[:, apart], roots[:, apart]
            if not pairs.shape[1]:
                return
            high, low = roots.max(axis=0), roots.min(axis=0)
            order = np.lexsort((low, high))
            hooks = order[np.concatenate(([True], high[order][1:] != high[order][:-1]))]  # one for each higher root
            parent[high[hooks]] = low[hooks]
            taken.append(pairs[:, hooks])
            while not np.array_equal(up := parent[parent], parent):
                parent[:] = up

    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    lo, hi = cuts[:-1], cuts[1:]
    many = hi - lo > 1
    lo, hi = lo[many], hi[many]
    todo = [(0, np.stack([lo, hi, lo, hi, np.zeros_like(lo)])[:, at : at + CHUNK]) for at in range(0, len(lo), CHUNK)]
    ones: dict[int, np.ndarray] = {}
    while todo:
        depth, pairs = todo.pop()
        la, ha, lb, hb, diff = pairs
        leaf = (ha - la == 1) & (hb - lb == 1)
        if leaf.any():
            ends = np.stack([la[leaf], lb[leaf]])
            union(ends[:, np.bitwise_count(fp[ends[0]] ^ fp[ends[1]]) <= budget])
            la, ha, lb, hb, diff = pairs[:, ~leaf]
        if not len(la):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate(([0], np.cumsum(fp >> np.uint64(63 - depth) & np.uint64(1), dtype=np.int64)))
        c = ones[depth]
        ma, mb, same = ha - (c[ha] - c[la]), hb - (c[hb] - c[lb]), la == lb
        up = diff + 1
        nxt = np.concatenate(
            [
                np.stack([la, ma, lb, mb, diff]),
                np.stack([ma, ha, mb, hb, diff]),
                np.stack([la, ma, mb, hb, up]),
                np.stack([ma, ha, lb, mb, up])[:, ~same],
            ],
            axis=1,
        )
        la, ha, lb, hb, diff = nxt
        keep = (ha > la) & (hb > lb) & (diff <= budget) & ~((la == lb) & (ha - la < 2))
        nxt = nxt[:, keep]
        todo += [(depth + 1, nxt[:, at : at + CHUNK]) for at in range(0, nxt.shape[1], CHUNK)]
    i, j = np.concatenate(taken, axis=1)
    return i, j


def block_masks(fixed: int, budget: int) -> list[int]:
    """Masks that fix, beside the bits in ``fixed``, two of the ``budget + 2`` blocks of the free bits."""
    free = [b for b in range(64) if not fixed >> b & 1]
    n = budget + 2
    blocks = [sum(1 << b for b in free[len(free) * k // n : len(free) * (k + 1) // n]) for k in range(n)]
    return [fixed | x | y for x, y in itertools.combinations(blocks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_pass(rows: DataFrame, budget: int) -> DataFrame:
    """Rows (mask, key, fp) to (a, b, mask): a link if mask is 0, else a row of an over-full bucket."""

    def forest(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pd.DataFrame]:
        """Whole buckets: the links of small ones, the rows of over-full ones."""
        cuts = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]), [True])))
        sizes = np.diff(cuts)
        number, size = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes, sizes)
        over, some = size > GROUP_LIMIT, (size > 1) & (size <= GROUP_LIMIT)
        if over.any():
            yield pd.DataFrame({"a": fp[over], "b": fp[over], "mask": mask[over]})
        if some.any():
            x, g = fp[some].view(np.uint64), number[some]
            order = np.lexsort((x, g))
            i, j = trie_forest(g[order], x[order], budget)
            own = x[order].view(np.int64)
            yield pd.DataFrame({"a": own[i], "b": own[j], "mask": np.zeros(len(i), dtype=np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, passing = [np.zeros((3, 0), dtype=np.int64)], None  # passing: an over-full bucket whose rows go by
        for b in batches:
            rows = np.stack([b["mask"].to_numpy(), b["key"].to_numpy(), b["fp"].to_numpy()])
            if passing is not None:
                same = (rows[0] == passing[0]) & (rows[1] == passing[1])
                if same.any():
                    yield pd.DataFrame({"a": rows[2, same], "b": rows[2, same], "mask": rows[0, same]})
                rows = rows[:, ~same]
                if not rows.shape[1]:
                    continue
                passing = None
            held.append(rows)
            if sum(x.shape[1] for x in held) < 8 * GROUP_LIMIT:
                continue
            rows = np.concatenate(held, axis=1)
            last = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
            yield from forest(*rows[:, ~last])
            held = [rows[:, last]]
            if held[0].shape[1] > GROUP_LIMIT:
                passing = tuple(held[0][:2, 0].tolist())
                yield from forest(*held[0])
                held = [held[0][:, :0]]
        rows = np.concatenate(held, axis=1)
        if rows.shape[1]:
            yield from forest(*rows)

    dealt = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInPandas(run, "a long, b long, mask long")


def links(fps: DataFrame, budget: int = 4) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) that connect exactly what the pairs within the budget connect."""
    found, todo, passes, masks = None, fps.select("fp"), [], F.array(*[F.lit(_signed(m)) for m in block_masks(0, budget)])
    todo = todo.select("fp", F.explode(masks).alias("mask"))
    while True:  # every pass fixes more bits, and 13 free bits leave no over-full bucket
        out = stash(_bucket_pass(todo.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"), budget), "buckets")
        passes.append(out)
        some = out.where("mask = 0").select("a", "b")
        found = some if found is None else found.unionAll(some)
        over = out.where("mask != 0")
        if not over.take(1):
            found = stash(found, "trie")
            discard(*passes)
            return found

        def finer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known: dict[int, list[int]] = {}
            for b in batches:
                new = []
                for m in b["mask"].tolist():
                    if m not in known:
                        known[m] = [_signed(x) for x in block_masks(m % (1 << 64), budget)]
                    new.append(known[m])
                n = [len(x) for x in new]
                yield pd.DataFrame({"fp": np.repeat(b["a"].to_numpy(), n), "mask": np.array([m for x in new for m in x], dtype=np.int64)})

        todo = over.select("a", "mask").mapInPandas(finer, "fp long, mask long").distinct()

def shingle_set(text: str, words: int) -> set:
    tokens = text.encode().lower().split()
    return {tuple(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))}


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    budget: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, text_hash, fp (signed long), component_id and stays.

    ``component_id`` is the least id that the document reaches over links; ``stays`` marks the one document of
    each component with the least (id, text hash). Equal fingerprints always link, those of texts without
    words too. Rows that repeat an id and a text are one document: all have the same values. Null ids come
    after all others.
    """
    bounded_batches(docs.sparkSession)
    all_fps = stash(fingerprints(docs, words, id_col, text_col), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    distinct = stash(all_fps.groupBy("fp").agg(F.min(place).alias("least")), "distinct")
    roots = components(links(distinct, budget))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("first"))
    of_fp = named.select("fp", "root").join(ids, "root").select("fp", "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return all_fps.join(of_fp, "fp").select("doc_id", "text_hash", "fp", F.col("first.doc_id").alias("component_id"), stays.alias("stays"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", budget: int = 4) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the least (id, text hash).

    Texts link if their shingle sets have this Jaccard similarity or more, and groups are what links connect. Texts
    without words are alike. Null ids come after all others. The trie join gives candidates, whose fingerprints differ
    in ``budget`` bits or fewer; they are verified on all shingles. Fingerprints cannot bound the similarity, so the
    links that remain between texts still apart come from an exact join, whatever their fingerprints.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("node"), text.alias("text"))
    rows = stash(fingerprints(docs, words, id_col, text_col).withColumnRenamed("text_hash", "node"), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col("node").alias("text_hash"))
    least = stash(rows.groupBy("node").agg(F.min(place).alias("least"), F.min("fp").alias("fp")), "distinct")
    heads = stash(least.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    within = links(heads, budget)
    for end in ("a", "b"):
        within = within.join(heads.toDF(end, "head"), end).drop(end).withColumnRenamed("head", f"{end}_")
    equal = least.join(heads, "fp").where("node != head").select(F.col("head").alias("a_"), F.col("node").alias("b_"))
    pairs = stash(within.unionByName(equal).toDF("a", "b").distinct(), "pairs")
    near = verified(pairs, texts, words, similarity)
    known = stash(components(near), "roots")
    rest = similar_links(texts, words, similarity, known)
    roots = components(near.unionAll(rest))
    named = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = named.groupBy("root").agg(F.min("least").alias("first"))
    of_text = named.select("node", "root").join(firsts, "root").select("node", "first")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.text_hash"))
    own_id, own_hash = unused(docs, "id", "hash")
    gone = stash(rows.join(of_text, "node").where(~stays).select(F.col("doc_id").alias(own_id), F.col("node").alias(own_hash)).distinct(), "gone")
    discard(rows, least, heads, pairs, near, known)
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_hash))
    some, others = split(docs, F.xxhash64(text), gone.select(own_hash))
    return some.join(gone, same, "left_anti").unionAll(others)
