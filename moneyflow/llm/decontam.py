"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur in a text with up to k = rate * m edits. Cut into k + 1 pieces, at least
one piece occurs unchanged. One Aho-Corasick automaton finds all pieces of all items in a single pass over
a text; a hit fixes a window of the text, and Myers' bit-parallel algorithm gives the least edit distance
of the item to any stretch of that window. Windows that cannot hold the item are left out before, by the
trigram lemma: an edit destroys three trigrams at most. Short items match unedited, as whole words.

Items and texts are compared lower-cased, with runs of white space as one space.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import bounded_batches, kept, stash


def normal(text: str) -> str:
    return " ".join(text.lower().split())


@dataclass
class Item:
    name: int
    text: str
    budget: int
    masks: dict[str, int]
    trigrams: frozenset


def make_item(name: int, text: str, rate: float) -> Item:
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    return Item(name, text, int(rate * len(text)), masks, frozenset(text[i : i + 3] for i in range(len(text) - 2)))


def pieces(item: Item) -> list[tuple[int, str]]:
    """(start, piece): the item's text in budget + 1 pieces of nearly equal length."""
    m, n = len(item.text), item.budget + 1
    cuts = [m * k // n for k in range(n + 1)]
    return [(a, item.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def best_match(item: Item, window: str) -> tuple[int, int]:
    """(least edit distance of the item to a stretch of the window, the first end of such a stretch). Myers, 1999."""
    m, get = len(item.text), item.masks.get
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(window, 1):
        eq = get(c, 0)
        d = ((eq & plus) + plus ^ plus) | eq | minus
        up, down = minus | ~(d | plus) & full, plus & d
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best, end = score, i
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(d | up) & full, up & d
    return best, end


class Matcher:
    """All items of one block against texts; those of under ``min_chars`` unedited and at word boundaries."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int = 0):
        import ahocorasick

        self.min_chars = min_chars
        self.items = [make_item(name, text, 0 if len(text) < min_chars else rate) for name, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for start, piece in pieces(item):
                places.setdefault(piece, []).append((k, start))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item, distance, end in the normal text) of every item within its budget: its best match, the first if tied."""
        if not self.any:
            return []
        t, windows = normal(text), {}
        for last, (size, found) in self.automaton.iter(t):
            for k, start in found:
                # a match that keeps this piece in place begins within budget characters of here
                windows.setdefault(k, set()).add(last + 1 - size - start)
        out = []
        for k, begins in windows.items():
            item, best = self.items[k], None
            m, b = len(item.text), item.budget
            if m < self.min_chars:
                whole = [x for x in begins if self._apart(t, x) and self._apart(t, x + m)]
                if whole:
                    out.append((item.name, 0, min(whole) + m))
                continue
            need, at = len(item.trigrams) - 3 * b, None
            for begin in sorted(begins):
                # neighbouring windows are joined; each starts and ends a budget further out than the item
                if at is not None and begin - b <= at[1] and begin + m + b - at[0] <= 4 * (m + 2 * b):
                    at = (at[0], begin + m + b)
                    continue
                best = self._look(item, t, at, need, best)
                at = (begin - b, begin + m + b)
            best = self._look(item, t, at, need, best)
            if best:
                out.append((item.name, *best))
        return out

    @staticmethod
    def _apart(t: str, at: int) -> bool:
        """No word goes on over this place."""
        return not (0 < at < len(t) and t[at - 1].isalnum() and t[at].isalnum())

    @staticmethod
    def _look(item: Item, t: str, at: tuple[int, int] | None, need: int, best: tuple[int, int] | None) -> tuple[int, int] | None:
        if at is None or best and best[0] == 0:
            return best
        a, window = max(0, at[0]), t[max(0, at[0]) : at[1]]
        if need > 0 and len(item.trigrams.intersection([window[i : i + 3] for i in range(len(window) - 2)])) < need:
            return best
        distance, end = best_match(item, window)
        if distance > item.budget or best and best[0] <= distance:
            return best
        return distance, a + end


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[tuple[list[tuple[int, str]], bool]]:
    """(item_id, normal text) of the items that are not empty, in blocks of about ``block_chars`` characters, and whether
    a block is the only one. The driver holds two blocks at most."""
    block, size, before = [], 0, None
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).toLocalIterator():
        text = normal(r["text"])
        if not text:
            continue
        if block and size + len(text) > block_chars:
            if before is not None:
                yield before, False
            before, block, size = block, [], 0
        block.append((r["item_id"], text))
        size += len(text)
    if before is not None:
        yield before, False
    yield block, before is None


def in_order(items: list[tuple[int, str]]) -> list[tuple[int, str]]:
    return sorted(items, key=lambda x: (x[0] is None, x))


RATE, MIN_CHARS, BLOCK_CHARS = 0.08, 40, 4_000_000


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, distance, stop) for each document and item found in it, the best match only.

    ``stop`` is the match's end in the normal form of the document. Items shorter than ``min_chars`` in
    normal form match unedited and as whole words only; null and empty items match nothing. Items go in blocks, each
    of which fits a worker and is broadcast; all documents meet all blocks, one pass each, whose matches are written
    before the next block is fetched where there are several. Null and empty texts match nothing; rows that
    repeat a document or an item give rows for each.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())

    def against(items: list[tuple[int, str]]) -> DataFrame:
        shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = kept(("items", key), lambda: Matcher(shared.value, rate, min_chars))
            for b in batches:
                out = [(name, *found) for name, text in zip(b["doc_id"], b["text"], strict=True) for found in matcher.matches(text)]
                d = pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "stop"])
                yield d.astype({"doc_id": "Int64", "item_id": "Int64", "distance": "int32", "stop": "int64"})

        return rows.mapInPandas(run, "doc_id long, item_id long, distance int, stop long")

    parts = []
    for items, only in item_blocks(benchmark, block_chars):
        found = against(in_order(items))
        parts.append(found if only else stash(found, "matches"))
    return reduce(DataFrame.unionAll, parts)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that hold an item; rows are filtered in place, nothing is shuffled."""
    bounded_batches(docs.sparkSession)
    for items, only in item_blocks(benchmark, block_chars):
        shared, key = docs.sparkSession.sparkContext.broadcast(in_order(items)), uuid.uuid4().hex

        def run(batches: Iterator[pd.DataFrame], shared=shared, key=key) -> Iterator[pd.DataFrame]:
            matcher = kept(("items", key), lambda: Matcher(shared.value, rate, min_chars))
            for b in batches:
                yield b.loc[np.array([not matcher.matches(t or "") for t in b[text_col]], dtype=bool)]

        kept_rows = docs.mapInPandas(run, docs.schema)
        docs = kept_rows if only else stash(kept_rows, "clean")
    return docs
