"""Removes passages of lines that repeat anywhere in the corpus, by content-defined chunks of lines.

A rolling hash over two line hashes chooses the boundaries. In every stretch of ``min_words`` words the place with
the least rolling hash is one, so boundaries depend on nothing but the lines around them, an insertion elsewhere does
not move them, and a passage of ``min_words`` words or more holds a boundary that all its copies have. The chunk of a
boundary is the two lines that meet there. A single line of ``min_words`` words or more is a chunk, too: it is no
multi-line passage, but no less a repeated one.

Chunks that occur again are seeds, from which repeated runs grow line by line, both ways: a line belongs to the run
if it and its neighbour stand together in an earlier place, too, where also a seed is near. These pairs of lines are
compared with their first occurrence in the order of (doc_id, line), by 128 bits of BLAKE2 of each line: no two texts
are known that have these in common. Runs of ``min_words`` words or more are removed; the first occurrence of every
pair stays. Growth goes ``min_words`` words beyond a seed: farther off, a repeated passage has another seed.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import bounded_batches, discard, split, stash, unused

MULTIPLIER = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
#: Bytes of a line's digest.
DIGEST = 16


def words_in(line: str) -> int:
    return len(line.split())


def rolling_hashes(hashes: list[int], words: list[int]) -> list[int]:
    """For each line the hash of the line before and itself; two lines without words are boundaries last of all."""
    out = [MASK]
    for k in range(1, len(hashes)):
        x = (hashes[k - 1] * MULTIPLIER + hashes[k]) & MASK
        out.append((x ^ x >> 29) * 0xBF58476D1CE4E5B9 & MASK if words[k - 1] or words[k] else MASK)
    return out


def boundaries(rolled: list[int], words: list[int], min_words: int) -> list[int]:
    """The places k, between lines k - 1 and k, with the least rolling hash in some stretch of ``min_words`` words.

    A stretch begins at any line and ends with the line that brings it to so many words, and has two lines at least.
    """
    n, found, queue = len(words), [], deque()  # queue: places of the stretch by rising hash
    end, total = 0, 0
    for a in range(n):
        while end < n and (total < min_words or end < a + 2):
            while queue and rolled[queue[-1]] >= rolled[end]:
                queue.pop()
            queue.append(end)
            total, end = total + words[end], end + 1
        if total < min_words or end < a + 2:
            break
        while queue[0] <= a:
            queue.popleft()
        if not found or found[-1] < queue[0]:
            found.append(queue[0])
        total -= words[a]
    return found


def line_chunks(text: str, min_words: int) -> list[tuple[int, int, int]]:
    """(first line, lines, digest) of every chunk; digests are signed 64-bit numbers."""
    import xxhash

    lines = text.split("\n")
    raw, words = [x.encode() for x in lines], [words_in(x) for x in lines]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(x) for x in raw]
    out = [(k - 1, 2, digest(raw[k - 1] + b"\n" + raw[k])) for k in boundaries(rolling_hashes(hashes, words), words, min_words)]
    out += [(k, 1, hashes[k]) for k, w in enumerate(words) if w >= min_words]
    return [(k, n, h - (1 << 64) if h >> 63 else h) for k, n, h in out]


def grown(words: list[int], seeds: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """(first line, lines) of all pairs of lines within ``min_words`` words of a seed, and of the seeds themselves."""
    places, done = set(seeds), set()
    for start, n in seeds:
        for at, step in ((start + n - 1, 1), (start, -1)):
            total = 0
            while 0 <= at + step < len(words) and total < min_words and (at, step) not in done:
                if total == 0:
                    done.add((at, step))
                places.add((min(at, at + step), 2))
                at += step
                total += words[at]
    return sorted(places)


def long_runs(lines: list[str], spans: list[tuple[int, int]], min_words: int) -> list[tuple[int, int]]:
    """Maximal runs (from, to) of lines that the spans cover, of ``min_words`` words or more."""
    out, at = [], 0
    for i, n in sorted(spans):
        if out and i <= at:
            at = max(at, i + n)
            out[-1] = (out[-1][0], at)
        else:
            at = i + n
            out.append((i, at))
    return [(a, b) for a, b in out if sum(map(words_in, lines[a:b])) >= min_words]


def line_digests(lines: list[str]) -> list[bytes]:
    """128 cryptographic bits of each line: lines with equal digests are equal."""
    return [blake2b(x.encode(), digest_size=DIGEST).digest() for x in lines]


def repeated_spans(rows: DataFrame, min_words: int) -> DataFrame:
    """(id, hash, text) to (id, hash, starts, sizes): pairs of lines, and long lines, that equal an earlier occurrence.

    Texts are read once and never shuffled; the steps after that read their outlines, which are the chunks and the
    number of words and the digest of every line.
    """

    def frame(out: list[tuple], columns: list[str]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=columns).astype({"id": "Int64", "hash": "int64"})

    def plain(name) -> int | None:
        return None if name is None or name != name else int(name)

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "hash", "chunks", "words", "lines"]
        for b in batches:
            out, size = [], 0
            for name, h, text in zip(b["id"], b["hash"], b["text"], strict=True):
                if chunks := line_chunks(text, min_words):
                    lines = text.split("\n")
                    words = np.fromiter(map(words_in, lines), dtype=np.int32, count=len(lines))
                    out.append((plain(name), h, [dict(zip(("start", "n", "digest"), c, strict=True)) for c in chunks], words, b"".join(line_digests(lines))))
                    size += len(lines) * (DIGEST + 4) + len(chunks) * 100
                if size >= 1 << 22:
                    yield frame(out, columns)
                    out, size = [], 0
            yield frame(out, columns)

    outlines = stash(rows.mapInPandas(outline, "id long, hash long, chunks array<struct<start int, n int, digest long>>, words array<int>, lines binary"), "outlines")
    chunks = outlines.select("id", "hash", F.inline("chunks"))
    again = stash(chunks.groupBy("digest").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("digest"), "again")
    often, _ = split(chunks, F.col("digest"), again)
    seeds = often.join(again, "digest").groupBy(F.col("id").alias("__i"), F.col("hash").alias("__h")).agg(F.collect_set(F.struct("start", "n")).alias("s"))
    seeds = stash(seeds.select("__i", "__h", F.col("s.start").alias("start"), F.col("s.n").alias("n")), "seeds")

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "hash", "start", "n", "digest"]
        for b in batches:
            out: list[tuple] = []
            for name, h, words, lines, starts, ns in zip(*(b[c] for c in ("id", "hash", "words", "lines", "start", "n")), strict=True):
                name = plain(name)
                for i, n in grown(words.tolist(), list(zip(starts.tolist(), ns.tolist(), strict=True)), min_words):
                    out.append((name, h, i, n, blake2b(lines[DIGEST * i : DIGEST * (i + n)], digest_size=DIGEST).digest()))
                if len(out) >= 50_000:
                    yield frame(out, columns)
                    out = []
            yield frame(out, columns)

    same = F.col("id").eqNullSafe(F.col("__i")) & (F.col("hash") == F.col("__h"))
    near, _ = split(outlines.select("id", "hash", "words", "lines"), F.col("hash"), seeds.select("__h"))
    joined = near.join(seeds, same).select("id", "hash", "words", "lines", "start", "n")
    found = stash(joined.mapInPandas(pairs, "id long, hash long, start int, n int, digest binary"), "found")
    discard(outlines, again, seeds)
    place = F.struct("id", "hash", "start")
    heads = found.groupBy("digest").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("place")).where("times > 1")
    heads = stash(heads.select("digest", "place"), "heads")
    later = found.join(heads, "digest").where(place != F.col("place"))
    gone = later.groupBy("id", "hash").agg(F.collect_set(F.struct("start", "n")).alias("s"))
    gone = stash(gone.select("id", "hash", F.col("s.start").alias("starts"), F.col("s.n").alias("sizes")), "gone")
    discard(found, heads)
    return gone


def remove_repeats(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``text_col`` cleaned, plus ``lines_removed`` (int) and ``words_removed`` (long).

    Null and empty texts stay as they are. Null ids come first in the order. Rows that repeat an id with
    another text are ordered by the text's hash; rows alike in id and text count as one and are treated
    alike. An empty table gives an empty table. Columns that already have the names of the counts are replaced; other
    columns may have any name.
    """
    bounded_batches(docs.sparkSession)
    own_id, own_hash, starts, sizes = unused(docs, "id", "hash", "starts", "sizes")
    named = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_hash, F.xxhash64(F.col(text_col)))
    rows = named.where(F.col(text_col).isNotNull()).select(F.col(own_id).alias("id"), F.col(own_hash).alias("hash"), F.col(text_col).alias("text"))
    gone_id, gone_hash = unused(named, "gone_id", "gone_hash")
    gone = repeated_spans(rows, min_words).toDF(gone_id, gone_hash, starts, sizes)
    schema = docs.select(*[c for c in docs.columns if c not in ("lines_removed", "words_removed")]).schema
    columns = schema.fieldNames()

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kept, n_lines, n_words = [], [], []
            for text, at, n in zip(b[text_col], b[starts], b[sizes], strict=True):
                runs = []
                if at is not None:
                    lines = text.split("\n")
                    runs = long_runs(lines, list(zip(at.tolist(), n.tolist(), strict=True)), min_words)
                n_lines.append(sum(y - x for x, y in runs))
                n_words.append(sum(words_in(line) for x, y in runs for line in lines[x:y]))
                for x, y in reversed(runs):
                    del lines[x:y]
                kept.append("\n".join(lines) if runs else text)
            yield b[columns].assign(**{text_col: pd.Series(kept, dtype=object, index=b.index)}, lines_removed=np.array(n_lines, dtype=np.int32), words_removed=np.array(n_words, dtype=np.int64))

    some, whole = split(named, F.col(own_hash), gone.select(gone_hash))
    joined = some.join(gone, F.col(own_id).eqNullSafe(F.col(gone_id)) & (F.col(own_hash) == F.col(gone_hash)), "left")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", lines_removed int, words_removed long"
    cleaned = joined.select(*columns, starts, sizes).mapInPandas(clean, ddl)
    return cleaned.unionAll(whole.select(*columns, F.lit(0).alias("lines_removed"), F.lit(0).cast("long").alias("words_removed")))
