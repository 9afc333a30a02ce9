"""Token ids in directly addressable codes (DAC).

Every id is split into chunks of eight bits. Level 0 holds the lowest chunk of every id, level k the k-th
chunk of the ids that need it. A continuation bitmap beside each level says which ids go on, and a rank
directory (ones before every 512th bit) finds an id's place on the next level in constant time. Any token
is read from a few bytes; no block is decoded.

A file holds one segment: header, document index, levels. Segments of one writing task are consecutive;
the header gives the task's number and the tokens before it in that task, so that the start of a document
in the whole corpus is the sum over earlier tasks plus a local offset.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from moneyflow.llm.common import kept, shared_path

MAGIC = b"DACSEG1\n"
HEADER = struct.Struct(">8sQQQQQ")  # magic, tokens, tokens before in the task, task, documents, levels
RANK_STEP = 512


class SegmentWriter:
    """Takes the ids of one document after the other and packs them level by level as they come."""

    def __init__(self):
        self.levels, self.doc_ids, self.starts = [(bytearray(), bytearray())], [], [0]

    @property
    def n(self) -> int:
        return len(self.levels[0][0])

    def add(self, ids: np.ndarray) -> None:
        rest, k = np.asarray(ids, dtype="<u4"), 0
        while len(rest):
            if k == len(self.levels):
                self.levels.append((bytearray(), bytearray()))
            more = rest > 0xFF
            self.levels[k][0].extend(rest.astype(np.uint8).data)  # the lowest eight bits
            self.levels[k][1].extend(more.data)
            rest, k = rest[more] >> np.uint32(8), k + 1

    def end_document(self, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n)

    def pack(self, task: int, before: int) -> bytes:
        known = np.array([x is not None and x == x for x in self.doc_ids], dtype=np.uint8)
        named = np.array([int(x) if k else 0 for x, k in zip(self.doc_ids, known, strict=True)], dtype="<i8")
        head = HEADER.pack(MAGIC, self.n, before, task, len(self.doc_ids), len(self.levels))
        parts = [head, named.tobytes(), known.tobytes(), np.array(self.starts, dtype="<u8").tobytes()]
        for low, more in self.levels:
            bits = np.packbits(np.frombuffer(more, dtype=np.uint8), bitorder="little")
            blocks = np.bitwise_count(np.pad(bits, (0, -len(bits) % (RANK_STEP // 8)))).reshape(-1, RANK_STEP // 8).sum(axis=1, dtype=np.int64)
            ones = np.concatenate(([0], np.cumsum(blocks)))[: len(low) // RANK_STEP + 1].astype("<u4")
            parts += [struct.pack(">QQQ", len(low), len(bits), len(ones)), low, bits.tobytes(), ones.tobytes()]
        return b"".join(parts)


def pack_segment(ids: np.ndarray, doc_ids: list, counts: list[int], task: int, before: int) -> bytes:
    """One segment from the token ids of whole documents."""
    out, at = SegmentWriter(), 0
    for name, k in zip(doc_ids, counts, strict=True):
        out.add(ids[at : at + k])
        out.end_document(name)
        at += k
    return out.pack(task, before)


class Segment:
    """Reads a packed segment: ``token(i)`` touches one byte a level, ``slice(a, b)`` decodes a range."""

    def __init__(self, data: bytes):
        magic, self.n_tokens, self.before, self.task, self.n_docs, levels = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a DAC segment")
        at = HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.known = take("<i8", self.n_docs), take("u1", self.n_docs).astype(bool)
        self.starts = take("<u8", self.n_docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n, n_bits, n_ones = struct.unpack_from(">QQQ", data, at)
            at += 24
            self.levels.append((take("u1", n), take("u1", n_bits), take("<u4", n_ones)))

    @staticmethod
    def _rank(bits: np.ndarray, ones: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        block = i // RANK_STEP
        from_byte, whole = block * RANK_STEP // 8, i // 8
        n = int(ones[block]) + int(np.unpackbits(bits[from_byte:whole]).sum(dtype=np.int64))
        return n + (int(bits[whole]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for chunks, bits, ones in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i // 8] >> i % 8 & 1:
                break
            i, shift = self._rank(bits, ones, i), shift + 8
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b - 1, without decoding what lies outside."""
        out, place = np.zeros(b - a, dtype="<u4"), np.arange(b - a)
        for k, (chunks, bits, ones) in enumerate(self.levels):
            if a >= b:
                break
            out[place] |= chunks[a:b].astype("<u4") << np.uint32(8 * k)
            more = np.unpackbits(bits[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            place = place[more]
            a = self._rank(bits, ones, a) if len(place) else 0
            b = a + len(place)
        return out

    def decode(self) -> np.ndarray:
        return self.slice(0, self.n_tokens)


#: Texts of these characters alone are cut into runs in arrays: ASCII that prints, ASCII white space, and the
#: letters of Latin-1, whose lower case and normal form are one character each.
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
SPACE, LETTER, DIGIT, OTHER, HOLE, END = range(6)
END_MARK, HOLE_MARK = 0, 1
#: What a tokenizer's parts must be, as far as the runs depend on them.
RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTERS = [
    {"type": "Split", "pattern": {"Regex": RUNS}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, lower case and plainness of the characters 0 to 255."""
    kind, lower, plain = np.full(256, OTHER, dtype=np.uint8), np.arange(256, dtype=np.uint8), np.zeros(256, dtype=bool)
    for i in range(256):
        c = chr(i)
        plain[i] = bool(PLAIN.fullmatch(c))
        if plain[i]:
            kind[i] = SPACE if c.isspace() else DIGIT if c in "0123456789" else LETTER if c.isalpha() else OTHER
            lower[i] = ord(c.lower()) if ord(c.lower()) < 256 else i
    kind[END_MARK], kind[HOLE_MARK] = END, HOLE
    return kind, lower, plain


KIND, LOWER, IS_PLAIN = _classes()
#: The first n bytes of eight.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


class RunTable:
    """Runs of up to sixteen bytes (two words, zero-padded) and their numbers: open addressing in arrays."""

    def __init__(self, bits: int):
        self.bits, self.n, self.mask = bits, 0, np.int64((1 << bits) - 1)
        self.low, self.high = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=np.uint64)
        self.value = np.full(1 << bits, -1, dtype=np.int32)

    def _grow(self) -> None:
        used = self.value >= 0
        low, high, value = self.low[used], self.high[used], self.value[used]
        self.__init__(self.bits + 1)
        self._put(low, high, value)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(33)).astype(np.int64) & self.mask

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the runs, -1 for those that are not here."""
        out, slot, who = np.full(len(low), -1, dtype=np.int64), self._slots(low, high), None
        while len(slot):
            value = self.value[slot]
            hit = (value >= 0) & (self.low[slot] == low) & (self.high[slot] == high)
            if who is None:
                out[hit], on = value[hit], np.flatnonzero((value >= 0) & ~hit)
                who = on
            else:
                out[who[hit]], on = value[hit], np.flatnonzero((value >= 0) & ~hit)
                who = who[on]
            low, high, slot = low[on], high[on], slot[on] + 1 & self.mask
        return out

    def add(self, low: np.ndarray, high: np.ndarray, first: int) -> None:
        """Distinct runs that are not here get the numbers from ``first`` on."""
        while 2 * (self.n + len(low)) > len(self.value):
            self._grow()
        self._put(low, high, np.arange(first, first + len(low), dtype=np.int32))

    def _put(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> None:
        self.n += len(low)
        slot, claim = self._slots(low, high), self.value
        while len(slot):
            free = claim[slot] < 0
            claim[slot[free]] = value[free]  # of several runs at one slot the last one stays
            won = claim[slot] == value
            self.low[slot[won]], self.high[slot[won]] = low[won], high[won]
            low, high, value, slot = low[~won], high[~won], value[~won], slot[~won] + 1 & self.mask


class RunCachingEncoder:
    """Encodes as the library does for whole texts, but asks it once for each distinct run of characters.

    That holds for tokenizers that lower-case, cut texts into contractions, letters, single digits and other signs,
    drop white space, and end each run's last token with a suffix: the runs of a batch are then found and looked up
    in arrays, and new ones go to the library many in one text, cut apart at the run ends. Words with characters
    outside ``PLAIN`` or with marks of special tokens go to the library whole. A tokenizer of any other make gets
    whole texts. Before a batch, runs met only once are
    forgotten when there are more than ``room`` (a run of over sixteen characters counts as eight).
    """

    def __init__(self, path: str, table_bits: int = 19, room: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.table_bits, self.room = Tokenizer.from_file(path), table_bits, room
        made = json.loads(self.tokenizer.to_str())
        suffix = made["model"].get("end_of_word_suffix")
        self.by_run = bool(suffix) and self._known(made)
        if not self.by_run:
            return
        from tokenizers import pre_tokenizers

        # the same model for runs: they are in lower case and apart already
        self.of_runs = Tokenizer.from_file(path)
        self.of_runs.normalizer = None
        self.of_runs.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.table, self.long, self.uses = RunTable(table_bits), {}, np.zeros(0, dtype=np.int32)  # long: longer runs by their bytes
        self.ids, self.starts = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    @staticmethod
    def _known(made: dict) -> bool:
        steps = lambda x, inner: (x or {}).get(inner, [x])
        special = all("<|" in x["content"] and not x["normalized"] and not any(c.isspace() for c in x["content"]) for x in made["added_tokens"])
        model = made["model"]
        return (
            steps(made["normalizer"], "normalizers") == NORMALIZERS
            and steps(made["pre_tokenizer"], "pretokenizers") == SPLITTERS
            and model["type"] == "BPE"
            and not (model["dropout"] or model["continuing_subword_prefix"] or model["ignore_merges"] or made["truncation"] or made["padding"])
            and special
        )

    def _forget(self) -> None:
        """All but the runs that were met more than once; all, if those are too many."""
        old, self.table, self.long = self.table, RunTable(self.table_bits), {}
        kept = np.flatnonzero(old.value >= 0)
        kept = kept[self.uses[old.value[kept]] > 1]
        if 2 * len(kept) > self.room:
            kept = kept[:0]
        number = old.value[kept].astype(np.int64)
        length = self.starts[number + 1] - self.starts[number]
        self.ids = self._gather(self.ids, self.starts[number], length)
        self.starts = np.concatenate(([0], np.cumsum(length)))
        self.table.add(old.low[kept], old.high[kept], 0)
        self.uses = np.zeros(len(kept), dtype=np.int32)

    @staticmethod
    def _gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The stretches of ``data``, one after the other."""
        ends = np.cumsum(length)
        return data[np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]

    def _learn(self, buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        """Distinct new runs get the next numbers."""
        spaced = np.append(buf, np.uint8(32))
        for at in range(0, len(start), 20_000):
            a, n = start[at : at + 20_000], length[at : at + 20_000]
            index = np.stack([a, np.full(len(a), len(buf))], axis=1).ravel()
            each = np.stack([n, np.ones_like(n)], axis=1).ravel()
            text, cuts = self._gather(spaced, index, each).tobytes().decode("latin-1"), np.concatenate(([0], np.cumsum(n + 1)))[::200].tolist()
            got = self.of_runs.encode_batch_fast([text[x:y] for x, y in zip(cuts, [*cuts[1:], len(text)], strict=True) if x < y], add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in got])
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(a):
                raise ValueError("a run of characters is not one run of tokens")
            self.starts = np.concatenate((self.starts, len(self.ids) + ends))
            self.ids = np.concatenate((self.ids, ids))

    def _numbers(self, buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The numbers of runs of plain characters; new ones are learned."""
        out = np.zeros(len(start), dtype=np.int64)
        words = np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))
        short = length <= 16
        a, n = start[short], length[short]
        low, high = words[a] & FIRST[np.minimum(n, 8)], words[a + 8] & FIRST[np.maximum(n, 8) - 8]
        found = self.table.find(low, high)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((low[new], high[new]))]
            first = np.concatenate(([True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])))
            once, base = order[first], len(self.starts) - 1
            self._learn(buf, a[once], n[once])
            self.table.add(low[once], high[once], base)
            found[order] = base + np.cumsum(first) - 1
        out[short] = found
        far = np.flatnonzero(~short)
        if len(far):
            names = [buf[x : x + k].tobytes() for x, k in zip(start[far].tolist(), length[far].tolist(), strict=True)]
            some = {w: k for k, w in enumerate(names) if w not in self.long}
            if some:
                base, at = len(self.starts) - 1, far[list(some.values())]
                self._learn(buf, start[at], length[at])
                self.long.update(zip(some, range(base, base + len(some)), strict=True))
            out[far] = [self.long[w] for w in names]
        uses = np.bincount(out, minlength=len(self.starts) - 1).astype(np.int32)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return out

    @staticmethod
    def _plain_bytes(text: str, holes: list[str]) -> bytes:
        """One byte a character; a word that the arrays cannot take is a mark, and goes to ``holes``."""
        if "<|" not in text and PLAIN.fullmatch(text):
            return text.encode("latin-1")
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        space = (points == 32) | (points >= 9) & (points <= 13)
        odd = ~IS_PLAIN[np.minimum(points, 255)] | (points > 255)
        odd[:-1] |= (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
        begin, end = edges[::2], edges[1::2]  # words
        count = np.concatenate(([0], np.cumsum(odd)))
        bad = count[end] > count[begin]
        out, keep = np.minimum(points, 255).astype(np.uint8), np.ones(len(points), dtype=bool)
        for x, y in zip(begin[bad].tolist(), end[bad].tolist(), strict=True):
            holes.append(text[x:y])
            keep[x:y] = False
            out[x], keep[x] = HOLE_MARK, True
        return out[keep].tobytes()

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end_id``, and the number of ids of each text."""
        if not self.by_run:
            own = [[*x.ids, end_id] for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for x in own for i in x], dtype="<u4"), np.array([len(x) for x in own], dtype=np.int64)
        if self.table.n + 8 * len(self.long) > self.room:
            self._forget()
        holes: list[str] = []
        raw = bytes([END_MARK]).join([*(self._plain_bytes(x, holes) for x in texts), bytes(24)])
        buf = LOWER[np.frombuffer(raw, dtype=np.uint8)]
        kind = KIND[buf[:-24]]  # the end mark of the last text, without the room behind it
        start = np.concatenate(([True], kind[1:] != kind[:-1])) | (kind == DIGIT) | (kind == END) | (kind == HOLE)
        # contractions: an apostrophe that begins a run takes the letters after it
        sign = np.flatnonzero((buf[: len(kind)] == ord("'")) & start)
        x, y = buf[sign + 1], buf[sign + 2]
        two = np.isin(x, np.frombuffer(b"stmd", dtype=np.uint8))
        three = (y == ord("e")) & ((x == ord("r")) | (x == ord("v"))) | (x == ord("l")) & (y == ord("l"))
        cut = two | three
        start[sign[cut] + 1] = False
        start[sign[cut] + np.where(two[cut], 2, 3)] = True
        at = np.flatnonzero(start)
        length, what = np.diff(np.append(at, len(kind))), kind[at]
        runs = what != SPACE
        at, length, what = at[runs], length[runs], what[runs]
        is_end, is_hole = what == END, what == HOLE
        plain = ~(is_end | is_hole)
        number = np.zeros(len(at), dtype=np.int64)
        number[plain] = self._numbers(buf, at[plain], length[plain])
        pool, starts = [self.ids, np.array([end_id], dtype="<u4")], [self.starts, [len(self.ids) + 1]]
        number[is_end] = len(self.starts) - 1
        if holes:
            place = {w: k for k, w in enumerate(dict.fromkeys(holes))}
            got = [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(list(place), add_special_tokens=False)]
            pool += got
            starts.append(len(self.ids) + 1 + np.cumsum([len(x) for x in got]))
            number[is_hole] = [len(self.starts) + place[w] for w in holes]
        ids, starts = np.concatenate(pool), np.concatenate(starts)
        each = starts[number + 1] - starts[number]
        last = np.cumsum(each)[is_end]
        return self._gather(ids, starts[number], each), np.diff(np.concatenate(([0], last)))


#: Characters encoded in one step.
STEP_CHARS = 1 << 19
WHITE = re.compile("[\t-\r ]")


def stretches(text: str, size: int) -> Iterator[tuple[str, bool]]:
    """The text in stretches of ``size`` characters or more that end before ASCII white space, and whether each is the last."""
    at = 0
    while len(text) - at > size and (m := WHITE.search(text, at + size)):
        yield text[at : m.start()], False
        at = m.start()
    yield text[at:] if at else text, True


def encode_to_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_tokens: int = 1 << 22,
) -> None:
    """Encode whole texts and write segments to ``path``, in ascending id order (null ids first).

    Each document is followed by ``end_id``; null and empty texts yield only that. Rows that repeat an id
    are all written, ordered by their text's hash. A segment closes at the first document that brings it
    to ``segment_tokens`` and is one file. An empty table writes no segment. Files are written by Spark's
    own committer: a lost executor leaves no half file behind, and any store that Spark knows will do.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
        """Stretches of texts, as (doc_id, stretch, whether the text ends with it), of about ``STEP_CHARS`` in all."""
        some, size = [], 0
        for b in batches:
            for name, text in zip(b["doc_id"].astype(object).where(b["doc_id"].notna(), None).tolist(), b["text"].tolist(), strict=True):
                for stretch, last in stretches(text, STEP_CHARS):
                    if some and size + len(stretch) > STEP_CHARS:
                        yield some
                        some, size = [], 0
                    some.append((name, stretch, last))
                    size += len(stretch)
        if some:
            yield some

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = kept(("encoder", tokenizer_file), lambda: RunCachingEncoder(tokenizer_file))
        task, before, out = TaskContext.get().partitionId(), 0, SegmentWriter()
        for some in steps(batches):
            ids, n = encoder.encode([x for _, x, _ in some], end_id)
            done = 0
            for (name, _, last), k in zip(some, n.tolist(), strict=True):
                out.add(ids[done : done + k - (not last)])
                done += k
                if last:
                    out.end_document(name)
                    if out.n >= segment_tokens:
                        yield pd.DataFrame({"segment": [out.pack(task, before)]})
                        before, out = before + out.n, SegmentWriter()
        if out.doc_ids:
            yield pd.DataFrame({"segment": [out.pack(task, before)]})

    packed = rows.select("doc_id", "text").mapInPandas(run, "segment binary")
    # The text writer puts a string's bytes into the file as they are, and a binary cast to string keeps its bytes
    packed.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def task_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """Tokens before each writing task: one number for each task of the write, not for each document."""
    part = lambda at: F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("long")
    files = segments(spark, path).select(part(9).alias("n"), part(25).alias("task"))
    totals = sorted((r["task"], r["n"]) for r in files.groupBy("task").agg(F.sum("n").alias("n")).collect())
    out, before = {}, 0
    for task, n in totals:
        out[task], before = before, before + n
    return out


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segment files as rows with their ``content``."""
    return spark.read.format("binaryFile").load(path).where("length >= 48").select("content")


def map_documents(spark: SparkSession, path: str, each: Callable[[np.ndarray], object], column: str, kind: str) -> DataFrame:
    """Read the files at ``path`` back: doc_id, start, n_tokens and ``each`` of a document's ids."""
    starts = task_starts(spark, path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                s = Segment(content)
                ids, base, cuts = s.decode(), starts[s.task] + s.before, s.starts.tolist()
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([int(x) if k else None for x, k in zip(s.doc_ids, s.known, strict=True)], dtype="Int64"),
                        "start": base + s.starts[:-1],
                        "n_tokens": np.diff(s.starts),
                        column: [each(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)],
                    }
                )

    return segments(spark, path).mapInPandas(run, f"doc_id long, start long, n_tokens long, {column} {kind}")


def stored_tokens(docs: DataFrame, tokenizer_file: str, end_id: int = 1) -> DataFrame:
    """Write the tokens of ``docs`` to the shared folder, read the files back, and describe each document."""
    import zlib

    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    encode_to_files(docs, path, tokenizer_file, end_id)
    return map_documents(spark, path, lambda ids: zlib.crc32(ids.tobytes()), "ids_crc32", "long")
