"""SentencePiece segmentations sampled from the piece lattice, and lossless decoding.

Forward filtering, backward sampling: forward sums over the lattice of all segmentations of a chunk, then
arcs drawn from the chunk's end to its start, each in proportion to the forward sum it comes from, which
draws whole segmentations by their exact probabilities. Draws are a hash of (seed, row key, chunk number,
step), so a row's segmentation depends on nothing else: not on partitions, batches or retries.

No piece of the model holds the word sign after another character, so the lattice of a text falls into
independent chunks (spaces and the word after them). A chunk's lattice is built once and kept while there
is room; the draws of all chunks of a batch go step by step in arrays.

A byte-pair model ranks its pieces but gives no probabilities: a piece at rank r gets the Zipf-Mandelbrot
weight 1 / (r + 2.7), raised to ``sharpness``. Characters without a piece, line ends, and the word sign
itself where a text holds it, are spelt in the model's byte pieces: decoding gives the text back exactly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import kept

SIGN = "▁"
CHUNKS = re.compile(f" +[^ \n{SIGN}]*|[^ \n{SIGN}]+|\n|{SIGN}")
#: Characters handled in one step, and arcs kept from one batch to the next.
STEP_CHARS, ARCS_KEPT = 1 << 18, 3_000_000
#: Characters of the step table; chunks with others, and chunks over so many characters, take the plain loop.
DENSE_CHARS, DENSE_LENGTH = 127, 60
#: Longer chunks are sampled window by window, and nothing of them is kept.
WINDOW = 1 << 12


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, by wrapping unsigned arithmetic."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, kind: str):
        self.data, self.n = np.zeros(1024, dtype=kind), 0

    def extend(self, values) -> None:
        while self.n + len(values) > len(self.data):
            self.data = np.concatenate((self.data, np.zeros_like(self.data)))
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class PieceSampler:
    def __init__(self, model_file: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.weights: dict[str, tuple[int, float]] = {}
        self.bytes_of, self.byte_id = [b""] * model.get_piece_size(), [0] * 256
        rank = 0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.bytes_of[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SIGN in piece.lstrip(SIGN):
                    raise ValueError("a piece goes past the start of a word")
                self.weights[piece] = (i, (rank + 2.7) ** -sharpness)
                self.bytes_of[i] = piece.replace(SIGN, " ").encode()
                rank += 1
        self.byte_weight = (rank + 2.7) ** -sharpness
        self.longest = max(map(len, self.weights))
        self.prefixes = {p[:n]: (-1, 0.0) for p in self.weights for n in range(1, len(p))} | self.weights
        self._make_trie()
        self.forget()

    def _make_trie(self) -> None:
        """The pieces over the commonest characters as a table of steps: (node, character) -> node, or -1."""
        often: dict[str, int] = {}
        for p in self.weights:
            for c in p:
                often[c] = often.get(c, 0) + 1
        common = sorted((c for c in often if c in self.weights and ord(c) < 0xFFFF), key=lambda c: (-often[c], c))[:DENSE_CHARS]
        self.char_code = np.zeros(1 << 16, dtype=np.uint8)  # 0: not among them
        self.char_code[[ord(c) for c in common]] = np.arange(1, len(common) + 1)
        known = set(common)
        own = [p for p in self.weights if known.issuperset(p)]
        names = sorted({p[:n] for p in own for n in range(len(p) + 1)})
        node = {x: k for k, x in enumerate(names)}  # the empty prefix comes first: node 0
        self.trie = np.full((len(names), len(common) + 1), -1, dtype=np.int32)
        for x, k in node.items():
            if x:
                self.trie[node[x[:-1]], self.char_code[ord(x[-1])]] = k
        self.node_piece = np.array([self.weights[x][0] if x in self.weights else -1 for x in names], dtype=np.int32)
        self.piece_weight = np.zeros(len(self.bytes_of))
        for i, w in self.weights.values():
            self.piece_weight[i] = w

    def forget(self) -> None:
        self.ends: dict[str, int] = {}  # chunk -> its last state; a state is a place between characters
        self.up, self.came, self.token, self.first_arc = _Grown("f4"), _Grown("i4"), _Grown("i4"), _Grown("i4")
        self.spelt: list[list[int]] = []  # ids of the arcs with several tokens, which have -1 - place as token

    def arcs(self, chunk: str) -> list[list[tuple[float, int, tuple[int, ...]]]]:
        """For each end 1..n of the chunk: (probability given the end, start, ids) of the arcs that lead there."""
        raw = chunk in (SIGN, "\n")
        w = chunk if raw else chunk.replace(" ", SIGN)
        n, get, found = len(w), self.prefixes.get, [[] for _ in range(len(w))]
        forward = [1.0] + [0.0] * n
        for i in range(n):
            here = forward[i]
            if here < 1e-150:  # only sums from here on are needed, and only their proportions matter
                for j in range(i, min(n, i + self.longest) + 1):
                    forward[j] *= 1e150
                    if j > i:
                        found[j - 1] = [(x * 1e150, k, ids) for x, k, ids in found[j - 1]]
                here = forward[i]
            j, known = i + 1, False
            while j <= n and not raw:
                got = get(w[i:j])
                if got is None:
                    break
                if got[0] >= 0:
                    known |= j == i + 1
                    x = here * got[1]
                    forward[j] += x
                    found[j - 1].append((x, i, (got[0],)))
                j += 1
            if not known:
                ids = tuple(self.byte_id[b] for b in w[i].encode())
                x = here * self.byte_weight ** len(ids)
                forward[i + 1] += x
                found[i].append((x, i, ids))
        return [[(x / forward[j], i, ids) for x, i, ids in arcs] for j, arcs in enumerate(found, 1)]

    def _learn(self, chunks: list[str]) -> None:
        length = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        points = np.frombuffer("".join(chunks).replace(" ", SIGN).encode("utf-32-le"), dtype="<u4")
        code = self.char_code[np.minimum(points, 0xFFFF)]
        plain = length > DENSE_LENGTH
        plain[np.repeat(np.arange(len(chunks)), length)[code == 0]] = True
        if SIGN in chunks:
            plain[chunks.index(SIGN)] = True
        if not plain.all():
            self._learn_dense([c for c, x in zip(chunks, plain, strict=True) if not x], code[~np.repeat(plain, length)], length[~plain])
        if plain.any():
            self._learn_plain([c for c, x in zip(chunks, plain, strict=True) if x])

    def _learn_dense(self, chunks: list[str], code: np.ndarray, length: np.ndarray) -> None:
        """``arcs`` for many chunks at once. A state is a character's place: the boundary after it."""
        stop = np.cumsum(length)
        word = np.repeat(np.arange(len(chunks)), length)
        begin, end = (stop - length)[word], stop[word]
        at, node, found = np.arange(len(code)), np.zeros(len(code), dtype=np.int32), []
        for n in range(self.longest):
            node = self.trie[node, code[at + n]]
            on = node >= 0
            at, node = at[on], node[on]
            piece = self.node_piece[node]
            hit = piece >= 0
            found.append((at[hit], at[hit] + n, piece[hit]))
            on = at + n + 1 < end[at]
            at, node = at[on], node[on]
        first, last, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        weight, offset = self.piece_weight[piece], first - begin[first]
        forward = np.zeros(len(code))
        order = np.argsort(offset.astype(np.int8), kind="stable")
        cuts = np.concatenate(([0], np.cumsum(np.bincount(offset))))
        mass = np.zeros(len(first))
        for a, b in zip(cuts, cuts[1:], strict=False):  # arcs from the same place of their chunks: ends differ
            k = order[a:b]
            mass[k] = weight[k] if a == 0 else forward[first[k] - 1] * weight[k]
            forward[last[k]] += mass[k]
        order = np.argsort(last, kind="stable")
        first, last, piece, mass = first[order], last[order], piece[order], mass[order]
        starts = np.flatnonzero(np.concatenate(([True], last[1:] != last[:-1])))
        total = np.cumsum(mass / forward[last])
        up = (total - np.repeat(np.concatenate(([0.0], total[starts[1:] - 1])), np.diff(np.concatenate((starts, [len(last)]))))).astype(np.float32)
        up[np.concatenate((starts[1:], [len(last)])) - 1] = 2.0
        base = self.first_arc.n
        self.first_arc.extend(self.up.n + starts)
        self.up.extend(up)
        self.came.extend(np.where(first == begin[first], -1, base + first - 1))
        self.token.extend(piece)
        self.ends.update(zip(chunks, (base + stop - 1).tolist(), strict=True))

    def _learn_plain(self, chunks: list[str]) -> None:
        up, came, token, first = [], [], [], []
        states, arcs_before = self.first_arc.n, self.up.n
        for chunk in chunks:
            base = states + len(first)
            for arcs in self.arcs(chunk):
                arcs.sort(reverse=True)  # likely arcs are met first
                first.append(arcs_before + len(up))
                total = 0.0
                for p, i, ids in arcs:
                    total += p
                    up.append(total)
                    came.append(base + i - 1 if i else -1)
                    if len(ids) == 1:
                        token.append(ids[0])
                    else:
                        self.spelt.append(ids)
                        token.append(-len(self.spelt))
                up[-1] = 2.0
            self.ends[chunk] = states + len(first) - 1
        for grown, values in ((self.up, up), (self.came, came), (self.token, token), (self.first_arc, first)):
            grown.extend(values)

    def _reach(self, w: str, raw: bool, a: int, b: int, sums: list[float]) -> tuple[list[list[tuple]], list[float]]:
        """One window of a long chunk: the arcs that end at a + 1 .. b, and the forward sums of the last places up to b.

        ``sums`` are the forward sums of the places up to ``a`` from which an arc can reach beyond it, in proportion.
        """
        from_ = a + 1 - len(sums)
        forward, found, get = sums + [0.0] * (b - a), [[] for _ in range(b - a)], self.prefixes.get
        for i in range(from_, b):
            here = forward[i - from_]
            if here < 1e-150:
                for j in range(i, min(b, i + self.longest) + 1):
                    forward[j - from_] *= 1e150
                    if j > a:
                        found[j - a - 1] = [(x * 1e150, k, ids) for x, k, ids in found[j - a - 1]]
                here = forward[i - from_]
            j, known = i + 1, False
            while j <= len(w) and not raw:
                got = get(w[i:j])
                if got is None:
                    break
                if got[0] >= 0:
                    known |= j == i + 1
                    if a < j <= b:
                        forward[j - from_] += here * got[1]
                        found[j - a - 1].append((here * got[1], i, (got[0],)))
                j += 1
            if not known and i >= a:
                ids = tuple(self.byte_id[x] for x in w[i].encode())
                x = here * self.byte_weight ** len(ids)
                forward[i + 1 - from_] += x
                found[i - a].append((x, i, ids))
        last = forward[max(0, b + 1 - self.longest - from_) :]
        top = max(last)
        return found, [x / top for x in last]

    def _sample_long(self, chunk: str, seed: np.uint64) -> np.ndarray:
        """Ids of one long chunk: forward sums are kept at window ends only, and arcs of one window at a time."""
        raw = chunk in (SIGN, "\n")
        w = chunk if raw else chunk.replace(" ", SIGN)
        ends, sums = list(range(0, len(w), WINDOW)), [[1.0]]
        for a in ends[:-1]:
            sums.append(self._reach(w, raw, a, a + WINDOW, sums[-1])[1])
        at, t, out = len(w), 0, []
        for a, before in zip(reversed(ends), reversed(sums), strict=True):
            if at <= a:
                continue
            arcs = self._reach(w, raw, a, min(a + WINDOW, len(w)), before)[0]
            steps = np.arange(t, t + at - a, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + seed
            draws = ((_mix(steps) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)).tolist()
            first = t
            while at > a:
                own = arcs[at - a - 1]
                total, left = sum(x for x, _, _ in own), 0.0
                pick = own[-1]
                for arc in own:
                    left += arc[0]
                    if draws[t - first] * total < left:
                        pick = arc
                        break
                out.append(pick[2])
                at, t = pick[1], t + 1
        return np.array([i for ids in reversed(out) for i in ids], dtype=np.int32)

    def _sample(self, chunks: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, and the number of ids of each."""
        long = [k for k, c in enumerate(chunks) if len(c) > WINDOW]
        if long:
            own = np.ones(len(chunks), dtype=bool)
            own[long] = False
            ids, n = self._sample([c for c, x in zip(chunks, own, strict=True) if x], seeds[own]) if own.any() else (np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
            each, cuts = [None] * len(chunks), np.concatenate(([0], np.cumsum(n)))
            for k, a, b in zip(np.flatnonzero(own).tolist(), cuts, cuts[1:], strict=False):
                each[k] = ids[a:b]
            for k in long:
                each[k] = self._sample_long(chunks[k], seeds[k])
            return np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)
        new = set(chunks).difference(self.ends)
        if new:
            self._learn(sorted(new))
        state = np.fromiter(map(self.ends.__getitem__, chunks), dtype=np.int32, count=len(chunks))
        up, came, first_arc = self.up.data, self.came.data, self.first_arc.data
        who, steps, taken, t = np.arange(len(chunks)), np.zeros(len(chunks), dtype=np.int64), [], 0
        while len(who):
            seed = seeds[who] if t else seeds
            u = ((_mix(seed + np.uint64(t * 0xD1B54A32D192ED03 % (1 << 64))) >> np.uint64(40)).astype(np.float32)) * np.float32(2.0**-24)
            arc = first_arc[state]
            on = np.flatnonzero(up[arc] <= u)
            while len(on):
                arc[on] += 1
                on = on[up[arc[on]] <= u[on]]
            taken.append((who, arc))
            steps[who] += 1
            state = came[arc]
            left = np.flatnonzero(state >= 0)
            who, state, t = who[left], state[left], t + 1
        before = np.cumsum(steps) - steps
        arcs = np.zeros(int(steps.sum()), dtype=np.int64)
        for k, (who, arc) in enumerate(taken):
            arcs[before[who] + steps[who] - 1 - k] = arc
        ids = self.token.data[arcs]
        many = np.flatnonzero(ids < 0)
        if len(many):
            n = np.ones(len(ids), dtype=np.int64)
            spelt = [self.spelt[-1 - k] for k in ids[many].tolist()]
            n[many] = [len(x) for x in spelt]
            ids, per_arc = np.repeat(ids, n), np.concatenate(([0], np.cumsum(n)))
            at = np.concatenate([np.arange(a, a + len(x)) for a, x in zip(per_arc[many].tolist(), spelt, strict=True)])
            ids[at] = [i for x in spelt for i in x]
            return ids, per_arc[before + steps] - per_arc[before]
        return ids, steps

    def encode(self, text: str, key: int, seed: int) -> np.ndarray:
        return self.encode_all([text], [key], seed)[0]

    def encode_all(self, texts: list[str], keys: list[int], seed: int) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        at = 0
        with np.errstate(over="ignore"):
            row = _mix(np.array([k % (1 << 64) for k in keys], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 64)))
            while at < len(texts):
                size, to = 0, at
                while to < len(texts) and (to == at or size + len(texts[to]) <= STEP_CHARS):
                    size, to = size + len(texts[to]), to + 1
                if to == at + 1:
                    out.append(self._encode_long(texts[at], row[at]))
                else:
                    out += self._encode_some([CHUNKS.findall(" " + t) if t else [] for t in texts[at:to]], row[at:to], [0] * (to - at))
                at = to
        return out

    def _encode_long(self, text: str, row: np.uint64) -> np.ndarray:
        """One text, in stretches that end before a space."""
        parts, at, done, text = [], 0, 0, " " + text if text else ""
        while at < len(text):
            to = min(at + STEP_CHARS, len(text))
            while 0 < to < len(text):  # chunks begin with the first of a run of spaces
                to = text.find(" ", to)
                if to < 0:
                    to = len(text)
                elif text[to - 1] == " ":
                    to += 1
                    continue
                break
            chunks = CHUNKS.findall(text[at:to])
            parts += self._encode_some([chunks], np.array([row]), [done])
            at, done = to, done + len(chunks)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)

    def _encode_some(self, chunks: list[list[str]], rows: np.ndarray, first: list[int]) -> list[np.ndarray]:
        if self.up.n > ARCS_KEPT:
            self.forget()
        n = np.array([len(c) for c in chunks], dtype=np.int64)
        if not n.sum():
            return [np.zeros(0, dtype=np.int32) for _ in chunks]
        ends = np.cumsum(n)
        number = np.arange(ends[-1]) - np.repeat(ends - n - np.array(first), n)
        seeds = np.repeat(rows, n) + number.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        ids, per_chunk = self._sample([c for x in chunks for c in x], _mix(seeds))
        cuts = np.concatenate(([0], np.cumsum(per_chunk)))[np.concatenate(([0], ends))]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The text: every piece's bytes, without the space that was put before the first word."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace") if len(ids) else ""


def encode(docs: DataFrame, model_file: str, seed: int = 1, sharpness: float = 1.0, id_col: str = "doc_id", text_col: str = "text", described: bool = False) -> DataFrame:
    """(doc_id, ids): a sampled segmentation of each whole text; null and empty texts have no ids.

    The id is the row key: rows that repeat an id and a text get the same ids, a null id counts as 0. With
    ``described`` also n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers) and text_crc32 (of
    the UTF-8 that the ids decode to); one Python worker does both, which halves their memory.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = kept(("pieces", model_file, sharpness), lambda: PieceSampler(model_file, sharpness))
        for b in batches:
            keys = b["doc_id"].astype("Int64").fillna(0).astype("int64").tolist()
            for at in range(0, len(b), 200):
                part = b.iloc[at : at + 200]
                ids = sampler.encode_all([t or "" for t in part["text"]], keys[at : at + 200], seed)
                out = {"doc_id": part["doc_id"].astype("Int64").reset_index(drop=True), "ids": ids}
                if described:
                    out["n_tokens"] = [len(x) for x in ids]
                    out["ids_crc32"] = [zlib.crc32(x.astype("<i4").tobytes()) for x in ids]
                    out["text_crc32"] = [zlib.crc32(sampler.decode(x).encode()) for x in ids]
                yield pd.DataFrame(out)

    return rows.mapInPandas(run, "doc_id long, ids array<int>" + ", n_tokens long, ids_crc32 long, text_crc32 long" * described)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids) with ``text`` again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = kept(("pieces", model_file, 1.0), lambda: PieceSampler(model_file))
        for b in batches:
            yield b.assign(text=[sampler.decode(x) for x in b["ids"]])

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, ids array<int>, text string")
