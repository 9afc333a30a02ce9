"""Media columns: signature sniffing, type correction and carving.

One Aho-Corasick automaton finds the magic bytes of all known formats in a single pass over a binary value.
A hit counts only if the format's validator confirms its structure and finds where it ends. The format at
offset 0 corrects the declared type; confirmed formats further in are embedded media and are carved out.

``pack_wav`` and ``unpack`` store bytes losslessly as 8-bit unsigned PCM samples in a WAVE container.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import shared_path

Validator = Callable[[bytes, int], int]


def _wav(data: bytes, at: int) -> int:
    """End of a RIFF/WAVE file whose chunks add up, or -1."""
    if len(data) < at + 44 or data[at + 8 : at + 12] != b"WAVE":
        return -1
    end, place, kinds = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little"), at + 12, set()
    while place + 8 <= end <= len(data):
        kinds.add(data[place : place + 4])
        size = int.from_bytes(data[place + 4 : place + 8], "little")
        place += 8 + size + size % 2
    return end if place == end and kinds >= {b"fmt ", b"data"} else -1


def _png(data: bytes, at: int) -> int:
    """End of a PNG whose chunks have right checksums up to IEND."""
    place = at + 8
    if data[place + 4 : place + 8] != b"IHDR":
        return -1
    while place + 12 <= len(data):
        size, kind = int.from_bytes(data[place : place + 4], "big"), data[place + 4 : place + 8]
        stop = place + 12 + size
        if stop > len(data) or zlib.crc32(data[place + 4 : stop - 4]) != int.from_bytes(data[stop - 4 : stop], "big"):
            return -1
        if kind == b"IEND":
            return stop
        place = stop
    return -1


def _gif(data: bytes, at: int) -> int:
    """End of a GIF: blocks walked to the trailer."""
    if len(data) < at + 14:
        return -1
    place = at + 13 + (3 << (data[at + 10] & 7) + 1 if data[at + 10] & 0x80 else 0)
    while place < len(data):
        kind = data[place]
        if kind == 0x3B:
            return place + 1
        if kind == 0x21:
            place += 2
        elif kind == 0x2C and place + 10 < len(data):
            place += 11 + (3 << (data[place + 9] & 7) + 1 if data[place + 9] & 0x80 else 0)
        else:
            return -1
        while place < len(data) and data[place]:
            place += data[place] + 1
        place += 1
    return -1


def _bmp(data: bytes, at: int) -> int:
    """End of a BMP by its size field, with a plausible header."""
    if len(data) < at + 54:
        return -1
    size, zero, offset, header = struct.unpack_from("<IIII", data, at + 2)
    planes, depth = struct.unpack_from("<HH", data, at + 26)
    ok = zero == 0 and header in (40, 52, 56, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32) and 14 + header <= offset <= size
    return at + size if ok and at + size <= len(data) else -1


def _jpeg(data: bytes, at: int) -> int:
    """End of a JPEG: marker segments, then entropy-coded data to the end marker."""
    place, scanned = at + 2, False
    while place + 4 <= len(data):
        if data[place] != 0xFF:
            return -1
        kind = data[place + 1]
        if kind == 0xD9:
            return place + 2 if scanned else -1
        if kind == 0xDA:
            scanned = True
            place += 2 + int.from_bytes(data[place + 2 : place + 4], "big")
            while True:
                place = data.find(b"\xff", place)
                if place < 0 or place + 1 >= len(data):
                    return -1
                if data[place + 1] == 0 or 0xD0 <= data[place + 1] <= 0xD7:
                    place += 2
                    continue
                break
            continue
        if not 0xC0 <= kind <= 0xFE:
            return -1
        size = int.from_bytes(data[place + 2 : place + 4], "big")
        if size < 2:
            return -1
        place += 2 + size
    return place + 2 if scanned and data[place : place + 2] == b"\xff\xd9" else -1


def _gzip(data: bytes, at: int) -> int:
    """End of one gzip member that inflates with the right checksum and length."""
    inflater, place = zlib.decompressobj(31), at
    try:
        while not inflater.eof and place < len(data):
            inflater.decompress(data[place : place + (1 << 16)])
            place += 1 << 16
    except zlib.error:
        return -1
    return min(place, len(data)) - len(inflater.unused_data) if inflater.eof else -1


class Value(bytes):
    """A value that remembers where marks stand in it, so that many hits do not search the same bytes again."""

    def places(self, mark: bytes) -> list[int]:
        known = self.__dict__.setdefault("_places", {})
        if mark not in known:
            known[mark] = [m.start() for m in re.finditer(re.escape(mark), self)]
        return known[mark]

    def after(self, mark: bytes, at: int) -> int:
        """The first place of the mark from ``at`` on, or -1."""
        found = self.places(mark)
        k = bisect_left(found, at)
        return found[k] if k < len(found) else -1

    def archives(self) -> dict[int, int]:
        """Where ZIP archives begin and end by their end records, each of which says how far its directory and start lie before."""
        if "_archives" not in self.__dict__:
            self._archives = {}
            for found in self.places(b"PK\x05\x06"):
                if found + 22 <= len(self):
                    size, offset, comment = struct.unpack_from("<IIH", self, found + 12)
                    begin = found - size - offset
                    if begin >= 0 and offset >= 30 and self[begin + offset : begin + offset + 4] == b"PK\x01\x02":
                        self._archives.setdefault(begin, min(found + 22 + comment, len(self)))
        return self._archives


def _zip(data: Value, at: int) -> int:
    """End of a ZIP: the end record whose directory lies where it says, counted from the first local header."""
    return data.archives().get(at, -1)


def _pdf(data: Value, at: int) -> int:
    """End of a PDF: the last end-of-file mark after a cross-reference pointer and before the next PDF, so that files
    that were updated or are linearized stay whole."""
    pointer, other, marks = data.after(b"startxref", at), data.after(b"%PDF-", at + 5), data.places(b"%%EOF")
    if pointer < 0 or not data[at + 5 : at + 6].isdigit():
        return -1
    k = bisect_left(marks, other if other >= 0 else len(data)) - 1
    return marks[k] + 5 if k >= 0 and marks[k] > pointer else -1


def _flac(data: bytes, at: int) -> int:
    """A FLAC stream with a whole STREAMINFO block runs to the end of the value."""
    return len(data) if data[at + 4 : at + 8] in (b"\x00\x00\x00\x22", b"\x80\x00\x00\x22") and len(data) >= at + 42 else -1


#: Magic bytes, media type, validator.
SIGNATURES: list[tuple[bytes, str, Validator]] = [
    (b"RIFF", "audio/wav", _wav),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"BM", "image/bmp", _bmp),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"%PDF-", "application/pdf", _pdf),
    (b"fLaC", "audio/flac", _flac),
]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    for magic, kind, check in SIGNATURES:
        out.add_word(magic.decode("latin-1"), (len(magic), kind, check))
    out.make_automaton()
    return out


def sniff(data: bytes) -> list[tuple[str, int, int]]:
    """(media type, from, to) of every confirmed format, outermost first; hits that fail validation are left out.

    What lies inside a confirmed format is searched too: containers embed other media. A format whose end
    is not past its start's hit is not reported twice.
    """
    data = Value(data)
    text, out = data.decode("latin-1"), []
    for last, (size, kind, check) in _automaton().iter(text):
        at = last - size + 1
        end = check(data, at)
        if end > at:
            out.append((kind, at, end))
    return sorted(out, key=lambda x: (x[1], -x[2], x[0]))


def pack_wav(payload: bytes, rate: int = 8000) -> bytes:
    """Bytes as unsigned 8-bit mono samples in a WAVE file."""
    pad = len(payload) % 2
    head = b"RIFF" + struct.pack("<I", 36 + len(payload) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8)
    return head + b"data" + struct.pack("<I", len(payload)) + payload + b"\0" * pad


def unpack(media: bytes) -> tuple[bytes, dict]:
    """The samples of a confirmed 8-bit WAVE value and what its format chunk says; raises if it is none."""
    if _wav(media, 0) != len(media):
        raise ValueError("not a whole WAVE file")
    place, info = 12, {}
    while place + 8 <= len(media):
        kind, size = media[place : place + 4], int.from_bytes(media[place + 4 : place + 8], "little")
        if kind == b"fmt ":
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, place + 8)
            info = {"channels": channels, "rate": rate, "bits": bits}
        elif kind == b"data":
            return media[place + 8 : place + 8 + size], info
        place += 8 + size + size % 2
    raise ValueError("no samples")


def payload_of(text: str | None, unit: int = 576) -> tuple[int, bytes]:
    """Length of the text's UTF-8, and the UTF-8 filled with bytes 255 up to a positive multiple of ``unit``."""
    raw = (text or "").encode()
    return len(raw), raw + b"\xff" * (max(1, -(-len(raw) // unit)) * unit - len(raw))


def sniff_column(rows: DataFrame, media_col: str, declared_col: str | None = None) -> DataFrame:
    """Adds ``media_type`` (corrected), ``type_was_wrong`` and ``embedded`` (type, from, to, bytes) to the rows.

    A value without a confirmed format at offset 0 has the type application/octet-stream; null values give
    null. Ties between formats at one offset go to the longer, then to the name.
    """

    rows = rows.drop("media_type", "embedded", "type_was_wrong")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            kinds, inner = [], []
            for data in b[media_col]:
                found = [] if data is None else sniff(data)
                whole = [x for x in found if x[1] == 0]
                kinds.append(None if data is None else whole[0][0] if whole else "application/octet-stream")
                parts = [x for x in found if x not in whole[:1]]
                inner.append(None if data is None else [{"type": k, "start": i, "stop": j, "content": data[i:j]} for k, i, j in parts])
            yield b.assign(media_type=kinds, embedded=inner)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInPandas(run, f"{ddl}, media_type string, embedded array<struct<type:string,start:int,stop:int,content:binary>>")
    return out.withColumn("type_was_wrong", ~F.col(declared_col).eqNullSafe(F.col("media_type")) if declared_col else F.lit(False))


def stored_payloads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text's payload as a media value, read it back, and describe it.

    The values are written to the shared folder under a wrong declared type (as crawled media often are) and
    read back as files; ``feature`` is the corrected type, the sample format, what is embedded, and the
    samples' sum and sum of absolute differences. Null texts count as empty; rows that repeat an id are kept.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "media")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at : at + 256]
                got = [payload_of(t) for t in part["text"]]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "n_bytes": [n for n, _ in got], "media": [pack_wav(p) for _, p in got]})

    stored = rows.mapInPandas(store, "doc_id long, n_bytes long, media binary")
    stored.withColumn("declared", F.lit("text/plain")).write.option("compression", "zstd").parquet(path)
    back = spark.read.schema("doc_id long, n_bytes long, media binary, declared string").parquet(path)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for b in batches:
            out = []
            for media, declared in zip(b["media"], b["declared"], strict=True):
                found = sniff(media)
                payload, info = unpack(media)
                samples = np.frombuffer(payload, dtype=np.uint8)
                change = int(np.abs(np.diff(samples.astype(np.int16))).sum(dtype=np.int64))
                kind = next(k for k, i, j in found if i == 0 and j == len(media))
                inner = ",".join(f"{k}@{i}-{j}" for k, i, j in found if (i, j) != (0, len(media)))
                feature = f"{kind};was={declared};{info['rate']}Hz;{info['channels']}ch;{info['bits']}bit;embedded=[{inner}];sum={int(samples.sum(dtype=np.int64))};change={change}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            d = pd.DataFrame(out, columns=["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
            yield pd.concat([b[["doc_id", "n_bytes"]].astype("Int64").reset_index(drop=True), d], axis=1)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return back.mapInPandas(describe, schema)
