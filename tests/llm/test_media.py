"""Formats are confirmed by structure, carved whole, and payloads come back byte for byte."""

import gzip
import hashlib
import io
import struct
import zipfile
import zlib

from hypothesis import given, settings, strategies as st

from moneyflow.llm import media as M
from moneyflow.llm.queries import op9_media


def png():
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\1")) + chunk(b"IEND", b"")


def zipped():
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("a", "hello" * 20)
    return b.getvalue()


GIF = b"GIF89a\1\0\1\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\1\0\1\0\0\2\2D\1\0;"
BMP = struct.pack("<2sIIIIiiHH", b"BM", 58, 0, 54, 40, 1, 1, 1, 24) + bytes(24) + b"\1\2\3\0"
JPEG = b"\xff\xd8\xff\xe0\0\4ab\xff\xda\0\4xx\1\2\xff\0\3\xff\xd9"
SAMPLES = {
    "image/png": png(), "image/gif": GIF, "image/bmp": BMP, "image/jpeg": JPEG, "application/gzip": gzip.compress(b"abc" * 99), "application/zip": zipped(),
    "application/pdf": b"%PDF-1.4\nstartxref\n0\n%%EOF", "audio/wav": M.pack_wav(b"abc"),
}


def test_each_format_is_found_carved_and_rejected_when_cut():
    for kind, data in SAMPLES.items():
        assert (kind, 0, len(data)) in M.sniff(data), kind
        assert (kind, 5, 5 + len(data)) in M.sniff(b"junk " + data + b" tail"), kind
        assert all(k != kind or j <= len(data) - 3 for k, i, j in M.sniff(data[:-3])), kind


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=300))
def test_wav_round_trip(data):
    assert M.unpack(M.pack_wav(data))[0] == data
    M.sniff(b"RIFF" + data), M.sniff(b"PK\3\4" + data), M.sniff(b"GIF89a" + data), M.sniff(b"\xff\xd8\xff" + data)


def test_column(spark):
    rows = [(1, "image/png", M.pack_wav(png())), (2, "image/png", png()), (3, None, None), (4, "x", b""), (5, "x", b"plain text BM PK")]
    got = {r.id: r for r in M.sniff_column(spark.createDataFrame(rows, "id int, declared string, media binary"), "media", "declared").collect()}
    assert got[1].media_type == "audio/wav" and got[1].type_was_wrong and [(e.type, bytes(e.content)) for e in got[1].embedded] == [("image/png", png())]
    assert got[2].media_type == "image/png" and not got[2].type_was_wrong and got[3].media_type is None
    assert got[4].media_type == got[5].media_type == "application/octet-stream"


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op9_media(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        raw = docs[r.doc_id].encode()
        p = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        form = M.pack_wav(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(form), hashlib.sha256(form).hexdigest()) and r.feature.startswith("audio/wav;")


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "é" * 300, 0)], "doc_id long, text string, media int")
    got = M.stored_payloads(df).collect()
    assert sorted((r.n_bytes, r.payload_bytes) for r in got) == [(0, 576), (0, 576), (600, 1152)]
    assert len({r.feature for r in got if r.n_bytes == 0}) == 1 and M.stored_payloads(df.where("false")).count() == 0
