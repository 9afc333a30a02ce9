"""Very long texts go through the operators whole; others have such tests beside their own."""

import hashlib
import zlib

from moneyflow.llm import interleave, media, simhash

LONG = " ".join(f"w{k % 7919}x{k}" for k in range(200_000))  # about 2.4 MB
ROWS = [(1, LONG), (2, LONG + " end"), (3, "y" * 2_000_000), (4, "short text"), (5, LONG)]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def test_simhash(spark):
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark)).collect()}
    assert all(got[i].fp % (1 << 64) == simhash.fingerprint(t, 4) for i, t in ROWS)
    assert [got[i].component_id for i in (1, 2, 5)] == [1, 1, 1] and got[3].component_id == 3
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(frame(spark)).collect()) == [1, 3, 4]


def test_interleave(spark):
    docs = frame(spark).selectExpr("doc_id", "text", "'s' AS source")
    got = {r.doc_id: r for r in interleave.interleave(docs, shards=2).collect()}
    assert all(got[i].size == len(t) + 1 and got[i].text_crc32 == zlib.crc32(t.encode()) for i, t in ROWS)


def test_media(spark):
    got = {r.doc_id: r for r in media.stored_payloads(frame(spark)).collect()}
    for i, t in ROWS:
        raw = t.encode()
        padded = raw + b"\xff" * (-len(raw) % 576)
        assert got[i].n_bytes == len(raw) and got[i].payload_sha256 == hashlib.sha256(padded).hexdigest() and got[i].tail_crc32 == zlib.crc32(padded[-32:])
    hits = b"%PDF-1" * 100_000 + b"PK\x03\x04" * 100_000
    assert media.sniff(hits) == []
