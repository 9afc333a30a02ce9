"""Shards against a plain version; counts, mixtures, slots."""

import zlib
from collections import Counter

import xxhash

from moneyflow.llm import interleave as I
from moneyflow.llm.queries import op3_interleave

SF = "/root/testdata/sf0.001"


def test_shards_match_the_mixture(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op3_interleave(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    share = Counter(d.source for d in docs.values())
    mix = Counter((r.shard, docs[r.doc_id].source) for r in got)
    assert all(abs(mix[s, x] - share[x] * counts[s] / len(docs)) < 2 for s in counts for x in share)
    for r in got:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def _hash(seed, *values):
    """Spark's xxhash64 of (int, long, long, long): each value is hashed with the former result as seed."""
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest((v % (1 << 64)).to_bytes(8, "little"), h)
    return h - (1 << 64) if h >> 63 else h


def test_order_equals_plain_version(spark):
    rows = [(k, "t" * (k % 7) if k % 11 else None, None if k % 13 == 0 else f"s{min(k % 5, 2)}", "x") for k in range(101)] + [(5, "again", "s0", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string")
    got = sorted(I.interleave(docs, 4).collect(), key=lambda r: (r.shard, r.slot))
    plain = []
    for i, t, s, _ in rows:
        raw = (t or "").encode()
        plain.append(("=" + s if s is not None else "", _hash(I.SEED, i, len(raw) + 1, zlib.crc32(raw)), i, len(raw) + 1, zlib.crc32(raw)))
    totals, order = Counter(p[0] for p in plain), []
    for stratum, n in totals.items():
        for rank, p in enumerate(sorted(x for x in plain if x[0] == stratum)):
            order.append(((rank + 0.5) / n, p))
    assert [(r.stratum, r.doc_id, r.size) for r in got] == [(p[0], p[2], p[3]) for _, p in sorted(order)]
    assert I.interleave(docs.where("false"), 4).count() == 0


def test_written_shards_hold_all_rows_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    I.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count() and sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={k}" for k in range(4)]
