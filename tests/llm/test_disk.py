"""What steps leave on disk."""

import os
import random
import time

from pyspark.sql import functions as F

from moneyflow.llm import common, jaccard, line_dedup, simhash
from moneyflow.llm.common import REMOVE_SHUFFLES, shared_dir, split, stash


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def gone(spark, before):
    """Files are deleted by another thread."""
    end = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return not left


def tables(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file://")))


def new(spark, before):
    return {x.rsplit("-", 1)[0] for x in tables(spark) - before}


def docs(spark):
    rng = random.Random(5)
    lines = [" ".join(f"l{k}w{j}" for j in range(30)) for k in range(40)]
    return spark.createDataFrame([(i, "\n".join(rng.sample(lines, 6) + [f"own{i}"] * 3)) for i in range(60)], "doc_id long, text string")


def test_stash_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = stash(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    assert gone(spark, before) and out.count() == 7 and REMOVE_SHUFFLES not in spark.conf.getAll


def test_steps_leave_only_what_their_results_read(spark):
    before, there = shuffle_files(spark), tables(spark)
    lines = line_dedup.remove_repeats(docs(spark), 50)
    assert new(spark, there) == {"gone"} and gone(spark, before)
    near = simhash.drop_near_duplicates(docs(spark))
    assert not new(spark, there) & {"met", "led", "buckets", "shingles", "sizes", "found"} and gone(spark, before)
    assert lines.count() == 60 and near.count() <= 60


def test_split_finds_every_hash(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, rng.randrange(-(1 << 63), 1 << 63)) for i in range(3000)] + [(9000, -(1 << 63)), (9001, (1 << 63) - 1), (9002, 0), (9003, -1), (9004, None)]
    hashes = [h for i, h in rows if i % 7 == 0 and h is not None] + [-(1 << 63), (1 << 63) - 1, -1, 5]
    table, wanted = spark.createDataFrame(rows, "bitmap_number long, h long"), spark.createDataFrame([(h,) for h in hashes], "x long")
    for most, extra in ((1 << 25, 200), (1 << 15, 400)):
        monkeypatch.setattr(common, "MAX_BITS", most)
        some, others = ({tuple(r) for r in part.collect()} for part in split(table, F.col("h"), wanted))
        assert some | others == set(rows) and not some & others and (9004, None) in others
        within = {r for r in rows if r[1] in set(hashes)}
        assert within <= some and len(some - within) < extra
    some, others = split(table, F.col("h"), wanted.where("false"))
    assert some.count() == 0 and others.count() == len(rows) and others.columns == table.columns


def written(spark, work):
    """Bytes that the stages of this work shuffle."""
    def total():
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty()
        stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = total()
    work()
    return total() - before


def noise(spark, n, passage):
    """Texts of 20 kB of which few hold the passage."""
    rng = random.Random(8)
    body = lambda: "\n".join(" ".join(f"{rng.getrandbits(40):x}" for _ in range(20)) for _ in range(90))
    rows = [(i, body() + ("\n" + passage if i % 40 == 0 else "")) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), sum(len(t) for _, t in rows)


def test_texts_without_repeats_are_not_shuffled(spark):
    passage = "\n".join(" ".join(f"p{k}x{j}" for j in range(20)) for k in range(4))
    docs, size = noise(spark, 240, passage)
    docs, own = stash(docs, "docs"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = []
        moved = written(spark, lambda: got.extend(line_dedup.remove_repeats(docs, 50).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert len(got) == 240 and sum(r.lines_removed for r in got) == 4 * 5 and {r.lines_removed for r in got} == {0, 4}
    assert moved < 0.25 * size


def test_texts_without_near_duplicates_are_not_shuffled(spark):
    docs, size = noise(spark, 240, "")
    twin = docs.where("doc_id = 7").selectExpr("doc_id + 1000 AS doc_id", "text || ' more' AS text")
    docs, own = stash(docs.unionAll(twin), "docs"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = []
        moved = written(spark, lambda: got.extend(r.doc_id for r in simhash.drop_near_duplicates(docs).select("doc_id", "text").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert sorted(got) == list(range(240)) and moved < size


def test_buckets_carry_texts_and_few_shingles(spark):
    rng = random.Random(12)
    bases = [[f"g{g}w{rng.randrange(900)}" for _ in range(1500)] for g in range(12)]
    rows = [(20 * g + k, " ".join(b[: 40 * k] + ["new"] + b[40 * k + 1 :])) for g, b in enumerate(bases) for k in range(12)]
    texts, own = stash(spark.createDataFrame(rows, "node long, text string").repartition(4), "texts"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = []
        moved = written(spark, lambda: got.extend((r.a // 20, r.b // 20) for r in jaccard.similar_links(texts, 5, 0.8).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert {a for a, _ in got} == set(range(12)) and all(a == b for a, b in got)
    assert moved < 2.5 * sum(len(t) for _, t in rows)
