"""The pipeline stage by stage against plain Python, each stage on its own input."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from moneyflow.llm import decontam, line_dedup, simhash
from moneyflow.llm.common import table
from tests.llm.test_line_dedup import key as line_key, plain as dedup_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    out, docs = {}, table(spark, SF, "documents")
    for name, f in C.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, docs, SF).write.parquet(path)
        got = spark.read.parquet(path)
        out[name] = (docs.collect(), got.collect(), got.columns)
        docs = got
    return out


def test_columns(stages):
    own = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [c for _, _, c in stages.values()][:4] == [own] * 4 and [n for n, _ in C.STAGES] == list(stages)


def test_quality_drops_rejected_rows_only(spark, stages):
    before, after, _ = stages["quality"]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    good = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and len(kept.intersection(good)) > 0.93 * len(good) and len(after) < len(before)


def test_lines(stages):
    before, after, _ = stages["line_dedup"]
    clean = dedup_lines([(r.doc_id, r.text) for r in before], 50)
    want = {r.doc_id: t for r in before if (t := clean[line_key(r.doc_id, r.text)]) == r.text or t.split()}
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)


def test_near_duplicates(stages):
    """One document of each group of five-word similarity 0.8 or more, whatever the fingerprints: all pairs are compared."""
    before, after, _ = stages["near_dedup"]
    sets = [simhash.shingle_set(r.text or "", 5) for r in before]
    root = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    want = {min(before[i].doc_id for i in range(len(before)) if root[i] == r) for r in set(root)}
    assert {r.doc_id for r in after} == want


def test_contaminated_documents_go(spark, stages):
    before, after, _ = stages["decontamination"]
    matcher = decontam.Matcher([(r.item_id, decontam.normal(r.text)) for r in table(spark, SF, "benchmark").collect()], decontam.RATE)
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not matcher.matches(r.text)}


def test_pieces_decode_to_the_texts(stages):
    before, after, _ = stages["pieces"]
    assert {r.doc_id: r.text_crc32 for r in after} == {r.doc_id: zlib.crc32(r.text.encode()) for r in before}


def test_nulls_clashing_names_and_empty_tables(spark):
    """Every stage takes null and empty texts, null and repeated ids, columns of any name, and no rows at all."""
    long = "\n".join(" ".join(f"w{k}x{j}" for j in range(12)) for k in range(8))
    rows = [(1, long, "a", None, 1, 2), (1, long, "a", None, 1, 2), (None, long + " more", None, "s", 1, 2), (2, None, "a", "s", 1, 2), (3, "", "a", "s", 1, 2), (4, " \n ", "a", "s", 1, 2)]
    schema = "doc_id long, text string, lang string, source string, __id long, node long"
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit("own") for c in ("hash", "__hash", "starts", "score", "ids", "key", "__spans", "item_id")}).withColumn("n_chars", F.length("text").cast("long"))
    kept = {"quality": None, "line_dedup": 6, "near_dedup": 3, "decontamination": 6, "pieces": 6}
    for name, f in C.STAGES:
        out = f(spark, docs, SF)
        got = out.collect()
        assert name == "pieces" or out.columns == docs.columns and all(r["__hash"] == "own" and r.node == 2 for r in got), name
        assert kept[name] is None or len(got) == kept[name], (name, got)
        assert f(spark, docs.where("false"), SF).count() == 0, name


def test_run_equals_stages(spark, stages):
    key = lambda rows: sorted((r.doc_id, r.n_tokens, r.ids_crc32, r.text_crc32) for r in rows)
    assert key(C.run(spark, SF).collect()) == key(stages["pieces"][1])


def test_long_run_helper():
    assert line_dedup.long_runs(["a b", "c", "d e f"], [(0, 2), (1, 2)], 5) == [(0, 3)]
