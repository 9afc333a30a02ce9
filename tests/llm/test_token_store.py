"""Codes decode to what was packed, any token is read on its own, and files hold what the tokenizer gives."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from moneyflow.llm import token_store as S

PATH = P.path("word_bpe_49k.json")
TOKENIZER, SMALL = Tokenizer.from_file(PATH), S.RunCachingEncoder(PATH, table_bits=3, room=5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 70_000) | st.integers(0, 2**32 - 1), max_size=700), min_size=1, max_size=4))
def test_round_trip_and_random_access(docs):
    ids = np.array([x for d in docs for x in d], dtype="<u4")
    s = S.Segment(S.pack_segment(ids, list(range(len(docs) - 1)) + [None], [len(d) for d in docs], 3, 17))
    assert (s.decode() == ids).all() and (s.task, s.before, s.n_docs) == (3, 17, len(docs))
    assert s.known.tolist() == [True] * (len(docs) - 1) + [False]
    for i in range(0, len(ids), 37):
        assert s.token(i) == ids[i]
    a, b = len(ids) // 3, len(ids) * 2 // 3
    assert (s.slice(a, b) == ids[a:b]).all()
    with pytest.raises(IndexError):
        s.token(len(ids))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(alphabet="aB'sß Σς\t\n ́\x1c<|endoftext>", max_size=40), min_size=1, max_size=5))
def test_run_cache_equals_whole_texts(texts):
    got, n = SMALL.encode(texts, 1)
    want = [TOKENIZER.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert n.tolist() == [len(w) for w in want] and got.tolist() == [x for w in want for x in w]


def test_other_tokenizers_get_whole_texts(tmp_path):
    """A vocabulary with case, or cut at other places, or byte-level: the library's own ids, not those of lower-case runs."""
    import json

    made = json.loads(TOKENIZER.to_str())
    variants = {"cased": made | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}, "cut": made | {"pre_tokenizer": made["pre_tokenizer"]["pretokenizers"][1]}}
    paths = {"bytes": P.path("byte_bpe_50k.json")}
    for name, text in variants.items():
        paths[name] = str(tmp_path / name)
        (tmp_path / name).write_text(json.dumps(text))
    for path in paths.values():
        encoder, own = S.RunCachingEncoder(path), Tokenizer.from_file(path)
        assert not encoder.by_run
        texts = ["Hello hello don,t", "", "A\tB  c's 42"]
        got, n = encoder.encode(texts, 7)
        want = [own.encode(t, add_special_tokens=False).ids + [7] for t in texts]
        assert got.tolist() == [x for w in want for x in w] and n.tolist() == [len(w) for w in want]
    assert SMALL.by_run


def test_long_texts_are_cut_at_white_space(spark):
    text = "".join(f"Word{k}'s {k}\n" for k in range(150_000)) + "x" * 700_000
    parts = list(S.stretches(text, 1000))
    assert "".join(x for x, _ in parts) == text and [last for _, last in parts] == [False] * (len(parts) - 1) + [True]
    ids = TOKENIZER.encode(text, add_special_tokens=False).ids + [1]
    r = S.stored_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_files(spark):
    rows = [(5, "five five", "x"), (3, None, "x"), (4, "", "x"), (None, "no id", "x"), (1, "Hello  World " * 3000, "x"), (5, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = S.stored_tokens(docs, PATH).collect()
    tok = Tokenizer.from_file(PATH)
    crc = lambda t: zlib.crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(i), crc(t)) for i, t, _ in rows)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [None, 1, 3, 4, 5, 5]
    at = 0
    for r in in_order:
        assert r.start == at
        at += r.n_tokens
    assert S.stored_tokens(docs.where("false"), PATH).count() == 0


def test_query_equals_whole_texts(spark):
    from moneyflow.llm.queries import op1_token_store

    sf = "/root/testdata/sf0.001"
    tok, start = Tokenizer.from_file(PATH), 0
    got = {r.doc_id: r for r in op1_token_store(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
