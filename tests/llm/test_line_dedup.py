"""Repeated passages go wherever they stand, the first occurrence and clean documents stay."""

import random
from collections import Counter

import numpy as np
import xxhash

from moneyflow.llm import line_dedup as L

PASSAGE = "\n".join(" ".join(f"p{k}x{j}" for j in range(20)) for k in range(4))
ONE_LINE = " ".join(f"single{j}" for j in range(60))


def line(tag, n=6):
    return " ".join(f"{tag}{j}" for j in range(n))


def key(i, t):
    h = xxhash.xxh64_intdigest((t or "").encode(), 42)
    return (i is not None, i or 0, h - (1 << 64) if h >> 63 else h)


def plain(rows, min_words):
    """The definition without tables: pairs of lines near repeated chunks, by their text; {key: kept text}."""
    docs = {key(i, t): t.split("\n") for i, t in rows if t is not None}
    times, first, near, out = {}, {}, {}, {}
    chunks = {k: [(i, n) for i, n, _ in L.line_chunks("\n".join(lines), min_words)] for k, lines in docs.items()}
    for k, lines in docs.items():
        for i, n in chunks[k]:
            times[n, tuple(lines[i : i + n])] = times.get((n, tuple(lines[i : i + n])), 0) + 1
    for k in sorted(docs):
        lines, near[k] = docs[k], set()
        for i, n in chunks[k]:
            if times[n, tuple(lines[i : i + n])] > 1:
                near[k].add((i, n))
                for step, at in ((-1, i), (1, i + n - 1)):
                    total = 0
                    while 0 <= at + step < len(lines) and total < min_words:
                        near[k].add((min(at, at + step), 2))
                        at += step
                        total += len(lines[at].split())
        for i, n in sorted(near[k]):
            first.setdefault(tuple(lines[i : i + n]), (k, i))
    for k, lines in docs.items():
        gone = {j for i, n in near[k] if first[tuple(lines[i : i + n])] != (k, i) for j in range(i, i + n)}
        kept, at = [], 0
        while at < len(lines):
            to = at
            while to < len(lines) and to in gone:
                to += 1
            if to == at or sum(len(x.split()) for x in lines[at:to]) < min_words:
                to = max(to, at + 1)
                kept += lines[at:to]
            at = to
        out[k] = "\n".join(kept)
    return out


def repeated_lines(rows, min_words):
    """By brute force: (key, line) of every line in a run of two lines and ``min_words`` words that stands earlier, too."""
    docs, out = {key(i, t): t.split("\n") for i, t in rows if t is not None}, set()
    order, places = sorted(docs), {}
    for k in order:
        for i, x in enumerate(docs[k]):
            for fk, fi in places.get(x, []):
                if fi and i and docs[fk][fi - 1] == docs[k][i - 1]:
                    continue  # not the run's first line
                n = 0
                while i + n < len(docs[k]) and fi + n < len(docs[fk]) and docs[k][i + n] == docs[fk][fi + n]:
                    n += 1
                if n > 1 and sum(len(y.split()) for y in docs[k][i : i + n]) >= min_words:
                    out.update((k, j) for j in range(i, i + n))
            places.setdefault(x, []).append((k, i))
    return out


def fixture():
    rows = [(10, "\n".join([line("a"), PASSAGE, line("b")]))]
    rows += [(20 + k, "\n".join([line(f"h{k}"), line(f"i{k}"), PASSAGE, line(f"t{k}")])) for k in range(30)]
    rows += [(60, ONE_LINE), (61, line("q") + "\n" + ONE_LINE + "\n" + line("r"))]
    rows += [(70, "short\nboilerplate"), (71, "short\nboilerplate\n" + line("z")), (72, None), (73, ""), (None, PASSAGE), (10, rows[0][1])]
    rows += [(80, "\n\n" * 400 + PASSAGE.replace("p", "v")), (81, line("w") + "\n" * 500 + PASSAGE.replace("p", "v") + "\n\n")]
    return rows


def mixed(rng, n, passages):
    """Documents of short, long and blank lines, with passages in between."""
    out = []
    for i in range(n):
        lines = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(rng.choice([0, 1, 2, 3, 9, 14]))) for _ in range(rng.randrange(1, 40))]
        for at in sorted(rng.sample(range(0, len(lines) + 1, 3), min(rng.randrange(3), 1 + len(lines) // 3)), reverse=True):
            lines[at:at] = rng.choice(passages)[: None if rng.random() < 0.7 else 2]  # sometimes only its beginning
        out.append((i, "\n".join(lines)))
    return out


def test_against_the_definition(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, "x", "y", 1, "z") for i, t in rows], "doc_id long, text string, id string, __hash string, __id int, starts string")
    got = L.remove_repeats(docs)
    assert got.columns == ["doc_id", "text", "id", "__hash", "__id", "starts", "lines_removed", "words_removed"]
    assert all((r["__hash"], r["__id"], r.starts) == ("y", 1, "z") for r in got.collect())
    want = plain(rows, 50)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((i, t if t is None else want[key(i, t)]) for i, t in rows), key=str)
    by = {r.doc_id: r for r in got.collect()}
    assert PASSAGE not in by[10].text and by[None].text == PASSAGE  # a null id comes first
    assert all(PASSAGE.split("\n")[0] not in by[20 + k].text and by[20 + k].lines_removed == 4 for k in range(30))
    assert ONE_LINE in by[60].text and ONE_LINE not in by[61].text
    assert by[71].text.startswith("short\nboilerplate") and by[72].text is None and by[73].text == ""
    assert "v0x0" in by[80].text and "v0x0" not in by[81].text
    assert L.remove_repeats(docs.where("false")).count() == 0


def test_query_against_the_definition(spark):
    from moneyflow.llm.queries import op4_line_dedup

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain(rows, 50)
    assert {(r.doc_id, r.text) for r in op4_line_dedup(spark, sf).collect()} == {(i, t if t is None else want[key(i, t)]) for i, t in rows}


def test_every_long_run_is_found():
    """All passages of the words wanted go, whatever their lines' lengths and wherever they stand; no line goes that stands once."""
    for seed in range(12):
        rng = random.Random(seed)
        passages = [[" ".join(f"s{seed}p{k}l{j}w{x}" for x in range(size)) for j in range(-(-50 // size) + rng.randrange(3))] for k, size in enumerate([1, 2, 3, 5, 12, 30])]
        rows = mixed(rng, 40, passages)
        often = Counter(x for _, t in rows for x in t.split("\n"))
        want, kept = repeated_lines(rows, 50), plain(rows, 50)
        assert want
        for i, t in rows:
            lines = t.split("\n")
            lost = Counter(lines) - Counter(kept[key(i, t)].split("\n"))
            wanted = Counter(x for j, x in enumerate(lines) if x and (key(i, t), j) in want)
            assert not wanted - lost and all(often[x] > 1 for x in lost)


def test_boundaries_by_brute_force():
    for seed in range(60):
        rng = random.Random(seed)
        words = [rng.choice([0, 1, 3, 8, 20, 60]) for _ in range(rng.randrange(30))]
        rolled = [rng.randrange(9) for _ in words]
        want = set()
        for a in range(len(words)):
            ends = [b for b in range(a + 2, len(words) + 1) if sum(words[a:b]) >= 50]
            if ends:
                want.add(min(range(a + 1, ends[0]), key=lambda k: (rolled[k], -k)))
        assert L.boundaries(rolled, words, 50) == sorted(want)


def test_the_rolling_hash_makes_boundaries_resist_shifts(monkeypatch):
    body = [line(f"l{k}", 9) for k in range(60)]
    shifted = [line("new", 9), line("newer", 9), *body]
    digests = lambda lines: {d for _, _, d in L.line_chunks("\n".join(lines), 50)}
    assert len(digests(body) & digests(shifted)) >= len(digests(body)) - 1 and len(digests(body)) < 45
    # boundaries by position, in place of the rolling hash: every fourth line, and a shift by two loses all
    monkeypatch.setattr(L, "boundaries", lambda rolled, words, min_words: list(range(1, len(words), 4)))
    assert not digests(body) & digests(shifted)


def test_very_long_texts(spark):
    body = "\n".join(line(f"k{k}x", 8) for k in range(60_000))  # about 3 MB
    rows = [(1, body), (2, "own line\n" + body), (3, "x" * 3_000_000), (4, "\n" * 1_000_000)]
    got = {r.doc_id: r for r in L.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == body and got[2].text == "own line" and got[2].lines_removed == 60_000
    assert got[3].text == rows[2][1] and got[4].text == rows[3][1]


def test_words_are_counted_one_way():
    text = "\n".join([chr(160).join(f"w{j}" for j in range(60)), "b"])
    assert L.line_chunks(text, 50) and L.long_runs(text.split("\n"), [(0, 2)], 50) == [(0, 2)]
    assert np.array(L.boundaries([], [], 50)).size == 0
