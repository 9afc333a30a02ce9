"""Every occurrence within the budget is found; distances against dynamic programming."""

import random

from hypothesis import given, settings, strategies as st

from moneyflow.llm import decontam as D


def least_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row), row.index(min(row))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=90), st.text(alphabet="abc ", max_size=120))
def test_myers(item, text):
    got, want = D.best_match(D.make_item(0, item, 0.1), text), least_distance(item, text)
    assert got[0] == want[0] and (got == want or got[0] == len(item))


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        k = rng.randrange(len(chars))
        kind = rng.randrange(3)
        chars[k : k + 1] = {0: [rng.choice("xyz")], 1: [], 2: [chars[k], rng.choice("xyz")]}[kind]
    return "".join(chars)


def test_all_matches_within_budget_are_found():
    rng = random.Random(4)
    words = ["the", "and", "thing", "ration", "order", "onset", "ash", "tin"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, D.normal(say(rng.randrange(12, 40)))) for k in range(12)]
    matcher = D.Matcher(items, 0.1)
    for _ in range(60):
        k, text = rng.choice(items)
        t = D.normal(say(30) + " " + edited(rng, text, rng.randrange(0, int(0.1 * len(text)) + 3)) + " " + say(30))
        want = {(i, d) for i, x in items if (d := least_distance(x, t)[0]) <= int(0.1 * len(x))}
        assert {(i, d) for i, d, _ in matcher.matches(t)} == want


def test_tables(spark):
    item = "one rather long benchmark question about the order of things"
    docs = spark.createDataFrame(
        [(1, f"before {item.upper()}   after", 0), (2, "clean", 0), (3, None, 0), (4, "", 0), (1, item.replace("long", "lung"), 0), (None, item, 0)], "doc_id long, text string, item_id int"
    )
    bench = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "short", 1), (7, item, 1)], "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in D.contaminations(docs, bench).collect()), key=str)
    assert got == sorted([(1, 7, 0), (1, 7, 1), (None, 7, 0)] * 2, key=str)
    assert sorted((r.doc_id for r in D.drop_contaminated(docs, bench).collect())) == [2, 3, 4]
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in D.contaminations(docs, bench, block_chars=10).collect()), key=str) == got
    assert D.contaminations(docs.where("false"), bench).count() == 0 and D.contaminations(docs, bench.where("false")).count() == 0
    assert D.drop_contaminated(docs, bench.where("false")).count() == 6 and D.drop_contaminated(docs.where("false"), bench).count() == 0


def test_query_equals_plain_search(spark):
    from moneyflow.llm.queries import op6_decontam

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, D.normal(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, D.normal(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    exact = {(i, k) for i, t in docs for k, x in items if x in t}
    got = {(r.doc_id, r.item_id): r.distance for r in op6_decontam(spark, sf).collect()}
    assert exact == {k for k, d in got.items() if d == 0} and exact


def test_short_items_match_unedited_as_whole_words(spark):
    bench = spark.createDataFrame([(1, "Who wrote  the Iliad?"), (2, "in"), (3, " "), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "asked: who wrote the iliad?"), (2, "who wrote the iliads? wind, inn"), (3, "who wrota the iliad?"), (4, "(in) tin"), (5, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.distance, r.stop) for r in D.contaminations(docs, bench).collect()) == [(1, 1, 0, 27), (4, 2, 0, 3)]
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [2, 3, 5]
