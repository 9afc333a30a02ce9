"""Blocks and plans on small fixtures: nulls and blanks, order, memos and refunds, nested filings, sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from moneyflow.operators import relational as R
from moneyflow.plans import contributions, lobbying, site, tagging
from moneyflow.sources import bulk, lobbying as lda, rest, sinks
from moneyflow.streaming import series


def row(columns, **values):
    return "|".join(values.get(c, "") for c in columns)


@pytest.fixture
def cycle_root(tmp_path):
    def put(name, rows):
        spec = bulk.REGISTRY[name]
        path = spec.path(str(tmp_path), 2024)
        import os

        os.makedirs(os.path.dirname(path))
        with open(path, "w") as f:
            f.write("\n".join(row(spec.columns, **r) for r in rows) + "\n")

    base = {"cmte_id": "C1", "name": "DOE", "transaction_amt": "100"}
    put(
        "itcont",
        [
            base | {"transaction_tp": "15", "employer": '"Acme'},
            base | {"transaction_tp": "15E", "memo_cd": "X"},
            base | {"transaction_tp": "15E"},
            base | {"transaction_tp": "10", "memo_cd": "X", "transaction_amt": "abc"},
            base | {"transaction_tp": "22Y"},
            base | {"transaction_tp": "21Y", "transaction_amt": "-5"},
            base | {"transaction_tp": "24T"},
            base | {"transaction_tp": "15", "cmte_id": "C404"},
        ],
    )
    put("cm", [{"cmte_id": "C1", "cmte_nm": "ONE", "cmte_tp": "H"}])
    return str(tmp_path)


def test_contribution_rules(spark, cycle_root):
    itcont = bulk.scan(spark, cycle_root, 2024, "itcont")
    assert itcont.where(F.col("memo_cd").isNull()).count() == 0
    out = contributions.donor_contributions(itcont, bulk.scan(spark, cycle_root, 2024, "cm"))
    got = sorted(((r.transaction_tp, r.memo_cd, r.net_amt, r.cmte_nm) for r in out.collect()), key=str)
    want = [("10", "X", 0.0, "ONE"), ("15", "", 100.0, "ONE"), ("15", "", 100.0, None), ("15E", "", 100.0, "ONE"), ("21Y", "", 5.0, "ONE"), ("22Y", "", -100.0, "ONE")]
    assert got == sorted(want, key=str)
    assert bulk.cycles_in(spark, cycle_root) == [2024]
    kept = bulk.bronze(spark, cycle_root, 2024, "itcont", cycle_root + "/bronze")
    assert [r.transaction_tp for r in kept.orderBy("_row_ord").limit(3).collect()] == ["15", "15E", "15E"]


def test_first_curated_row_wins(spark):
    c = spark.createDataFrame([("acme ", "A", "s", 2), ("ACME", "B", "t", 1), ("blank", "", "u", 3)], "employer string, canonical_name string, sector string, _row_ord long")
    f = spark.createDataFrame([("\tAcme",), ("BLANK",), ("other",)], "employer string")
    got = {r.employer: (r.tech_canonical_name, r.is_tech_employer) for r in contributions.tag_employers(f, c).collect()}
    assert got == {"\tAcme": ("B", True), "BLANK": ("", False), "other": (None, False)}


def test_blocks_on_nulls_and_order(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "", 2), ("a", "x", 3), (None, "y", 4)], "k string, v string, o long")
    assert R.upsert_dimension(df, "k", F.col("o"), ["v"]).collect() == [("a", "x")]
    assert R.first_seen(df, "k", [F.col("o").asc()]).count() == 2
    assert R.drop_null_keys(df, ["k"]).count() == 3
    left = spark.createDataFrame([(None, 1), ("b", 2)], "k string, n long")
    right = spark.createDataFrame([(None, 7)], "k string, m long")
    assert sorted(R.null_safe_join(left, right, ["k"]).collect(), key=str) == sorted([(None, 1, 7), ("b", 2, None)], key=str)
    assert df.agg(R.concat_distinct(F.col("v"))).first()[0] == "; x; y"
    assert df.agg(R.concat_in_order(F.col("v"), -F.col("o"))).first()[0].startswith("y | x")
    empty = df.where("false")
    assert R.first_by(empty, ["k"], [F.col("o").asc()]).count() == 0 and R.upsert_dimension(empty, "k", F.col("o"), ["v"]).count() == 0
    assert R.key_overlap(df, df.where("o > 2"), ["o"]).first().asDict() == {"n_both": 2, "n_left_only": 2, "n_right_only": 0}
    assert R.flagged_or_all(df, F.col("o") == 1, ["k"]).count() == 2


def test_order_of_rows_does_not_matter(spark):
    rows = [(f"n{i % 5}", float(i)) for i in range(100)]
    a = R.best_of(spark.createDataFrame(rows, "k string, v double"), ["k"], ["v"], "v", ["k"])
    b = R.best_of(spark.createDataFrame(rows[::-1], "k string, v double").repartition(7), ["k"], ["v"], "v", ["k"])
    assert sorted(a.collect()) == sorted(b.collect())


FILING = {
    "filing_uuid": "u1", "filing_year": 2024, "filing_period": "mid_year", "filing_period_display": "MY", "income": "10.5", "expenses": None, "dt_posted": "2024-01-01",
    "client": {"id": 1, "client_id": 11, "name": "Client"}, "registrant": {"id": 5, "name": "Reg", "house_registrant_id": 50},
    "lobbying_activities": [{"general_issue_code": "TAX", "lobbyists": [{"lobbyist": {"id": 9, "first_name": "A", "last_name": "B"}, "new": True}, {"lobbyist": {"id": 9, "first_name": "", "last_name": "C"}, "new": False}],
        "government_entities": [{"id": 2, "name": "SENATE"}]}, {"general_issue_code": "AGR", "lobbyists": [], "government_entities": []}],
    "foreign_entities": [], "affiliated_organizations": [{"name": "Aff", "extra": 1}], "conviction_disclosures": [],
}


@pytest.fixture
def page_folder(tmp_path):
    second = FILING | {"filing_uuid": "u2", "client": {"id": 1, "client_id": None, "name": "Client Renamed"}, "lobbying_activities": [], "dt_posted": "2024-01-02"}
    for n, rows in ((1, [FILING, second]), (2, [second | {"income": "99"}, FILING | {"filing_uuid": None}])):
        (tmp_path / f"page_{n:05d}.json").write_text(json.dumps({"count": 3, "next": None, "results": rows}))
    return str(tmp_path)


def test_pages_flatten_and_dedup(spark, page_folder):
    filed = lda.filings_or_pages(spark, page_folder)
    assert filed.count() == 3  # u1, u2 once, and the row without an id
    assert lobbying.completeness(lda.pages(spark, page_folder)).first().asDict() == {"n_rows": 4, "n_ids": 2, "n_duplicated": 1}
    assert lobbying.tied_boundaries(lda.pages(spark, page_folder)).count() == 1
    filed = filed.where("filing_uuid IS NOT NULL")
    reports = filed.select("filing_uuid", "registrant", "_row_ord")
    flat = lobbying.flatten(filed, reports)
    assert {k: len(v.columns) for k, v in flat.items()} == {
        "filings": 34, "filing_activities": 9, "filing_activity_lobbyists": 15, "filing_activity_government_entities": 6, "filing_foreign_entities": 16,
        "filing_affiliated_organizations": 4, "filing_conviction_disclosures": 2, "contributions": 30, "contribution_items": 10, "clients": 16, "registrants": 19, "lobbyists": 10,
    }
    assert sorted(r.activity_id for r in flat["filing_activities"].collect()) == ["u1:activity:1", "u1:activity:2"]
    assert [(r.client_name, r.client_source_id) for r in flat["clients"].collect()] == [("Client Renamed", "11")]
    assert [(r.first_name, r.last_name) for r in flat["lobbyists"].collect()] == [("A", "C")]
    assert {r.income for r in flat["filings"].collect()} == {10.5}
    assert flat["filing_foreign_entities"].count() == 0
    shapes = {r.table: r.n_rows for r in lobbying.table_shapes(flat).collect()}
    assert shapes["filing_activity_lobbyists"] == 2
    assert ("client.name", "scalar") in lobbying.structure(filed.schema)
    assert {r.path: r.n_present for r in lobbying.presence(filed).collect()}["client.client_id"] == 1


def test_supplemental_replaces(spark):
    pages = spark.createDataFrame([("a", "p1", 1, 0), ("a", "p2", 2, 0), ("b", "p1", 1, 1)], "filing_uuid string, v string, _page long, _pos long")
    more = spark.createDataFrame([("a", "s1", 1, 0), ("a", "s2", 2, 0)], "filing_uuid string, v string, _page long, _pos long")
    assert {r.filing_uuid: r.v for r in lobbying.snapshot(pages, more).collect()} == {"a": "s2", "b": "p1"}
    assert lobbying.unseen(more, pages).count() == 0


def test_review_queue_is_an_anti_join(spark):
    rows = spark.createDataFrame([("Acme Inc", 5.0, "n"), ("acme inc", 5.0, "m"), ("T", 1.0, "n"), ("zzz", 1.0, "z")], "employer string, transaction_amt double, name string")
    found = tagging.employer_candidates(rows, {"acme": ["ACME"]}, {"att": ["T"]}, ["INC"])
    assert {r.employer: (r.matched_searches, r.match_types, r.flagged_noisy) for r in found.collect()} == {
        "Acme Inc": ("acme", "regex", True), "acme inc": ("acme", "regex", True), "T": ("att", "exact", False)
    }
    known = spark.createDataFrame([(" ACME INC",)], "employer string")
    assert [r.employer for r in tagging.review_queue(found, known).collect()] == ["T"]
    old = spark.createDataFrame([("e", "yes", "", "s1"), ("f", "", "x", "s2"), ("g", "no", "", "s3")], "employer string, include string, canonical_name string, matched_searches string")
    assert sorted((r.employer, r.include, r.canonical_name) for r in tagging.migrate_curated(old).collect()) == [("e", "TRUE", "s1"), ("g", "FALSE", "")]


class Transport:
    def __init__(self):
        self.calls = []

    def __call__(self, url):
        self.calls.append(url)
        if len(self.calls) == 1:
            return 429, {"Retry-After": "3"}, b""
        page = int(url.split("page=")[1].split("&")[0])
        rows = [{"filing_uuid": f"{page}-{k}", "dt_posted": f"2024-0{page}"} for k in range(2)] if page < 3 else []
        return 200, {}, json.dumps({"count": 4, "next": "more", "results": rows}).encode()


def test_rest_retries_and_lands_pages(tmp_path):
    waits, t = [], Transport()
    client = rest.PagedClient("http://x", t, key="secret", sleep=waits.append)
    out = rest.ingest(client, "filings", str(tmp_path))
    assert waits == [3.0] and out["page_count"] == 2 and out["complete"] and out["max_dt_posted"] == "2024-02"
    n = len(t.calls)
    assert rest.ingest(client, "filings", str(tmp_path)) == out and len(t.calls) == n
    with pytest.raises(RuntimeError, match=r"\*\*\*"):
        rest.PagedClient("http://x", lambda url: (404, {}, b""), key="secret").get("y")
    assert rest.pages_needed(101, 25) == 5
    assert [r["source"] for r in rest.freshness({"a": "2024-02", "b": "2024-01"}, {"a": "2024-01", "b": "2024-01"}) if r["stale"]] == ["a"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, float("nan"), "b"), (1, 1 / 3, "a")], "id long, x double, slug string")
    assert [json.loads(r.json)["x"] for r in sinks.records(df.orderBy("id")).collect()] == [0.3333333333, None]
    sinks.write_sorted_lines(df, str(tmp_path / "lines"), "id")
    assert [r.id for r in spark.read.json(str(tmp_path / "lines")).collect()] == [1, 2]
    sinks.write_entities(df.select("slug", "id"), str(tmp_path / "one"))
    assert sorted(p.name for p in (tmp_path / "one").glob("slug=*")) == ["slug=a", "slug=b"]
    sinks.write_document({"rows": df.select("id"), "n": {"k": 1}}, str(tmp_path / "doc.json"))
    assert json.loads((tmp_path / "doc.json").read_text())["n"] == {"k": 1}
    assert sinks.with_columns(df, ["z", "id"]).columns == ["z", "id", "x", "slug"]


def test_stream_equals_batch(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "value")
    src = str(tmp_path / "src")
    ev.select(F.col("ts").cast("timestamp").alias("ts"), "value").write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = series.weekly_stream(stream, "ts", "value").writeStream.outputMode("complete").format("memory").queryName("weeks").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = R.weekly(spark.read.parquet(src).withColumn("week_end", F.date_add(F.to_date(F.date_trunc("WEEK", "ts")), 6)), "week_end", [], {"n_rows": F.count(F.lit(1))})
    assert {r.week_end: r.n_rows for r in spark.table("weeks").collect()} == {r.week_end: r.n_rows for r in batch.collect()}


def test_pages_of_the_site():
    assert site.nearest_section({"", "a", "a/b"}, "a/b/c/d") == "a/b"
    assert "<td>&lt;x&gt;</td>" in site.html_table([{"n": "<x>"}], {"n": "Name"})


def test_reconcile_builds_a_complete_snapshot(spark, page_folder, tmp_path):
    from moneyflow.plans import reconcile

    late = FILING | {"filing_uuid": "u3"}
    client = rest.PagedClient("http://x", lambda url: (200, {}, json.dumps({"count": 3, "results": [late, FILING]}).encode()))
    assert reconcile.repair_boundaries(spark, client, "filings", page_folder, live_rows=3) == 1
    out = reconcile.build_snapshot(spark, page_folder, str(tmp_path / "snap"), live_rows=3)
    assert out["complete"] and out["n_duplicated"] == 1
    assert [r.filing_uuid for r in spark.read.json(str(tmp_path / "snap")).collect()] == ["u1", "u2", "u3"]
    assert reconcile.top_up(client, "filings", page_folder, known_rows=4, live_rows=5, page_size=2) == 2


def test_investigations_on_fixtures(spark, cycle_root):
    from moneyflow.plans import investigations

    itcont = bulk.scan_cycles(spark, cycle_root, "itcont", [2024])
    paths, givers = investigations.inflow_paths({"itcont": itcont}, "C1")
    assert paths.count() == 7 and [r.name for r in givers.collect()] == ["DOE"]
    alias = spark.createDataFrame([('"acme', "Acme")], "employer string, canonical_name string")
    assert [r.canonical_name for r in investigations.alias_summary(itcont, alias).collect()] == ["Acme"]
    filed = spark.read.json(spark.sparkContext.parallelize([json.dumps(FILING | {"filing_type": "Q1"})]))
    got = investigations.sample_summary(filed)
    assert sorted(r.issue for r in got["issues"].collect()) == ["AGR", "TAX"] and got["types"].first().n == 1
