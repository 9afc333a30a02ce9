"""Registered queries over nested disclosures, written files, streams and pages; ``catalog`` imports this to register them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from moneyflow.analog import CYCLE, view
from moneyflow.catalog import Tables, query, tables
from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R
from moneyflow.operators.staging import shared_folder, staged
from moneyflow.plans import investigations, lobbying, races, site, summaries, tagging
from moneyflow.sources import bulk, lobbying as lda, sinks
from moneyflow.streaming import series

_WRITTEN: dict[tuple, str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """A folder that ``write(path)`` fills once for each session and input."""
    import uuid

    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


# ---- nested filings and reports, made from orders and their lines


def _text(c: Column) -> Column:
    return c.cast("string")


def _many(n: Column, item) -> Column:
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), item)).otherwise(F.slice(F.transform(F.sequence(F.lit(1), F.lit(1)), item), 1, 0))


def nested_filings(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")

    def lobbyist(i: Column) -> Column:
        n = (F.col("l_suppkey") + i) % 40
        person = F.struct(n.cast("long").alias("id"), F.concat(F.lit("First "), _text(n)).alias("first_name"), F.when(n % 3 == 0, "").otherwise(F.concat(F.lit("Last "), _text(F.col("l_orderkey") % 5))).alias("last_name"))
        return F.struct(person.alias("lobbyist"), F.when(F.col("l_returnflag") == "R", "Staff").alias("covered_position"), (F.col("l_linestatus") == "O").alias("new"))

    agency = lambda i: F.struct((F.col("l_partkey") % 9 + i).cast("long").alias("id"), F.concat(F.lit("Agency "), _text(F.col("l_partkey") % 9 + i)).alias("name"))
    activity = F.struct(
        F.concat(F.lit("I"), _text(F.col("l_partkey") % 7)).alias("general_issue_code"), F.concat(F.lit("Issue "), _text(F.col("l_partkey") % 7)).alias("general_issue_code_display"),
        F.when(line % 2 == 0, F.concat(F.lit("On part "), _text(F.col("l_partkey")))).alias("description"), _many(line % 3, lobbyist).alias("lobbyists"), _many(line % 2, agency).alias("government_entities"),
    )
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", activity.alias("a"))
    acts = t.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(place)).alias("x")).select("o_orderkey", F.col("x.a").alias("lobbying_activities"))
    o = t.table("orders").join(t.table("customer"), F.col("o_custkey") == F.col("c_custkey")).join(acts, "o_orderkey", "left")
    key = F.col("o_orderkey")
    client = F.struct(
        F.col("o_custkey").alias("id"), F.when(key % 3 != 0, F.col("o_custkey") + 7).alias("client_id"), F.when(key % 5 == 0, F.concat("c_name", F.lit(" Ltd"))).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("general_description"), _text(F.col("c_nationkey")).alias("state"), F.lit("US").alias("country"),
    )
    reg = F.col("o_custkey") % 13
    registrant = F.struct(reg.alias("id"), (reg + 100).alias("house_registrant_id"), F.concat(F.lit("REG "), _text(reg)).alias("name"), F.lit("firm").alias("description"), F.lit("DC").alias("state"), F.lit("US").alias("country"))
    foreign = lambda i: F.struct(F.concat(F.lit("Foreign "), _text(key), F.lit("-"), _text(i)).alias("name"), F.when(i == 1, "12.5").alias("contribution"), F.lit("XX").alias("country"))
    return o.select(
        F.concat(F.lit("F"), _text(key)).alias("filing_uuid"), F.year("o_orderdate").alias("filing_year"), F.concat(F.lit("Q"), _text(F.quarter("o_orderdate"))).alias("filing_period"),
        F.col("o_orderstatus").alias("filing_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt_posted"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(_text(F.col("o_totalprice"))).alias("income"), F.when(F.col("o_orderstatus") == "F", _text(F.col("o_totalprice"))).alias("expenses"),
        client.alias("client"), registrant.alias("registrant"), "lobbying_activities", _many((key % 3).cast("int"), foreign).alias("foreign_entities"),
        _many((key % 2).cast("int"), lambda i: F.struct(F.concat(F.lit("Aff "), _text(key)).alias("name"), i.alias("extra"))).alias("affiliated_organizations"),
        _many((key % 50 == 0).cast("int"), lambda i: F.struct(F.lit("2020-01-01").alias("date"))).alias("conviction_disclosures"), key.alias("_row_ord"),
    )


def nested_reports(t: Tables) -> DataFrame:
    item = F.struct(F.col("l_shipdate").alias("at"), "l_linenumber", "l_partkey", "l_extendedprice", F.struct(F.concat(F.lit("T"), _text(F.col("l_linenumber") % 2)).alias("contribution_type"), F.concat(F.lit("Payee "), _text(F.col("l_partkey") % 50)).alias("payee_name"), F.when(F.col("l_linenumber") == 2, "").otherwise(_text(F.col("l_extendedprice"))).alias("amount")).alias("i"))
    items = t.table("lineitem").where("l_linenumber < 4").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(item)).alias("x")).select("o_orderkey", F.col("x.i").alias("contribution_items"))
    key, reg, n = F.col("o_orderkey"), F.col("o_custkey") % 13, F.col("o_orderkey") % 60
    person = F.struct(n.alias("id"), F.concat(F.lit("First "), _text(n)).alias("first_name"), F.lit("").alias("middle_name"), F.when(n % 4 != 0, F.concat(F.lit("R "), _text(n))).alias("last_name"))
    return t.table("orders").where("o_orderkey % 2 = 0").join(items, "o_orderkey", "left").select(
        F.concat(F.lit("R"), _text(key)).alias("filing_uuid"), F.year("o_orderdate").alias("filing_year"), F.lit("mid_year").alias("filing_period"), (F.col("o_orderstatus") == "P").alias("no_contributions"),
        F.when(key % 4 == 0, F.array(F.lit("PAC A"), F.lit("PAC B"))).otherwise(F.array(F.lit("PAC C"))).alias("pacs"), F.struct(reg.alias("id"), F.concat(F.lit("REG "), _text(reg)).alias("name")).alias("registrant"),
        person.alias("lobbyist"), "contribution_items", key.alias("_row_ord"),
    )


class Nested:
    """Filings read back from a written snapshot, reports, and their flat tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        t = tables(spark, sf_dir)
        folder = written(spark, sf_dir, "filings", lambda p: sinks.write_sorted_lines(nested_filings(t).drop("_row_ord"), f"{p}/snapshot.jsonl", "filing_uuid"))
        order = F.substring("filing_uuid", 2, 20).cast("long")
        self.filed = lda.filings_or_pages(spark, folder).withColumn("_row_ord", order)
        self.reports = t.reports
        self.flat = lobbying.flatten(self.filed, self.reports)


def _flat(name: str, *columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Nested(spark, sf_dir).flat[name].select(*columns)

    return run


_PERIOD = ("filing_uuid", "filing_year", "filing_period")
FLAT = {
    "flat_filings": _flat("filings", *_PERIOD, "filing_type", "dt_posted", "income", "expenses", "client_api_id", "client_source_id", "client_name", "registrant_api_id", "registrant_house_id", "registrant_name", "posted_by_name", "n_activities", "n_foreign_entities", "n_affiliated_organizations", "n_conviction_disclosures"),
    "flat_activities": _flat("filing_activities", "activity_id", "filing_uuid", "activity_index", "general_issue_code", "general_issue_code_display", "description", "foreign_entity_issues", "n_lobbyists", "n_government_entities"),
    "flat_lobbyists": _flat("filing_activity_lobbyists", "activity_id", "filing_uuid", "activity_index", "activity_lobbyist_index", "lobbyist_api_id", "lobbyist_first_name", "lobbyist_last_name", "covered_position", "is_new"),
    "flat_agencies": _flat("filing_activity_government_entities", "activity_id", "filing_uuid", "activity_index", "activity_government_entity_index", "government_entity_id", "government_entity_name"),
    "flat_foreign": _flat("filing_foreign_entities", "filing_uuid", "foreign_entity_index", "name", "contribution", "country", "city"),
    "flat_affiliated": _flat("filing_affiliated_organizations", "filing_uuid", "affiliated_organization_index", "name", "extra"),
    "flat_convictions": _flat("filing_conviction_disclosures", "filing_uuid", "conviction_disclosure_index", "date"),
    "flat_reports": _flat("contributions", *_PERIOD, "no_contributions", "pacs", "n_contribution_items", "registrant_api_id", "registrant_name", "lobbyist_api_id", "lobbyist_name"),
    "flat_report_items": _flat("contribution_items", "contribution_item_id", "filing_uuid", "item_index", "contribution_type", "payee_name", "amount"),
    "dim_clients": _flat("clients", "client_api_id", "client_source_id", "client_name", "general_description", "state", "registrant_api_id"),
    "dim_registrants": _flat("registrants", "registrant_api_id", "house_registrant_id", "registrant_name", "state"),
    "dim_lobbyists": _flat("lobbyists", "lobbyist_api_id", "first_name", "last_name", "registrant_api_id"),
}
for _name, _run in FLAT.items():
    _run.__name__ = _name
    query(_run)


@query
def lobbying_entities(spark, d):
    flat = Nested(spark, d).flat
    filed = flat["filings"].withColumns({c: F.col(c).cast("string") for c in ("client_api_id", "registrant_api_id")})
    return lobbying.entities(filed, flat["clients"], flat["registrants"])


OVERLAY = [("Customer 000000012", "REG 1"), ("REG 2 LLC", "nothing alike"), ("000000100 Ltd", "Customer#000000100 Ltd")]


@query
def lobbying_overlay(spark, d):
    """Clients and registrants matched to aliases, reviewed, by kind."""
    alias = spark.createDataFrame([(a, "TRUE", c, "s", "", "") for a, c in OVERLAY], "employer string, include string, canonical_name string, sector string, matched_searches string, notes string")
    out = lobbying.overlay(lobbying.match_entities(lobbying_entities(spark, d), lobbying.aliases(alias)))
    rows = [out[f"{k}_review"].select("entity_type", "entity_id", "best_match_score", "best_alias", "n_candidate_matches", "candidate_aliases", "review_status") for k in ("client", "registrant")]
    return R.union_all(*rows)


@query
def nested_presence(spark, d):
    return lobbying.presence(nested_filings(tables(spark, d))).where(F.col("path").isin("client", "client.client_id", "income", "expenses", "lobbying_activities", "registrant.name"))


@query
def flat_shapes(spark, d):
    return lobbying.table_shapes({k: v for k, v in Nested(spark, d).flat.items() if k in ("filings", "contributions", "contribution_items", "filing_activities", "clients")})


@query
def nested_sample(spark, d):
    got = investigations.sample_summary(nested_filings(tables(spark, d)))
    return R.union_all(*[got[k].select(F.lit(k).alias("list"), F.col(c).alias("entry"), "n") for k, c in (("types", "filing_type"), ("issues", "issue"))])


# ---- paged JSON


def _page_files(spark: SparkSession, d: str) -> str:
    def write(path: str) -> None:
        ev = tables(spark, d).table("events").where("event_id < 3000")
        row = F.struct(F.concat(F.lit("E"), _text(F.col("event_id") - F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))).alias("filing_uuid"), "event_type", "event_id")
        pages = ev.groupBy(F.floor(F.col("event_id") / 500).alias("p")).agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))).alias("x"))
        body = F.to_json(F.struct(F.lit(3000).alias("count"), F.col("x.r").alias("results")))
        pages.repartitionByRange("p").sortWithinPartitions("p").select(body.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
        fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        place = spark._jvm.org.apache.hadoop.fs.Path
        names = sorted(s.getPath().getName() for s in fs.listStatus(place(path)) if s.getPath().getName().startswith("part-"))
        for k, name in enumerate(names, 1):
            fs.rename(place(f"{path}/{name}"), place(f"{path}/page_{k:05d}.json"))

    return written(spark, d, "pages", write)


@query
def paged_filings(spark, d):
    """Rows of page files, the first of each id."""
    return lda.filings_or_pages(spark, _page_files(spark, d)).select("filing_uuid", "event_id", "event_type")


@query
def supplemented_snapshot(spark, d):
    """Repair rows replace page rows of their id, the last one counts, and others are added."""
    pages = lda.pages(spark, _page_files(spark, d))
    more = tables(spark, d).table("events").where("event_id % 40 = 7 AND event_id < 4000").select(F.concat(F.lit("E"), _text(F.col("event_id") - F.col("event_id") % 80 + 1)).alias("filing_uuid"), "event_id", F.lit("repaired").alias("event_type"), F.lit(0).cast("long").alias("_page"), F.col("event_id").alias("_pos"))
    return lobbying.snapshot(pages, more).select("filing_uuid", "event_id", "event_type")


@query
def unseen_rows(spark, d):
    pages = lda.pages(spark, _page_files(spark, d)).where("_page < 4")
    return lobbying.unseen(lda.pages(spark, _page_files(spark, d)).where("_page >= 3"), pages).select("filing_uuid", "event_id")


# ---- bulk files, written and scanned


def _bulk_root(spark: SparkSession, d: str) -> str:
    def write(root: str) -> None:
        for name, spec in bulk.REGISTRY.items():
            rows = view(spark, d, name)
            columns = [F.coalesce(_text(F.col(c)), F.lit("")) if c in rows.columns else F.lit("") for c in spec.columns]
            rows.select(F.concat_ws("|", *columns).alias("value")).write.text(spec.path(root, CYCLE))

    return written(spark, d, "bulk", write)


def _scan(name: str, *columns: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bulk.scan(spark, _bulk_root(spark, sf_dir), CYCLE, name, list(columns))

    return run


BULK = {
    "scan_committees": _scan("cm", "cmte_id", "cmte_nm", "tres_nm", "cmte_tp", "cmte_dsgn", "cmte_pty_affiliation", "connected_org_nm", "cand_id"),
    "scan_candidates": _scan("cn", "cand_id", "cand_name", "cand_pty_affiliation", "cand_election_yr", "cand_office_st", "cand_office", "cand_office_district", "cand_zip"),
    "scan_links": _scan("ccl", "cand_id", "cand_election_yr", "fec_election_yr", "cmte_id", "cmte_tp", "cmte_dsgn", "linkage_id"),
    "scan_contributions": _scan("itcont", "cmte_id", "transaction_tp", "name", "state", "employer", "occupation", "transaction_dt", "transaction_amt", "other_id", "memo_cd", "memo_text", "sub_id"),
    "scan_spending": _scan("itoth", "cmte_id", "transaction_tp", "name", "transaction_amt", "other_id", "memo_cd", "sub_id"),
    "scan_to_candidates": _scan("itpas2", "cmte_id", "transaction_tp", "transaction_amt", "cand_id", "memo_cd", "sub_id", "city"),
}
for _name, _run in BULK.items():
    _run.__name__ = _name
    query(_run)


@query
def bulk_cycles(spark, d):
    """Rows of a file over the cycles that the folder has."""
    root = _bulk_root(spark, d)
    rows = bulk.scan_cycles(spark, root, "itpas2", bulk.cycles_in(spark, root), ["cmte_id", "transaction_amt"])
    return rows.groupBy("cycle").agg(F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("transaction_amt")).alias("total"))


@query
def bronze_order(spark, d):
    """The file's order survives its way to Parquet."""
    root = _bulk_root(spark, d)
    rows = bulk.bronze(spark, root, CYCLE, "ccl", written(spark, d, "bronze", lambda p: None))
    return rows.groupBy("cycle").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_row_ord").alias("n_places"))


@query
def curated_list(spark, d):
    path = written(spark, d, "curated", lambda p: sinks.write_csv(view(spark, d, "curated").select(*bulk.CURATED).coalesce(1), p))
    return bulk.curated(spark, path).select(*bulk.CURATED)


@query
def flat_table_csv(spark, d):
    path = written(spark, d, "flat", lambda p: sinks.write_csv(sinks.with_columns(tables(spark, d).table("nation").select("n_name", "n_nationkey"), ["n_nationkey", "n_name", "note"]), p))
    return lda.flat_table(spark, path, ["n_nationkey", "n_name", "note"])


@query
def json_records(spark, d):
    """One JSON text a row, numbers to ten digits, missing values as null."""
    rows = tables(spark, d).table("supplier").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("s_suppkey") / 7).alias("x"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("s"))
    back = sinks.records(rows).select(F.from_json("json", "k long, x double, s string").alias("r"))
    return back.select("r.k", "r.x", "r.s")


@query
def entity_files(spark, d):
    """One file for each entity, read back with the entity's name from its folder."""
    t = tables(spark, d)
    path = written(spark, d, "entities", lambda p: sinks.write_entities(t.table("nation").select(T.slug(F.col("n_name")).alias("slug"), "n_nationkey", "n_regionkey"), p))
    got = spark.read.text(path).select("slug", F.from_json("value", "n_nationkey long, n_regionkey long").alias("r"))
    return got.select("slug", "r.n_nationkey", "r.n_regionkey")


# ---- tagging, investigations


@query
def curated_migration(spark, d):
    c = tables(spark, d).table("customer").where("c_custkey <= 300")
    old = c.select(F.col("c_name").alias("employer"), F.element_at(F.array(*[F.lit(x) for x in ("yes", "no", "", "1", "maybe", "False")]), (F.col("c_custkey") % 6 + 1).cast("int")).alias("include"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("canonical_name"), F.lit("found by").alias("matched_searches"))
    return tagging.migrate_curated(old)


@query
def alias_states(spark, d):
    t = tables(spark, d)
    return investigations.alias_summary(t.itcont, t.curated.select("employer", F.upper("sector").alias("canonical_name")).where("canonical_name != 'OTHER'"))


@query
def inflow_paths(spark, d):
    t = tables(spark, d)
    return investigations.inflow_paths({"itcont": t.itcont, "itoth": t.itoth}, "C3")[0]


@query
def inflow_givers(spark, d):
    t = tables(spark, d)
    return investigations.inflow_paths({"itcont": t.itcont, "itoth": t.itoth}, "C3")[1]


@query
def memo_only_types(spark, d):
    t = tables(spark, d)
    marked = t.itoth.withColumn("memo_cd", F.when(F.col("transaction_tp").isin("24C", "15J"), "X").otherwise(F.col("memo_cd")))
    return investigations.memo_only_types(marked)


@query
def first_seen_rows(spark, d):
    ev = tables(spark, d).table("events").select(F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("user_id"), "event_id", "event_type")
    return R.first_seen(ev, "user_id", [F.asc("event_id")])


@query
def composite_overlap(spark, d):
    t = tables(spark, d)
    pair = lambda df: df.select("cmte_id", T.key(F.col("name")).alias("name"))
    return R.key_overlap(pair(t.itcont.where("memo_cd = 'X'")), pair(t.itcont.where("memo_cd = ''")), ["cmte_id", "name"])


# ---- pages and labels


@query
def number_labels(spark, d):
    c = tables(spark, d).table("customer")
    amt = F.when(F.col("c_custkey") % 9 != 0, F.floor(F.col("c_acctbal")).cast("double"))
    short = F.concat(F.lit("$"), _text(F.col("c_custkey")), F.element_at(F.array(*[F.lit(x) for x in ("k", "M", "b", "%", "")]), (F.col("c_custkey") % 5 + 1).cast("int")))
    return c.select(
        "c_custkey", T.money_label(amt).alias("money"), T.pct_label(F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey") / 4)).alias("pct"), T.parsed_number(short).alias("parsed"),
        T.join_parts(F.when(F.col("c_custkey") % 2 == 0, ""), F.col("c_mktsegment"), F.lit(None).cast("string"), F.col("c_name")).alias("joined"),
        N.iso(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_custkey").cast("int"))).alias("day"),
    )


@query
def lean_order(spark, d):
    """The first hundred rows of the lean table with their places."""
    t = tables(spark, d)
    rows = summaries.in_entity_order(summaries.entity_lean(CYCLE, t.companies, t.classes, t.donors)).limit(100)
    return _placed(rows, "entity_type", "entity_id")


def _placed(rows: DataFrame, *columns: str) -> DataFrame:
    """A few rows in their order, numbered from 1: as one array, which keeps the order of a sorted limit."""
    kept = staged(rows.coalesce(1).withColumn("__at", F.monotonically_increasing_id()), "placed")  # one partition of a bounded limit
    return kept.select((F.col("__at") + 1).alias("place"), *columns)


@query
def race_order(spark, d):
    return _placed(races.in_race_order(tables(spark, d).races).limit(25), "cand_id", "race_key")


@query
def state_order(spark, d):
    return _placed(races.in_state_order(races.state_summary(tables(spark, d).races)).limit(60), "state_code")


@query
def house_page(spark, d):
    return _placed(site.page_candidates(tables(spark, d).races, "H"), "cand_id", "cand_name")


@query
def home_leaders(spark, d):
    t = tables(spark, d)
    return _placed(site.leading(t.companies, "net_total", "tech_canonical_name"), "tech_canonical_name", "net_total")


@query
def political_bodies(spark, d):
    return site.political_bodies(summaries.committee_export(tables(spark, d).receipts)).select("cmte_id", "tech_receipts", "recipient_bucket")


@query
def donor_shares(spark, d):
    return site.donor_shares(tables(spark, d).donors.withColumn("pct_r", F.when(F.col("n_committees") % 2 == 0, F.col("pct_r")))).select("name", "pct_d", "pct_r")


@query
def tile_map(spark, d):
    states = races.state_summary(tables(spark, d).races)
    return site.mapped(states, site.tiles(spark)).select("state_code", "tile_x", "tile_y", "is_mapped", "state_name")


@query
def badges(spark, d):
    t = tables(spark, d)
    return t.classes.select("cmte_id", T.party_badge(F.col("party_dr")).alias("badge"), T.slug(F.concat_ws(" ", "cmte_nm", "cmte_id")).alias("slug"))


@query
def weekly_chart(spark, d):
    weeks = summaries.weekly_totals(tables(spark, d).giving, CYCLE).select("week_end", "cumulative_net_total")
    return site.chart_points(weeks, "cumulative_net_total", 720.0, 220.0)


# ---- streams over what is there


@query
def weekly_stream(spark, d):
    """Weekly sums by a stream that takes all there is, stops, and leaves a table."""

    def run(path: str) -> None:
        ev = tables(spark, d).table("events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
        ev.write.parquet(f"{path}/in")
        src = spark.readStream.schema(ev.schema).parquet(f"{path}/in")
        q = series.weekly_stream(src, "ts", "value").writeStream.outputMode("update").option("checkpointLocation", f"{path}/state")
        q.foreachBatch(lambda rows, n: rows.write.mode("append").parquet(f"{path}/out")).trigger(availableNow=True).start().awaitTermination()

    path = written(spark, d, "weekly-stream", run)
    return spark.read.schema("week_end date, net_total double, n_rows bigint").parquet(f"{path}/out").distinct()


@query
def first_seen_stream(spark, d):
    """Ids once, by a stream with a watermark wider than the data."""

    def run(path: str) -> None:
        ev = tables(spark, d).table("events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
        ev.write.parquet(f"{path}/in")
        src = spark.readStream.schema(ev.schema).parquet(f"{path}/in")
        series.run_available(series.first_seen_stream(src, "user_id", "ts", "9000 days").select("user_id"), f"{path}/out", f"{path}/state").awaitTermination()

    return spark.read.schema("user_id long").parquet(written(spark, d, "first-seen", run) + "/out")
