"""The registered queries: every block and plan on the analog tables of ``moneyflow.analog``, or on driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from moneyflow import codes
from moneyflow.analog import CYCLE, view
from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R
from moneyflow.operators.staging import staged
from moneyflow.plans import classify, contributions, investigations, lobbying, races, site, summaries, tagging

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


class Tables:
    """The plans' inputs and shared intermediates for one folder, built lazily, each at most once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.v = partial(view, spark, sf_dir)
        self.table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in MAKERS:
            raise AttributeError(name)
        out = MAKERS[name](self)
        self.__dict__[name] = out
        return out


_TABLES: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """One set of tables for each session and folder: what several queries read is staged once. ``forget`` starts anew."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


def forget() -> None:
    _TABLES.clear()


MAKERS: dict[str, Callable[[Tables], DataFrame]] = {
    **{n: (lambda t, n=n: t.v(n)) for n in ("cm", "cn", "ccl", "itcont", "itoth", "itpas2", "curated", "filed", "activities")},
    "contrib": lambda t: contributions.donor_contributions(t.itcont, t.cm),
    "spending": lambda t: contributions.committee_spending(t.itoth, t.cm),
    "included": lambda t: t.curated.where(T.key(F.col("include")) == "TRUE"),
    "tagged": lambda t: contributions.tag_employers(t.contrib, t.included),
    "giving": lambda t: staged(contributions.giving(t.itcont, t.cm, t.included), "giving"),
    "party": lambda t: classify.candidate_party(t.cn, CYCLE),
    "evidence": lambda t: classify.behavioural_evidence(t.itoth, t.itpas2, t.ccl, t.party),
    "classes": lambda t: staged(classify.classify_committees(t.cm, t.evidence), "classes"),
    "donor_class": lambda t: classify.classify_donors(t.giving, t.classes),
    "donors": lambda t: summaries.donor_summary(t.giving, t.donor_class),
    "companies": lambda t: summaries.company_summary(t.giving, t.classes),
    "by_donor": lambda t: classify.company_by_donor_party(t.giving, t.donor_class),
    "company_table": lambda t: summaries.company_table(t.companies, t.by_donor),
    "receipts": lambda t: staged(summaries.committee_receipts(t.giving, t.cm, t.classes), "receipts"),
    "reports": lambda t: catalog_nested.nested_reports(t),
    "races": lambda t: staged(races.candidate_races(CYCLE, t.cn, t.ccl, t.cm, t.spending, t.receipts), "races"),
}


@query
def contrib_net_by_type(spark, d):
    t = tables(spark, d).contrib
    return t.groupBy("transaction_tp", "is_refund").agg(F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("net_amt")).alias("net_total"))


@query
def spending_filter_join(spark, d):
    t = tables(spark, d).spending
    support = F.when(F.col("transaction_tp") == "24E", F.col("net_amt")).otherwise(0.0)
    oppose = F.when(F.col("transaction_tp") == "24A", F.col("net_amt")).otherwise(0.0)
    return t.groupBy("filer_cmte_tp", "transaction_tp").agg(
        F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("net_amt")).alias("total"), N.money_sum(support).alias("support"), N.money_sum(oppose).alias("oppose")
    )


@query
def employer_tag_exact(spark, d):
    t = tables(spark, d).tagged
    return t.groupBy("employer", "tech_canonical_name", "tech_sector", "is_tech_employer").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name").alias("n_donors"))


@query
def company_party_split(spark, d):
    return tables(spark, d).companies


@query
def company_donor_pivot2(spark, d):
    return tables(spark, d).by_donor


@query
def donor_summary(spark, d):
    return tables(spark, d).donors


@query
def donor_top_committee(spark, d):
    t = summaries.tech(tables(spark, d).giving)
    per = R.drop_null_keys(t, ["name", "cmte_nm"]).groupBy("name", "cmte_nm").agg(N.money_sum(F.col("net_amt")).alias("amt"))
    return R.top_k(per, ["name"], [F.desc("amt"), F.asc("cmte_nm")], 1).drop("rank")


@query
def donor_party_class(spark, d):
    return tables(spark, d).donor_class


@query
def committee_behavior(spark, d):
    return tables(spark, d).evidence


@query
def committee_evidence_merge(spark, d):
    return tables(spark, d).classes


@query
def committee_receipts_share(spark, d):
    return tables(spark, d).receipts


@query
def outbound_inner(spark, d):
    t = tables(spark, d)
    return summaries.outbound(t.spending, t.receipts).drop("transaction_amt", "memo_cd")


@query
def funded_semi(spark, d):
    t = tables(spark, d)
    funded = summaries.tech(t.giving).select("cmte_id")
    return t.cm.join(funded, "cmte_id", "left_semi").select("cmte_id", "cmte_nm", "cmte_tp")


@query
def review_anti(spark, d):
    t = tables(spark, d)
    return t.table("documents").select("doc_id", "lang", "source").join(t.table("labels").select("doc_id"), "doc_id", "left_anti")


@query
def sankey_edges(spark, d):
    t = tables(spark, d)
    return summaries.sankey_edges(t.giving, t.spending, summaries.funded_committees(t.giving))


@query
def entity_lean_union(spark, d):
    t = tables(spark, d)
    return summaries.entity_lean(CYCLE, t.companies, t.classes, t.donors)


@query
def candidate_race(spark, d):
    return tables(spark, d).races.drop("_row_ord")


@query
def state_rollup(spark, d):
    return races.state_summary(tables(spark, d).races)


@query
def district_rollup(spark, d):
    return races.house_district_summary(tables(spark, d).races)


@query
def senate_rollup(spark, d):
    return races.senate_summary(tables(spark, d).races)


@query
def office_page(spark, d):
    return site.candidates_for_office(tables(spark, d).races, "H").select("cand_id", "cand_name", "cand_office_st", "is_display_candidate", "tech_itemized_receipts")


@query
def district_normalize(spark, d):
    t = tables(spark, d).cn
    dist = T.house_district(F.col("cand_office_district"))
    return t.select(
        "cand_id", T.clean_code(F.col("cand_office_district")).alias("code"), dist.alias("district"), T.district_order(F.col("cand_office_district")).cast("long").alias("district_order"),
        T.valid_house_district(F.col("cand_office_st"), dist).alias("is_valid"), T.race_key(F.col("cand_office"), F.col("cand_office_st"), F.col("cand_office_district")).alias("race_key"),
    )


@query
def weekly_totals(spark, d):
    return summaries.weekly_totals(tables(spark, d).giving, CYCLE)


@query
def weekly_by_company(spark, d):
    return summaries.weekly_by_company(tables(spark, d).giving, CYCLE)


@query
def weekly_by_bucket(spark, d):
    return summaries.weekly_by_bucket(tables(spark, d).giving, CYCLE)


@query
def weekly_by_party(spark, d):
    t = tables(spark, d)
    return summaries.weekly_by_party(t.giving, t.classes, CYCLE)


@query
def weekly_events(spark, d):
    ev = tables(spark, d).table("events").withColumn("week_end", N.week_end(F.to_date("ts")))
    return R.weekly(ev, "week_end", ["event_type"], {"net_total": N.money_sum(F.col("value")), "n_events": F.count(F.lit(1))}, ("net_total", "running_total"))


@query
def weekly_display(spark, d):
    return summaries.displayed(summaries.weekly_totals(tables(spark, d).giving, CYCLE), 1997)


@query
def company_top_k(spark, d):
    return summaries.company_top_donors(tables(spark, d).giving, 5)


@query
def company_top_committees(spark, d):
    t = tables(spark, d)
    return summaries.company_top_committees(t.giving, t.classes, 5)


@query
def company_payload_nested(spark, d):
    """The nested payloads, laid flat again: one row for each company, section and place."""
    t = tables(spark, d)
    out = summaries.company_payloads(t.giving, t.company_table, t.classes, CYCLE, 3)
    shown = {"weekly_series": ("week_end", "n_donors"), "top_donors": ("name", "n_committees"), "top_committees": ("cmte_id", "n_donors")}

    def section(name: str, entry: str, n: str):
        return F.transform(name, lambda x, i: F.struct(F.lit(name).alias("section"), (i + 1).cast("long").alias("place"), x[entry].cast("string").alias("entry"), x["net_total"].alias("net_total"), x[n].alias("n")))

    sections = [section(name, *columns) for name, columns in shown.items()]
    kind = "array<struct<section:string,place:bigint,entry:string,net_total:double,n:bigint>>"
    head = F.array(F.struct(F.lit("summary").alias("section"), F.lit(1).cast("long").alias("place"), F.col("summary.slug").alias("entry"), F.col("summary.net_total").alias("net_total"), F.col("summary.n_donors_total").alias("n")))
    return out.select("tech_canonical_name", F.inline(F.concat(head, *[F.coalesce(x, F.array().cast(kind)) for x in sections])))


@query
def payload_top_donors(spark, d):
    """What the payloads hold of donors, all columns."""
    t = tables(spark, d)
    rows, _ = summaries.payload_rows(t.giving, t.company_table, t.classes, CYCLE, 7)["top_donors"]
    return rows


@query
def payload_top_committees(spark, d):
    t = tables(spark, d)
    rows, _ = summaries.payload_rows(t.giving, t.company_table, t.classes, CYCLE, 7)["top_committees"]
    return rows


@query
def payload_summary(spark, d):
    return tables(spark, d).company_table


@query
def headline_numbers(spark, d):
    t = tables(spark, d)
    return summaries.headline(t.giving, t.receipts)


@query
def homepage_lists(spark, d):
    """The homepage's four lists as one, each entry with its place."""
    t = tables(spark, d)
    lists = summaries.homepage_lists(t.company_table, summaries.committee_export(t.receipts), t.donors)
    keys = {"top_companies": ("tech_canonical_name", "net_total"), "top_candidates": ("cmte_id", "tech_receipts"), "top_political_bodies": ("cmte_id", "tech_receipts"), "top_donors": ("name", "net_total")}
    rows = [lists[n].select(F.lit(n).alias("list"), F.col(k).alias("entry"), F.col(v).alias("amount")) for n, (k, v) in keys.items()]
    return R.union_all(*rows)


@query
def featured_committees(spark, d):
    out = summaries.committee_export(tables(spark, d).receipts)
    return out.select("cmte_id", "tech_receipts", "tech_pct", "recipient_bucket", "is_candidate_committee", "is_featured", "is_tech_dominated", "cmte_nm", "connected_org_nm", "total_contributions")


@query
def major_donors(spark, d):
    return summaries.major_donors(tables(spark, d).donors).select("name", "net_total", "donor_party")


@query
def ranked_donors(spark, d):
    return summaries.ranked(tables(spark, d).donors.select("name", "net_total"), "net_total", "name", 25)


PATTERNS = {"bolt": ["BOLT", r"\bGEAR\b"], "hot": ["^hot"], "medium": ["MEDIUM"], "end9": [r"9$"]}
EXACT = {"exact_ring": ["SMALL RING BRAND#2 ECONOMY"], "hot": ["RED WIDGET BRAND#17 ECONOMY"]}
NOISY = ["WIDGET", "BLUE"]


def _part_rows(t: Tables) -> DataFrame:
    name = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return t.table("part").select(name.alias("employer"), F.col("p_retailprice").alias("transaction_amt"), F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("name"))


@query
def employer_stats(spark, d):
    return tagging.employer_stats(_part_rows(tables(spark, d)))


@query
def employer_candidates(spark, d):
    return tagging.employer_candidates(_part_rows(tables(spark, d)), PATTERNS, EXACT, NOISY)


@query
def review_queue(spark, d):
    t = tables(spark, d)
    found = tagging.employer_candidates(_part_rows(t), PATTERNS, EXACT, NOISY)
    known = t.table("part").where("p_size % 2 = 0").select(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("employer"))
    return tagging.review_queue(found, known)


@query
def top_donor_variants(spark, d):
    return tagging.top_donors(tables(spark, d).contrib, 2000)


@query
def committees_by_sponsor(spark, d):
    return tagging.committees_by_sponsor(tables(spark, d).cm, ["supplier#0+[0-9]*7$", "00003"])


@query
def text_norm(spark, d):
    t = tables(spark, d).table("customer")
    raw = F.concat(F.col("c_mktsegment"), F.lit(" & "), F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, ", Inc. Co").otherwise(" Holdings  llc"))
    norm = T.normalize_name(raw)
    return t.select(
        "c_custkey", norm.alias("norm"), T.core_name(norm).alias("core"), T.compact(norm).alias("compact"), T.contains_digit(norm).alias("has_digit"),
        T.long_enough_to_contain(T.core_name(norm)).alias("contains_ok"), T.slug(raw).alias("slug"), T.key(F.concat(F.lit("\t "), raw, F.lit(" \n"))).alias("key"),
    )


@query
def url_slugs(spark, d):
    t = tables(spark, d).table("pages")
    return t.select("page_id", T.slug(F.col("url")).alias("slug"), (T.substring_count(F.col("url"), "/")).cast("long").alias("n_slashes"))


def _entities(t: Tables) -> DataFrame:
    """Parts as entities: a type and a brand make a name."""
    name = F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, " Inc.").otherwise(""))
    out = t.table("part").select(
        F.lit("client").alias("entity_type"), F.col("p_partkey").cast("string").alias("entity_id"), name.alias("entity_name"), F.lit("").alias("entity_description"),
        F.lit("").alias("entity_state"), F.lit("").alias("entity_country"), F.col("p_size").cast("long").alias("n_filings"), F.lit(1).cast("long").alias("n_counterparties"),
        F.lit("registrants").alias("counterparty_label"), F.col("p_retailprice").alias("total_reported_spend"), F.lit("a").alias("first_posted"), F.lit("b").alias("last_posted"),
    )
    out = out.withColumn("entity_name_norm", T.normalize_name(F.col("entity_name")))
    return out.withColumn("entity_name_core", T.core_name(F.col("entity_name_norm")))


ALIAS_ROWS = [
    ("STANDARD POLISHED TIN Brand#11", "Polished steel", "Tin Co"),
    ("Anodized Copper", "", "ANODIZED COPPER Holdings"),
    ("small", "Brand#2", "ECONOMY"),
    ("MEDIUM PLATED BRASS Brand#33 LLC", "x; y", "Plated Brass Inc"),
]


def _aliases(spark: SparkSession) -> DataFrame:
    rows = [(a, "TRUE", c, "s", m, "") for a, m, c in ALIAS_ROWS]
    return spark.createDataFrame(rows, "employer string, include string, canonical_name string, sector string, matched_searches string, notes string")


@query
def alias_unpivot(spark, d):
    return lobbying.aliases(tables(spark, d).curated).select("matched_alias", "alias_source", "canonical_name", "alias_norm", "alias_core", "contains_ok", F.col("alias_length").cast("long").alias("alias_length"))


@query
def entity_alias_match(spark, d):
    out = lobbying.match_entities(_entities(tables(spark, d)), lobbying.aliases(_aliases(spark)))
    return out.select("entity_id", "match_score", "match_type", "match_confidence", "matched_alias", "alias_source")


@query
def entity_review(spark, d):
    out = lobbying.review_matches(lobbying.match_entities(_entities(tables(spark, d)), lobbying.aliases(_aliases(spark))))
    return out.select("entity_id", "best_match_score", "best_alias", "best_alias_source", "n_candidate_matches", "candidate_aliases")


@query
def json_props(spark, d):
    ev = tables(spark, d).table("events")
    k = F.get_json_object("props", "$.k").try_cast("long")
    return ev.groupBy("event_type").agg(F.count(k).alias("n_k"), F.sum(k).alias("sum_k"), F.count_if(N.present(F.col("props"))).alias("n_present"))


@query
def nested_explode(spark, d):
    c = tables(spark, d).table("conversations")
    nested = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    rows = nested.select("conv_id", N.array_length(F.col("turns")).alias("n_turns"), F.posexplode("turns").alias("pos", "x"))
    return rows.select(F.concat(F.col("conv_id").cast("string"), F.lit(":turn:"), (F.col("pos") + 1).cast("string")).alias("turn_id"), "conv_id", "n_turns", F.col("x.role").alias("role"))


def _paged(t: Tables) -> DataFrame:
    """Events as pages of 100 rows, one id in ten seen twice."""
    ev = t.table("events").select(F.concat(F.lit("E"), (F.col("event_id") - F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)).cast("string")).alias("filing_uuid"), "event_id", "event_type")
    return ev.select("*", F.floor(F.col("event_id") / 100).cast("long").alias("_page"), (F.col("event_id") % 100).alias("_pos"), F.floor(F.col("event_id") / 7).cast("string").alias("dt_posted"))


@query
def snapshot_first_wins(spark, d):
    return lobbying.snapshot(_paged(tables(spark, d))).select("filing_uuid", "event_id", "event_type")


@query
def snapshot_completeness(spark, d):
    return lobbying.completeness(_paged(tables(spark, d)))


@query
def tied_boundaries(spark, d):
    return lobbying.tied_boundaries(_paged(tables(spark, d)))


@query
def dimension_upsert(spark, d):
    o = tables(spark, d).table("orders")
    rows = o.select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"))
    return R.upsert_dimension(rows, "o_custkey", F.col("o_orderkey"), ["status", "priority"])


@query
def client_quarter(spark, d):
    return lobbying.client_quarter(tables(spark, d).filed)


@query
def client_issue(spark, d):
    t = tables(spark, d)
    return lobbying.client_issue(t.activities, t.filed)


@query
def issue_quarter(spark, d):
    t = tables(spark, d)
    return lobbying.issue_quarter(t.activities, t.filed)


@query
def client_lobbyist(spark, d):
    t = tables(spark, d)
    return lobbying.client_lobbyist(t.activities.drop("amount"), t.filed)


@query
def agency_issue(spark, d):
    t = tables(spark, d)
    agencies = t.activities.select("activity_id", "filing_uuid", "government_entity_id", "government_entity_name")
    return lobbying.agency_issue(agencies, t.activities, t.filed)


@query
def contribution_rollup(spark, d):
    t = tables(spark, d)
    return lobbying.contribution_rollup(t.filed, t.activities.select("filing_uuid", "amount"))


@query
def entity_summary_null_safe(spark, d):
    """Entities joined to their summary with missing ids equal."""
    f = tables(spark, d).filed
    per = f.groupBy("client_api_id").agg(F.count_distinct("filing_uuid").alias("n_filings"), F.min("dt_posted").alias("first_posted"), F.max("dt_posted").alias("last_posted"))
    return R.null_safe_join(f.select("client_api_id", "client_name").dropDuplicates(), per, ["client_api_id"])


@query
def key_overlap(spark, d):
    t = tables(spark, d)
    left = t.table("orders").select(F.col("o_orderkey").alias("k"))
    return R.key_overlap(left, t.table("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("k")), ["k"])


@query
def messy_donors(spark, d):
    t = tables(spark, d)
    return investigations.messy_donors(t.itcont, 100_000, 10.0, 50)


@query
def histogram_bins(spark, d):
    rows = tables(spark, d).table("lineitem").select(F.col("l_returnflag").alias("transaction_tp"), F.col("l_extendedprice").alias("transaction_amt"))
    return investigations.sign_study(rows, [1000.0, 5000.0, 10000.0, 25000.0, 50000.0])


@query
def value_counts(spark, d):
    return R.value_counts(tables(spark, d).table("lineitem"), "l_returnflag")


@query
def describe_numbers(spark, d):
    return R.five_numbers(tables(spark, d).table("lineitem"), "l_extendedprice")


@query
def negatives_by_type(spark, d):
    return investigations.negatives(tables(spark, d).itcont)


@query
def memo_share(spark, d):
    return investigations.memo_share(tables(spark, d).itcont)


@query
def prefixed_types(spark, d):
    return investigations.prefixed_types(tables(spark, d).itcont, ["15", "22"])


@query
def uninvestigated_types(spark, d):
    return investigations.uninvestigated_types(tables(spark, d).itoth, codes.SPENDING_CODES)


@query
def counterparties(spark, d):
    t = tables(spark, d)
    return investigations.counterparties(t.itoth, t.cm)


@query
def donor_net(spark, d):
    return investigations.donor_net(tables(spark, d).contrib, {"seven": "7$", "one_hundreds": "#0+1[0-9]{2}$"})


@query
def refund_origins(spark, d):
    c = tables(spark, d).contrib
    return investigations.refund_origins(c.where("is_refund"), c, 10)


@query
def named_rows(spark, d):
    t = tables(spark, d)
    pick = ["name", "cmte_id", "transaction_tp", "transaction_amt", "sub_id"]
    return investigations.named_rows({"itcont": t.itcont.select(*pick), "itoth": t.itoth.select(*pick)}, "(?:customer#0+[12]|payee 7)$")


@query
def fallback_to_all(spark, d):
    c = tables(spark, d).table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return R.flagged_or_all(c, F.col("c_acctbal") > 9900, ["c_nationkey"])


@query
def sort_direction(spark, d):
    ev = tables(spark, d).table("events").select("user_id", "event_id", "value", (F.col("user_id") % 2 == 0).alias("even"))
    return R.is_sorted(ev.withColumn("v", F.when(F.col("even"), F.col("event_id").cast("double")).otherwise(F.col("value"))), "v", [F.asc("event_id")], ["user_id"])


@query
def page_labels(spark, d):
    """Labels and cut texts as pages show them."""
    c = tables(spark, d).table("customer")
    return c.select("c_custkey", T.label(F.lower("c_mktsegment")).alias("label"), T.truncate(F.col("c_name"), 12).alias("short"), T.truthy(F.substring("c_mktsegment", 1, 1)).alias("truthy"))


@query
def row_filter(spark, d):
    c = tables(spark, d).table("customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.where(T.row_contains(["c_name", "c_mktsegment"], "Auto"))


from moneyflow import catalog_nested  # noqa: E402  registers its queries here
