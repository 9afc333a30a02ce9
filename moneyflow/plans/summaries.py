"""Donor, company and committee summaries, flows, lean, weekly series and payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

from moneyflow import codes
from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R
from moneyflow.plans.classify import with_committee_party
from moneyflow.plans.contributions import COMMITTEE_COLUMNS



def _sums() -> dict[str, Column]:
    return {"net_total": N.total("net_amt"), "gross_positive": N.total("gross_amt"), "n_contributions": F.sum("n_rows")}


def _some(*names: str) -> dict[str, Column]:
    return {n: _sums()[n] for n in names}


def _money(df: DataFrame) -> DataFrame:
    """Exact sums as doubles, for publication."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema])


def tech(giving: DataFrame) -> DataFrame:
    return giving.where("is_tech_employer")


def _top_committee(amount: str, ties: Sequence[str]) -> Column:
    """Aggregate over (donor, committee) rows: the committee with the largest sum; without metadata it does not count."""
    known = F.col("cmte_nm").isNotNull() & F.col("cmte_tp").isNotNull()
    return F.min_by(F.struct("cmte_nm", "cmte_tp", F.col(amount).alias("amt")), F.when(known, F.struct((-F.col(amount)).alias("a"), *ties)))


def _with_top(df: DataFrame) -> DataFrame:
    top = [F.col("__top.cmte_nm").alias("top_committee"), F.col("__top.cmte_tp").alias("top_committee_type"), F.col("__top.amt").alias("top_committee_amt")]
    return df.select("*", *top).drop("__top")


def donor_summary(giving: DataFrame, donors: DataFrame) -> DataFrame:
    """One row for each tech donor: totals, employers, top committee (largest sum, then least id), party.

    Rows are first added up by donor and committee; a donor's committees are then counted and ranked in one aggregate.
    """
    texts = {"employers": "employer", "occupations": "occupation", "states": "state", "tech_companies": "tech_canonical_name", "tech_sectors": "tech_sector"}
    rows = R.drop_null_keys(tech(giving), ["name"])
    per = rows.groupBy("name", "cmte_id").agg(
        *[c.alias(n) for n, c in _sums().items()], F.min("cmte_nm").alias("cmte_nm"), F.min("cmte_tp").alias("cmte_tp"),
        *[F.collect_set(c).alias(n) for n, c in texts.items()],
    )
    base = per.groupBy("name").agg(
        *[F.sum(n).alias(n) for n in _sums()], F.count("cmte_id").alias("n_committees"), *[R.concat_sets(F.col(n)).alias(n) for n in texts],
        _top_committee("net_total", ["cmte_id"]).alias("__top"),
    )
    label = ["name", "donor_party", "D", "R", "pct_d", "pct_r", "pct_classified", "classified_total", "overall_total", "Mixed", "Unknown"]
    return _money(_with_top(base)).join(donors.select(*label), "name", "left")


def company_summary(giving: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each company, its money split by the recipients' party."""
    rows = R.drop_null_keys(with_committee_party(tech(giving), classes), ["tech_canonical_name"])
    sides = {"D": "amt_dem", "R": "amt_rep", "Mixed": "amt_mixed", "Unknown": "amt_unknown"}
    split = {name: N.total(F.when(F.col("cmte_party") == p, F.col("net_amt"))) for p, name in sides.items()}
    out = R.grouped(rows, ["tech_canonical_name"], _some("net_total", "n_contributions") | split, {"n_committees": "cmte_id", "n_donors": "name"})
    sectors = rows.select("tech_canonical_name", "tech_sector").distinct().groupBy("tech_canonical_name").agg(R.concat_distinct(F.col("tech_sector")).alias("sectors"))
    out = _money(out.join(sectors, "tech_canonical_name"))
    total = F.col("amt_dem") + F.col("amt_rep")
    return out.select(
        "*", (F.col("amt_mixed") + F.col("amt_unknown")).alias("amt_other"), total.alias("classified_recipient_total"),
        N.pct(F.col("amt_dem"), total).alias("pct_dem"), N.pct(total, F.col("net_total")).alias("pct_classified_recipients"),
    )


def committee_receipts(giving: DataFrame, committees: DataFrame, classes: DataFrame) -> DataFrame:
    """All receipts and tech receipts of each committee: added up by committee and donor first, so that a large committee
    is many groups before it is one."""
    is_tech = F.col("is_tech_employer")
    own = lambda c: F.when(is_tech, F.col(c))
    per = R.drop_null_keys(giving, ["cmte_id"]).groupBy("cmte_id", "name").agg(
        N.total("net_amt").alias("total_receipts"), F.sum("n_rows").alias("total_contributions"), N.total(own("net_amt")).alias("tech_receipts"),
        F.coalesce(F.sum(own("n_rows")), F.lit(0)).alias("tech_contributions"), F.collect_set(own("tech_canonical_name")).alias("companies"),
    )
    out = per.groupBy("cmte_id").agg(
        F.sum("total_receipts").alias("total_receipts"), F.count("name").alias("total_donors"), F.sum("total_contributions").alias("total_contributions"),
        F.sum("tech_receipts").alias("tech_receipts"), F.count_if(F.col("name").isNotNull() & (F.col("tech_contributions") > 0)).alias("tech_donors"),
        F.sum("tech_contributions").alias("tech_contributions"), R.concat_sets(F.col("companies")).alias("tech_companies"),
    )
    out = _money(out).withColumn("tech_pct", N.pct(F.col("tech_receipts"), F.col("total_receipts")))
    out = R.lookup_join(out, committees, "cmte_id", COMMITTEE_COLUMNS)
    label = ["party_dr", "classification_source", "evidence_sources", "dem_evidence_amt", "rep_evidence_amt", "evidence_total", "evidence_pct_dem"]
    return R.lookup_join(out, classes, "cmte_id", label)


def outbound(spending: DataFrame, receipts: DataFrame) -> DataFrame:
    """Spending of committees that took tech money."""
    funded = receipts.where("tech_receipts > 0").select("cmte_id", "tech_receipts", "total_receipts", "tech_pct", "tech_companies")
    return spending.join(funded, "cmte_id", "inner")


def funded_committees(giving: DataFrame) -> DataFrame:
    """(cmte_id) of the committees that took tech money."""
    return R.drop_null_keys(tech(giving), ["cmte_id"]).groupBy("cmte_id").agg(N.total("net_amt").alias("t")).where("t > 0").select("cmte_id")


def sankey_edges(giving: DataFrame, spending: DataFrame, funded: DataFrame) -> DataFrame:
    """Donor to committee, and tech-funded committee to payee, as one edge list.

    Edges are told apart by committee id, though they show its name: committees of one name stay two. Edges without
    an end do not exist.
    """
    keys = ["name", "tech_canonical_name", "cmte_id", "cmte_nm", "cmte_tp"]
    left = R.drop_null_keys(tech(giving), keys).groupBy(*keys).agg(N.total("net_amt").cast("double").alias("amount"))
    left = left.select(
        F.col("name").alias("source"), F.lit("donor").alias("source_type"), F.col("tech_canonical_name").alias("source_company"),
        F.col("cmte_nm").alias("target"), F.col("cmte_tp").alias("target_type"), F.lit("donor_to_committee").alias("edge_type"), "amount",
    )
    keys = ["cmte_id", "filer_cmte_nm", "filer_cmte_tp", "name", "transaction_tp"]
    right = R.drop_null_keys(spending, keys).groupBy(*keys).agg(N.money_sum(F.col("net_amt")).alias("amount")).join(funded, "cmte_id", "left_semi")
    right = right.select(
        F.col("filer_cmte_nm").alias("source"), F.col("filer_cmte_tp").alias("source_type"), F.lit("").alias("source_company"),
        F.col("name").alias("target"), F.col("transaction_tp").alias("target_type"), F.lit("committee_to_candidate").alias("edge_type"), "amount",
    )
    return R.union_all(left, right)


def entity_lean(cycle: int, companies: DataFrame, classes: DataFrame, donors: DataFrame) -> DataFrame:
    """Lean of companies, of all classified committees and of tech donors on one scale: 1 is D, 0 is R."""
    limit = codes.LEAN_THRESHOLD * 100
    score, zero, amount = F.col("party_score_dem"), F.lit(0.0), lambda c: F.coalesce(F.col(c), F.lit(0.0))

    def rows(df: DataFrame, kind: str, entity: str, name: str, subtype: Column, label: Column, dem: Column, amounts: list[Column], measure: str, covers: str, coverage: Column, method: Column, source: Column, scope: str) -> DataFrame:
        out = df.select(
            F.lit(cycle).alias("cycle"), F.lit(kind).alias("entity_type"), F.col(entity).alias("entity_id"), F.col(name).alias("entity_name"), subtype.alias("entity_subtype"),
            label.alias("party_label"), dem.alias("party_score_dem"), *[a.alias(n) for a, n in zip(amounts, ["lean_dem_amt", "lean_rep_amt", "mixed_amt", "unknown_amt"], strict=True)],
            F.col(measure).alias("lean_measure_total"), F.col(covers).alias("coverage_total"), coverage.alias("coverage_ratio"), method.alias("classification_method"),
            source.alias("classification_source"), F.lit(scope).alias("scope"),
        )
        return out.withColumn("party_score_rep", 1 - score)

    pct, classified = F.col("pct_dem"), F.col("classified_recipient_total")
    c = rows(
        companies, "company", "tech_canonical_name", "tech_canonical_name", F.lit("tech_company"),
        F.when(100 - pct >= limit, "R").when(pct >= limit, "D").when(classified > 0, "Mixed").otherwise("Unknown"), F.when(classified > 0, pct / 100),
        [F.col("amt_dem"), F.col("amt_rep"), F.col("amt_mixed"), F.col("amt_unknown")], "classified_recipient_total", "net_total", F.col("pct_classified_recipients") / 100,
        F.lit("employee_recipient_committee_lean"), F.lit("company_employee_giving"), "tech_companies",
    )
    party, source, evidence = F.col("party_dr"), F.col("classification_source"), F.col("evidence_total")
    k = rows(
        classes, "committee", "cmte_id", "cmte_nm", F.coalesce("cmte_tp", F.lit("")), F.coalesce(party, F.lit("Unknown")),
        F.when(party == "D", 1.0).when(party == "R", 0.0).when(party == "Mixed", F.col("evidence_pct_dem")),
        [F.col("dem_evidence_amt"), F.col("rep_evidence_amt"), zero, zero], "evidence_total", "evidence_total", F.when(evidence > 0, 1.0),
        F.when(source == "party_field", "filed_committee_party").when(source != "", "candidate_facing_committee_activity").otherwise("unknown"), source, "all_committees",
    )
    d = rows(
        donors, "donor", "name", "name", F.lit("tech_donor"), F.coalesce("donor_party", F.lit("Unknown")), F.col("pct_d"), [amount("D"), amount("R"), amount("Mixed"), amount("Unknown")],
        "classified_total", "overall_total", F.col("pct_classified"), F.lit("recipient_committee_lean"), F.lit("donor_recipient_committee_lean"), "tech_donors",
    )
    return R.union_all(k, d, c)


ENTITY_ORDER = ["company", "committee", "donor"]


def in_entity_order(lean: DataFrame) -> DataFrame:
    """Companies, committees, donors; then by measure and coverage, largest first, missing last, then by name."""
    kind = F.array_position(F.array(*[F.lit(x) for x in ENTITY_ORDER]), F.col("entity_type"))
    return lean.orderBy(kind, F.desc_nulls_last("lean_measure_total"), F.desc_nulls_last("coverage_total"), F.asc_nulls_last("entity_name"), "entity_id")


WEEK_SUMS = ("net_total", "gross_positive", "n_contributions")


def dated(giving: DataFrame) -> DataFrame:
    return giving.where(F.col("contribution_date").isNotNull())


def _weekly(rows: DataFrame, cycle: int, keys: list[str], sums: tuple[str, ...], distinct: dict[str, str], cumulative: bool = False) -> DataFrame:
    out = R.weekly(rows, "week_end", keys, _some(*sums), ("net_total", "cumulative_net_total") if cumulative else None, distinct)
    return _money(out).select(F.lit(cycle).alias("cycle"), "*")


def weekly_totals(giving: DataFrame, cycle: int) -> DataFrame:
    return _weekly(tech(dated(giving)), cycle, [], WEEK_SUMS, {"n_committees": "cmte_id", "n_donors": "name"}, True)


def weekly_by_company(giving: DataFrame, cycle: int) -> DataFrame:
    rows = R.drop_null_keys(tech(dated(giving)), ["tech_canonical_name"])
    out = _weekly(rows, cycle, ["tech_canonical_name"], WEEK_SUMS, {"n_donors": "name"}, True)
    return out.withColumn("company_slug", T.slug(F.col("tech_canonical_name")))


def weekly_by_bucket(giving: DataFrame, cycle: int) -> DataFrame:
    rows = tech(dated(giving)).withColumn("recipient_bucket", N.recipient_bucket(F.col("cmte_tp")))
    return _weekly(rows, cycle, ["recipient_bucket"], ("net_total", "n_contributions"), {"n_committees": "cmte_id", "n_donors": "name"})


def weekly_by_party(giving: DataFrame, classes: DataFrame, cycle: int) -> DataFrame:
    rows = with_committee_party(tech(dated(giving)), classes).withColumnRenamed("cmte_party", "recipient_party")
    return _weekly(rows, cycle, ["recipient_party"], ("net_total", "n_contributions"), {"n_committees": "cmte_id", "n_donors": "name"})


def displayed(series: DataFrame, cycle: int, week: str = "week_end") -> DataFrame:
    """A series from January 1 of the year before the cycle; running totals were made before, over all weeks."""
    return series.where(F.col(week) >= F.make_date(F.lit(cycle - 1), F.lit(1), F.lit(1)))


def company_top_donors(giving: DataFrame, k: int = codes.TOP_PER_COMPANY) -> DataFrame:
    """Each company's k donors with the most money, with employers, states and the committee (by name and type) that got most."""
    rows = R.drop_null_keys(tech(giving), ["tech_canonical_name", "name"])
    texts = {"employers": "employer", "states": "state"}
    key = ["tech_canonical_name", "name"]
    per = rows.groupBy(*key, "cmte_id", "cmte_nm", "cmte_tp").agg(*[c.alias(n) for n, c in _sums().items()], *[F.collect_set(c).alias(n) for n, c in texts.items()])
    per = per.groupBy(*key, "cmte_nm", "cmte_tp").agg(*[F.sum(n).alias(n) for n in _sums()], F.count("cmte_id").alias("n_committees"), *[F.flatten(F.collect_list(n)).alias(n) for n in texts])
    out = per.groupBy(*key).agg(
        *[F.sum(n).alias(n) for n in (*_sums(), "n_committees")], *[R.concat_sets(F.col(n)).alias(n) for n in texts], _top_committee("net_total", ["cmte_nm", "cmte_tp"]).alias("__top")
    )
    return _money(_with_top(R.top_k(out, ["tech_canonical_name"], [F.desc("net_total"), F.asc("name")], k)))


def company_top_committees(giving: DataFrame, classes: DataFrame, k: int = codes.TOP_PER_COMPANY) -> DataFrame:
    """Each company's k committees with the most money; committees without metadata or class are left out."""
    labels = classes.select("cmte_id", F.coalesce("party_dr", F.lit("Unknown")).alias("party_dr"), "classification_source")
    rows = R.drop_null_keys(tech(giving), ["tech_canonical_name", "cmte_id", "cmte_nm", "cmte_tp"])
    per = R.grouped(rows, ["tech_canonical_name", "cmte_id", "cmte_nm", "cmte_tp"], _some("net_total", "n_contributions"), {"n_donors": "name"})
    per = per.join(labels, "cmte_id").where("classification_source IS NOT NULL").withColumn("recipient_bucket", N.recipient_bucket(F.col("cmte_tp")))
    return _money(R.top_k(per, ["tech_canonical_name"], [F.desc("net_total"), F.asc("cmte_id")], k))


def company_table(companies: DataFrame, by_donor: DataFrame) -> DataFrame:
    """Companies with their split by the donors' party and their slug."""
    return companies.join(by_donor, "tech_canonical_name", "left").withColumn("slug", T.slug(F.col("tech_canonical_name")))


def payload_rows(giving: DataFrame, table: DataFrame, classes: DataFrame, cycle: int, k: int = codes.TOP_PER_COMPANY) -> dict[str, tuple[DataFrame, str]]:
    """The parts of the payloads with their order within a company: weekly series, top donors, top committees."""
    giving = dated(giving)
    return {
        "weekly_series": (weekly_by_company(giving, cycle).drop("company_slug"), "week_end"),
        "top_donors": (company_top_donors(giving, k), "rank"),
        "top_committees": (company_top_committees(giving, classes, k), "rank"),
    }


def company_payloads(giving: DataFrame, table: DataFrame, classes: DataFrame, cycle: int, k: int = codes.TOP_PER_COMPANY) -> DataFrame:
    """One nested row for each company: summary, weekly series, top donors and committees; one job for all."""
    out = table.select("tech_canonical_name", "slug", F.struct(*table.columns).alias("summary"))
    for name, (rows, order) in payload_rows(giving, table, classes, cycle, k).items():
        inner = [c for c in rows.columns if c not in ("tech_canonical_name", order)]
        nested = rows.groupBy("tech_canonical_name").agg(F.array_sort(F.collect_list(F.struct(order, *inner))).alias(name))
        out = out.join(nested, "tech_canonical_name", "left")
    return out


def committee_export(receipts: DataFrame) -> DataFrame:
    """Committees with tech money, their bucket, and whether they are featured or dominated by tech money."""
    r, p = F.col("tech_receipts"), F.coalesce("tech_pct", F.lit(0.0))
    bucket = N.recipient_bucket(F.col("cmte_tp"))
    return receipts.where(r > 0).select(
        "*", bucket.alias("recipient_bucket"), (bucket == "candidate").alias("is_candidate_committee"),
        ((r >= codes.FEATURED_RECEIPTS_USD) | (p >= codes.FEATURED_PCT)).alias("is_featured"), (p >= codes.DOMINATED_PCT).alias("is_tech_dominated"),
    )


def major_donors(donors: DataFrame, least: float = codes.MAJOR_DONOR_USD) -> DataFrame:
    return donors.where(F.col("net_total") >= least)


def headline(giving: DataFrame, receipts: DataFrame) -> DataFrame:
    """One row of site-wide figures: money and days of dated rows, donors and companies of all."""
    on = F.col("contribution_date").isNotNull()
    sums = {"net_total": N.total(F.when(on, F.col("net_amt"))), "n_contributions": F.sum(F.when(on, F.col("n_rows")).otherwise(0))}
    t = R.grouped(tech(giving), [], sums, {"n_donors": "name", "n_companies": "tech_canonical_name"})
    days = tech(giving).agg(F.min("contribution_date").alias("first_date"), F.max("contribution_date").alias("last_date"))
    k = committee_export(receipts).agg(F.count(F.lit(1)).alias("n_committees"), F.count_if("is_featured").alias("n_featured"), F.count_if("is_tech_dominated").alias("n_dominated"))
    return _money(t).join(days, F.lit(True)).join(k, F.lit(True))  # one row each


HOME_COMPANY = ["tech_canonical_name", "slug", "net_total", "n_donors", "n_contributions", "n_committees", "pct_dem", "pct_classified_recipients", "pct_dem_by_donor"]
HOME_COMMITTEE = ["cmte_id", "cmte_nm", "cmte_tp", "party_dr", "tech_receipts", "tech_pct", "tech_donors", "is_featured", "is_tech_dominated", "recipient_bucket"]
HOME_DONOR = ["name", "D", "R", "net_total", "donor_party", "pct_d", "pct_r", "n_contributions", "n_committees", "tech_companies", "top_committee", "top_committee_type", "top_committee_amt"]


def homepage_lists(table: DataFrame, export: DataFrame, donors: DataFrame) -> dict[str, DataFrame]:
    """The homepage's lists: ten companies, ten candidate committees, ten other bodies, twenty major donors."""
    candidate = F.col("recipient_bucket") == "candidate"
    return {
        "top_companies": ranked(table, "net_total", "tech_canonical_name", 10).select(*HOME_COMPANY),
        "top_candidates": ranked(export.where(candidate), "tech_receipts", "cmte_id", 10).select(*HOME_COMMITTEE),
        "top_political_bodies": ranked(export.where(~candidate), "tech_receipts", "cmte_id", 10).select(*HOME_COMMITTEE),
        "top_donors": ranked(major_donors(donors), "net_total", "name", 20).select(*HOME_DONOR),
    }


def ranked(df: DataFrame, by: str, name: str, n: int) -> DataFrame:
    """The first n rows by a measure: a top-n without a full sort."""
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(name)).limit(n)
