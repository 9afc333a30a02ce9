"""Candidates and races: one row for each candidate, then states, House districts and Senate races."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R
from moneyflow.plans.classify import with_target

RECEIPTS = ["total_itemized_receipts", "tech_itemized_receipts"]
IE = ["ie_support_total", "ie_oppose_total", "tech_funded_ie_support_total", "tech_funded_ie_oppose_total"]


def cycle_linkage(linkage: DataFrame, cycle: int) -> DataFrame:
    """Links of the cycle by either year, one for each candidate and committee."""
    rows = linkage.where((F.col("cand_election_yr") == str(cycle)) | (F.col("fec_election_yr") == str(cycle)))
    return R.first_by(rows, ["cand_id", "cmte_id"], [F.col("_row_ord").asc()])


def candidate_races(
    cycle: int, candidates: DataFrame, linkage: DataFrame, committees: DataFrame, spending: DataFrame, receipts: DataFrame
) -> DataFrame:
    """Linked committees, their receipts, and independent expenditures for each candidate of the cycle.

    Donors are counted once for each committee, so a candidate's donor counts add up over committees.
    """
    cand = candidates.where(F.col("cand_election_yr") == str(cycle)).withColumn("party_dr", N.party_of(F.col("cand_pty_affiliation")))
    cand = cand.withColumn("is_major_party", F.col("party_dr").isNotNull())
    cand = cand.withColumn("race_key", T.race_key(F.col("cand_office"), F.col("cand_office_st"), F.col("cand_office_district")))
    links = cycle_linkage(linkage, cycle)
    named = R.lookup_join(links, committees.select("cmte_id", F.col("cmte_nm").alias("linked_cmte_nm")), "cmte_id", ["linked_cmte_nm"])
    linked = named.groupBy("cand_id").agg(
        F.count_distinct("cmte_id").alias("linked_committee_count"), F.count_if(F.col("cmte_dsgn") == "P").alias("linked_principal_committee_count"),
        R.concat_distinct(F.col("cmte_id")).alias("linked_committee_ids"), R.concat_distinct(F.col("linked_cmte_nm")).alias("linked_committee_names"),
        R.concat_distinct(F.col("cmte_tp")).alias("linked_committee_types"),
    )
    own = receipts.select(
        "cmte_id", F.col("total_receipts").alias("total_itemized_receipts"), F.col("total_donors").alias("total_itemized_donors"), F.col("tech_receipts").alias("tech_itemized_receipts"),
        F.col("tech_donors").alias("tech_itemized_donors"), F.col("tech_contributions").alias("tech_itemized_contributions"), F.split("tech_companies", "; ").alias("tags"),
    )
    finance = links.select("cand_id", "cmte_id").join(own, "cmte_id", "left").groupBy("cand_id").agg(
        N.money_sum(F.col("total_itemized_receipts")).alias("total_itemized_receipts"), F.sum("total_itemized_donors").alias("total_itemized_donors"),
        N.money_sum(F.col("tech_itemized_receipts")).alias("tech_itemized_receipts"), F.sum("tech_itemized_donors").alias("tech_itemized_donors"),
        F.sum("tech_itemized_contributions").alias("tech_itemized_contributions"), R.concat_distinct_parts(F.col("tags")).alias("tech_company_tags"),
    )
    finance = finance.withColumn("tech_pct_itemized_receipts", N.pct(F.col("tech_itemized_receipts"), F.col("total_itemized_receipts")))
    # the last link of a committee in the cycle names the candidate
    last = R.first_by(links, ["cmte_id"], [F.col("_row_ord").desc()]).select(F.col("cmte_id").alias("linked_cmte"), F.col("cand_id").alias("linked_cand"))
    funded = receipts.where("tech_receipts > 0").select("cmte_id", F.lit(True).alias("funded"))
    ies = with_target(spending.where(F.col("transaction_tp").isin("24E", "24A")), last).where(F.col("target_cand_id") != "").join(funded, "cmte_id", "left")
    amt = lambda code, only=None: N.money_sum(F.when((F.col("transaction_tp") == code) & (F.lit(True) if only is None else only), F.col("net_amt")))
    fund = F.coalesce("funded", F.lit(False))
    ie = ies.groupBy(F.col("target_cand_id").alias("cand_id")).agg(
        amt("24E").alias("ie_support_total"), amt("24A").alias("ie_oppose_total"),
        amt("24E", fund).alias("tech_funded_ie_support_total"), amt("24A", fund).alias("tech_funded_ie_oppose_total"),
    )
    out = cand.join(linked, "cand_id", "left").join(finance, "cand_id", "left").join(ie, "cand_id", "left")
    counts = ["linked_committee_count", "linked_principal_committee_count", "total_itemized_donors", "tech_itemized_donors", "tech_itemized_contributions"]
    texts = ["linked_committee_ids", "linked_committee_names", "linked_committee_types", "tech_company_tags"]
    out = out.fillna(0.0, RECEIPTS + IE).fillna(0, counts).fillna("", texts)
    out = out.withColumn("ie_net_support", F.col(IE[0]) - F.col(IE[1])).withColumn("tech_funded_ie_net_support", F.col(IE[2]) - F.col(IE[3]))
    active = F.lit(False)
    for c in RECEIPTS + IE:
        active = active | (F.col(c) > 0)
    out = out.withColumn("has_principal_candidate_committee", F.col("linked_principal_committee_count") > 0).withColumn("has_finance_activity", active)
    return out.withColumn("is_display_candidate", F.col("has_principal_candidate_committee") | F.col("has_finance_activity"))


def in_race_order(races: DataFrame) -> DataFrame:
    return races.orderBy(
        F.desc("is_display_candidate"), F.desc("is_major_party"), F.desc("tech_itemized_receipts"), F.desc("ie_support_total"),
        F.desc("linked_principal_committee_count"), F.asc_nulls_last("cand_name"), "cand_id",
    )


TOP = {"cand_name": "top_candidate_name", "party_dr": "top_candidate_party", "tech_itemized_receipts": "top_candidate_tech_itemized_receipts"}


def _metrics(donors: bool) -> list[Column]:
    side = lambda p: N.money_sum(F.when(F.col("party_dr") == p, F.col("tech_itemized_receipts")))
    return [
        F.count(F.lit(1)).alias("candidate_count"), F.count_if("is_major_party").alias("major_party_candidate_count"), *[N.money_sum(F.col(c)).alias(c) for c in RECEIPTS + IE],
        side("D").alias("dem_tech_itemized_receipts"), side("R").alias("rep_tech_itemized_receipts"), *([F.sum("tech_itemized_donors").alias("tech_itemized_donors")] if donors else []),
    ]


def _finish(df: DataFrame) -> DataFrame:
    d, r = F.col("dem_tech_itemized_receipts"), F.col("rep_tech_itemized_receipts")
    df = df.withColumn("ie_net_support", F.col(IE[0]) - F.col(IE[1])).withColumn("tech_funded_ie_net_support", F.col(IE[2]) - F.col(IE[3]))
    return df.withColumn("pct_dem", N.pct(d, d + r)).withColumn("pct_rep", N.pct(r, d + r)).withColumn("party_label", N.summary_party(d, r))


def _leaders(sides: bool) -> list[Column]:
    """Aggregates over candidates: the leading display candidate by tech receipts, support, linked committees, name and id;
    with ``sides`` also the leading D and R, and the names of all others."""
    order = F.struct((-F.col("tech_itemized_receipts")).alias("a"), (-F.col("ie_support_total")).alias("b"), (-F.col("linked_committee_count")).alias("c"), "cand_name", "cand_id")
    shown, party = F.col("is_display_candidate"), F.col("party_dr")
    best = lambda c, cond: F.min_by(F.col(c), F.when(cond, order))
    out = [best(c, shown).alias(n) for c, n in TOP.items()]
    if sides:
        out += [best("cand_name", shown & (party == p)).alias(n) for p, n in (("D", "dem_candidate_name"), ("R", "rep_candidate_name"))]
        out.append(R.concat_distinct(F.when(shown & party.isNull(), F.col("cand_name"))).alias("other_candidate_names"))
    return out


def _placed(races: DataFrame) -> DataFrame:
    """Candidates with clean state and district codes; House candidates of districts that do not exist go."""
    rows = races.withColumn("state_code", T.clean_code(F.col("cand_office_st"))).where("state_code != ''")
    rows = rows.withColumn("district_code", T.house_district(F.col("cand_office_district")))
    return rows.where((F.col("cand_office") != "H") | T.valid_house_district(F.col("state_code"), F.col("district_code")))


def state_summary(races: DataFrame) -> DataFrame:
    """House and Senate candidates by state; blank and US codes are left out."""
    rows = _placed(races).where(F.col("cand_office").isin("H", "S") & (F.col("state_code") != "US"))
    house, senate = F.col("cand_office") == "H", F.col("cand_office") == "S"
    out = rows.groupBy("state_code").agg(
        *_metrics(False), F.count_if(house).alias("house_candidate_count"), F.count_if(senate).alias("senate_candidate_count"),
        F.size(F.collect_set(F.when(house, F.col("district_code")))).cast("long").alias("house_district_count"),
        F.size(F.collect_set(F.when(house & F.col("is_major_party"), F.col("district_code")))).cast("long").alias("major_party_house_district_count"),
        F.bool_or(senate).cast("long").alias("has_senate_race"), *_leaders(False),
    )
    return _finish(out)


def house_district_summary(races: DataFrame) -> DataFrame:
    rows = _placed(races.where(F.col("cand_office") == "H"))
    out = rows.groupBy("state_code", "district_code").agg(*_metrics(True), *_leaders(True))
    return _finish(out.withColumn("district_sort", T.district_order(F.col("district_code")).cast("long")).withColumn("district_label", F.concat("state_code", F.lit("-"), "district_code")))


def senate_summary(races: DataFrame) -> DataFrame:
    return _finish(_placed(races.where(F.col("cand_office") == "S")).groupBy("state_code").agg(*_metrics(True), *_leaders(True)))


def in_state_order(states: DataFrame) -> DataFrame:
    return states.orderBy(F.desc("tech_itemized_receipts"), F.desc("house_district_count"), F.asc("state_code"))


def in_district_order(districts: DataFrame) -> DataFrame:
    return districts.orderBy("state_code", "district_sort", F.desc("tech_itemized_receipts"), "district_code")


def in_senate_order(states: DataFrame) -> DataFrame:
    return states.orderBy(F.desc("tech_itemized_receipts"), F.asc("state_code"))
