"""Party lean of candidates, committees and donors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moneyflow.functions import numbers as N
from moneyflow.operators import relational as R

# Types of committees whose filed party counts by itself
FILED_TYPES = ["H", "P", "S", "X", "Y"]


def candidate_party(candidates: DataFrame, cycle: int) -> DataFrame:
    """(cand_id, cand_party) of the cycle's D and R candidates; the last master row of a candidate counts."""
    rows = candidates.where(F.col("cand_election_yr") == str(cycle)).withColumn("cand_party", N.party_of(F.col("cand_pty_affiliation")))
    rows = rows.where(F.col("cand_party").isNotNull())
    return R.first_by(rows, ["cand_id"], [F.col("_row_ord").desc()]).select("cand_id", "cand_party")


def filed_party(committees: DataFrame) -> DataFrame:
    """Committees with ``party_dr`` from the filed party; the source is named only for candidate and party committees."""
    out = committees.withColumn("party_dr", N.party_of(F.col("cmte_pty_affiliation")))
    filed = F.col("party_dr").isNotNull() & F.col("cmte_tp").isin(*FILED_TYPES)
    return out.select(
        "cmte_id", "cmte_nm", "cmte_tp", "cmte_pty_affiliation", "cand_id",
        F.coalesce("party_dr", F.lit("")).alias("party_dr"),
        F.when(filed, "party_field").otherwise("").alias("classification_source"),
    )


def first_linked_candidate(linkage: DataFrame) -> DataFrame:
    """(cmte_id, linked_cand): the first linked candidate in file order, over all cycles."""
    rows = R.first_by(linkage.where(F.col("cand_id") != ""), ["cmte_id"], [F.col("_row_ord").asc()])
    return rows.select(F.col("cmte_id").alias("linked_cmte"), F.col("cand_id").alias("linked_cand"))


def with_target(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``target_cand_id``: the candidate linked to ``other_id``, or ``other_id`` itself."""
    out = rows.join(linked, F.col("other_id") == F.col("linked_cmte"), "left")
    target = F.when(F.col("linked_cand").isNotNull() & (F.col("linked_cand") != ""), F.col("linked_cand")).otherwise(F.col("other_id"))
    return out.withColumn("target_cand_id", target).drop("linked_cmte", "linked_cand")


def behavioural_evidence(itoth: DataFrame, itpas2: DataFrame, linkage: DataFrame, party: DataFrame) -> DataFrame:
    """Committees by what they do for candidates: spending for and against (memos included), and 24K gifts (without memos)."""
    target = party.select(F.col("cand_id").alias("target_cand_id"), "cand_party")
    ies = with_target(itoth.where(F.col("transaction_tp").isin("24E", "24A")), first_linked_candidate(linkage)).join(target, "target_cand_id", "left")
    for_it, d, r = F.col("transaction_tp") == "24E", F.col("cand_party") == "D", F.col("cand_party") == "R"
    effect = F.when(for_it & d, "D").when(for_it & r, "R").when(~for_it & d, "R").when(~for_it & r, "D")
    gifts = itpas2.where((F.col("transaction_tp") == "24K") & (F.col("memo_cd") != "X")).join(party, "cand_id", "left")
    names = {"D": "dem_evidence_amt", "R": "rep_evidence_amt"}
    both = R.union_all(
        ies.select("cmte_id", "transaction_amt", effect.alias("side"), F.lit("ie_spending").alias("source")),
        gifts.select("cmte_id", "transaction_amt", F.col("cand_party").alias("side"), F.lit("24k_contributions").alias("source")),
    ).where(F.col("side").isNotNull())
    # sums of both sources in one aggregate: they are added anyway
    out = both.groupBy("cmte_id").agg(
        *[N.money_sum(F.when(F.col("side") == s, F.col("transaction_amt"))).alias(n) for s, n in names.items()],
        R.concat_distinct(F.col("source"), "+").alias("evidence_sources"),
    )
    dem, rep = F.col("dem_evidence_amt"), F.col("rep_evidence_amt")
    return out.select(
        "cmte_id", dem, rep, (dem + rep).alias("evidence_total"), N.ratio(dem, dem + rep).alias("evidence_pct_dem"),
        N.ratio(rep, dem + rep).alias("evidence_pct_rep"), N.behavioural_party(dem, rep).alias("behavioral_party"), "evidence_sources",
    )


def classify_committees(committees: DataFrame, evidence: DataFrame) -> DataFrame:
    """Filed party, completed by behaviour where no source is named; evidence columns are filled for all."""
    out = filed_party(committees).join(evidence, "cmte_id", "left")
    open_ = (F.col("classification_source") == "") & F.col("behavioral_party").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return out.select(
        "cmte_id", "cmte_nm", "cmte_tp", "cmte_pty_affiliation", "cand_id",
        F.when(open_, F.col("behavioral_party")).otherwise(F.nullif(F.col("party_dr"), F.lit(""))).alias("party_dr"),
        F.when(open_, F.col("evidence_sources")).otherwise(F.col("classification_source")).alias("classification_source"),
        F.coalesce("evidence_sources", F.lit("")).alias("evidence_sources"),
        zero("dem_evidence_amt"), zero("rep_evidence_amt"), zero("evidence_total"), "evidence_pct_dem", "evidence_pct_rep",
    )


BUCKETS = {"D": "D", "R": "R", "Mixed": "Mixed", "Unknown": "Unknown"}


def with_committee_party(tagged: DataFrame, classes: DataFrame) -> DataFrame:
    """``cmte_party``: the committee's label, Unknown where there is none."""
    party = classes.select("cmte_id", F.col("party_dr").alias("cmte_party"))
    return tagged.join(party, "cmte_id", "left").withColumn("cmte_party", F.coalesce("cmte_party", F.lit("Unknown")))


def classify_donors(giving: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each donor name, by where its money went."""
    rows = R.drop_null_keys(with_committee_party(giving, classes), ["name"])
    out = R.split_sums(rows, ["name"], F.col("cmte_party"), F.col("net_amt"), BUCKETS)
    d, r = F.col("D"), F.col("R")
    total = d + r + F.col("Mixed") + F.col("Unknown")
    return out.select(
        "name", "D", "R", "Mixed", "Unknown", total.alias("overall_total"), (d + r).alias("classified_total"),
        N.ratio(d, d + r).alias("pct_d"), N.ratio(r, d + r).alias("pct_r"), N.ratio(d + r, total).alias("pct_classified"),
        N.donor_party(d, r).alias("donor_party"),
    )


def company_by_donor_party(giving: DataFrame, donors: DataFrame) -> DataFrame:
    """Tech money and donors of each company by the donors' party; a donor of two companies counts in both."""
    keys = ["tech_canonical_name", "name"]
    rows = R.drop_null_keys(giving.where("is_tech_employer"), keys).groupBy(*keys).agg(N.total("net_amt").alias("amt"))
    rows = rows.join(donors.select("name", "donor_party"), "name", "left").withColumn("donor_party", F.coalesce("donor_party", F.lit("Unknown")))
    parties = list(BUCKETS)
    out = R.pivot_sums(rows, ["tech_canonical_name"], "donor_party", {"donor_amt": F.sum("amt"), "n_donors": F.count(F.lit(1))}, parties)
    out = out.select("tech_canonical_name", *[F.col(f"donor_amt_{p}").cast("double").alias(f"donor_amt_{p}") for p in parties], *[f"n_donors_{p}" for p in parties])
    d, r = F.col("donor_amt_D"), F.col("donor_amt_R")
    return out.select(
        "*", R.row_total([f"donor_amt_{p}" for p in parties]).alias("donor_amt_total"), sum((F.col(f"n_donors_{p}") for p in parties), F.lit(0)).alias("n_donors_total"),
        N.pct(d, d + r).alias("pct_dem_by_donor"),
    )
