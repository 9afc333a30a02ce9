"""From bulk rows to a donor's contributions, a committee's spending, and tagged employers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from moneyflow import codes
from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R

COMMITTEE_COLUMNS = ["cmte_nm", "cmte_tp", "cmte_dsgn", "cmte_pty_affiliation", "connected_org_nm", "cand_id"]


@dataclass(frozen=True)
class Cycle:
    """The frames of one election cycle, lazily built."""

    cycle: int
    contributions: DataFrame
    spending: DataFrame
    committees: DataFrame


def included(itcont: DataFrame) -> DataFrame:
    """Kept codes, without memo rows of codes whose memos count twice; refunds turn the sign of ``net_amt``."""
    kept = itcont.where(F.col("transaction_tp").isin(*codes.CONTRIBUTION_CODES, *codes.REFUND_CODES))
    kept = kept.where((F.col("memo_cd") != "X") | ~F.col("transaction_tp").isin(*codes.MEMO_EXCLUDED_CODES))
    refund = F.col("transaction_tp").isin(*codes.REFUND_CODES)
    return kept.withColumn("is_refund", refund).withColumn("net_amt", F.when(refund, -F.col("transaction_amt")).otherwise(F.col("transaction_amt")))


def donor_contributions(itcont: DataFrame, committees: DataFrame) -> DataFrame:
    """Included rows with their committee's columns."""
    kept = included(itcont)
    kept = kept.drop(*[c for c in COMMITTEE_COLUMNS if c in kept.columns])
    return R.lookup_join(kept, committees, "cmte_id", COMMITTEE_COLUMNS)


def committee_spending(itoth: DataFrame, committees: DataFrame, spending_codes: Sequence[str] = tuple(codes.SPENDING_CODES)) -> DataFrame:
    """Spending rows of the given codes without memos, with the filer's committee columns as ``filer_*``."""
    rows = itoth.where(F.col("transaction_tp").isin(*spending_codes) & (F.col("memo_cd") != "X"))
    filer = committees.select("cmte_id", *[F.col(c).alias(f"filer_{c}") for c in COMMITTEE_COLUMNS])
    return rows.withColumn("net_amt", F.col("transaction_amt")).join(filer, "cmte_id", "left")


def tag_employers(contributions: DataFrame, curated: DataFrame) -> DataFrame:
    """Canonical company and sector by the employer's key; the first curated row of a key counts.

    ``curated`` has employer, canonical_name, sector and ``_row_ord``. A match without a canonical name is
    no tech employer.
    """
    lookup = curated.select(T.key(F.col("employer")).alias("employer_key"), "canonical_name", "sector", "_row_ord")
    lookup = R.first_by(lookup, ["employer_key"], [F.col("_row_ord").asc()])
    lookup = lookup.select("employer_key", F.col("canonical_name").alias("tech_canonical_name"), F.col("sector").alias("tech_sector"))
    out = contributions.withColumn("employer_key", T.key(F.col("employer"))).join(lookup, "employer_key", "left")
    named = F.col("tech_canonical_name").isNotNull() & (F.col("tech_canonical_name") != "")
    return out.drop("employer_key").withColumn("is_tech_employer", named)


def dated(tagged: DataFrame, require_date: bool = True) -> DataFrame:
    """``contribution_date`` and ``week_end``; undated rows go unless ``require_date`` is false."""
    out = tagged.withColumn("contribution_date", N.parse_mdy(F.col("transaction_dt")))
    out = out.withColumn("week_end", N.week_end(F.col("contribution_date")))
    return out.where(F.col("contribution_date").isNotNull()) if require_date else out


GIVING_KEYS = ["name", "cmte_id", "employer", "occupation", "state", "contribution_date"]


def giving(itcont: DataFrame, committees: DataFrame, curated: DataFrame) -> DataFrame:
    """Donor contributions added up by who gave what to whom on which day, then tagged: what the summaries read.

    Facts are aggregated before any join, with ``net_amt`` and ``gross_amt`` as exact sums and ``n_rows``; positive
    refund rows are part of the gross amount, as published figures have it.
    """
    rows = included(itcont).withColumn("contribution_date", N.parse_mdy(F.col("transaction_dt")))
    gross = F.when(F.col("transaction_amt") > 0, F.col("transaction_amt")).otherwise(0.0)
    per = rows.groupBy(*GIVING_KEYS).agg(F.sum(F.col("net_amt").cast(N.MONEY)).alias("net_amt"), F.sum(gross.cast(N.MONEY)).alias("gross_amt"), F.count(F.lit(1)).alias("n_rows"))
    out = tag_employers(R.lookup_join(per, committees, "cmte_id", COMMITTEE_COLUMNS), curated)
    return out.withColumn("week_end", N.week_end(F.col("contribution_date")))


def load_cycle(cycle: int, itcont: DataFrame, itoth: DataFrame, committees: DataFrame) -> Cycle:
    return Cycle(cycle, donor_contributions(itcont, committees), committee_spending(itoth, committees), committees)
