"""Employer candidates for tagging, the review queue, and the helpers around the curated list.

The dictionary of company patterns is a parameter: (slug, pattern) rows and (slug, exact term) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R


def employer_stats(rows: DataFrame) -> DataFrame:
    """One row for each employer string: everything after works on distinct strings, not on contributions."""
    per = rows.groupBy("employer").agg(
        F.count(F.lit(1)).alias("n_contributions"), N.money_sum(F.col("transaction_amt")).alias("total_usd"), F.count_distinct("name").alias("n_donors")
    )
    return per.where(F.col("employer").isNotNull())


def employer_candidates(rows: DataFrame, patterns: dict[str, list[str]], exact: dict[str, list[str]], noisy: list[str]) -> DataFrame:
    """Employers that a slug's patterns find (case-insensitive, on the raw string) or whose key is a slug's exact term.

    The patterns are columns of one projection over distinct employers: no join, no nested loop.
    """
    stats = employer_stats(rows)
    key = T.key(F.col("employer"))
    by_regex = F.array(*[F.when(T.matches_any(F.col("employer"), p), F.lit(s)) for s, p in sorted(patterns.items())] or [F.lit(None).cast("string")])
    by_term = F.array(*[F.when(key.isin(*t), F.lit(s)) for s, t in sorted(exact.items())] or [F.lit(None).cast("string")])
    found = stats.withColumn("by_regex", F.array_compact(by_regex)).withColumn("by_term", F.array_compact(by_term))
    slugs = F.array_sort(F.array_union("by_regex", "by_term"))
    kinds = F.array_compact(F.array(F.when(F.size("by_regex") > 0, "regex"), F.when(F.size("by_term") > 0, "exact")))
    return found.where((F.size("by_regex") > 0) | (F.size("by_term") > 0)).select(
        "employer", "n_contributions", "total_usd", "n_donors", F.array_join(slugs, "; ").alias("matched_searches"),
        F.array_join(kinds, "; ").alias("match_types"), T.matches_any(F.col("employer"), noisy).alias("flagged_noisy"),
    )


def review_queue(candidates: DataFrame, curated: DataFrame) -> DataFrame:
    """Candidates that nobody has decided on, with blank columns for the decision."""
    known = curated.select(T.key(F.col("employer")).alias("k")).distinct()
    rows = candidates.withColumn("k", T.key(F.col("employer"))).join(known, "k", "left_anti").drop("k")
    return rows.select("*", *[F.lit("").alias(c) for c in ("include", "canonical_name", "sector", "notes")])


def migrate_curated(old: DataFrame) -> DataFrame:
    """Decided rows of a hand-kept list: include as TRUE or FALSE, the canonical name filled from the searches."""
    include = F.when(T.truthy(F.col("include")), "TRUE").when(T.key(F.col("include")).isin("0", "FALSE", "F", "NO", "N"), "FALSE")
    name = F.coalesce(F.nullif(T.strip(F.col("canonical_name")), F.lit("")), F.when(include == "TRUE", F.col("matched_searches")), F.lit(""))
    return old.withColumn("include", include).where(F.col("include").isNotNull()).withColumn("canonical_name", name).orderBy("canonical_name", "employer")


def top_donors(contributions: DataFrame, k: int = 2000) -> DataFrame:
    """Largest donors with their name's employers and states, and whether one name is found in three states or more."""
    per = R.drop_null_keys(contributions, ["name"]).groupBy("name").agg(
        N.money_sum(F.col("net_amt")).alias("net_total"), F.count(F.lit(1)).alias("n_contributions"), R.concat_distinct(F.col("employer")).alias("employers"),
        R.concat_distinct(F.col("state")).alias("states"), F.count_distinct("state").alias("n_states"),
    )
    return per.withColumn("possible_collision", F.col("n_states") >= 3).orderBy(F.desc("net_total"), "name").limit(k)


def committees_by_sponsor(committees: DataFrame, patterns: list[str]) -> DataFrame:
    return committees.where(T.matches_any(F.col("connected_org_nm"), patterns)).select("cmte_id", "cmte_nm", "cmte_tp", "connected_org_nm")
