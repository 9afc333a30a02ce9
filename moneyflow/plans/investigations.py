"""Query shapes of one-off investigations, kept as parametrised validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moneyflow import codes
from moneyflow.functions import numbers as N, text as T
from moneyflow.operators import relational as R


def by_type_and_memo(rows: DataFrame, where=None) -> DataFrame:
    rows = rows if where is None else rows.where(where)
    return rows.groupBy("transaction_tp", "memo_cd").agg(F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("transaction_amt")).alias("total"))


def memo_share(rows: DataFrame) -> DataFrame:
    memo = F.col("memo_cd") == "X"
    out = rows.groupBy("transaction_tp").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(memo).alias("n_memo"), N.money_sum(F.col("transaction_amt")).alias("total"),
        N.money_sum(F.when(memo, F.col("transaction_amt"))).alias("memo_total"),
    )
    return out.withColumn("pct_memo", N.pct(F.col("n_memo"), F.col("n_rows")))


def memo_only_types(rows: DataFrame) -> DataFrame:
    return memo_share(rows).where("n_memo = n_rows").select("transaction_tp", "n_rows")


def uninvestigated_types(rows: DataFrame, known: list[str]) -> DataFrame:
    return R.value_counts(rows.where(~F.col("transaction_tp").isin(*known)), "transaction_tp")


def donor_net(contributions: DataFrame, donors: dict[str, str], outside_types: list[str] = codes.RECIPIENT_BUCKETS["outside_spending"]) -> DataFrame:
    """Gross, refunds and net for donors given as {label: name pattern}, with the share to outside groups."""
    rows = contributions.withColumn("label", F.array_compact(F.array(*[F.when(T.matches_any(F.col("name"), [p]), F.lit(k)) for k, p in sorted(donors.items())])))
    rows = rows.withColumn("label", F.explode("label"))
    amt, outside = F.col("transaction_amt"), F.col("cmte_tp").isin(*outside_types)
    return rows.groupBy("label").agg(
        N.money_sum(F.when(~F.col("is_refund"), amt)).alias("gross"), N.money_sum(F.when(F.col("is_refund"), amt)).alias("refunds"),
        N.money_sum(F.col("net_amt")).alias("net"), N.money_sum(F.when(outside, F.col("net_amt"))).alias("outside_net"),
    )


def messy_donors(rows: DataFrame, least: float = 100_000, share: float = 10.0, k: int = 50) -> DataFrame:
    """Donors with more than ``least`` in and more than ``share`` percent of it going back."""
    amt = F.col("transaction_amt")
    out = rows.groupBy("name").agg(
        N.money_sum(N.clip(amt, low=0.0)).alias("positive"), N.money_sum(N.clip(amt, high=0.0)).alias("negative"), F.count_if(amt < 0).alias("n_negative")
    )
    out = out.withColumn("negative_pct", N.pct(F.abs("negative"), F.col("positive")))
    return out.where((F.col("positive") > least) & (F.col("negative_pct") > share)).orderBy(F.asc("negative"), "name").limit(k)


def sign_study(rows: DataFrame, edges: list[float]) -> DataFrame:
    """Rows and sums by code and histogram bin."""
    out = rows.withColumn("bin", N.bins(F.col("transaction_amt"), edges).cast("long"))
    return out.groupBy("transaction_tp", "bin").agg(F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("transaction_amt")).alias("total"))


def negatives(rows: DataFrame) -> DataFrame:
    amt = F.col("transaction_amt")
    return rows.groupBy("transaction_tp").agg(
        F.count_if(amt < 0).alias("n_negative"), F.count_if(amt > 0).alias("n_positive"), F.count_if(amt == 0).alias("n_zero"),
        F.min(amt).alias("low"), F.max(amt).alias("high"), F.avg(amt.cast(N.MONEY)).cast("double").alias("mean"),
    )


def refund_origins(refunds: DataFrame, contributions: DataFrame, k: int = 10) -> DataFrame:
    """The k largest refunds with what the donor had given to that committee."""
    top = refunds.orderBy(F.desc("transaction_amt"), "sub_id").limit(k)
    given = contributions.where(~F.col("is_refund")).groupBy("name", "cmte_id").agg(N.money_sum(F.col("transaction_amt")).alias("given"), F.count(F.lit(1)).alias("n_given"))
    return top.select("sub_id", "name", "cmte_id", "transaction_amt").join(given, ["name", "cmte_id"], "left")


def counterparties(rows: DataFrame, committees: DataFrame) -> DataFrame:
    """Money between committees, by the types of both sides."""
    a = committees.select("cmte_id", F.col("cmte_tp").alias("filer_tp"))
    b = committees.select(F.col("cmte_id").alias("other_id"), F.col("cmte_tp").alias("other_tp"))
    return rows.join(a, "cmte_id", "left").join(b, "other_id", "left").groupBy("transaction_tp", "filer_tp", "other_tp").agg(
        F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("transaction_amt")).alias("total")
    )


def prefixed_types(rows: DataFrame, prefixes: list[str]) -> DataFrame:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col("transaction_tp").startswith(p)
    return by_type_and_memo(rows, cond)


def named_rows(frames: dict[str, DataFrame], pattern: str) -> DataFrame:
    """All rows of a name in several sources, tagged with the source."""
    return R.union_all(*[f.where(T.matches_any(F.col("name"), [pattern])).withColumn("source_file", F.lit(n)) for n, f in sorted(frames.items())])


def inflow_paths(frames: dict[str, DataFrame], committee: str, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """How money reaches one committee over several files: by source, code and memo, and the top givers."""
    cols = ["cmte_id", "transaction_tp", "memo_cd", "name", "transaction_amt"]
    rows = R.union_all(*[f.select(*cols).where(F.col("cmte_id") == committee).withColumn("source_file", F.lit(n)) for n, f in sorted(frames.items())])
    paths = rows.groupBy("source_file", "transaction_tp", "memo_cd").agg(F.count(F.lit(1)).alias("n_rows"), N.money_sum(F.col("transaction_amt")).alias("total"))
    givers = rows.groupBy("source_file", "name").agg(N.money_sum(F.col("transaction_amt")).alias("total")).orderBy(F.desc("total"), "name").limit(k)
    return paths, givers


def alias_summary(rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Contributions of employers on an alias list, by alias and state."""
    own = aliases.select(T.key(F.col("employer")).alias("k"), "canonical_name").dropDuplicates(["k"])
    return rows.join(own, T.key(F.col("employer")) == F.col("k"), "inner").groupBy("canonical_name", "state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("name").alias("n_donors"), N.money_sum(F.col("transaction_amt")).alias("total")
    )


def sample_summary(filed: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The commonest values of a sampled API response: filing types, clients, issue codes."""
    issues = filed.select(F.explode("lobbying_activities").alias("a")).select(F.col("a.general_issue_code").alias("issue"))
    top = lambda df, c: R.value_counts(df, c).orderBy(F.desc("n"), c).limit(k)
    return {"types": top(filed, "filing_type"), "clients": top(filed.select(F.col("client.name").alias("client")), "client"), "issues": top(issues, "issue")}
