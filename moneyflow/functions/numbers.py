"""Numeric, date and labelling expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from moneyflow import codes

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    """Text to a number; what cannot be read is 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def money_or_null(c: Column) -> Column:
    return c.try_cast("double")


def money_sum(c: Column) -> Column:
    """A sum that does not depend on the order of rows; 0.0 for a group without values."""
    return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY)).cast("double")


def total(c: Column | str) -> Column:
    """An exact sum of money, as decimal; 0 for a group without values. Sums of such sums stay exact."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def pct(a: Column, b: Column) -> Column:
    return ratio(a, b) * 100


def parse_mdy(c: Column) -> Column:
    """MMDDYYYY; a leading zero may be missing, what cannot be read is null."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]{7,8}$"), F.to_date(F.try_to_timestamp(F.lpad(t, 8, "0"), F.lit("MMddyyyy"))))


def week_end(d: Column) -> Column:
    """The Sunday that ends the date's week."""
    return F.date_add(F.to_date(F.date_trunc("WEEK", d)), 6)


def iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def party_of(affiliation: Column) -> Column:
    out = F.lit(None).cast("string")
    for filed, short in codes.PARTY_LABELS.items():
        out = F.when(affiliation == filed, short).otherwise(out)
    return out


def recipient_bucket(cmte_tp: Column) -> Column:
    out = F.lit("other")
    for bucket, types in codes.RECIPIENT_BUCKETS.items():
        out = F.when(cmte_tp.isin(*types), bucket).otherwise(out)
    return F.coalesce(out, F.lit("other"))


def lean(dem: Column, rep: Column, start: Column) -> Column:
    """``start``, unless D or R has the threshold's share of dem + rep; R is tested last and wins."""
    total = dem + rep
    return F.when(ratio(rep, total) >= codes.LEAN_THRESHOLD, "R").when(ratio(dem, total) >= codes.LEAN_THRESHOLD, "D").otherwise(start)


def behavioural_party(dem: Column, rep: Column) -> Column:
    """Mixed, D or R; never Unknown."""
    return lean(dem, rep, F.lit("Mixed"))


def donor_party(dem: Column, rep: Column) -> Column:
    """As behavioural, but Unknown where the classified total is not positive."""
    return F.when(dem + rep <= 0, "Unknown").otherwise(lean(dem, rep, F.lit("Mixed")))


def summary_party(dem: Column, rep: Column) -> Column:
    """Unknown, but Mixed where the classified total is positive, then D or R by percentages."""
    start = F.when(dem + rep > 0, "Mixed").otherwise("Unknown")
    limit = codes.LEAN_THRESHOLD * 100.0
    return F.when(pct(rep, dem + rep) >= limit, "R").when(pct(dem, dem + rep) >= limit, "D").otherwise(start)


def confidence(score: Column) -> Column:
    return F.when(score >= 95, "high").when(score >= 80, "medium").otherwise("low")


def period_order(c: Column) -> Column:
    out = F.lit(codes.PERIOD_LAST)
    for name, n in codes.PERIOD_ORDER.items():
        out = F.when(c == name, n).otherwise(out)
    return out


def clip(c: Column, low=None, high=None) -> Column:
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return out


def present(c: Column) -> Column:
    """Tri-state flag of a text: null stays null, any text but the empty one is true."""
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(c != "")


def array_length(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)).cast("long")


def bins(c: Column, edges: list[float]) -> Column:
    """Right-closed histogram bins: the number of the first edge that is not below the value."""
    out = F.lit(len(edges))
    for k in range(len(edges) - 1, -1, -1):
        out = F.when(c <= edges[k], k).otherwise(out)
    return F.when(c.isNotNull(), out)
