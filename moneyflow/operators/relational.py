"""Relational blocks. Spark keeps no row order, so every 'first' or 'last' takes an order that is total.

Dimension joins carry no broadcast hint: their sides' sizes are known at run time only, and adaptive
execution broadcasts a side it has measured under ``spark.sql.autoBroadcastJoinThreshold``, else it sorts
and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from moneyflow.operators.staging import in_ranges


def blank_safe(df: DataFrame) -> DataFrame:
    """Missing text is '', never null: comparisons such as memo != 'X' then keep the row."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in df.columns])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a missing key do not exist."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key: the first in ``order``, which must be total within a key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("long")).where(F.col(rank) <= k)


def best_of(df: DataFrame, keys: Sequence[str], pick: Sequence[str], largest: str, then: Sequence[str]) -> DataFrame:
    """The values of ``pick`` in the row with the largest value, ties by ``then`` ascending: an aggregate, no sort.

    Skewed keys are reduced before the shuffle.
    """
    order = F.struct((-F.col(largest)).alias("__a"), *[F.col(c) for c in then])
    rows = df.groupBy(*keys).agg(F.min_by(F.struct(*pick), order).alias("__best"))
    return rows.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in pick])


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Left join to a dimension; with ``order`` the dimension is first reduced to one row a key."""
    own = dim.select(key, *[c for c in columns if c != key]) if order is None else first_by(dim, [key], order).select(key, *columns)
    return fact.join(own, key, "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which missing keys equal each other; keys come from the left."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(r, on, how).drop(*[f"__r_{k}" for k in keys])


def split_sums(df: DataFrame, key: Sequence[str], bucket: Column, value: Column, buckets: dict[str, str]) -> DataFrame:
    """Sum of a value by fixed buckets, one column each ({bucket: column}); absent buckets are 0.0."""
    from moneyflow.functions.numbers import money_sum

    return df.groupBy(*key).agg(*[money_sum(F.when(bucket == b, value)).alias(name) for b, name in buckets.items()])


def pivot_sums(df: DataFrame, key: Sequence[str], bucket: str, aggs: dict[str, Column], buckets: Sequence[str]) -> DataFrame:
    """Several aggregates by fixed buckets; columns are named aggregate_bucket and filled with 0."""
    rows = df.groupBy(*key).pivot(bucket, list(buckets)).agg(*[a.alias(n) for n, a in aggs.items()])
    out = []
    for n in aggs:
        for b in buckets:
            c = f"{b}_{n}" if len(aggs) > 1 else b
            out.append(F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"{n}_{b}"))
    return rows.select(*key, *out)


def row_total(columns: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total


def concat_distinct(c: Column, sep: str = "; ") -> Column:
    """Aggregate: sorted distinct texts; missing ones do not count, blank ones do."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def concat_sets(c: Column, sep: str = "; ") -> Column:
    """Aggregate over arrays: sorted distinct members, blank ones too."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), sep)


def concat_distinct_parts(c: Column, sep: str = "; ") -> Column:
    """Aggregate over arrays: sorted distinct non-blank members."""
    parts = F.array_distinct(F.flatten(F.collect_list(c)))
    return F.array_join(F.array_sort(F.filter(parts, lambda x: x.isNotNull() & (x != ""))), sep)


def concat_in_order(c: Column, order: Column, sep: str = " | ") -> Column:
    """Aggregate: distinct texts by first appearance in ``order``."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("o"), c.alias("x"))))
    return F.array_join(F.array_distinct(F.transform(rows, lambda r: r["x"])), sep)


def running_total(c: str, order: Sequence[Column], keys: Sequence[str] = ()) -> Column:
    """Cumulative sum; meant for aggregated series, whose length does not grow with the rows."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return F.sum(F.col(c).cast("decimal(28,2)")).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).cast("double")


def grouped(df: DataFrame, keys: Sequence[str], sums: dict[str, Column], distinct: dict[str, str]) -> DataFrame:
    """Aggregates that add up, and numbers of distinct values ({name: column}), by keys; missing keys are groups, too.

    ``sums`` are sums or counts of columns. Every number comes from an aggregate of its own over (keys, value), the
    first of which carries the sums; no row is multiplied, and a hot key is spread over its values.
    """
    out = None
    for k, (name, c) in enumerate(distinct.items()):
        inner = df.groupBy(*keys, F.col(c).alias("__v")).agg(*[a.alias(n) for n, a in sums.items()] if k == 0 else [F.lit(1).alias("__one")])
        part = inner.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums] if k == 0 else [], F.count("__v").alias(name))
        if out is None:
            out = part
        else:
            out = null_safe_join(out, part, keys, "inner") if keys else out.join(part, F.lit(True))  # one row each
    return out


def weekly(df: DataFrame, week: str, keys: Sequence[str], metrics: dict[str, Column], cumulative: tuple[str, str] | None = None, distinct: dict[str, str] | None = None) -> DataFrame:
    """Metrics by week (and keys); weeks without rows stay absent. ``cumulative``: (metric, name of its running total)."""
    out = grouped(df, [*keys, week], metrics, distinct) if distinct else df.groupBy(*keys, week).agg(*[m.alias(n) for n, m in metrics.items()])
    if cumulative:
        out = out.withColumn(cumulative[1], running_total(cumulative[0], [F.col(week).asc()], keys))
    return out


def upsert_dimension(df: DataFrame, key: str, order: Column, fields: Sequence[str]) -> DataFrame:
    """One row a key: for each field the last value in ``order`` that is neither missing nor blank."""
    text = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull() & (F.col(c) != "") if c in text else F.col(c).isNotNull(), order))
    return drop_null_keys(df, [key]).groupBy(key).agg(*[last(c).alias(c) for c in fields if c != key])


def first_seen(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows with a key once, the first in ``order``; rows without a key all stay."""
    return first_by(df.where(F.col(key).isNotNull()), [key], order).unionByName(df.where(F.col(key).isNull()))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that one side lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def key_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of distinct keys on both sides, only on the left, only on the right: one pass, one shuffle."""
    sides = a.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(b.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = sides.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return seen.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("n_left_only"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("n_right_only"),
    )


def flagged_or_all(df: DataFrame, flag: Column, keys: Sequence[str]) -> DataFrame:
    """Flagged rows of each group, or all of its rows if none is flagged."""
    some = df.groupBy(*keys).agg(F.bool_or(flag).alias("__some"))
    return null_safe_join(df, some, keys, "inner").where(flag | ~F.col("__some")).drop("__some")


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def five_numbers(df: DataFrame, c: str) -> DataFrame:
    """Count, mean, extremes and exact quartiles (interpolated).

    Values are counted, dealt to ranges, and only the ranges that hold a wanted rank are put in order: no task gets
    all distinct values.
    """
    counted = in_ranges(df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n")), [F.col(c)], "values")
    per = counted.groupBy("__p").agg(F.sum("__n").alias("__m"))  # one row a range
    per = per.withColumn("__before", F.sum("__m").over(Window.orderBy("__p")) - F.col("__m"))
    whole = counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), (F.sum(F.col(c).cast("decimal(18,2)") * F.col("__n")) / F.sum("__n")).cast("decimal(22,6)").cast("double").alias("mean"), F.min(c).alias("low"), F.max(c).alias("high")
    )
    quarters = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    at = lambda q: (F.col("n") - 1) * q
    near = per.join(whole, F.lit(True)).where(F.exists(F.array(*[f(at(q)) for q in quarters.values() for f in (F.floor, F.ceil)]), lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__m"))))
    rows = counted.join(near.select("__p", "__before", "n"), "__p")
    rows = rows.withColumn("__to", F.col("__before") + F.sum("__n").over(Window.partitionBy("__p").orderBy(c)))
    found = rows.agg(*[F.min(F.when(F.col("__to") > f(at(q)), F.col(c))).alias(f"{name}_{k}") for name, q in quarters.items() for k, f in enumerate((F.floor, F.ceil))])
    part = lambda name, q: (F.col(f"{name}_0") + (F.col(f"{name}_1") - F.col(f"{name}_0")) * (at(q) - F.floor(at(q)))).alias(name)
    return whole.join(found, F.lit(True)).select("n", "mean", "low", *[part(*x) for x in quarters.items()], "high")  # one row each


def is_sorted(df: DataFrame, c: str, order: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    """For each group, whether a column never falls (or never rises) in the given order.

    Rows are compared range by range, then the ends of a group's ranges: a hot group is many ranges.
    """
    rows = in_ranges(df, [*[F.col(k) for k in keys], *order], "sorted")
    by = Window.partitionBy(*keys, "__p").orderBy(*order)
    rows = rows.withColumn("__b", F.lag(c).over(by)).withColumn("__i", F.row_number().over(by))
    per = rows.groupBy(*keys, "__p").agg(
        F.bool_and(F.col(c) >= F.col("__b")).alias("up"), F.bool_and(F.col(c) <= F.col("__b")).alias("down"),
        F.min_by(F.struct(F.col(c).alias("v")), "__i").alias("first"), F.max_by(F.struct(F.col(c).alias("v")), "__i").alias("last"),
    )
    before, first = F.lag("last").over(Window.partitionBy(*keys).orderBy("__p")), F.col("first.v")
    per = per.withColumn("__b", before["v"])
    yes = F.lit(True)
    return per.groupBy(*keys).agg(
        F.bool_and(F.coalesce("up", yes) & F.coalesce(first >= F.col("__b"), yes)).alias("ascending"),
        F.bool_and(F.coalesce("down", yes) & F.coalesce(first <= F.col("__b"), yes)).alias("descending"),
    )
