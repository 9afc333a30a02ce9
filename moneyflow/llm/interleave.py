"""Shards by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and ranked there; a row's fractional rank is
(rank + 1/2) / rows of its source. Sorted by fractional rank, any stretch holds each source in its share of
the whole, so cutting the order into equal counts gives shards that each match the mixture.

Ranks within a source do not come from a window over the source, which may hold a third of all rows: the
rows are range-partitioned by (source, hash), and a row's rank is its place in its partition plus the rows
of its source in earlier partitions. The order of fractional ranks is numbered in the same way. Only counts
for each partition and source are gathered, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from moneyflow.llm.common import stash

SEED = 20240607


def _numbered(rows: DataFrame, by: list[str], group: list[str], tag: str) -> DataFrame:
    """Rows with ``place`` (from 0 within the group, in the order of ``by``) and ``total`` (rows of the group).

    ``by`` starts with the columns of ``group``.
    """
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    dealt = stash(dealt.withColumn("part", F.shiftright("at", 33)), tag)  # a second run could deal otherwise
    counts = dealt.groupBy("part", *group).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    inside = Window.partitionBy(*group)
    before = F.coalesce(F.sum("n").over(inside.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", *group, "first", before.alias("before"), F.sum("n").over(inside).alias("total"))
    joined = dealt.join(counts, ["part", *group])
    return joined.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


def interleave(
    docs: DataFrame,
    shards: int = 16,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row for each row: doc_id, stratum, size, text_crc32, shard and slot, then the columns in ``carry``.

    Size is the text's UTF-8 bytes (null: none) plus 1. Counts of shards differ by one at most, and in each
    shard every source has its share to within two rows. A null source is a source of its own. Rows that
    repeat an id are told apart by size and checksum; rows alike in all are interchangeable. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    stratum: Column = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        stratum.alias("stratum"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)],
    ).withColumn("mixed", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32"))
    tie = ["mixed", "doc_id", "size", "text_crc32"]
    ranked = _numbered(rows, ["stratum", *tie], ["stratum"], "strata")
    ranked = ranked.withColumn("fraction", (F.col("place") + 0.5) / F.col("total")).drop("place", "total").withColumn("whole", F.lit(0))
    placed = _numbered(ranked, ["whole", "fraction", "stratum", *tie], ["whole"], "fractions")
    shard = F.expr(f"place * {int(shards)} div total")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "stratum",
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")).alias("slot"),
        *[F.col(f"carried_{k}").alias(c) for k, c in enumerate(carry)],
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = SEED, columns: tuple[str, ...] = ("text",)) -> None:
    """Write one folder ``shard=k`` for each shard, its rows in slot order."""
    out = interleave(docs, shards, seed, carry=columns).select("doc_id", "shard", "slot", *columns)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
