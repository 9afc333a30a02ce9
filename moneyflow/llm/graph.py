"""Connected components of a link table, as rounds of large-star and small-star on DataFrames.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Each round is two joins and
aggregations; its result is written to the shared folder, so lineage stays short and nothing reaches the
driver but a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from moneyflow.llm.common import discard, shuffles_removed, stash


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (a long, b long) to (node, root): root is the least node of the component.

    Nodes without links do not appear. Loops and repeated links are harmless; an empty table gives none.
    """

    def mark(e: DataFrame) -> tuple:
        with shuffles_removed(e.sparkSession):
            r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    edges = stash(links.select("a", "b").where("a != b").distinct(), "links")
    before = mark(edges)
    while before[0]:
        old, edges = edges, stash(_small_star(_large_star(edges)), "links")
        discard(old)
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
