"""Paged JSON snapshots of lobbying disclosures, and flat CSV tables with declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from moneyflow.plans.lobbying import snapshot


def pages(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """Rows of ``page_*.json`` with ``_page`` (the number in the file's name) and ``_pos`` (from 0)."""
    reader = spark.read.option("multiLine", True)
    raw = (reader.schema(schema) if schema else reader).json(f"{folder}/page_*.json")
    page = F.regexp_extract(F.col("_metadata.file_name"), r"page_0*([0-9]+)\.json", 1).cast("long")
    return raw.select(page.alias("_page"), F.posexplode("results").alias("_pos", "r")).select("_page", F.col("_pos").cast("long"), "r.*")


def filings_or_pages(spark: SparkSession, folder: str, key: str = "filing_uuid") -> DataFrame:
    """The snapshot where there is one, else the pages with repeated ids removed; rows without an id stay on pages."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/snapshot.jsonl")
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        rows = spark.read.json(f"{folder}/snapshot.jsonl")
        return rows.withColumn("_row_ord", F.monotonically_increasing_id())
    rows = pages(spark, folder)
    out = snapshot(rows, key=key).unionByName(rows.where(F.col(key).isNull()))
    return out.withColumn("_row_ord", F.col("_page") * 1_000_000 + F.col("_pos")).drop("_page", "_pos")


def flat_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A header CSV with declared columns, all text; a missing or empty file has no rows."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
