"""Sinks: CSV, JSON records, one document, one file an entity, ordered snapshots, manifests.

Parquet is the primary form; these serve published exports, which are aggregates.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampNTZType, TimestampType


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; white space at the ends of texts stays."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**keep).option("header", True).option("escape", '"').csv(path)


def with_columns(df: DataFrame, declared: list[str]) -> DataFrame:
    """Declared columns first (null where absent), then what else was observed."""
    own = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in declared]
    return df.select(*own, *[c for c in df.columns if c not in declared])


def json_safe(df: DataFrame) -> DataFrame:
    """NaN as null, doubles to ten digits, dates as ISO text."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = F.when(F.isnan(c), None).otherwise(F.round(c, 10))
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        out.append(c.alias(f.name))
    return df.select(*out)


def records(df: DataFrame) -> DataFrame:
    """One JSON text a row."""
    safe = json_safe(df)
    return safe.select(F.to_json(F.struct(*safe.columns), {"ignoreNullFields": "false"}).alias("json"))


def _lines(rows: Iterable[Row]) -> list:
    return [json.loads(r["json"]) for r in rows]


def write_document(parts: dict[str, DataFrame | dict], path: str) -> None:
    """Small aggregate frames as one JSON document."""
    doc = {k: _lines(records(v).collect()) if isinstance(v, DataFrame) else v for k, v in parts.items()}
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(doc, indent=2))


def write_entities(payloads: DataFrame, path: str, name: str = "slug") -> None:
    """One folder with a JSON file for each entity, written by the executors."""
    rows = payloads.withColumn("json", F.to_json(F.struct(*payloads.columns))).select(name, "json")
    rows.repartition(name).write.mode("overwrite").partitionBy(name).text(path)


def write_sorted_lines(df: DataFrame, path: str, key: str) -> None:
    """JSON lines in the order of the key, range-partitioned: part files follow each other, no single task holds all."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").json(path)


def write_manifest(tables: dict[str, int], path: str, **more) -> None:
    Path(path).write_text(json.dumps({"tables": {k: {"row_count": v} for k, v in sorted(tables.items())}} | more, indent=2))
