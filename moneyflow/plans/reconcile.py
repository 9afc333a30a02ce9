"""Year reconciliation: top-up of tail pages, repair of tied page boundaries, the final snapshot and its check.

The loops run on the driver because they wait for a remote service; what they decide on comes from frames.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from moneyflow.plans.lobbying import completeness, snapshot, tied_boundaries, unseen
from moneyflow.sources.lobbying import pages
from moneyflow.sources.rest import PagedClient, pages_needed
from moneyflow.sources.store import HadoopStore, LocalStore
from moneyflow.sources.sinks import write_sorted_lines

REPAIRS = 8


def top_up(client: PagedClient, path: str, folder: str, known_rows: int, live_rows: int, page_size: int, store: LocalStore | None = None, **params) -> int:
    """Fetch the pages from the last one landed to the live end again; returns how many were landed."""
    store = store or LocalStore()
    first, last = max(1, pages_needed(known_rows, page_size)), pages_needed(live_rows, page_size)
    for n in range(first, last + 1):
        store.write_json(f"{folder}/page_{n:05d}.json", client.get(path, page=n, page_size=page_size, **params))
    return max(0, last - first + 1)


def repair_boundaries(spark: SparkSession, client: PagedClient, path: str, folder: str, live_rows: int, **params) -> int:
    """Fetch both sides of tied boundaries until ids are complete or the tries are used up; returns tries made."""
    store = HadoopStore(spark)
    for attempt in range(REPAIRS):
        if completeness(pages(spark, folder)).first()["n_ids"] >= live_rows:
            return attempt
        tied = [r["_page"] for r in tied_boundaries(pages(spark, folder)).select("_page").collect()]  # a number a page
        extra = [client.get(path, page=n, **params)["results"] for p in tied for n in (p - 1, p)]
        known = store.read(f"{folder}/supplemental.jsonl") if store.exists(f"{folder}/supplemental.jsonl") else ""
        store.write(f"{folder}/supplemental.jsonl", known + "".join(json.dumps(r) + "\n" for rows in extra for r in rows))
        merged = supplemental(spark, folder)
        if merged is None or unseen(merged, pages(spark, folder)).count() + completeness(pages(spark, folder)).first()["n_ids"] >= live_rows:
            return attempt + 1
    return REPAIRS


def supplemental(spark: SparkSession, folder: str) -> DataFrame | None:
    """Repair rows, numbered in file order; none if there are none."""
    store, path = HadoopStore(spark), f"{folder}/supplemental.jsonl"
    if not store.exists(path) or not store.read(path).strip():
        return None
    rows = spark.read.json(path)
    return rows.withColumn("_page", F.lit(0).cast("long")).withColumn("_pos", F.monotonically_increasing_id())


def build_snapshot(spark: SparkSession, folder: str, out: str, live_rows: int, key: str = "filing_uuid") -> dict:
    """Write the deduplicated rows in id order and say whether they are complete."""
    landed = pages(spark, folder)
    rows = snapshot(landed, supplemental(spark, folder), key)
    write_sorted_lines(rows.drop("_page", "_pos"), out, key)
    counts = completeness(landed, key).first().asDict()
    n = spark.read.json(out).count()
    return counts | {"n_snapshot": n, "live_count": live_rows, "complete": n == live_rows}


def live_count(client: PagedClient, path: str, **params) -> int:
    return client.get(path, page=1, page_size=1, **params)["count"]


def reconcile_year(spark: SparkSession, client: PagedClient, year: int, folder: str, page_size: int = 100) -> dict:
    """Snapshots of both endpoints of a year: repaired at tied page boundaries, then topped up at the tail, until complete."""
    out = {}
    for end in ("filings", "contributions"):
        where, path, params = f"{folder}/{year}/{end}", f"{end}/", {"filing_year": year, "ordering": "dt_posted"}
        snap = lambda where=where, path=path, params=params: build_snapshot(spark, where, f"{where}/snapshot.jsonl", live_count(client, path, **params))
        got = snap()
        if end == "filings" and not got["complete"]:
            got = got | {"repairs": repair_boundaries(spark, client, path, where, got["live_count"], page_size=page_size, **params)} | snap()
        if not got["complete"]:
            got = got | {"topped_up": top_up(client, path, where, got["n_rows"], got["live_count"], page_size, HadoopStore(spark), **params)} | snap()
        out[end] = got
    return {"year": year, "snapshots": out, "complete": all(g["complete"] for g in out.values())}


def verify_year(spark: SparkSession, client: PagedClient, year: int, folder: str) -> dict:
    """What is landed against its manifests and against the live service."""
    store, rows = HadoopStore(spark), []
    for end in ("filings", "contributions"):
        where = f"{folder}/{year}/{end}"
        manifest, got = store.read_json(f"{where}/manifest.json"), completeness(pages(spark, where)).first()
        live = live_count(client, f"{end}/", filing_year=year)
        same = manifest["complete"] and got["n_rows"] == manifest["row_count"] == manifest["api_reported_count"]
        rows.append(
            {"endpoint": end, "counted_rows": got["n_rows"], "unique_ids": got["n_ids"], "duplicate_ids": got["n_duplicated"], "live_api_count": live, "complete": same,
             "complete_as_of_verification": got["n_duplicated"] == 0 and got["n_ids"] == got["n_rows"] == live}
        )
    out = {"year": year, "endpoints": rows, "complete": all(r["complete"] for r in rows), "complete_as_of_verification": all(r["complete_as_of_verification"] for r in rows)}
    store.write_json(f"{folder}/{year}/verification.json", out)
    return out
