"""Read queries behind the published pages, and a plain HTML table."""

from __future__ import annotations

import html
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from moneyflow import codes
from moneyflow.functions import text as T
from moneyflow.operators import relational as R
from moneyflow.sources.store import HadoopStore

PAGE_ROWS = {"P": 6, "S": 12, "H": 18}


def leading(df: DataFrame, by: str, name: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(name)).limit(n)


def candidate_order() -> list:
    return [F.desc("tech_itemized_receipts"), F.desc("ie_support_total"), F.desc("linked_committee_count"), F.asc_nulls_last("cand_name"), F.asc("cand_id")]


def candidates_for_office(races: DataFrame, office: str) -> DataFrame:
    """Display candidates of an office, or all of them if none is for display, on the page's order."""
    rows = R.flagged_or_all(races.where(F.col("cand_office") == office), F.col("is_display_candidate"), ["cand_office"])
    return rows.orderBy(*candidate_order())


def page_candidates(races: DataFrame, office: str) -> DataFrame:
    return candidates_for_office(races, office).limit(PAGE_ROWS[office])


def tiles(spark: SparkSession) -> DataFrame:
    """(state_code, tile_x, tile_y): where the tile map has each state."""
    return spark.createDataFrame([(k, x, y) for k, (x, y) in codes.STATE_TILES.items()], "state_code string, tile_x int, tile_y int")


def mapped(states: DataFrame, places: DataFrame) -> DataFrame:
    """States with their name and place on the tile map; those without a place are listed below it."""
    out = states.join(places, "state_code", "left").withColumn("is_mapped", F.col("tile_x").isNotNull())
    return out.withColumn("state_name", T.state_name(F.col("state_code")))


def chart_points(series: DataFrame, value: str, width: float, height: float) -> DataFrame:
    """A series with the place of each point on a chart of the given size: weeks in equal steps, values from the least (or 0) up."""
    ends = series.agg(F.min("week_end").alias("__from"), F.max("week_end").alias("__to"), F.least(F.min(value), F.lit(0.0)).alias("__low"), F.greatest(F.max(value), F.lit(0.0)).alias("__high"))
    span, days = F.nullif(F.col("__high") - F.col("__low"), F.lit(0.0)), F.nullif(F.datediff("__to", "__from"), F.lit(0))
    out = series.join(ends, F.lit(True))  # one row of ends
    x = F.coalesce(F.datediff("week_end", "__from") / days * width, F.lit(0.0))
    y = F.coalesce(height - (F.col(value) - F.col("__low")) / span * height, F.lit(float(height)))
    return out.select(*series.columns, x.alias("x"), y.alias("y"))


def donor_shares(donors: DataFrame) -> DataFrame:
    return donors.withColumn("pct_r", F.coalesce("pct_r", 1 - F.col("pct_d")))


def political_bodies(export: DataFrame) -> DataFrame:
    return export.where("is_featured AND NOT is_candidate_committee")


def nearest_section(pages: set[str], wanted: str) -> str:
    """The page itself or its nearest ancestor that exists, '' at the root."""
    while wanted and wanted not in pages:
        wanted = wanted.rpartition("/")[0]
    return wanted


def html_table(rows: list[dict], columns: dict[str, str]) -> str:
    head = "".join(f"<th>{html.escape(t)}</th>" for t in columns.values())
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if r.get(c) is None else str(r[c]))}</td>" for c in columns) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"


def write_page(path: str, title: str, body: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body>{body}</body></html>")


BUNDLE = {"metadata": "site_metadata.json", "homepage": "homepage_summary.json", "companies": "companies.json", "committees": "committees.json", "donors": "major_donors.json"}
BUNDLE_TABLES = {
    "candidate_race": "candidate_race_summary.csv", "candidate_state": "candidate_state_summary.csv", "candidate_house_district": "candidate_house_district_summary.csv",
    "candidate_senate": "candidate_senate_summary.csv",
}


def load_bundle(spark: SparkSession, root: str, cycle: int) -> dict:
    """A cycle's published files: documents as they are, tables as frames of text. A missing file raises."""
    store, where = HadoopStore(spark), f"{root}/{cycle}"
    out = {"cycle": cycle} | {k: store.read_json(f"{where}/{f}") for k, f in BUNDLE.items()}
    return out | {k: spark.read.option("header", True).option("escape", '"').csv(f"{where}/{f}") for k, f in BUNDLE_TABLES.items()}


#: What the published columns mean.
GLOSSARY = {
    "net_total": "Contributions less refunds.",
    "gross_positive": "Sum of amounts above zero; positive refund rows are part of it.",
    "tech_receipts": "Itemized receipts of a committee from donors with a tagged employer.",
    "tech_pct": "Share of tagged donors in a committee's itemized receipts.",
    "pct_dem": "Share of committees with a Democratic lean in what went to committees with a D or R lean.",
    "pct_dem_by_donor": "The same share, by the lean of the donors in place of the committees.",
    "pct_classified_recipients": "Share of the net total that went to committees with a D or R lean.",
    "party_label": "D or R from 70 percent on, Mixed below, Unknown without classified money.",
    "ie_support_total": "Independent expenditures for a candidate.",
    "ie_oppose_total": "Independent expenditures against a candidate.",
}


def glossary_page() -> str:
    return html_table([{"term": k, "meaning": v} for k, v in GLOSSARY.items()], {"term": "Column", "meaning": "Meaning"})
