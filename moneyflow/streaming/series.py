"""Weekly totals and snapshot dedup as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from moneyflow.functions.numbers import money_sum


def weekly_window(ts: Column) -> Column:
    """Weeks from Monday; the epoch was a Thursday, hence the offset of four days."""
    return F.window(ts, "7 days", "7 days", "4 days")


def weekly_stream(events: DataFrame, ts: str, value: str, late: str = "14 days") -> DataFrame:
    """Sums and counts by week from a stream; state of weeks older than the watermark is dropped."""
    rows = events.withWatermark(ts, late).groupBy(weekly_window(F.col(ts)).alias("w")).agg(money_sum(F.col(value)).alias("net_total"), F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.date_sub(F.to_date("w.end"), 1).alias("week_end"), "net_total", "n_rows")


def first_seen_stream(rows: DataFrame, key: str, ts: str, late: str = "30 days") -> DataFrame:
    """Rows with an id once within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append"):
    """Process what is there and stop: the incremental form of a batch run."""
    return df.writeStream.outputMode(mode).format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
