"""Event-driven metrics windows and deduplication on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.streaming.runner import BATCH
from holdfast.vocabulary import ALERT_COUNTERS, HOLD

# Fixed value: how late a row may come and still change its window.
LATENESS = "2 hours"
COUNTED = ["payments", "shipped", "ingest_count", "event_errors", *ALERT_COUNTERS.values()]


def timed(df: DataFrame, time: str, lateness: str = LATENESS) -> DataFrame:
    """Watermarked stream; the watermark needs a TIMESTAMP."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)


def stream_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The windows' event counts, kept up to date as rows arrive (update mode).

    Holds, percentiles and snapshot numbers need whole tables; recompute those windows
    with the batch rollup.
    """
    held = f"current_status = '{HOLD}'"
    alerts = [f"count_if({held} AND coalesce(ops_status, 'OPEN') = '{s}')" for s in ALERT_COUNTERS]
    counts = ["count_if(current_status = 'PAID')", "count_if(current_status = 'SHIPPED')", "count(*)", f"count_if({held})", *alerts]
    grouped = timed(events, "ingested_at", lateness).groupBy(F.window("ingested_at", "30 minutes").alias("w"))
    counted = grouped.agg(*[F.expr(e).alias(c) for e, c in zip(counts, COUNTED)])
    return counted.selectExpr("w.start AS window_start", "w.end AS window_end", *COUNTED)


def current_counts(updates: DataFrame) -> DataFrame:
    """The last update of each window."""
    return updates.sparkSession.sql(
        f"""
        SELECT window_start, window_end, last.* FROM (
          SELECT window_start, window_end, max_by(struct({', '.join(COUNTED)}), {BATCH}) AS last
          FROM {{updates}} GROUP BY window_start, window_end
        )
        """,
        updates=updates,
    )


def stream_dedup(events: DataFrame, time: str = "ingested_at", lateness: str | None = None) -> DataFrame:
    """One row per event id, however late its copies come; the state holds every id seen.

    With a ``lateness`` only copies within it of each other are found, the state forgets
    older ids, and rows later than that behind the newest are dropped by Spark.
    """
    if lateness is None:
        return events.dropDuplicates(["event_id"])
    return timed(events, time, lateness).dropDuplicatesWithinWatermark(["event_id"])
