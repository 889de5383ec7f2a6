"""Metrics windows kept up to date by micro-batches, late rows included.

A batch adds, under its id and the day of the window, what its rows add to their windows: counts, an exact histogram of
delays, and the orders seen. All three merge by sums and sets, so any split of the rows into batches gives the
windows of the batch rollup, and no row is read again. A row is late when its window had closed by the watermark that the
batches before stored. Late rows change their windows like all others and are kept in a table of their own, and
:func:`refresh` rewrites just the stored windows a batch has touched.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.times import BUCKET, at, between, bucket_start, floor_bucket, span, spine, type_of
from holdfast.operators.rollup import arrived_rows, counted_rows, window_count, window_metrics
from holdfast.session import staged
from holdfast.sources.tables import DAY, write_metrics
from holdfast.streaming.runner import BATCH, read_batch, run_available, write_batch

# How far behind the newest row a window stays open.
LATENESS = timedelta(hours=2)


def closed_before(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """One row (newest): the newest arrival of all batches before this one, null before the first."""
    return read_batch(spark, f"{out}/clock", batch_id - 1, "newest timestamp_ntz")


def add_batch(rows: DataFrame, batch_id: int, out: str, lateness: timedelta = LATENESS) -> None:
    """Adds one micro-batch of ledger rows. A repeated batch replaces what it wrote.

    Rows without an arrival time belong to no window and are left out.
    """
    spark = rows.sparkSession
    before = closed_before(spark, out, batch_id)
    newest = before.first()
    arrived = arrived_rows(rows.where("ingested_at IS NOT NULL"))
    late = "false"
    if newest and newest["newest"]:
        late = f"CAST(ts + {span(BUCKET)} AS timestamp_ntz) <= {at(newest['newest'] - lateness, T.TimestampNTZType())}"
    arrived = staged(arrived.selectExpr("*", f"{late} AS late"), "arrived")

    def put(df: DataFrame, name: str) -> None:
        by_day = df.withColumn(DAY, F.to_date("ts"))
        by_day.write.mode("overwrite").partitionBy(DAY).parquet(f"{out}/{name}/{BATCH}={batch_id}")

    counted = counted_rows(arrived)
    names = [c for c in counted.columns if c != "ts"]
    late_rows = counted.unionByName(arrived.where("late").selectExpr("ts", "1L AS late_rows"), allowMissingColumns=True)
    put(late_rows.groupBy("ts").agg(*[F.sum(c).alias(c) for c in (*names, "late_rows")]), "counts")
    put(arrived.where("_delay IS NOT NULL").groupBy("ts", "_delay").agg(F.count("*").alias("_n")), "delays")
    put(arrived.where("order_id IS NOT NULL").select("ts", "order_id").distinct(), "seen")
    write_batch(arrived.where("late").drop("_delay", "late"), batch_id, f"{out}/late")
    own = arrived.select(F.max("ingested_at").cast("timestamp_ntz").alias("newest"))
    write_batch(own.unionByName(before).agg(F.max("newest").alias("newest")), batch_id, f"{out}/clock")


def _read(spark: SparkSession, out: str, name: str, start: datetime, end: datetime) -> DataFrame:
    """What batches added to the windows in [start, end); only their days are read."""
    rows = spark.read.parquet(f"{out}/{name}")
    days = F.col(DAY).between(F.lit(start.date()), F.lit(end.date()))
    return rows.where(days).where(between("ts", type_of(rows, "ts"), start, end)).drop(DAY)


def _metrics(spark: SparkSession, out: str, points: DataFrame, windows: int, start: datetime, end: datetime, orders: DataFrame, as_of: datetime, only: bool) -> DataFrame:
    """Metrics of the windows in ``points``, all in [start, end); ``only`` if there are others between them."""
    chosen = lambda df: df.join(F.broadcast(points) if windows <= 1_000_000 else points, "ts", "left_semi") if only else df
    read = lambda name: chosen(_read(spark, out, name, start, end).drop(BATCH))
    created = orders.where(between("created_at", type_of(orders, "created_at"), start, end))
    created = chosen(created.selectExpr(f"{bucket_start('created_at')} AS ts", "1L AS orders"))
    return window_metrics(points, windows, [read("counts").drop("late_rows"), created], read("delays"), read("seen").select("order_id", "ts"), orders, as_of)


def live_metrics(spark: SparkSession, out: str, orders: DataFrame, start: datetime, end: datetime, as_of: datetime) -> DataFrame:
    """Metrics of every window in [start, end), equal to the batch rollup of all rows added so far."""
    start = floor_bucket(start)
    windows = window_count(start, end)
    end = start + BUCKET * windows
    points = spine(spark, start, end - BUCKET, BUCKET, type_of(spark.read.parquet(f"{out}/counts"), "ts"))
    return _metrics(spark, out, points, windows, start, end, orders, as_of, False)


def touched(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """(ts): the windows that a batch added to."""
    return spark.read.parquet(f"{out}/counts").where(F.col(BATCH) == batch_id).select("ts").distinct()


def refresh(spark: SparkSession, out: str, batch_id: int, orders: DataFrame, as_of: datetime, store: str) -> None:
    """Rewrites the stored windows that the batch touched, however old they are."""
    points = staged(touched(spark, out, batch_id), "touched")
    n, first, last = points.agg(F.count("*"), F.min("ts").cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz")).first()
    if n:
        write_metrics(spark, _metrics(spark, out, points, n, first, last + BUCKET, orders, as_of, True), store)


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows that came after their window had closed, with the batch that brought them."""
    return spark.read.parquet(f"{out}/late")


def window_counts(spark: SparkSession, out: str) -> DataFrame:
    """The windows' counts over all batches, with how many of the rows were late."""
    counts = spark.read.parquet(f"{out}/counts").drop(DAY, BATCH)
    sums = counts.groupBy("ts").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns if c != "ts"])
    return sums.selectExpr("ts AS window_start", f"ts + {span(BUCKET)} AS window_end", "* EXCEPT (ts)")


def run_windows(rows: DataFrame, out: str, checkpoint: str, lateness: timedelta = LATENESS) -> None:
    """Adds all rows there are in a stream of ledger rows, batch by batch."""
    run_available(rows, lambda df, batch_id: add_batch(df, batch_id, out, lateness), checkpoint)
