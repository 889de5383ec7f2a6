"""Quarantine that goes on from batch to batch.

A trigger also holds orders of its user or product that earlier batches stored. Each batch keeps, under its id, the first
row it has of every order, by day of creation, and the marks its own triggers set. A batch reads stored first rows from
the day on that its earliest trigger reaches back to, and of the orders found it looks up, in their hash
buckets, whether an older batch had them first. So a batch without triggers reads nothing, and one with triggers the recent
days. Batches follow the order of arrival; creation times may go back and forth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.times import at, span, type_of
from holdfast.operators.quarantine import cascade_marks, first_writes, last_trigger
from holdfast.plans.segments import DEFAULT_SPLIT, Split
from holdfast.session import staged
from holdfast.sources.tables import DAY
from holdfast.streaming.runner import BATCH, write_batch
from holdfast.vocabulary import FRAUD_PRODUCT, FRAUD_USER, HOLD

BUCKET = "bucket"
BUCKETS = 64
_OF_ORDER = f"CAST(pmod(xxhash64(order_id), {BUCKETS}) AS int)"


def _before(spark: SparkSession, path: str, batch_id: int, like: DataFrame) -> DataFrame:
    """What batches before this one stored, partitions pruned by later filters."""
    try:
        return spark.read.parquet(path).where(F.col(BATCH) < batch_id)
    except Exception as e:  # the analysis error class differs between session kinds
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return like.limit(0).withColumn(BATCH, F.lit(0))


def mark_batch(classified: DataFrame, batch_id: int, out: str, lookback: float, pair: bool = False, split: Split = DEFAULT_SPLIT) -> None:
    """Stores one micro-batch's first rows and the marks of its triggers. A repeated batch replaces both.

    ``classified`` has seq, order_id, user_id, product_id, created_at and reason. Marks are (order_id, q_seq, q_reason), the
    last trigger that reaches the order. With ``pair`` triggers reach orders of their user and product.
    """
    spark = classified.sparkSession
    rows = staged(classified.select("seq", "order_id", "user_id", "product_id", "created_at", "reason"), "classified")
    fresh = staged(first_writes(rows), "firsts")
    days = lambda df: df.withColumn(DAY, F.to_date("created_at"))
    buckets = fresh.selectExpr("order_id", "seq AS first_seq", f"{_OF_ORDER} AS {BUCKET}")
    days(fresh).write.mode("overwrite").partitionBy(DAY).parquet(f"{out}/firsts/{BATCH}={batch_id}")
    buckets.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{out}/known/{BATCH}={batch_id}")

    triggers = rows.where(f"reason = '{FRAUD_USER}'" if pair else f"reason IN ('{FRAUD_USER}', '{FRAUD_PRODUCT}')")
    since = triggers.selectExpr(f"CAST(min(created_at) - {span(lookback)} AS timestamp_ntz)").first()[0]
    marks = f"{out}/marks"
    if since is None:
        none = fresh.selectExpr("order_id", "seq AS q_seq", "CAST(NULL AS string) AS q_reason")
        return write_batch(none.limit(0), batch_id, marks)
    stored = _before(spark, f"{out}/firsts", batch_id, days(fresh)).where(F.col(DAY) >= F.lit(since.date()))
    stored = stored.where(f"created_at >= {at(since, type_of(rows, 'created_at'))}").select(*fresh.columns)
    reached = _reached(stored, triggers, pair).unionByName(fresh)
    firsts = staged(first_writes(reached), "reached")
    if pair:
        found = last_trigger(firsts, triggers, ["user_id", "product_id"], lookback, firsts, split)
        found = found.selectExpr("order_id", "trigger AS q_seq", f"'{FRAUD_USER}' AS q_reason")
    else:
        found = cascade_marks(firsts, triggers, lookback, firsts, split)
    found = staged(found.join(firsts.select("order_id", F.col("seq").alias("first_seq")), "order_id"), "marked")
    touched = [r[0] for r in found.selectExpr(_OF_ORDER).distinct().limit(BUCKETS).collect()]
    known = _before(spark, f"{out}/known", batch_id, buckets).where(F.col(BUCKET).isin(touched))
    older = known.select("order_id", F.col("first_seq").alias("older")).join(found.select("order_id", "first_seq"), "order_id").where("older < first_seq")
    write_batch(found.join(older.select("order_id").distinct(), "order_id", "left_anti").drop("first_seq"), batch_id, marks)


def _reached(stored: DataFrame, triggers: DataFrame, pair: bool) -> DataFrame:
    """Stored first rows of the triggers' users or products (of their pairs)."""
    if pair:
        return stored.join(triggers.select("user_id", "product_id").distinct(), ["user_id", "product_id"], "left_semi").select(*stored.columns)
    users = triggers.where(f"reason = '{FRAUD_USER}'").select("user_id").distinct()
    items = triggers.where(f"reason = '{FRAUD_PRODUCT}'").select("product_id").distinct()
    by_user = stored.join(users, "user_id", "left_semi").select(*stored.columns)
    return by_user.unionByName(stored.join(items, "product_id", "left_semi").select(*stored.columns))


def marks_of(spark: SparkSession, out: str) -> DataFrame:
    """(order_id, q_seq, q_reason): the last mark of every order."""
    marks = spark.read.parquet(f"{out}/marks")
    last = marks.groupBy("order_id").agg(F.max(F.struct("q_seq", "q_reason")).alias("q"))
    return last.select("order_id", "q.q_seq", "q.q_reason")


def held_orders(orders: DataFrame, marks: DataFrame) -> DataFrame:
    """Current orders with their marks: a marked order is on HOLD for the reason of its last trigger."""
    kept = ", ".join(f"o.{c}" for c in orders.columns if c not in ("current_status", "hold_reason_code"))
    return orders.sparkSession.sql(
        f"""
        SELECT {kept}, CASE WHEN q.q_reason IS NOT NULL THEN '{HOLD}' ELSE o.current_status END AS current_status,
          coalesce(q.q_reason, o.hold_reason_code) AS hold_reason_code
        FROM {{orders}} o LEFT JOIN {{marks}} q ON o.order_id = q.order_id
        """,
        orders=orders,
        marks=marks,
    )


def held_pairs(orders: DataFrame, marks: DataFrame) -> DataFrame:
    """Current orders of the anchored profile: open ones whose last row came before their last trigger are held.

    ``orders`` has raw_reference, the arrival of the order's last row.
    """
    open_ones = marks.join(orders.select("order_id", "raw_reference", F.col("current_status").alias("_now")), "order_id")
    hit = open_ones.where(f"_now <> '{HOLD}' AND q_seq > raw_reference")
    return held_orders(orders, hit.select("order_id", "q_seq", "q_reason"))
