"""Append-only tables and the metrics store, on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.rollup import WINDOW_COLUMNS, merge_windows
from holdfast.session import scratch_path
from holdfast.vocabulary import ALERT_COLUMNS, EVENT_COLUMNS, FLOW_COLUMNS, INGEST_COLUMNS, SNAPSHOT_COLUMNS, quoted

DAY = "day"


def metrics_schema(time_type: T.DataType) -> T.StructType:
    counts = {*FLOW_COLUMNS, *INGEST_COLUMNS, *SNAPSHOT_COLUMNS, *EVENT_COLUMNS, *ALERT_COLUMNS}
    doubles = {"hold_rate", "delay_p95_sec"}
    kind = lambda c: T.LongType() if c in counts else T.DoubleType() if c in doubles else time_type
    return T.StructType([T.StructField(c, kind(c)) for c in WINDOW_COLUMNS])


def first_arrivals(rows: DataFrame) -> DataFrame:
    """One row per event id, the first to arrive.

    A grouped minimum: copies of one event collapse before the shuffle.
    """
    kept = ", ".join(c for c in rows.columns if c != "event_id")
    return rows.sparkSession.sql(
        f"""
        SELECT event_id, f.* FROM (SELECT event_id, min_by(struct({kept}), seq) AS f FROM {{rows}} GROUP BY event_id)
        """,
        rows=rows,
    ).select(*rows.columns)


def append_ledger(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """The rows of ``new`` to append: first arrivals whose id is not stored yet."""
    fresh = first_arrivals(new)
    return fresh if existing is None else fresh.join(existing.select("event_id"), "event_id", "left_anti")


def append_table(df: DataFrame, path: str, time: str) -> None:
    """Appends rows to files partitioned by the day of ``time``."""
    df.withColumn(DAY, F.to_date(time)).write.mode("append").partitionBy(DAY).parquet(path)


def _read_days(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """An append-only table with its day; empty when nothing was written and a schema is given."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # the analysis error class differs between session kinds
        if schema is None or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(DAY, T.DateType())]))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """An append-only table; empty when nothing was written yet and a schema is given."""
    return _read_days(spark, path, schema).drop(DAY)


def write_metrics(spark: SparkSession, fresh: DataFrame, path: str) -> None:
    """Upserts windows by (start, end): only the touched days are read and rewritten.

    Files cannot be overwritten while they are read, so the merged days are staged first.
    """
    staging = scratch_path(spark, "metrics")
    fresh.withColumn(DAY, F.to_date("window_start")).write.parquet(f"{staging}/fresh")
    new = spark.read.parquet(f"{staging}/fresh")
    old = _read_days(spark, path, fresh.schema).join(new.select(DAY).distinct(), DAY, "left_semi")
    merge_windows(old.select(*new.columns), new).write.parquet(f"{staging}/merged")
    merged = spark.read.parquet(f"{staging}/merged")
    by_day = merged.repartition(DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    by_day.partitionBy(DAY).parquet(path)


def alert_payloads(held: DataFrame, link_prefix: str, at: str, send_status: str = "'PENDING'") -> DataFrame:
    """Notification log rows of held orders: (alert_id, order_id, send_status, alert_data).

    ``held`` has event_id, order_id and reason; ``at`` and ``send_status`` are
    expressions. Delivery is the caller's sink, so the default status is PENDING.
    """
    order_id = "coalesce(order_id, 'UNKNOWN')"
    field = "struct('{title}' AS title, CAST({value} AS string) AS value, {short} AS short)"
    fields = ", ".join(
        field.format(title=t, value=v, short=s)
        for t, v, s in [
            ("Reason Code", "reason", "true"),
            ("Order ID", order_id, "true"),
            ("URL", f"concat({quoted([link_prefix])}, {order_id})", "true"),
            ("Time", at, "false"),
        ]
    )
    body = f"struct('*Risk Detected! Order Blocked*' AS text, array(struct('#ff0000' AS color, array({fields}) AS fields)) AS attachments)"
    return held.where("reason IS NOT NULL").selectExpr(
        "concat('alert:', event_id) AS alert_id", f"{order_id} AS order_id", f"{send_status} AS send_status", f"to_json({body}) AS alert_data"
    )
