"""The driver's test tables seen as order-operations data.

Order events come from ``events``, the product list from ``part``. Times stay without a
zone (TIMESTAMP_NTZ); messages carry instants, as they do on a topic.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from holdfast.plans.nested import nested
from holdfast.functions.times import BUCKET, floor_bucket, from_utc
from holdfast.operators.rollup import rollup
from holdfast.vocabulary import stage_of

# How long before the end of the data the dashboards are asked.
ASKED_BEFORE = timedelta(hours=5, minutes=50)

# Giving the schema saves a footer read per query.
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
PART_SCHEMA = "p_partkey bigint, p_name string, p_size int"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.schema(PART_SCHEMA).parquet(f"{sf_dir}/part.parquet")
    return part.selectExpr("CAST(p_partkey AS string) AS product_id", "p_name AS product_name", "p_size - 5 AS stock")


def bind(events: DataFrame) -> DataFrame:
    """Ledger rows, each with the order fields its message carried."""
    return events.sparkSession.sql(
        nested(
            f"""
            SELECT event_id AS seq, CAST(event_id AS string) AS event_id, concat('ord-', event_id div 4) AS order_id,
              CAST(user_id AS string) AS user_id, CAST(k AS string) AS product_id, concat('item ', k) AS product_name,
              CASE WHEN k % 13 = 0 THEN '' WHEN k % 17 = 0 THEN 'Unknown st' ELSE concat('addr-', user_id) END AS shipping_address,
              coalesce({stage_of('status')}, 'SYSTEM') AS current_stage, status AS current_status, upper(event_type) AS event_type,
              CASE WHEN status = 'HOLD' THEN get(array('FUL-VALID', 'FUL-INV', 'FUL-FRAUD-USER', 'FUL-FRAUD-PROD'), k % 4) END AS reason_code,
              ts AS occurred_at, timestampadd(MICROSECOND, CAST(round(value * 1000000) AS bigint), ts) AS ingested_at,
              CASE WHEN status = 'HOLD' THEN state END AS ops_status,
              CASE WHEN status = 'HOLD' AND state IS NOT NULL THEN concat('op-', event_id % 7) END AS ops_operator, k
            FROM @s
            """,
            e=f"SELECT *, CAST(get_json_object(props, '$.k') AS int) AS k FROM {{events}}",
            s=f"""
              SELECT *, CASE event_type WHEN 'signup' THEN 'PAID' WHEN 'click' THEN 'PICKING'
                WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 'CANCELED' ELSE 'PACKED' END
                WHEN 'purchase' THEN CASE WHEN k % 2 = 1 THEN 'DELIVERED' ELSE 'SHIPPED' END ELSE 'HOLD' END AS status,
                get(array(NULL, 'OPEN', 'ACK', 'RESOLVED', 'RETRY_REQUESTED'), CAST(event_id % 5 AS int)) AS state
              FROM @e
            """,
        ),
        events=events,
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(events_table(spark, sf_dir))


def order_state(rows: DataFrame) -> DataFrame:
    """Current orders of the bound ledger: last row per order, created with its first."""
    return rows.sparkSession.sql(
        """
        SELECT order_id, last.*, created_at FROM (
          SELECT order_id, min(occurred_at) AS created_at,
            max_by(struct(user_id, product_id, product_name, shipping_address, current_stage, current_status,
              event_type AS last_event_type, occurred_at AS last_occurred_at, reason_code AS hold_reason_code,
              ops_status AS hold_ops_status, ops_operator AS hold_ops_operator), seq) AS last
          FROM {rows} GROUP BY order_id
        )
        """,
        rows=rows,
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_state(ledger(spark, sf_dir))


@dataclass(frozen=True)
class Times:
    """The buckets that hold all rows, [start, as_of), and the moment dashboards are asked at."""

    start: datetime
    as_of: datetime

    @property
    def asked(self) -> datetime:
        return self.as_of - ASKED_BEFORE


def times(rows: DataFrame) -> Times:
    """Read off the ledger in one aggregate; an empty one covers nothing."""
    first, last = rows.selectExpr("min(least(occurred_at, ingested_at)) AS first", "max(ingested_at) AS last").first()
    if first is None:
        return Times(datetime(1970, 1, 1), datetime(1970, 1, 1))
    return Times(floor_bucket(first), floor_bucket(last) + BUCKET)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of the ledger, rolled up anew."""
    rows = ledger(spark, sf_dir)
    over = times(rows)
    return rollup(rows, order_state(rows), over.start, over.as_of, over.as_of)


def event_actions(rows: DataFrame) -> DataFrame:
    """Three operator actions per held event, and one on an event that does not exist."""
    return rows.sparkSession.sql(
        nested(
            """
            SELECT seq * 4 + j AS seq, CASE WHEN j = 3 THEN concat('gone-', event_id) ELSE event_id END AS event_id,
              get(array('ACK', 'RESOLVED', 'RETRY_REQUESTED'), (k + j * (k % 2)) % 3) AS new_status,
              CASE WHEN j = 1 THEN 'second look' END AS note, concat('op-', j) AS operator, timestampadd(MINUTE, j + 1, ingested_at) AS at
            FROM @steps
            """,
            steps="""SELECT seq, event_id, k, ingested_at, explode(sequence(0, 3)) AS j FROM {rows} WHERE current_status = 'HOLD'""",
        ),
        rows=rows,
    )


def order_actions(rows: DataFrame) -> DataFrame:
    """One operator action per event: change the status, note a hold, or clear it."""
    return rows.selectExpr(
        "seq", "order_id", "get(array('STATUS', 'HOLD_OPS', 'CLEAR'), k % 3) AS kind",
        "get(array('PICKING', 'HOLD', 'SHIPPED'), (k div 3) % 3) AS next_status", "get(array('ACK', 'RESOLVED'), k % 2) AS new_status",
        "CAST(NULL AS string) AS note", "concat('op-', k % 5) AS operator", "timestampadd(MINUTE, 5, ingested_at) AS at",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes(ledger(spark, sf_dir))


def envelopes(rows: DataFrame) -> DataFrame:
    """Envelopes with every alias, time form and kind of damage the intake handles."""
    iso = "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\""
    return rows.sparkSession.sql(
        nested(
            f"""
            SELECT 'event' AS topic, CAST(seq % 4 AS int) AS partition, seq AS offset,
              CASE k WHEN 99 THEN concat(chr(123), chr(125)) WHEN 98 THEN substr(text, 1, 40) WHEN 97 THEN '[]' WHEN 96 THEN 'null' WHEN 95 THEN '[1]' ELSE text END AS value,
              {from_utc('ingested_at')} AS ingested_at
            FROM @t
            """,
            u=f"SELECT *, date_format(occurred_at, {iso}) AS utc, date_format(timestampadd(HOUR, 9, occurred_at), {iso}) AS seoul FROM {{rows}}",
            t=f"""
              SELECT *, to_json(named_struct(
                'order_id', order_id,
                'user_id', CASE WHEN seq % 2 = 0 THEN user_id END, 'customer_id', CASE WHEN seq % 2 = 1 THEN user_id END,
                'product_id', product_id, 'product_name', product_name,
                'shipping_address', CASE WHEN seq % 3 <> 0 THEN shipping_address END, 'address', CASE WHEN seq % 3 = 0 THEN shipping_address END,
                'current_stage', current_stage, 'current_status', CASE WHEN k % 19 <> 0 THEN current_status END,
                'last_event_type', CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN 'ORDER_CREATED' END,
                'event_type', CASE WHEN k % 3 = 0 THEN event_type END,
                'created_at', concat(utc, 'Z'),
                'last_occurred_at', CASE WHEN k = 94 THEN 'soon' WHEN seq % 4 = 0 THEN concat(utc, 'Z')
                  WHEN seq % 4 = 1 THEN concat(seoul, '+09:00') WHEN seq % 4 = 2 THEN utc END,
                'occurred_at', concat(utc, 'Z'), 'event_produced_at', concat(utc, 'Z'),
                'reason_code', CASE WHEN seq % 2 = 0 THEN reason_code END, 'hold_reason_code', CASE WHEN seq % 2 = 1 THEN reason_code END
              )) AS text
              FROM @u
            """,
        ),
        rows=rows,
    )
