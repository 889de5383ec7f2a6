"""The 30-minute metrics windows: one job for any number of windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from holdfast.plans.nested import nested
from holdfast.functions.times import BUCKET, at, between, bucket_start, floor_bucket, span, spine, type_of
from holdfast.vocabulary import ALERT_COLUMNS, ALERT_COUNTERS, EVENT_COLUMNS, FLOW_COLUMNS, HELD_STATUSES, HOLD, INGEST_COLUMNS, quoted

# Fixed values of the rollup job.
REROLL = timedelta(minutes=120)
BACKFILL_DAYS = 30
LATE_AFTER = timedelta(hours=2)
P95 = 0.95

WINDOW_COLUMNS = [
    "window_start", "window_end", *FLOW_COLUMNS, "hold_rate", *INGEST_COLUMNS, "backlog", "holds_now",
    "late_orders", *EVENT_COLUMNS, "delay_p95_sec", *ALERT_COLUMNS, "created_at",
]
COUNTED = [*FLOW_COLUMNS, "ingest_count", "parse_errors", "schema_missing", "event_errors", *ALERT_COLUMNS]
# Delays are first counted by their high bits; one group spans 2**20 microseconds.
_LOW_BITS = 20
# Up to this many windows, two rows per window are broadcast.
_BROADCAST_WINDOWS = 1_000_000


def window_count(start: datetime, end: datetime) -> int:
    """Whole buckets in [start, end)."""
    return max(0, (end - start) // BUCKET)


def snapshot_counts(orders: DataFrame, as_of: datetime) -> DataFrame:
    """One row: backlog, holds_now and late_orders at ``as_of``."""
    late = f"created_at < {at(as_of - LATE_AFTER, type_of(orders, 'created_at'))}"
    return orders.sparkSession.sql(
        f"""
        SELECT count_if(current_status = 'PAID') AS backlog, count_if(current_status = '{HOLD}') AS holds_now,
          count_if(current_status = 'PAID' AND {late}) AS late_orders
        FROM {{orders}}
        """,
        orders=orders,
    )


def _occurrences(df: DataFrame, time: str, column: str, start: datetime, end: datetime) -> DataFrame:
    like = type_of(df, time)
    return df.where(between(time, like, start, end)).selectExpr(f"{bucket_start(time)} AS ts", f"1L AS {column}")


def arrived_rows(events: DataFrame) -> DataFrame:
    """Ledger rows with their window ``ts`` and ``_delay``, the microseconds from occurrence to arrival."""
    return events.selectExpr("*", f"{bucket_start('ingested_at')} AS ts", "timestampdiff(MICROSECOND, occurred_at, ingested_at) AS _delay")


def counted_rows(arrived: DataFrame) -> DataFrame:
    """What each row adds to the counts of its window."""
    held = f"current_status = '{HOLD}'"
    alerts = [f"CAST({held} AND coalesce(ops_status, 'OPEN') = '{s}' AS bigint) AS {c}" for s, c in ALERT_COUNTERS.items()]
    return arrived.selectExpr(
        "ts", "CAST(current_status = 'PAID' AS bigint) AS payments", "CAST(current_status = 'SHIPPED' AS bigint) AS shipped",
        "1L AS ingest_count", f"CAST({held} AS bigint) AS event_errors", *alerts,
    )


def rollup(
    events: DataFrame,
    orders: DataFrame,
    start: datetime,
    end: datetime,
    as_of: datetime,
    errors: DataFrame | None = None,
    rejects: DataFrame | None = None,
) -> DataFrame:
    """Metrics of every whole 30-minute window in [start, end).

    ``errors`` (with occurred_at) and ``rejects`` (with ingested_at) count as parse_errors
    and schema_missing; without them both are 0.
    """
    start = floor_bucket(start)
    windows = window_count(start, end)
    end = start + BUCKET * windows
    like = type_of(events, "ingested_at")
    arrived = arrived_rows(events.where(between("ingested_at", like, start, end)))
    parts = [counted_rows(arrived), _occurrences(orders, "created_at", "orders", start, end)]
    if errors is not None:
        parts.append(_occurrences(errors, "occurred_at", "parse_errors", start, end))
    if rejects is not None:
        parts.append(_occurrences(rejects, "ingested_at", "schema_missing", start, end))
    delays = arrived.where("_delay IS NOT NULL").selectExpr("ts", "_delay", "1L AS _n")
    points = spine(events.sparkSession, start, end - BUCKET, BUCKET, like)
    return window_metrics(points, windows, parts, delays, arrived.select("order_id", "ts"), orders, as_of)


def window_metrics(
    points: DataFrame, windows: int, parts: Sequence[DataFrame], delays: DataFrame, seen: DataFrame, orders: DataFrame, as_of: datetime
) -> DataFrame:
    """Metrics of the windows in ``points`` (``ts``, ``windows`` of them) from what adds up to them.

    ``parts`` are rows of (ts, some counts), ``delays`` rows of (ts, _delay, _n) and ``seen`` rows of (order_id,
    ts), whole or summed up before, repeated or not; all lie in the windows of ``points``. Every source becomes rows of
    (window, small numbers), and all of them meet in one grouped sum. The exact delay percentile narrows in two
    counts instead of holding a window's delays in one task: counts per (window, high bits of the delay) locate the
    groups of the two ranks needed, and a second narrow scan counts exact delays only
    inside those groups. Both counts combine before the shuffle, so a busy window costs
    partial sums, and a located group has at most 2**20 distinct values.
    """
    spark = orders.sparkSession
    like = type_of(points, "ts")
    # A window set per order: partial sets bound what a busy order brings to the shuffle,
    # and the join reuses its partitioning.
    holds = spark.sql(
        f"""
        SELECT explode(t.windows) AS ts, 1L AS holds
        FROM (SELECT order_id, collect_set(ts) AS windows FROM {{seen}} WHERE order_id IS NOT NULL GROUP BY order_id) t
        LEFT SEMI JOIN (SELECT order_id FROM {{orders}} WHERE current_status IN ({quoted(HELD_STATUSES)})) h ON t.order_id = h.order_id
        """,
        seen=seen,
        orders=orders,
    )
    merged = points
    for part in [*parts, holds]:
        merged = merged.unionByName(part, allowMissingColumns=True)

    present = [c for c in COUNTED if c in merged.columns]
    total = lambda c: f"coalesce(sum({c}), 0L)" if c in present else "0L"
    hint = "/*+ BROADCAST(g) */" if windows <= _BROADCAST_WINDOWS else ""
    return spark.sql(
        nested(
            f"""
            SELECT s.ts AS window_start, s.ts + {span(BUCKET)} AS window_end, {', '.join('s.' + c for c in FLOW_COLUMNS)},
              coalesce(try_divide(s.holds, s.orders), 0D) AS hold_rate, {', '.join('s.' + c for c in INGEST_COLUMNS)},
              (SELECT backlog FROM {{now}}) AS backlog, (SELECT holds_now FROM {{now}}) AS holds_now, (SELECT late_orders FROM {{now}}) AS late_orders,
              s.ingest_count AS event_total, s.event_errors, coalesce((p.a + (p.b - p.a) * p.share) / 1e6D, 0D) AS delay_p95_sec,
              {', '.join('s.' + c for c in ALERT_COLUMNS)}, {at(as_of, like)} AS created_at
            FROM @sums s LEFT JOIN @p95 p ON s.ts = p.ts
            """,
            delays=f"SELECT ts, _delay, _n, shiftright(_delay, {_LOW_BITS}) AS _high FROM {{delays}}",
            coarse="SELECT ts, _high, sum(_n) AS _n FROM @delays GROUP BY ts, _high",
            placed=f"""
              SELECT ts, _high, _n, sum(_n) OVER (PARTITION BY ts ORDER BY _high ROWS UNBOUNDED PRECEDING) AS upto,
                {P95}D * (sum(_n) OVER (PARTITION BY ts) - 1) AS rank
              FROM @coarse
            """,
            located=f"""
              SELECT ts, _high, upto - _n AS before, floor(rank) AS low, ceil(rank) AS top, rank - floor(rank) AS share
              FROM @placed WHERE upto > floor(rank) AND upto - _n <= ceil(rank)
            """,
            exact=f"""
              SELECT {hint} a.ts, a._high, a._delay, sum(a._n) AS _n
              FROM @delays a LEFT SEMI JOIN @located g ON a.ts = g.ts AND a._high = g._high
              GROUP BY a.ts, a._high, a._delay
            """,
            ranked=f"""
              SELECT e.ts, e._delay, g.low, g.top, g.share,
                g.before + sum(e._n) OVER (PARTITION BY e.ts, e._high ORDER BY e._delay ROWS UNBOUNDED PRECEDING) AS upto
              FROM @exact e JOIN @located g ON e.ts = g.ts AND e._high = g._high
            """,
            p95=f"""
              SELECT ts, min(CASE WHEN upto > low THEN _delay END) AS a, min(CASE WHEN upto > top THEN _delay END) AS b, first(share) AS share
              FROM @ranked GROUP BY ts
            """,
            sums=f"SELECT ts, {', '.join(f'{total(c)} AS {c}' for c in COUNTED)} FROM {{merged}} GROUP BY ts",
        ),
        merged=merged,
        delays=delays,
        now=snapshot_counts(orders, as_of),
    )


def backfill_range(
    as_of: datetime, max_window_end: datetime | None, backfill_from: datetime | None = None, backfill_days: int = BACKFILL_DAYS
) -> tuple[datetime, datetime]:
    """Range to (re)compute: a fixed start, else the last days of an empty store, else
    from the newest stored window on; up to the last finished bucket."""
    end = floor_bucket(as_of)
    if backfill_from is not None:
        return floor_bucket(backfill_from), end
    if max_window_end is None:
        return floor_bucket(end - timedelta(days=backfill_days)), end
    return floor_bucket(max_window_end), end


def gap_range(as_of: datetime, max_window_end: datetime | None) -> tuple[datetime, datetime]:
    """Buckets after the newest stored one; a single bucket for an empty store."""
    end = floor_bucket(as_of)
    return (end - BUCKET if max_window_end is None else max_window_end), end


def reroll_range(as_of: datetime, horizon: timedelta = REROLL) -> tuple[datetime, datetime]:
    """The recent range that is always recomputed, to absorb late rows."""
    end = floor_bucket(as_of)
    return floor_bucket(end - horizon), end


def max_window_end(metrics: DataFrame) -> DataFrame:
    return metrics.selectExpr("max(window_end) AS max_end")


def newest_end(metrics: DataFrame) -> datetime | None:
    """The one value the driver reads, to choose a range."""
    return max_window_end(metrics).first()["max_end"]


def fill_gaps(events: DataFrame, orders: DataFrame, metrics: DataFrame, as_of: datetime) -> DataFrame:
    """Metrics of the finished windows after the newest stored one."""
    start, end = gap_range(as_of, newest_end(metrics))
    return rollup(events, orders, start, end, as_of)


def reroll_recent(events: DataFrame, orders: DataFrame, as_of: datetime, horizon: timedelta = REROLL) -> DataFrame:
    """Metrics of the windows in the recompute horizon."""
    return rollup(events, orders, *reroll_range(as_of, horizon), as_of)


def backfill(
    events: DataFrame,
    orders: DataFrame,
    metrics: DataFrame,
    as_of: datetime,
    backfill_from: datetime | None = None,
    backfill_days: int = BACKFILL_DAYS,
) -> DataFrame:
    """Metrics of the whole backfill range."""
    newest = None if backfill_from is not None else newest_end(metrics)
    return rollup(events, orders, *backfill_range(as_of, newest, backfill_from, backfill_days), as_of)


def merge_windows(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored windows with the fresh ones in place of theirs."""
    key = ["window_start", "window_end"]
    return stored.join(fresh.select(*key), key, "left_anti").unionByName(fresh)


def latest_window(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("window_end", "window_start", ascending=False).limit(1)
