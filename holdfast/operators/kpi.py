"""Dashboard summary and KPI rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from holdfast.plans.nested import nested
from holdfast.functions.times import at, day_start, type_of
from holdfast.operators.rollup import LATE_AFTER, latest_window
from holdfast.vocabulary import ALERT_COUNTERS, COMPLETED_STATUSES, HOLD, IN_PROGRESS_STATUSES, quoted

_WINDOW_VALUES = {
    "orders": "orders_window", "payments": "payments_window", "shipped": "shipped_window", "holds": "holds_window",
    "hold_rate": "hold_rate", "ingest_count": "ingest_count", "parse_errors": "parse_errors", "schema_missing": "schema_missing",
}


def _today(df: DataFrame, name: str, as_of: datetime, tz: str | None) -> str:
    like = type_of(df, name)
    return f"{day_start(name, like, tz)} = {day_start(at(as_of, like), like, tz)}"


def summary(orders: DataFrame, events: DataFrame, metrics: DataFrame, as_of: datetime, tz: str | None = None) -> DataFrame:
    """One row of today's counts and the newest window's values.

    Each table is read once; the one-row results meet as scalar subqueries.
    """
    today = _today(orders, "created_at", as_of, tz)
    values = ", ".join(f"coalesce(w.{c}, 0) AS {name}" for c, name in _WINDOW_VALUES.items())
    stamp = f"coalesce(w.created_at, {at(as_of, type_of(metrics, 'created_at'))})"
    return orders.sparkSession.sql(
        nested(
            f"""
            SELECT orders_today, shipped_today, backlog, holds_now, in_progress_now, completed_now, 0L AS late_shipments,
              w.window_start, w.window_end, {values}, {_stamp_text(stamp, tz)} AS metrics_created_at
            FROM @joined
            """,
            o=f"""
              SELECT count_if({today}) AS orders_today,
                count_if({today} AND current_status = 'PAID') AS backlog,
                count_if({today} AND current_status = '{HOLD}') AS holds_now,
                count_if(current_status IN ({quoted(IN_PROGRESS_STATUSES)})) AS in_progress_now,
                count_if(current_status IN ({quoted(COMPLETED_STATUSES)})) AS completed_now
              FROM {{orders}}
            """,
            joined=f"""
              SELECT *, (SELECT struct(*) FROM {{newest}}) AS w,
                (SELECT count(*) FROM {{events}} WHERE current_status = 'SHIPPED' AND {_today(events, 'occurred_at', as_of, tz)}) AS shipped_today
              FROM @o
            """,
        ),
        orders=orders,
        events=events,
        newest=latest_window(metrics),
    )


def _stamp_text(stamp: str, tz: str | None) -> str:
    """ISO text with milliseconds; the zone's offset follows when one is asked for."""
    iso = "\"yyyy-MM-dd'T'HH:mm:ss.SSS\""
    wall = f"CAST({stamp} AS timestamp_ntz)"
    if tz is None:
        return f"date_format({wall}, {iso})"
    local = f"convert_timezone(current_timezone(), '{tz}', {wall})"
    minutes = f"timestampdiff(MINUTE, convert_timezone(current_timezone(), 'UTC', {wall}), {local})"
    sign = f"CASE WHEN {minutes} < 0 THEN '-' ELSE '+' END"
    offset = f"format_string('%s%02d:%02d', {sign}, abs({minutes}) div 60, abs({minutes}) % 60)"
    return f"concat(date_format({local}, {iso}), {offset})"


def _column(points: DataFrame, name: str) -> str:
    """A points column, zero where the preset does not have it."""
    return f"coalesce({name}, 0)" if name in points.columns else "0"


def _total(points: DataFrame, name: str, alias: str | None = None) -> str:
    return f"CAST(coalesce(sum({_column(points, name)}), 0) AS bigint) AS {alias or name}"


def _last(points: DataFrame, name: str) -> str:
    return f"CAST(coalesce(max_by({_column(points, name)}, ts), 0) AS bigint) AS {name}"


def _rate(part: str, whole: str, name: str) -> str:
    return f"coalesce(try_divide({part}, {whole}), 0D) AS {name}"


def kpi_orders(points: DataFrame) -> DataFrame:
    """Order KPIs of a time series; a zero row when it is empty.

    ``holds_now`` is the current count carried by the first point, ``holds`` the sum.
    """
    row = points.selectExpr(
        "max(ts) AS updated_at", _total(points, "orders"), _total(points, "shipped"), _total(points, "holds"), _last(points, "backlog"),
        f"CAST(coalesce(min_by({_column(points, 'holds_now')}, ts), 0) AS bigint) AS holds_now", _last(points, "late_orders"),
    )
    return row.selectExpr("*", _rate("holds", "orders", "hold_rate"))


def kpi_events(points: DataFrame) -> DataFrame:
    """Event KPIs: totals, error rate, and the per-point lists in time order.

    A preset has at most 30 points, which bounds the lists.
    """
    def listed(name: str) -> str:
        pairs = f"collect_list(struct(ts, CAST({_column(points, name)} AS bigint) AS v))"
        return f"transform(sort_array({pairs}), p -> p.v) AS {name}"

    row = points.selectExpr(
        "max(ts) AS updated_at", _total(points, "event_total"), _total(points, "event_errors"),
        *[listed(c) for c in ("delay_p95_sec", "ingest_count", "parse_errors", "schema_missing")],
    )
    return row.selectExpr("*", _rate("event_errors", "event_total", "error_rate"))


def kpi_alerts(points: DataFrame) -> DataFrame:
    """Alert KPIs: one total per alert state."""
    return points.selectExpr("max(ts) AS updated_at", *[_total(points, c, state) for state, c in ALERT_COUNTERS.items()])


def on_time_rate(orders: DataFrame, as_of: datetime) -> DataFrame:
    """Open orders, late ones among them, and the on-time share clamped to [0, 1]."""
    late = f"current_status = 'PAID' AND created_at < {at(as_of - LATE_AFTER, type_of(orders, 'created_at'))}"
    unfinished = f"current_status NOT IN ({quoted(COMPLETED_STATUSES)})"
    row = orders.selectExpr(f"count_if({unfinished}) AS backlog", f"count_if({unfinished} AND {late}) AS late_orders")
    return row.selectExpr("*", "least(greatest(1 - late_orders / greatest(backlog, 1), 0D), 1D) AS on_time_rate")
