"""Filtered newest-first lists. Each is a filter and a top-N, so nothing is fully sorted.

Nulls sort first in descending time, and the row's key breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed limits (smallest, largest) of each list.
LIMITS = {
    "recent_orders": (1, 200),
    "alerts": (1, 200),
    "orders_page": (1, 500),
    "events_page": (10, 2000),
    "alerts_page": (10, 2000),
    "order_detail": (10, 1000),
}
ALL = "ALL"

ORDER_COLUMNS = [
    "order_id", "current_stage", "current_status", "hold_reason_code", "last_event_type", "last_occurred_at", "created_at",
]
EVENT_COLUMNS = ["event_id", "order_id", "event_type", "current_status", "reason_code", "occurred_at", "ingested_at"]


def clamp_limit(name: str, limit: int) -> int:
    """The limit, refused when outside the list's bounds."""
    low, high = LIMITS[name]
    if not low <= limit <= high:
        raise ValueError(f"limit of {name} must lie in [{low}, {high}], got {limit}")
    return limit


def _newest(df: DataFrame, time: str, key: str, limit: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_first(time), F.desc(key)).limit(limit)


def _equals(column: str, value: str) -> Column:
    return F.col(column) == F.lit(value)


def _contains(column: str, text: str) -> Column:
    """Case-insensitive containment; % and _ in the text act as wildcards, a backslash stands for itself."""
    return F.col(column).ilike("%" + text.replace("\\", "\\\\") + "%")


def recent_orders(orders: DataFrame, limit: int = 20) -> DataFrame:
    return _newest(orders.select(*ORDER_COLUMNS), "created_at", "order_id", clamp_limit("recent_orders", limit))


def orders_page(orders: DataFrame, status: str = ALL, stage: str = ALL, q: str = "", limit: int = 200) -> DataFrame:
    """Orders by status, stage and a part of the id; inactive filters leave no trace in the plan."""
    clamp_limit("orders_page", limit)
    found = orders.select(*ORDER_COLUMNS)
    if status != ALL:
        found = found.where(_equals("current_status", status))
    if stage != ALL:
        found = found.where(_equals("current_stage", stage))
    if q:
        found = found.where(_contains("order_id", q))
    return _newest(found, "created_at", "order_id", limit)


def order_one(orders: DataFrame, products: DataFrame, order_id: str) -> DataFrame:
    """One order with its product's name; absent when the product is unknown."""
    one = orders.where(_equals("order_id", order_id)).drop("product_name")
    return one.join(products.select("product_id", "product_name"), "product_id")


def events_page(events: DataFrame, order_id: str = "", event_type: str = "", only_error: bool = False, limit: int = 300) -> DataFrame:
    """Events by parts of order id and type; events without an order never match."""
    clamp_limit("events_page", limit)
    found = events.select(*EVENT_COLUMNS).where(_contains("order_id", order_id))
    if event_type:
        found = found.where(_contains("event_type", event_type))
    if only_error:
        found = found.where("reason_code IS NOT NULL")
    return _newest(found, "ingested_at", "event_id", limit)


def events_of_order(events: DataFrame, order_id: str, limit: int = 200) -> DataFrame:
    clamp_limit("order_detail", limit)
    return _newest(events.select(*EVENT_COLUMNS).where(_equals("order_id", order_id)), "ingested_at", "event_id", limit)


def event_alerts(events: DataFrame, time: str = "occurred_at") -> DataFrame:
    """Every event with a reason, as an alert."""
    return events.where("reason_code IS NOT NULL").selectExpr(
        "concat('event:', event_id) AS alert_key", "'EVENT' AS kind", "coalesce(ops_status, 'OPEN') AS status", "order_id", "event_id",
        "reason_code AS reason", f"{time} AS occurred_at", "ops_operator AS operator",
    )


def hold_alerts(orders: DataFrame) -> DataFrame:
    """Every order with a hold reason, as an alert."""
    return orders.where("hold_reason_code IS NOT NULL").selectExpr(
        "concat('hold:', order_id) AS alert_key", "'HOLD' AS kind", "coalesce(hold_ops_status, 'OPEN') AS status", "order_id",
        "CAST(NULL AS string) AS event_id", "hold_reason_code AS reason", "last_occurred_at AS occurred_at", "hold_ops_operator AS operator",
    )


def alerts(events: DataFrame, orders: DataFrame, limit: int = 10) -> DataFrame:
    """Newest event and hold alerts together."""
    both = event_alerts(events).unionByName(hold_alerts(orders))
    return _newest(both, "occurred_at", "alert_key", clamp_limit("alerts", limit))


def alerts_page(events: DataFrame, status: str = ALL, kind: str = ALL, limit: int = 300) -> DataFrame:
    """Event alerts by state; the time shown is the ingest time."""
    clamp_limit("alerts_page", limit)
    found = event_alerts(events, "ingested_at")
    if status != ALL:
        found = found.where(_equals("status", status))
    if kind != ALL:
        found = found.where(_equals("kind", kind))
    return _newest(found, "occurred_at", "alert_key", limit)


def alerts_of_order(events: DataFrame, order_id: str, limit: int = 200) -> DataFrame:
    clamp_limit("order_detail", limit)
    return _newest(event_alerts(events.where(_equals("order_id", order_id))), "occurred_at", "alert_key", limit)


def order_detail(
    orders: DataFrame, events: DataFrame, products: DataFrame, order_id: str, events_limit: int = 200, alerts_limit: int = 200
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The order, its events and its alerts."""
    return (
        order_one(orders, products, order_id),
        events_of_order(events, order_id, events_limit),
        alerts_of_order(events, order_id, alerts_limit),
    )


def alert_kind(key: str) -> str:
    """EVENT or HOLD for event:… and hold:… keys, null for anything else."""
    return f"CASE WHEN startswith({key}, 'event:') THEN 'EVENT' WHEN startswith({key}, 'hold:') THEN 'HOLD' END"


def alert_target(key: str) -> str:
    """The id behind an alert key's first colon, null for other texts."""
    return f"CASE WHEN {alert_kind(key)} IS NOT NULL THEN split({key}, ':', 2)[1] END"
