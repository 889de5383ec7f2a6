"""Fixed values shared by every operator, and the message schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Order statuses with their stage.
STAGE_OF_STATUS = {
    "PAID": "PAYMENT",
    "PICKING": "FULFILLMENT",
    "PACKED": "FULFILLMENT",
    "SHIPPED": "LOGISTICS",
    "DELIVERED": "LOGISTICS",
    "CANCELED": "SYSTEM",
}
HOLD = "HOLD"
# The rollup counts both spellings as held.
HELD_STATUSES = ["HOLD", "ORDER_HOLD"]
IN_PROGRESS_STATUSES = ["PICKING", "PACKED", "SHIPPED"]
COMPLETED_STATUSES = ["DELIVERED", "CANCELED"]

# Reason codes.
FUL_VALID = "FUL-VALID"
FUL_INV = "FUL-INV"
FRAUD_USER = "FUL-FRAUD-USER"
FRAUD_PRODUCT = "FUL-FRAUD-PROD"
SYSTEM_HOLD = "SYSTEM_HOLD"

# Dead-letter kinds.
EMPTY_JSON = "EMPTY_JSON"
NOT_OBJECT = "NOT_OBJECT"
PARSE_ERROR = "PARSE_ERROR"

# Alert states, with the metrics column that counts each.
ALERT_COUNTERS = {
    "OPEN": "alerts_open",
    "ACK": "alerts_ack",
    "RESOLVED": "alerts_resolved",
    "RETRY_REQUESTED": "alerts_retry",
}

# Substrings that mark an address as unusable (case-sensitive).
BAD_ADDRESS_KEYWORDS = ["?", "Unknown", "123", "NULL"]

# Columns of one metrics window, without its key.
FLOW_COLUMNS = ["orders", "payments", "shipped", "holds"]
INGEST_COLUMNS = ["ingest_count", "parse_errors", "schema_missing"]
SNAPSHOT_COLUMNS = ["backlog", "holds_now", "late_orders"]
EVENT_COLUMNS = ["event_total", "event_errors"]
ALERT_COLUMNS = list(ALERT_COUNTERS.values())

# The fields of the wire format.
_MESSAGE_FIELDS = [
    "event_id", "order_id", "user_id", "customer_id", "product_id", "product_name",
    "shipping_address", "address", "current_stage", "current_status",
    "last_event_type", "event_type", "event_produced_at", "created_at",
    "last_occurred_at", "occurred_at", "reason_code", "hold_reason_code",
    "hold_ops_status", "hold_ops_note", "hold_ops_comment",
    "hold_ops_operator", "hold_ops_user", "hold_ops_updated_at",
]
# Every field is text: objects under an address arrive as their JSON text.
MESSAGE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in _MESSAGE_FIELDS])


def quoted(values: Iterable[str | None]) -> str:
    """Values as a comma-separated list of SQL literals."""
    escaped = lambda v: v.replace("\\", "\\\\").replace("'", "\\'")
    return ", ".join("NULL" if v is None else f"'{escaped(v)}'" for v in values)


def stage_of(status: str) -> str:
    """Stage of a status; null for statuses without one (HOLD keeps the order's stage)."""
    pairs = quoted(x for item in STAGE_OF_STATUS.items() for x in item)
    return f"try_element_at(map({pairs}), {status})"
