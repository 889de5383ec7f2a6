"""Expressions that turn a decoded message into ledger fields."""

from __future__ import annotations

from holdfast.functions.times import instant_text
from holdfast.vocabulary import HOLD

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"

# Rewrites that bring accepted time texts to one zoned ISO form.
TIME_REWRITES = [
    (r"([+-]\d\d)(\d\d)$", "$1:$2"),
    (r"^(\d{4}-\d\d-\d\d)$", "$1T00:00:00Z"),
    (r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3T00:00:00Z"),
    (r"^(\d{4}-\d\d-\d\d[T ][^Z+-]*)$", "$1Z"),
]
ZONED_ISO = r"^\d{4}-\d\d-\d\d[T ].*$"


def first_filled(*values: str) -> str:
    """First value that is neither null nor the empty string."""
    return "coalesce(" + ", ".join(f"nullif({v}, '')" for v in values) + ")"


def is_filled(value: str) -> str:
    return f"(coalesce({value}, '') <> '')"


def event_type_of(record: str) -> str:
    found = first_filled(f"{record}.last_event_type", f"{record}.event_type", f"{record}.current_status")
    return f"coalesce({found}, 'UNKNOWN')"


def parse_event_time(text: str, default: str) -> str:
    """ISO text to an instant: naive text is UTC, missing or bad text is ``default``.

    The final match is needed because Spark also reads '2024' and '12:00' as times.
    """
    value = f"trim({text})"
    for pattern, form in TIME_REWRITES:
        value = f"regexp_replace({value}, r'{pattern}', '{form}')"
    return f"coalesce(try_cast(regexp_extract({value}, r'{ZONED_ISO}', 0) AS timestamp), {default})"


def name_digest(text: str, namespace: str = DNS_NAMESPACE) -> str:
    """The SHA-1 digest that a version 5 id of a text is cut from."""
    return f"sha1(concat(unhex('{namespace}'), encode({text}, 'utf-8')))"


def uuid5(digest: str) -> str:
    """RFC 4122 version 5 id from a digest column, all on the JVM side."""
    variant = f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (
        f"concat_ws('-', substr({digest}, 1, 8), substr({digest}, 9, 4), concat('5', substr({digest}, 14, 3)), "
        f"concat({variant}, substr({digest}, 18, 3)), substr({digest}, 21, 12))"
    )


def content_name(order_id: str, event_type: str, occurred_at: str, position: str) -> str:
    """The text an event's id is made from, so that replays collide.

    Without an order id the content says nothing, so the message position stands in.
    """
    content = f"concat_ws('|', {order_id}, {event_type}, {instant_text(occurred_at)})"
    return f"CASE WHEN {is_filled(order_id)} THEN {content} ELSE {position} END"


def order_offset_name(order_id: str, topic: str, partition: str, offset: str) -> str:
    """The text of profiles that name an event by its order and position.

    An offset alone repeats in every partition, and an order may have no id.
    """
    return f"concat_ws('_', coalesce({order_id}, ''), {topic}, CAST({partition} AS string), CAST({offset} AS string))"


def ledger_status(current_status: str, event_type: str) -> str:
    return f"coalesce({first_filled(current_status, event_type)}, 'UNKNOWN')"


def default_stage(stage: str) -> str:
    return f"coalesce({stage}, 'PAYMENT')"


def default_status(status: str) -> str:
    return f"coalesce({status}, 'PAID')"


def default_type(event_type: str) -> str:
    return f"coalesce({event_type}, 'ORDER_CREATED')"


def held_status(reason: str, status: str) -> str:
    """HOLD when a rule gave a reason, else the order's own status."""
    return f"CASE WHEN {reason} IS NOT NULL THEN '{HOLD}' ELSE {status} END"
