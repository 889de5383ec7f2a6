"""From decoded messages to raw rows, ledger rows and the snapshot, per profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from holdfast.functions.normalize import (
    content_name, default_stage, default_status, default_type, event_type_of, first_filled, is_filled, ledger_status, name_digest, order_offset_name,
    parse_event_time, uuid5,
)
from holdfast.functions.times import seconds_between
from holdfast.operators import quarantine, rules, snapshot
from holdfast.session import staged
from holdfast.sources.messages import ARRIVAL, decode_messages, land_raw, split_bad
from holdfast.sources.tables import append_ledger
from holdfast.vocabulary import HOLD

PROFILES = ["ingest", "paid_anomaly", "cascade", "anchored"]
LEDGER_COLUMNS = ["event_id", "order_id", "event_type", "current_status", "reason_code", "occurred_at", "ingested_at"]
ENVELOPE_COLUMNS = ["topic", "partition", "offset", "value", "ingested_at"]
_POSITION = "concat_ws('|', topic, CAST(partition AS string), CAST(offset AS string))"


def latency_columns(produced: str, received: str, stored: str) -> dict[str, str]:
    """Seconds from producer to broker and from producer to the table."""
    return {
        "latency_p_to_k_sec": seconds_between(produced, received),
        "latency_p_to_d_sec": seconds_between(produced, stored),
    }


def normalize(good: DataFrame) -> DataFrame:
    """Usable messages with normalised fields; the envelope stays."""
    hold_time = f"CASE WHEN {first_filled('record.hold_ops_updated_at')} IS NOT NULL THEN {parse_event_time('record.hold_ops_updated_at', 'ingested_at')} END"
    fields = {
        "seq": ARRIVAL,
        "order_id": "record.order_id",
        "user_id": first_filled("record.user_id", "record.customer_id"),
        "product_id": "record.product_id",
        "product_name": "record.product_name",
        # Text fields of the record hold nested addresses as their JSON text.
        "shipping_address": first_filled("record.shipping_address", "record.address"),
        "current_stage": "record.current_stage",
        "current_status": "record.current_status",
        "event_type": event_type_of("record"),
        "given_type": first_filled("record.last_event_type", "record.event_type"),
        "occurred_at": parse_event_time(first_filled("record.last_occurred_at", "record.occurred_at"), "ingested_at"),
        "created_at": parse_event_time("record.created_at", "ingested_at"),
        "event_produced_at": parse_event_time("record.event_produced_at", "ingested_at"),
        "reason_code": first_filled("record.reason_code", "record.hold_reason_code"),
        "hold_ops_status": "record.hold_ops_status",
        "hold_ops_note": first_filled("record.hold_ops_note", "record.hold_ops_comment"),
        "hold_ops_operator": first_filled("record.hold_ops_operator", "record.hold_ops_user"),
        "hold_ops_updated_at": hold_time,
        "given_event_id": "record.event_id",
    }
    return good.selectExpr(*ENVELOPE_COLUMNS, *[f"{e} AS {n}" for n, e in fields.items()])


def with_columns(df: DataFrame, new: dict[str, str]) -> DataFrame:
    """The frame with columns added or replaced by expressions."""
    kept = [c for c in df.columns if c not in new]
    return df.selectExpr(*kept, *[f"{e} AS {n}" for n, e in new.items()])


def classify(rows: DataFrame, products: DataFrame | None, profile: str, **options) -> DataFrame:
    """Normalised rows with the profile's ``reason``, ``hold_reason`` and final status."""
    if profile == "ingest":
        return with_columns(rows, {"reason": "reason_code", "hold_reason": "reason_code"})
    if profile in ("cascade", "anchored"):
        rows = with_columns(rows, {"current_stage": default_stage("current_stage"), "current_status": default_status("current_status")})
    if profile == "cascade":
        decided = rules.classify_cascade(rows, products, **options)
    elif profile == "paid_anomaly":
        decided = rules.classify_paid(rows, products, **options)
    elif profile == "anchored":
        decided = rules.classify_anchored(rows, **options)
    else:
        raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
    return rules.hold_decision(decided, profile)


def with_event_id(rows: DataFrame, profile: str) -> DataFrame:
    """Adds the ledger's type, status and id of each row, by profile."""
    if profile == "paid_anomaly":
        new = {
            "ledger_type": f"CASE WHEN current_status = '{HOLD}' THEN '{HOLD}' ELSE event_type END",
            "ledger_status": f"coalesce({first_filled('current_status')}, 'UNKNOWN')",
        }
    elif profile == "ingest":
        new = {"ledger_type": "event_type", "ledger_status": ledger_status("current_status", "event_type")}
    else:
        # Without a type the anchored ledger shows the stage, the order the default type.
        anchored_type = f"coalesce(given_type, {default_stage('current_stage')})"
        new = {"ledger_type": "'ORDER_CREATED'" if profile == "cascade" else anchored_type, "ledger_status": "current_status"}
    rows = with_columns(rows, new)
    given = is_filled("given_event_id") if profile in ("ingest", "paid_anomaly") else "false"
    name = order_offset_name("order_id", "topic", "partition", "offset")
    if profile in ("ingest", "paid_anomaly"):
        name = content_name("order_id", "ledger_type", "occurred_at", _POSITION)
    digested = rows.selectExpr("*", f"{name_digest(name)} AS _digest")
    return digested.selectExpr("* EXCEPT (_digest)", f"CASE WHEN {given} THEN given_event_id ELSE {uuid5('_digest')} END AS event_id")


@dataclass(frozen=True)
class Intake:
    """Everything one run of a profile produces."""

    raw: DataFrame
    ledger: DataFrame
    orders: DataFrame
    rejects: DataFrame | None
    errors: DataFrame
    held: DataFrame


def snapshot_input(rows: DataFrame, profile: str, stored_at: str = "ingested_at") -> DataFrame:
    """Classified rows as the writes a profile makes to the snapshot.

    ``stored_at`` is the moment of the write, an expression; nothing here reads a clock.
    """
    if profile in ("ingest", "paid_anomaly"):
        status = "current_status" if profile == "ingest" else "ledger_status"
        new = {"last_event_type": "event_type", "last_occurred_at": "occurred_at", "hold_reason_code": "hold_reason", "current_status": status}
    else:
        last_type = "'ORDER_CREATED'" if profile == "cascade" else default_type("given_type")
        new = {"last_event_type": last_type, "last_occurred_at": "created_at", "hold_reason_code": "hold_reason"}
        new |= latency_columns("event_produced_at", "ingested_at", stored_at)
    return with_columns(rows, new)


def ledger_input(rows: DataFrame, profile: str, *more: str) -> DataFrame:
    """Classified rows as ledger rows, still with ``seq``, and ``more`` expressions over the classified ones."""
    own_time = profile in ("cascade", "anchored")
    occurred, ingested = ("created_at", "created_at") if own_time else ("occurred_at", "ingested_at")
    return rows.selectExpr(
        "event_id", "seq", "order_id", "ledger_type AS event_type", "ledger_status AS current_status", "hold_reason AS reason_code",
        f"{occurred} AS occurred_at", f"{ingested} AS ingested_at", *more,
    )


def process(
    messages: DataFrame, products: DataFrame | None, profile: str, stored_ledger: DataFrame | None = None, stored_at: str = "ingested_at", **options
) -> Intake:
    """Runs a profile over a batch of envelopes; ``stored_at`` is the moment of the write.

    Raw rows, ledger, snapshot and rejects are separate frames, so a reject never costs a
    raw or ledger row. Rows classified once are staged, since several outputs read them.
    """
    good, errors = split_bad(decode_messages(messages))
    rows = staged(with_event_id(classify(normalize(good), products, profile, **options), profile), "classified")
    source = {"source": "'ANOMALY_CONSUMER'", "final_status": "ledger_status", "hold_reason": "hold_reason"}
    raw = land_raw(rows, source if profile == "paid_anomaly" else None)

    writes = snapshot_input(rows, profile, stored_at)
    orders = snapshot.fold_orders(writes, profile)
    entries = ledger_input(rows, profile)
    rejects = snapshot.rejected_rows(writes) if profile in ("ingest", "paid_anomaly") else None
    kept = [c for c in orders.columns if c not in ("current_status", "hold_reason_code")]
    if profile == "cascade":
        quarantined = quarantine.quarantine_cascade(rows)
        orders = orders.select(*kept).join(quarantine.quarantine_orders(rows), "order_id")
        marked = quarantine.quarantine_ledger(entries.withColumnRenamed("reason_code", "reason"), quarantined)
        entries = marked.withColumnRenamed("reason", "reason_code").select(*entries.columns)
    elif profile == "anchored":
        orders = orders.select(*kept).join(quarantine.quarantine_pair(rows), "order_id")
    ledger = append_ledger(stored_ledger, entries).select(*LEDGER_COLUMNS)
    held = rows.where("reason IS NOT NULL").select("event_id", "order_id", "reason", "created_at")
    return Intake(raw, ledger, orders, rejects, errors, held)
