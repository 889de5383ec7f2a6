"""Messages, normalisation, snapshot gate and the profiles end to end."""

from __future__ import annotations

import json
import random
import uuid
from datetime import datetime, timedelta, timezone

import pytest

from holdfast.functions.normalize import content_name, name_digest, parse_event_time, uuid5
from holdfast.operators import intake, snapshot
from holdfast.sources.messages import ENVELOPE, decode_messages, split_bad
from holdfast.sources.tables import alert_payloads

T0 = datetime(2026, 2, 1, 0, 30, tzinfo=timezone.utc)


def message(**changes):
    base = {
        "order_id": "ord-1", "user_id": "kim01", "product_id": "P1", "product_name": "책", "shipping_address": "서울 강남구 1",
        "current_status": "PAID", "current_stage": "PAYMENT", "event_produced_at": "2026-02-01T09:30:00+09:00",
        "created_at": "2026-02-01T09:30:00.700000+09:00", "last_occurred_at": "2026-02-01T09:30:00.700000+09:00",
        "occurred_at": "2026-02-01T09:30:00+09:00", "last_event_type": "ORDER_CREATED",
    } | changes
    return {k: v for k, v in base.items() if v != "-"}


def envelopes(spark, texts):
    texts = [t if isinstance(t, str) or t is None else json.dumps(t, ensure_ascii=False) for t in texts]
    return spark.createDataFrame([("event", 0, i, t, T0 + timedelta(seconds=i)) for i, t in enumerate(texts)], ENVELOPE)


def normal(spark, messages):
    good, _ = split_bad(decode_messages(envelopes(spark, messages)))
    return {r.offset: r for r in intake.normalize(good).collect()}


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([("P1", "book", 5), ("P0", "gone", 0)], "product_id string, product_name string, stock int")


def test_dead_letters(spark):
    texts = ["{}", "null", "[]", "[1]", "{bad", "", " { } ", message(), None, "7", "0"]
    good, errors = split_bad(decode_messages(envelopes(spark, texts)))
    kinds = {r.kafka_offset: r.error_type for r in errors.collect()}
    assert kinds == {
        0: "EMPTY_JSON", 1: "EMPTY_JSON", 2: "EMPTY_JSON", 3: "NOT_OBJECT", 4: "PARSE_ERROR", 5: "PARSE_ERROR", 6: "EMPTY_JSON",
        8: "PARSE_ERROR", 9: "NOT_OBJECT", 10: "EMPTY_JSON",
    }
    assert [r.offset for r in good.collect()] == [7]


def test_times(spark):
    at = datetime(2026, 2, 1, 9, 30)
    cases = {
        "2026-02-01T09:30:00Z": at, "2026-02-01T18:30:00+09:00": at, "2026-02-01T18:30:00+0900": at, "2026-02-01T09:30:00": at,
        "2026-02-01 09:30:00.25": at.replace(microsecond=250000), "20240101": datetime(2024, 1, 1), "2024-01-01": datetime(2024, 1, 1),
        "2024": None, "12:00": None, "soon": None, "": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = df.selectExpr("t", f"{parse_event_time('t', 'CAST(NULL AS timestamp)')} AS at").collect()
    utc = lambda v: v and v.astimezone(timezone.utc).replace(tzinfo=None)
    assert {r.t: utc(r.at) for r in got} == cases


def test_aliases(spark):
    rows = normal(
        spark,
        [
            message(user_id="", customer_id="lee"), message(user_id="-", customer_id="lee"), message(customer_id="lee"),
            message(shipping_address={"city": "Seoul"}), message(shipping_address="-", address=["a", "b"]),
            message(last_event_type="", event_type="-"), message(last_event_type="-", event_type="MOVED"),
            message(last_event_type="-", event_type="-", current_status="-"), message(hold_reason_code="FUL-INV", hold_ops_comment="c", hold_ops_user="u"),
            message(last_occurred_at="bad"),
        ],
    )
    assert [rows[i].user_id for i in range(3)] == ["lee", "lee", "kim01"]
    assert json.loads(rows[3].shipping_address) == {"city": "Seoul"} and json.loads(rows[4].shipping_address) == ["a", "b"]
    assert [rows[i].event_type for i in (5, 6, 7)] == ["PAID", "MOVED", "UNKNOWN"]
    assert (rows[8].reason_code, rows[8].hold_ops_note, rows[8].hold_ops_operator) == ("FUL-INV", "c", "u")
    assert rows[9].occurred_at == rows[9].ingested_at


def test_uuid5_equals_python(spark):
    df = spark.createDataFrame([(f"o{i}",) for i in range(50)], "o string").selectExpr("o", "TIMESTAMP '2026-02-01 00:30:00Z' AS t")
    named = df.selectExpr("*", f"{name_digest(content_name('o', chr(39) + 'PAID' + chr(39), 't', 'o'))} AS d").selectExpr("o", f"{uuid5('d')} AS id")
    for r in named.collect():
        assert r.id == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{r.o}|PAID|2026-02-01T00:30:00.000000+00:00"))


ROW = "seq bigint, order_id string, user_id string, product_id string, product_name string, shipping_address string, current_stage string, " \
    "current_status string, last_event_type string, last_occurred_at timestamp_ntz, hold_reason_code string, ingested_at timestamp_ntz"


def test_gate_and_fill_equal_a_loop(spark):
    rng = random.Random(5)
    maybe = lambda v: rng.choice([v, v, None, ""])
    naive = T0.replace(tzinfo=None)
    rows = []
    for seq in range(3000):
        o = rng.choice([f"o{rng.randrange(500)}"] * 30 + [None, ""])
        rows.append((seq, o, maybe(f"u{seq}"), maybe(f"p{seq}"), maybe(f"n{seq}"), maybe(f"a{seq}"), maybe("S"), maybe(f"st{seq}"), f"t{seq}",
                     naive + timedelta(seconds=seq), rng.choice([None, "R"]), naive + timedelta(seconds=seq)))
    stored, rejected = {}, {}
    for seq, o, *filled, stage, status, kind, at, reason, ingested in rows:
        missing = [n for n, v in zip(["order_id", "current_stage", "current_status"], [o, stage, status]) if not v]
        if o and o in stored:
            filled = [v or w for v, w in zip(filled, stored[o][:4])]
        missing += [n for n, v in zip(snapshot.FILLED_FORWARD, filled) if not v]
        if missing:
            rejected[seq] = missing
        else:
            stored[o] = (*filled, stage, status, kind, at, reason, seq, stored[o][-1] if o in stored else ingested)
    df = spark.createDataFrame(rows, ROW)
    got = {
        r.order_id: (r.user_id, r.product_id, r.product_name, r.shipping_address, r.current_stage, r.current_status, r.last_event_type,
                     r.last_occurred_at, r.hold_reason_code, r.raw_reference, r.created_at)
        for r in snapshot.fold_orders(df, "ingest").collect()
    }
    assert got == stored
    assert {r.seq: r.missing for r in snapshot.rejected_rows(df).collect()} == rejected


def test_sticky_hold(spark):
    base = ("kim", "P1", "n", "addr 1", "PAYMENT")
    naive = T0.replace(tzinfo=None)
    rows = [(i, "o", *base, s, "ORDER_CREATED", naive, r, naive) for i, (s, r) in enumerate([("HOLD", "A"), ("PAID", None), ("HOLD", "B")])]
    row = snapshot.fold_orders(spark.createDataFrame(rows, ROW), "cascade").first()
    assert (row.current_status, row.hold_reason_code) == ("HOLD", "A")


def test_operator_changes(spark):
    naive = T0.replace(tzinfo=None)
    orders = spark.createDataFrame(
        [("a", "P1", "HOLD", "E", naive, "R"), ("b", "P1", "HOLD", "E", naive, "R"), ("c", "PX", "HOLD", "E", naive, "R")],
        "order_id string, product_id string, current_status string, last_event_type string, last_occurred_at timestamp_ntz, hold_reason_code string",
    )
    products = spark.createDataFrame([("P1",)], "product_id string")
    later = naive + timedelta(hours=1)
    actions = spark.createDataFrame(
        [(1, "a", "PAID", later), (2, "a", "HOLD", later), (3, "b", "HOLD", later), (4, "c", "PAID", later), (5, "zz", "PAID", later)],
        "seq bigint, order_id string, next_status string, at timestamp_ntz",
    )
    got = {r.order_id: (r.current_status, r.hold_reason_code) for r in snapshot.apply_status_change(orders, actions, products).collect()}
    assert got == {"a": ("HOLD", None), "b": ("HOLD", "R"), "c": ("HOLD", "R")}
    ledger = snapshot.status_change_ledger(orders, actions, products, "concat('e', seq)").collect()
    assert sorted(r.event_id for r in ledger) == ["e1", "e2", "e3"] and all(r.reason_code is None for r in ledger)
    cleared = {r.order_id: r for r in snapshot.clear_hold(orders, actions.where("order_id = 'a'")).collect()}
    assert (cleared["a"].current_status, cleared["a"].last_event_type, cleared["a"].hold_reason_code) == ("PAID", "HOLD_CLEARED", "R")


@pytest.mark.parametrize("profile", intake.PROFILES)
def test_profiles_end_to_end(spark, products, profile):
    texts = [message(), "{}", message(order_id="ord-2", user_id="", shipping_address=""), message(order_id="ord-3", product_id="P0"), message()]
    done = intake.process(envelopes(spark, texts), products, profile)
    raw = {r.kafka_offset: json.loads(r.raw_payload) for r in done.raw.collect()}
    assert sorted(raw) == [0, 2, 3, 4] and raw[0]["_meta"]["kafka_offset"] == 0 and raw[0]["product_name"] == "책"
    assert done.errors.count() == 1
    ledger = {r.event_id: r for r in done.ledger.collect()}
    orders = {r.order_id: r for r in done.orders.collect()}
    held = {r.order_id: r.reason for r in done.held.collect()}
    if profile == "ingest":
        assert len(ledger) == 3 and set(orders) == {"ord-1", "ord-3"} and held == {}
        assert [r.missing for r in done.rejects.collect()] == [["user_id", "shipping_address"]]
    elif profile == "paid_anomaly":
        assert len(ledger) == 3 and held == {"ord-3": "FUL-INV"} and orders["ord-3"].current_status == "HOLD"
    elif profile == "cascade":
        assert len(ledger) == 4 and held == {"ord-2": "FUL-VALID", "ord-3": "FUL-INV"}
        assert orders["ord-2"].current_status == "HOLD" and orders["ord-1"].current_status == "PAID"
        assert abs(orders["ord-1"].latency_p_to_k_sec) < 60
    else:
        assert held["ord-2"] == "FUL-VALID" and orders["ord-3"].current_status == "PAID"
    log = alert_payloads(done.held, "/orders/", "created_at").collect()
    assert len(log) == len([r for r in done.held.collect()])
    assert all(json.loads(r.alert_data)["attachments"][0]["fields"][1]["value"] == r.order_id for r in log)


def test_replay_keeps_the_first(spark, products):
    texts = [message(event_id="e1"), message(event_id="e1", current_status="SHIPPED"), message(), message()]
    first = intake.process(envelopes(spark, texts), products, "ingest").ledger
    rows = first.collect()
    assert len(rows) == 2 and {r.current_status for r in rows} == {"PAID"}
    again = intake.process(envelopes(spark, texts), products, "ingest", stored_ledger=first).ledger
    assert again.count() == 0
