"""Odd inputs: padded keys, positions in several partitions, missing types, rejected requests, user text."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from holdfast.operators import intake, lists, ops, rules
from holdfast.sources.messages import ENVELOPE

from test_intake import T0, message

AT = datetime(2026, 2, 1, 9, 0)


def test_cascade_ignores_blanks_around_keys(spark):
    products = spark.createDataFrame([("P1", "one", 5)], "product_id string, product_name string, stock int")
    rows = [(i, [" u ", "u"][i % 2], [" P1 ", "P1"][i % 2], "an address", AT + timedelta(milliseconds=10 * i)) for i in range(7)]
    df = spark.createDataFrame(rows, "seq bigint, user_id string, product_id string, shipping_address string, created_at timestamp_ntz")
    got = {r.seq: (r.reason, r.user_id) for r in rules.classify_cascade(df, products).collect()}
    assert got == {i: ("FUL-FRAUD-USER" if i >= 5 else None, rows[i][1]) for i in range(7)}


def test_positions_of_several_partitions_are_several_events(spark):
    import json

    text = json.dumps(message(order_id="-"))
    envelopes = spark.createDataFrame([("event", p, 7, text, T0) for p in (0, 1)], ENVELOPE)
    products = spark.createDataFrame([("P1", "one", 5)], "product_id string, product_name string, stock int")
    out = intake.process(envelopes, products, "cascade")
    assert out.raw.count() == 2 and out.ledger.count() == 2


def test_anchored_types_default(spark):
    import json

    text = json.dumps(message(last_event_type="-"))
    out = intake.process(spark.createDataFrame([("event", 0, 1, text, T0)], ENVELOPE), None, "anchored")
    assert out.ledger.first().event_type == "PAYMENT"
    assert out.orders.first().last_event_type == "ORDER_CREATED"


def test_rejected_requests(spark):
    rows = [(1, "event:1", "ack"), (2, "bad", "ack"), (3, "hold:1", "shout"), (4, None, None), (5, "event:2", None)]
    df = spark.createDataFrame([(*r, None, "op", AT) for r in rows], "seq bigint, alert_key string, request string, note string, operator string, at timestamp_ntz")
    wrong = {r.seq: r.error_type for r in ops.rejected_requests(df).collect()}
    assert wrong == {2: "BAD_KEY", 3: "UNKNOWN_REQUEST", 4: "BAD_KEY", 5: "UNKNOWN_REQUEST"}
    assert {r.seq for r in ops.requests_to_actions(df).collect()} | set(wrong) == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("text", ["\\' OR 1=1 -- ", "' OR '1'='1", "\\", "a\\", 'x"y'])
def test_user_text_is_only_text(spark, text):
    columns = ", ".join(f"{c} {'timestamp_ntz' if c.endswith('_at') else 'string'}" for c in lists.ORDER_COLUMNS)
    row = lambda i: tuple(AT if c.endswith("_at") else i if c == "order_id" else "S" for c in lists.ORDER_COLUMNS)
    orders = spark.createDataFrame([row("plain"), row(f"has {text} in it")], columns)
    assert lists.orders_page(orders, status=text).count() == 0
    assert [r.order_id for r in lists.orders_page(orders, q=text).collect()] == [f"has {text} in it"]
