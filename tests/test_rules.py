"""Scenario fixtures of the rules and the quarantine."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from holdfast.operators import quarantine, rules
from holdfast.plans.segments import Split

T0 = datetime(2026, 2, 1, 9, 30)
TINY = Split(min_rows=4, samples=10**6, per_segment=2)
ROW = "seq bigint, order_id string, user_id string, product_id string, shipping_address string, current_stage string, current_status string, created_at timestamp_ntz"


def order(seq, at=0.0, user="kim", product="P1", address="Seoul street 1", status="PAID", stage="PAYMENT", order_id=None):
    return (seq, order_id or f"o{seq}", user, product, address, stage, status, T0 + timedelta(seconds=at))


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


@pytest.fixture(scope="module")
def products(spark):
    stock = [("P1", "one", 5), ("P0", "none", 0), ("PM", "minus", -1), ("PN", "unknown stock", None)]
    return spark.createDataFrame(stock, "product_id string, product_name string, stock int")


def reasons(df):
    return {r.seq: r.reason for r in df.collect()}


def test_required_and_address(spark, products):
    rows = [
        order(1), order(2, user=""), order(3, address=""), order(4, user="  ", address=""), order(5, user=None), order(6, address="1234"),
        order(7, address="road 123"), order(8, address="Unknown rd"), order(9, address="unknown rd"), order(10, address="what?"),
        order(11, address="NULL road"), order(12, product=None),
    ]
    df = frame(spark, [(*r[:7], r[7] + timedelta(minutes=r[0])) for r in rows])
    cascade = reasons(rules.classify_cascade(df, products))
    assert {s for s, r in cascade.items() if r == "FUL-VALID"} == {2, 3, 4, 5, 6, 12}
    anchored = reasons(rules.classify_anchored(df))
    assert {s for s, r in anchored.items() if r == "FUL-VALID"} == {3, 5, 2, 4, 6, 7, 8, 10, 11} and anchored[9] is None


def test_stock(spark, products):
    names = ["P1", "P0", "PM", "PN", "gone"]
    df = frame(spark, [order(i, at=100 * i, user=f"u{i}", product=p) for i, p in enumerate(names)]).withColumn("occurred_at", __import__("pyspark").sql.functions.col("created_at"))
    assert [reasons(rules.classify_cascade(df, products))[i] for i in range(5)] == [None, "FUL-INV", "FUL-INV", None, "FUL-VALID"]
    assert [reasons(rules.classify_paid(df, products))[i] for i in range(5)] == [None, "FUL-INV", "FUL-INV", None, "FUL-INV"]
    shipped = df.withColumn("current_status", __import__("pyspark").sql.functions.lit("SHIPPED"))
    assert set(reasons(rules.classify_paid(shipped, products)).values()) == {None}


def test_user_burst_and_quarantine(spark, products):
    df = frame(spark, [order(i, at=0.5 * i, product=f"P{1 if i % 2 else 1}") for i in range(8)])
    # Half a second apart: product windows of 1 s hold three rows only.
    decided = rules.hold_decision(rules.classify_cascade(df, products), "cascade").cache()
    assert [reasons(decided)[i] for i in range(8)] == [None] * 5 + ["FUL-FRAUD-USER"] * 3
    final = {r.order_id: (r.current_status, r.hold_reason_code) for r in quarantine.quarantine_orders(decided).collect()}
    assert set(final.values()) == {("HOLD", "FUL-FRAUD-USER")} and len(final) == 8


def test_product_burst(spark, products):
    rows = [order(i, at=0.05 * i, user=f"u{i}") for i in range(8)]
    df = frame(spark, rows)
    decided = rules.hold_decision(rules.classify_cascade(df, products), "cascade").cache()
    assert [reasons(decided)[i] for i in range(8)] == [None] * 5 + ["FUL-FRAUD-PROD"] * 3
    assert {r.hold_reason_code for r in quarantine.quarantine_orders(decided).collect()} == {"FUL-FRAUD-PROD"}
    paid = rules.classify_paid(df.withColumnRenamed("created_at", "occurred_at"), products)
    assert [reasons(paid)[i] for i in range(8)] == [None] * 3 + ["FUL-FRAUD-PROD"] * 5


def test_burst_edges_and_ties(spark, products):
    exact = frame(spark, [order(i, at=2.0 * i) for i in range(6)])
    assert reasons(rules.classify_cascade(exact, products))[5] == "FUL-FRAUD-USER"
    beyond = frame(spark, [order(i, at=2.0 * i + (0.000001 if i == 5 else 0)) for i in range(6)])
    assert reasons(rules.classify_cascade(beyond, products))[5] is None
    ties = frame(spark, [order(i, at=0.0) for i in range(7)])
    assert [reasons(rules.classify_cascade(ties, products))[i] for i in range(7)] == [None] * 5 + ["FUL-FRAUD-USER"] * 2


def test_rejected_rows_do_not_count(spark, products):
    rows = [order(i, at=0.1 * i, product="P0" if i < 4 else "P1", address="Seoul street") for i in range(9)]
    got = reasons(rules.classify_cascade(frame(spark, rows), products))
    assert [got[i] for i in range(9)] == ["FUL-INV"] * 4 + [None] * 5


def test_anchor_window_and_stage_hold(spark):
    at = [0, 1, 2, 3, 4, 5, 9, 11, 12]
    df = frame(spark, [order(i, at=a) for i, a in enumerate(at)])
    got = reasons(rules.classify_anchored(df))
    assert {at[i] for i, r in got.items() if r} == {5, 9}
    held = rules.hold_decision(rules.classify_anchored(frame(spark, [order(1, stage="HOLD")])), "anchored").first()
    assert (held.current_status, held.hold_reason, held.current_stage) == ("HOLD", "SYSTEM_HOLD", "HOLD")


CLASSIFIED = "seq bigint, order_id string, user_id string, product_id string, created_at timestamp_ntz, reason string, hold_reason string, current_status string"


def classified(spark, rows):
    return spark.createDataFrame(rows, CLASSIFIED)


def test_lookback_and_last_trigger(spark):
    user, product = "FUL-FRAUD-USER", "FUL-FRAUD-PROD"
    ago = lambda s: T0 - timedelta(seconds=s)
    rows = [
        (1, "a59", "u", "p", ago(59), None, None, "PAID"), (2, "a60", "u", "p", ago(60), None, None, "PAID"),
        (3, "a61", "u", "p", ago(61), None, None, "PAID"), (4, "t1", "u", "x", T0, user, user, "HOLD"),
        (5, "t2", "v", "p", T0, product, product, "HOLD"), (6, "later", "u", "y", T0, None, None, "PAID"),
    ]
    got = {r.order_id: (r.current_status, r.hold_reason_code) for r in quarantine.quarantine_orders(classified(spark, rows)).collect()}
    assert got == {
        "a59": ("HOLD", product), "a60": ("HOLD", product), "a61": ("PAID", None), "t1": ("HOLD", user), "t2": ("HOLD", product),
        "later": ("PAID", None),
    }


def _random_rows(rng, trial, n):
    """Orders, users and products of one trial never meet another trial's."""
    rows = []
    for i in range(n):
        reason = rng.choice([None, None, None, "FUL-INV", "FUL-FRAUD-USER", "FUL-FRAUD-PROD"])
        status = "HOLD" if reason else rng.choice(["PAID", "SHIPPED", "HOLD"])
        at = T0 + timedelta(seconds=rng.randrange(0, 200))
        rows.append((trial * 1000 + i, f"o{trial}-{rng.randrange(5)}", f"u{trial}-{rng.randrange(2)}", f"p{trial}-{rng.randrange(2)}", at, reason, reason, status))
    return rows


def _cascade_loop(rows):
    """Row by row: write the order, then let a trigger update orders and their rows."""
    orders, ledger = {}, {}
    for seq, oid, user, product, at, reason, _, status in rows:
        if oid not in orders:
            orders[oid] = {"user": user, "product": product, "created": at, "status": status, "reason": reason}
        else:
            o = orders[oid]
            o["status"] = "HOLD" if "HOLD" in (o["status"], status) else status
            o["reason"] = o["reason"] if o["reason"] is not None else reason
        ledger[seq] = (oid, status, reason)
        if reason in ("FUL-FRAUD-USER", "FUL-FRAUD-PROD"):
            field, value = ("user", user) if reason == "FUL-FRAUD-USER" else ("product", product)
            hit = {k for k, o in orders.items() if o[field] == value and o["created"] >= at - timedelta(seconds=60)}
            for k in hit:
                orders[k]["status"], orders[k]["reason"] = "HOLD", reason
            for s, (k, _, _) in list(ledger.items()):
                if k in hit:
                    ledger[s] = (k, "HOLD", reason)
    return orders, ledger


def _pair_loop(rows):
    orders = {}
    for seq, oid, user, product, at, reason, hold_reason, status in rows:
        if oid not in orders:
            orders[oid] = {"user": user, "product": product, "created": at}
        orders[oid] |= {"status": status, "reason": hold_reason}
        if reason == "FUL-FRAUD-USER":
            for k, o in orders.items():
                same = o["user"] == user and o["product"] == product and k != oid
                if same and o["created"] >= at - timedelta(seconds=15) and o["status"] != "HOLD":
                    o["status"], o["reason"] = "HOLD", reason
    return orders


@pytest.mark.parametrize("split", [Split(), TINY])
def test_quarantine_equals_loops(spark, split):
    rng = random.Random(7)
    trials = [_random_rows(rng, t, 14) for t in range(120)]
    df = classified(spark, [r for rows in trials for r in rows]).cache()
    quarantined = quarantine.quarantine_cascade(df, split=split)
    orders = {r.order_id: (r.current_status, r.hold_reason_code) for r in quarantine.quarantine_orders(df, split=split).collect()}
    ledger = {r.seq: (r.current_status, r.reason) for r in quarantine.quarantine_ledger(df, quarantined).collect()}
    pairs = {r.order_id: (r.current_status, r.hold_reason_code) for r in quarantine.quarantine_pair(df, split=split).collect()}
    for rows in trials:
        want_orders, want_ledger = _cascade_loop(rows)
        for oid, o in want_orders.items():
            assert orders[oid] == (o["status"], o["reason"])
        for seq, (_, status, reason) in want_ledger.items():
            assert ledger[seq] == (status, reason)
        for oid, o in _pair_loop(rows).items():
            assert pairs[oid] == (o["status"], o["reason"])
