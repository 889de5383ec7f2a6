"""Streams over several micro-batches against the batch operators."""

from __future__ import annotations

import json
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from holdfast.operators import intake, quarantine, rules, snapshot
from holdfast.operators.rules import Burst
from holdfast.plans.folds import AnchoredWindow, ArrivalBurst
from holdfast.session import scratch_path, staged
from holdfast.sources.messages import ENVELOPE, decode_messages, read_messages, split_bad
from holdfast.sources.tables import first_arrivals
from holdfast.streaming import intake as streamed
from holdfast.streaming import keyed, runner, windows
from holdfast.streaming.carried import _walking, carried

from test_intake import envelopes, message

T0 = datetime(2026, 2, 1, 9, 0)


def as_stream(spark, df, parts: int):
    """The frame as a file stream of one file per micro-batch, in the order of ``seq``."""
    path = scratch_path(spark, "source")
    rows = df.orderBy("seq").collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def collect(spark, stream, mode="append"):
    out = scratch_path(spark, "out")
    runner.run_available(stream, lambda df, b: runner.write_batch(df, b, f"{out}/rows"), f"{out}/checkpoint", mode)
    return runner.read_batches(spark, f"{out}/rows")


@pytest.mark.parametrize("anchored", [False, True])
def test_burst_state_crosses_batches(spark, anchored):
    rng = random.Random(11)
    burst = Burst(4.0, 2)
    rows = [(i, f"u{rng.randrange(4)}", "p", T0 + timedelta(seconds=rng.randrange(60))) for i in range(150)]
    df = spark.createDataFrame(rows, "seq bigint, user_id string, product_id string, created_at timestamp_ntz")
    if anchored:
        want, windows_of = {}, {}
        for seq, user, _, at in rows:  # in arrival order, times going back and forth
            first, seen = windows_of.get(user, (at, 0))
            if at > first + timedelta(seconds=burst.seconds):
                first, seen = at, 0
            windows_of[user] = (first, seen + 1)
            want[seq] = seen >= burst.limit
    else:
        flags = rules.burst_flag(df, ["user_id", "product_id"], burst, "burst", mode=rules.ARRIVAL)
        want = {r.seq: r.burst for r in flags.collect()}
    flagged = keyed.stream_burst(as_stream(spark, df, 4), ["user_id", "product_id"], burst, anchored=anchored)
    got = {r.seq: r.burst for r in collect(spark, flagged).collect()}
    assert got == want and any(got.values()) and len(got) == 150


def test_idle_keys_may_expire_on_an_endless_stream(spark):
    rows = [(i, "u", T0 + timedelta(seconds=i)) for i in range(20)]
    df = spark.createDataFrame(rows, "seq bigint, user_id string, created_at timestamp_ntz")
    flagged = keyed.stream_burst(as_stream(spark, df, 2), ["user_id"], Burst(4.0, 2), idle=timedelta(hours=1))
    out = scratch_path(spark, "out")
    writer = flagged.writeStream.foreachBatch(lambda d, b: runner.write_batch(d, b, f"{out}/rows")).option("checkpointLocation", f"{out}/checkpoint")
    query = writer.trigger(processingTime="1 second").start()
    deadline = time.time() + 90
    while sum(p["numInputRows"] for p in query.recentProgress) < 20 and time.time() < deadline and query.isActive:
        time.sleep(1)
    query.stop()
    got = runner.read_batches(spark, f"{out}/rows").collect()
    assert {r.seq: r.burst for r in got} == {i: i >= 2 for i in range(20)}


def test_windows_follow_late_rows(spark):
    late = [(1, "PAID", 0), (2, "HOLD", 5), (3, "SHIPPED", 40), (4, "PAID", 10), (5, "PAID", 300), (6, "PAID", 301), (7, "PAID", 1)]
    rows = [(i, s, None, T0 + timedelta(minutes=m)) for i, s, m in late]
    df = spark.createDataFrame(rows, "seq bigint, current_status string, ops_status string, ingested_at timestamp_ntz")
    updates = collect(spark, windows.stream_counts(as_stream(spark, df, 7)), "update")
    got = {r.window_start: (r.ingest_count, r.payments, r.event_errors) for r in windows.current_counts(updates).collect()}
    # The fourth row is late but within two hours; the last comes after the watermark has passed.
    assert got == {T0: (3, 2, 1), T0 + timedelta(minutes=30): (1, 0, 0), T0 + timedelta(minutes=300): (2, 2, 0)}


def test_dedup_across_batches(spark):
    # Copies come days apart, and the last row, never seen before, is days late.
    rows = [(i, f"e{i % 10}", T0 + timedelta(days=i)) for i in range(40)] + [(40, "late", T0 - timedelta(days=9))]
    df = spark.createDataFrame(rows, "seq bigint, event_id string, ingested_at timestamp_ntz")
    assert collect(spark, windows.stream_dedup(as_stream(spark, df, 4))).count() == 11


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    out = []
    for i in range(60):
        drop = rng.choice([{}, {}, {"user_id": ""}, {"current_stage": "-"}, {"shipping_address": "-"}])
        out.append(message(order_id=f"o{rng.randrange(12)}", last_event_type=f"T{i}", hold_reason_code=rng.choice(["-", "R"]), **drop))
    return out + ["{}", "{bad"]


def test_intake_in_batches_equals_one_batch(spark, texts):
    source = scratch_path(spark, "topic")
    all_rows = envelopes(spark, texts)
    rows = all_rows.collect()
    for i in range(0, len(rows), 16):
        spark.createDataFrame(rows[i:i + 16], ENVELOPE).coalesce(1).write.mode("append").parquet(source)
    out = scratch_path(spark, "tables")
    messages = read_messages(spark, "parquet", {"path": source, "maxFilesPerTrigger": "1"})
    streamed.run_intake(messages, None, "ingest", out, f"{out}-checkpoint")
    tables = streamed.read_intake(spark, out, "ingest")
    whole = scratch_path(spark, "whole")
    streamed.intake_batch(all_rows, 0, None, "ingest", whole)
    once = streamed.read_intake(spark, whole, "ingest")
    shown = ["order_id", "user_id", "shipping_address", "current_status", "last_event_type", "hold_reason_code", "raw_reference", "created_at"]
    rows_of = lambda t, cols: sorted(map(repr, t.select(*cols).collect()))
    assert rows_of(tables["orders"], shown) == rows_of(once["orders"], shown)
    assert rows_of(tables["ledger"], ["event_id", "reason_code"]) == rows_of(once["ledger"], ["event_id", "reason_code"])
    assert tables["errors"].count() == 2 and tables["raw"].count() == 60
    # A replayed batch changes nothing.
    before = rows_of(tables["orders"], shown)
    last = max(r.batch_id for r in tables["ledger"].select("batch_id").distinct().collect())
    replay = spark.createDataFrame(rows[16 * last:16 * last + 16], ENVELOPE)
    streamed.intake_batch(replay, last, None, "ingest", out)
    again = streamed.read_intake(spark, out, "ingest")
    assert rows_of(again["orders"], shown) == before and again["raw"].count() == 60


@pytest.mark.parametrize("profile", ["cascade", "paid_anomaly"])
def test_intake_with_products_runs_as_a_stream(spark, texts, profile):
    source, out = scratch_path(spark, "topic"), scratch_path(spark, "tables")
    envelopes(spark, texts).coalesce(1).write.parquet(source)
    path = scratch_path(spark, "products")
    spark.createDataFrame([("P1", "book", 5)], "product_id string, product_name string, stock int").write.parquet(path)
    messages = read_messages(spark, "parquet", {"path": source})
    streamed.run_intake(messages, lambda session: session.read.parquet(path), profile, out, f"{out}-checkpoint")
    tables = streamed.read_intake(spark, out, profile)
    assert tables["raw"].count() == 60 and tables["orders"].count() > 0
    again = scratch_path(spark, "tables")
    streamed.run_intake(messages, spark.read.parquet(path), profile, again, f"{again}-checkpoint")
    assert streamed.read_intake(spark, again, profile)["ledger"].count() == tables["ledger"].count()


@pytest.mark.parametrize("profile", ["anchored", "cascade", "paid_anomaly"])
def test_bursts_of_the_intake_cross_batches(spark, profile):
    """The size of a batch changes no verdict, with times going back and forth, and it is the plain loop's."""
    rng = random.Random(5)
    at = [T0 + timedelta(milliseconds=rng.randrange(20_000 if profile == "anchored" else 4_000)) for _ in range(40)]
    iso = [t.isoformat() + "Z" for t in at]
    texts = [message(order_id=f"o{i}", created_at=iso[i], last_occurred_at=iso[i], current_status="PAID") for i in range(40)]
    path = scratch_path(spark, "products")
    spark.createDataFrame([("P1", "book", 5)], "product_id string, product_name string, stock int").write.parquet(path)
    rows = envelopes(spark, texts).orderBy("ingested_at", "partition", "offset").collect()
    order = [json.loads(r.value)["order_id"] for r in rows]
    got = {}
    for batches in (1, 4):
        out, size = scratch_path(spark, "tables"), 40 // batches
        for b in range(batches):
            part = spark.createDataFrame(rows[b * size:(b + 1) * size], ENVELOPE)
            streamed.intake_batch(part, b, lambda s: s.read.parquet(path), profile, out)
        ledger = runner.read_batches(spark, f"{out}/ledger")  # as the rules decided, before the quarantine marks rows
        got[batches] = {r.order_id: r.reason_code for r in ledger.collect()}
    times = {f"o{i}": at[i] for i in range(40)}
    want = {"anchored": _anchored_loop, "cascade": _cascade_loop, "paid_anomaly": _paid_loop}[profile]([(o, times[o]) for o in order])
    assert got[1] == got[4] == want and len(set(want.values())) > 1


@pytest.mark.parametrize(
    ("profile", "batches"),
    [("ingest", 2), ("paid_anomaly", 2), ("cascade", 1), ("cascade", 10), ("anchored", 2)],
)
def test_any_number_of_batches_equals_one_pass(spark, profile, batches):
    """Orders, ledger and rejects of the intake, quarantine across batches included, are those of the whole topic."""
    rng = random.Random(17)
    texts = []
    for i in range(120):
        at = (T0 + timedelta(milliseconds=rng.randrange(150_000))).isoformat() + "Z"
        gaps = rng.choice([{}, {}, {}, {"user_id": ""}, {"product_name": ""}, {"current_stage": "-"}])
        given = {"event_id": f"given{rng.randrange(20)}"} if i % 11 == 0 else {}
        status = rng.choice(["PAID", "PAID", "PICKING", "HOLD"])
        names = {"order_id": f"o{rng.randrange(70)}", "user_id": f"u{rng.randrange(3)}", "product_id": f"P{rng.randrange(2)}"}
        texts.append(message(**(names | {"created_at": at, "last_occurred_at": at, "current_status": status} | gaps | given)))
    texts[40] = texts[3]
    rows = envelopes(spark, texts).orderBy("ingested_at", "partition", "offset").collect()
    products = spark.createDataFrame([("P0", "a", 9), ("P1", "b", 9)], "product_id string, product_name string, stock int")
    # more than three rows of a user within 30 s, of a product within 4 s; orders of the last 20 s are held as well
    user, item, pair = Burst(30.0, 3), Burst(4.0, 3), Burst(30.0, 3)
    limits = {"ingest": {}, "cascade": {"user_burst": user, "product_burst": item}, "paid_anomaly": {"burst": item}, "anchored": {"burst": pair}}[profile]
    out, size = scratch_path(spark, "tables"), 120 // batches
    for b in range(batches):
        part = spark.createDataFrame(rows[b * size:(b + 1) * size], ENVELOPE)
        streamed.intake_batch(part, b, products, profile, out, 20.0, **limits)
    tables = streamed.read_intake(spark, out, profile)

    good, _ = split_bad(decode_messages(spark.createDataFrame(rows, ENVELOPE)))
    normal = intake.normalize(good)
    if profile != "ingest":
        # the bursts in arrival order, by the operators over all rows; the anchored one is walked in one batch
        limits |= {"flag": carried(scratch_path(spark, "bursts"), 0, True)} if profile == "anchored" else {"mode": rules.ARRIVAL}
    classified = staged(intake.with_event_id(intake.classify(normal, products, profile, **limits), profile), "classified")
    writes = intake.snapshot_input(classified, profile)
    want = snapshot.fold_orders(writes, profile)
    entries = first_arrivals(intake.ledger_input(classified, profile)).withColumnRenamed("reason_code", "reason")
    shown = ["order_id", "user_id", "product_id", "current_stage", "raw_reference", "last_occurred_at", "created_at"]
    if profile in ("cascade", "anchored"):
        held = quarantine.quarantine_orders(classified, 20.0) if profile == "cascade" else quarantine.quarantine_pair(classified, 20.0)
        own = want.select("order_id", "current_status", "hold_reason_code")
        assert held.exceptAll(own).count() > 0, "some orders are held by others"
        want = want.drop("current_status", "hold_reason_code").join(held, "order_id")
    if profile == "cascade":
        entries = quarantine.quarantine_ledger(entries, quarantine.quarantine_cascade(classified, 20.0))
    rows_of = lambda df: sorted(map(repr, df.collect()))
    columns = [*shown, "current_status", "hold_reason_code"]
    assert rows_of(tables["orders"].select(*columns)) == rows_of(want.select(*columns))
    of_ledger = ["event_id", "order_id", "event_type", "current_status", "occurred_at"]
    assert rows_of(tables["ledger"].selectExpr(*of_ledger, "reason_code AS reason")) == rows_of(entries.select(*of_ledger, "reason"))
    if profile in ("ingest", "paid_anomaly"):
        assert rows_of(tables["rejects"].select("seq", "missing")) == rows_of(snapshot.rejected_rows(writes).select("seq", "missing"))


def test_ledger_lookup_reads_the_days_of_the_batch(spark):
    """Twenty daily batches: what a batch reads of the stored ledger stays the same."""
    out, read = scratch_path(spark, "tables"), []
    for day in range(20):
        at = [(T0 + timedelta(days=day, seconds=i)).isoformat() + "Z" for i in range(10)]
        texts = [message(order_id=f"o{i}", last_occurred_at=t, created_at=t) for i, t in enumerate(at)]
        old = (T0 + timedelta(days=day - 1)).isoformat() + "Z"
        late = [message(order_id="o0", last_occurred_at=old, created_at=old)] if day else []  # stored the day before
        rows = _rows(spark, envelopes(spark, texts + late))
        entries = staged(first_arrivals(intake.ledger_input(rows, "ingest", *streamed._parts("ingest"))), "entries")
        read.append(streamed.stored_ledger(spark, out, entries, day).count())
        streamed.append_entries(entries, day, out)
    assert read == [0] + [10] * 19
    assert runner.read_batches(spark, f"{out}/ledger").count() == 200


def _rows(spark, batch):
    good, _ = split_bad(decode_messages(batch))
    return intake.with_event_id(intake.classify(intake.normalize(good), None, "ingest"), "ingest")


@pytest.mark.parametrize("profile", intake.PROFILES)
def test_order_states_merge_in_any_order(spark, profile):
    rng = random.Random(6)
    maybe = lambda v: rng.choice([v, v, v, None, ""])
    rows = [
        (i, f"o{rng.randrange(25)}", maybe(f"u{i}"), maybe(f"p{i}"), maybe("n"), maybe("a"), maybe("S"), rng.choice(["PAID", "HOLD"]), f"t{i}", T0, rng.choice([None, f"R{i}"]),
         T0 + timedelta(seconds=i), T0 + timedelta(seconds=rng.randrange(900)))
        for i in range(300)
    ]
    schema = "seq bigint, order_id string, user_id string, product_id string, product_name string, shipping_address string, current_stage string, current_status string, " \
        "last_event_type string, last_occurred_at timestamp_ntz, hold_reason_code string, ingested_at timestamp_ntz, created_at timestamp_ntz"
    rng.shuffle(rows)
    out = scratch_path(spark, "states")
    for b in range(7):
        runner.write_batch(snapshot.order_states(spark.createDataFrame(rows[b::7], schema), profile), b, out)
    got = streamed.read_snapshots(spark, out, profile)
    want = snapshot.fold_orders(spark.createDataFrame(rows, schema), profile)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, got.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))


def _over(kept: list, t: datetime, burst: Burst) -> bool:
    kept[:] = [k for k in kept if k >= t - timedelta(seconds=burst.seconds)] + [t]
    return len(kept) > burst.limit


def _cascade_loop(rows):
    users, products, out = [], [], {}
    for order, t in rows:
        out[order] = "FUL-FRAUD-USER" if _over(users, t, rules.USER_BURST) else "FUL-FRAUD-PROD" if _over(products, t, rules.PRODUCT_BURST) else None
    return out


def _paid_loop(rows):
    kept = []
    return {order: "FUL-FRAUD-PROD" if _over(kept, t, rules.PAID_PRODUCT_BURST) else None for order, t in rows}


def _anchored_loop(rows):
    anchor, seen, out = None, 0, {}
    for order, t in rows:
        if anchor is None or t > anchor + timedelta(seconds=rules.ANCHORED_BURST.seconds):
            anchor, seen = t, 0
        seen += 1
        out[order] = "FUL-FRAUD-USER" if seen > rules.ANCHORED_BURST.limit else None
    return out


def test_live_snapshot_equals_fold(spark):
    rng = random.Random(4)
    maybe = lambda v: rng.choice([v, v, None, ""])
    rows = [
        (i, f"o{rng.randrange(20)}", maybe(f"u{i}"), maybe(f"p{i}"), maybe("n"), maybe("a"), maybe("S"), maybe("PAID"), f"t{i}", T0, None, T0 + timedelta(seconds=i))
        for i in range(200)
    ]
    schema = "seq bigint, order_id string, user_id string, product_id string, product_name string, shipping_address string, current_stage string, " \
        "current_status string, last_event_type string, last_occurred_at timestamp_ntz, hold_reason_code string, ingested_at timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    times = ["last_occurred_at", "ingested_at"]
    live = keyed.stream_orders(keyed.as_micros(as_stream(spark, df, 5), times), snapshot.FILLED_FORWARD, snapshot.REQUIRED_OWN)
    updates = collect(spark, live, "update").withColumnRenamed("seq", "raw_reference")
    got = keyed.from_micros(streamed.current_orders(updates), [*times, "created_at"])
    shown = ["order_id", "user_id", "product_id", "current_status", "last_event_type", "hold_reason_code", "raw_reference", "created_at"]
    want = snapshot.fold_orders(df, "ingest")
    assert sorted(map(tuple, got.select(*shown).collect()), key=repr) == sorted(map(tuple, want.select(*shown).collect()), key=repr)


class _Values:
    """Map state kept in a dict."""

    def __init__(self):
        self.kept, self.asked = {}, []

    def getValue(self, key):
        self.asked.append(key)
        return self.kept.get(key)

    def updateValue(self, key, value):
        self.kept[key] = value


def test_one_call_walks_all_keys_of_a_bucket():
    """A call of the burst or order state takes the rows of many keys, in any order, and looks each key up once."""
    rng = random.Random(8)
    fold = ArrivalBurst(5_000_000, 2)
    state, alone = keyed.BurstState(fold, "burst", ["seq"], None), {}
    state.values = _Values()
    for batch in range(2):
        rows = [(batch * 1000 + i, f"u{rng.randrange(40)}", rng.randrange(60) * 1_000_000) for i in range(400)]
        want = {}
        for seq, key, at in rows:
            flags, alone[key] = fold.walk(alone.get(key), np.array([at]))
            want[seq] = bool(flags[0])
        rng.shuffle(rows)
        given = pd.DataFrame(rows, columns=["seq", keyed.KEY, "time_us"])
        state.values.asked.clear()
        got = pd.concat(state.handleInputRows((0,), iter([given[:100], given[100:]]), None))
        assert dict(zip(got["seq"], got["burst"])) == want and any(want.values())
        assert len(state.values.asked) == len({key for _, key, _ in rows})
    orders = keyed.OrderState(["order_id", "seq", "user_id", "created_at"], ["seq", "created_at"], ["user_id"], ["order_id"], None)
    orders.values = _Values()
    rows = [("a", 1, None, 5.0), ("b", 2, "x", 6.0), ("a", 3, "y", 7.0), ("b", 4, "", None), ("c", 5, "", 9.0)]
    given = pd.DataFrame(rows, columns=["order_id", "seq", "user_id", "ingested_at"]).assign(**{keyed.KEY: lambda d: d["order_id"], keyed.BUCKET: 0})
    (got,) = orders.handleInputRows((0,), iter([given]), None)
    assert got.to_dict("split")["data"] == [["a", 3, "y", 7], ["b", 4, "x", 6]]


def test_null_keys_of_a_stream_are_their_own(spark):
    rows = [(i, [None, "", "u"][i % 3], T0 + timedelta(seconds=i // 3)) for i in range(12)]
    df = spark.createDataFrame(rows, "seq bigint, user_id string, created_at timestamp_ntz")
    got = collect(spark, keyed.stream_burst(as_stream(spark, df, 2), ["user_id"], Burst(60.0, 2))).collect()
    assert {r.seq: r.burst for r in got} == {i: i >= 6 for i in range(12)}


@pytest.mark.parametrize("anchored", [False, True])
def test_carried_walk_goes_through_keys_and_arrow_batches(anchored):
    """One walk takes all keys of a partition, stored states first, wherever the Arrow batches end."""
    rng = random.Random(9)
    fold = AnchoredWindow(4_000_000, 2) if anchored else ArrivalBurst(4_000_000, 2)
    walk = getattr(fold, "walk_arrivals", fold.walk)
    table, want, states = [], [], {}
    for key in sorted(f"k{i}" for i in range(30)):
        state, n = None, rng.randrange(1, 30)
        if rng.random() < 0.5:
            _, state = walk(None, np.array([0, 1_000_000]))
            table.append((None, key, None, json.dumps(state)))
        times = [rng.randrange(20) * 1_000_000 for _ in range(n)]
        flags, state = walk(state, np.array(times))
        table += [(len(want) + i, key, t, None) for i, t in enumerate(times)]
        want += [(len(want) + i, bool(f)) for i, f in enumerate(flags)]
        states[key] = state
    names = ["row", "_key", "_time", "_state"]
    whole = pa.table({n: pa.array([r[i] for r in table], t) for i, (n, t) in enumerate(zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string()]))})
    for size in (1, 7, 1000):
        got = [r for b in _walking(fold, ["row", "_key"])(iter(whole.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert [(r["row"], r["_flag"]) for r in got if r["_state"] is None] == want
        assert {r["_key"]: json.loads(r["_state"]) for r in got if r["_state"] is not None} == states
