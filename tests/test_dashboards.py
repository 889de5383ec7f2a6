"""Rollup, time series, KPIs, lists and operator actions on small literal tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from holdfast.functions.times import at, day_start, floor_bucket
from holdfast.operators import kpi, lists, ops, rollup, timeseries
from holdfast.plans.segments import Split
from holdfast.session import scratch_path
from holdfast.sources.tables import metrics_schema, read_table, write_metrics

T0 = datetime(2026, 2, 1, 9, 0)
TINY = Split(min_rows=4, samples=10**6, per_segment=2)
EVENT = "event_id string, order_id string, event_type string, current_status string, reason_code string, occurred_at timestamp_ntz, " \
    "ingested_at timestamp_ntz, ops_status string, ops_note string, ops_operator string, ops_updated_at timestamp_ntz"
ORDER = "order_id string, current_status string, created_at timestamp_ntz"
min_ = lambda m: T0 + timedelta(minutes=m)


def event(i, status="PAID", ingested=0.0, delay=1.0, order="o1", ops=None):
    when = min_(ingested)
    return (f"e{i}", order, status, status, "R" if status == "HOLD" else None, when - timedelta(seconds=delay), when, ops, None, None, None)


def tables(spark, events, orders):
    return spark.createDataFrame(events, EVENT), spark.createDataFrame(orders, ORDER)


def test_rollup_windows(spark):
    events, orders = tables(
        spark,
        [
            event(1, ingested=0), event(2, "HOLD", 29.99), event(3, "SHIPPED", 30), event(4, "HOLD", 30, order="o2", ops="ACK"),
            event(5, "HOLD", 31, order="o2"), event(6, "HOLD", 31, order=None, ops="RESOLVED"), event(7, ingested=90), event(8, ingested=-0.01),
        ],
        [("o1", "PAID", min_(0)), ("o2", "HOLD", min_(-300)), ("o3", "PAID", min_(30)), ("o4", "PAID", min_(59.9))],
    )
    got = rollup.rollup(events, orders, T0, min_(95), min_(150))
    rows = {r.window_start: r for r in got.collect()}
    assert sorted(rows) == [min_(0), min_(30), min_(60)]
    a, b, c = (rows[min_(m)] for m in (0, 30, 60))
    assert (a.orders, a.payments, a.holds, a.ingest_count, a.event_errors, a.hold_rate) == (1, 1, 0, 2, 1, 0.0)
    assert (b.orders, b.shipped, b.holds, b.hold_rate, b.alerts_open, b.alerts_ack, b.alerts_resolved) == (2, 1, 1, 0.5, 1, 1, 1)
    assert (c.orders, c.ingest_count, c.hold_rate, c.delay_p95_sec) == (0, 0, 0.0, 0.0)
    assert {(r.backlog, r.holds_now, r.late_orders) for r in rows.values()} == {(3, 1, 1)}


@pytest.mark.parametrize("spread", [3, 5_000_000_000])
def test_percentile_is_exact(spark, spread):
    rng = random.Random(spread)
    values = [(f"o{i}", min_(30 * rng.randrange(6)), rng.randrange(-spread, spread)) for i in range(900)]
    base = spark.createDataFrame(values, "order_id string, ingested_at timestamp_ntz, d bigint")
    events = base.selectExpr(
        "order_id", "ingested_at", "timestampadd(MICROSECOND, -d, ingested_at) AS occurred_at", "'PAID' AS current_status", "CAST(NULL AS string) AS ops_status"
    )
    orders = spark.createDataFrame([], ORDER)
    got = {r.window_start: r.delay_p95_sec for r in rollup.rollup(events, orders, T0, min_(180), min_(180)).collect()}
    want = base.groupBy("ingested_at").agg((F.percentile("d", 0.95) / 1e6).alias("p")).collect()
    assert len(want) == 6
    for r in want:
        assert got[r.ingested_at] == pytest.approx(r.p, abs=1e-9)


def test_ranges():
    now = T0 + timedelta(minutes=47)
    assert floor_bucket(now) == min_(30)
    assert rollup.backfill_range(now, None) == (min_(30) - timedelta(days=30), min_(30))
    assert rollup.backfill_range(now, min_(-60)) == (min_(-60), min_(30))
    assert rollup.backfill_range(now, min_(-60), datetime(2026, 1, 20)) == (datetime(2026, 1, 20), min_(30))
    assert rollup.gap_range(now, None) == (min_(0), min_(30)) and rollup.gap_range(now, min_(-60)) == (min_(-60), min_(30))
    assert rollup.reroll_range(now) == (min_(-90), min_(30))


def test_reroll_absorbs_late_rows(spark):
    early = [event(i, ingested=-200 + i) for i in range(5)]
    late = [event(10, ingested=-80), event(11, ingested=-190)]
    orders = [("o1", "PAID", min_(0))]
    path = scratch_path(spark, "metrics")
    before, o = tables(spark, early, orders)
    after, _ = tables(spark, early + late, orders)
    write_metrics(spark, rollup.rollup(before, o, min_(-240), T0, T0), path)
    write_metrics(spark, rollup.reroll_recent(after, o, T0), path)
    stored = {r.window_start: r.ingest_count for r in read_table(spark, path).collect()}
    assert len(stored) == 8 and stored[min_(-90)] == 1
    assert stored[min_(-210)] == 5, "older than the horizon: not recomputed"
    missing = rollup.fill_gaps(after, o, read_table(spark, path), min_(70)).collect()
    assert sorted(r.window_start for r in missing) == [min_(0), min_(30)]
    assert read_table(spark, scratch_path(spark, "none"), metrics_schema(before.schema["ingested_at"].dataType)).count() == 0


def _metrics(spark, rows):
    schema = metrics_schema(spark.createDataFrame([], EVENT).schema["ingested_at"].dataType)
    full = [{f.name: 0.0 if f.dataType.simpleString() == "double" else 0 for f in schema} | r for r in rows]
    full = [r | {"window_end": r["window_start"] + timedelta(minutes=30), "created_at": T0} for r in full]
    return spark.createDataFrame([[r[f.name] for f in schema] for r in full], schema)


def test_series_and_kpis(spark):
    orders = spark.createDataFrame([("a", "HOLD", min_(-60)), ("b", "HOLD", min_(-60 * 30)), ("c", "PAID", min_(-60))], ORDER)
    rows = [
        {"window_start": min_(-60), "orders": 4, "holds": 1, "alerts_open": 1, "backlog": 3, "delay_p95_sec": 2.5, "event_total": 8, "event_errors": 2},
        {"window_start": min_(-60), "orders": 4, "holds": 1, "alerts_open": 1, "backlog": 3},
        {"window_start": min_(-30), "orders": 2, "backlog": 7, "shipped": 1, "delay_p95_sec": 4.0, "event_total": 2},
    ]
    m = _metrics(spark, rows)
    half = {r.ts: r for r in timeseries.timeseries("12h_30m", m, orders, min_(10)).collect()}
    assert len(half) == 24 and max(half) == T0 and min(half) == T0 - timedelta(hours=11, minutes=30)
    assert (half[min_(-60)].orders, half[min_(-60)].alerts_open, half[min_(-60)].holds_now, half[T0].orders) == (4, 2, 1, 0)
    hours = {r.ts: r for r in timeseries.timeseries("24h_1h", m, orders, min_(10)).collect()}
    assert (hours[min_(-60)].orders, hours[min_(-60)].backlog, hours[min_(-60)].delay_p95_sec, hours[min_(-60)].holds_now) == (10, 7, 4.0, 1)
    assert hours[T0].holds_now == 0
    days = timeseries.timeseries("7d_1d", m, orders, min_(10)).collect()
    assert len(days) == 1 and (days[0].orders, days[0].backlog) == (10, 7)
    with pytest.raises(ValueError):
        timeseries.timeseries("1y", m, orders, T0)
    points = timeseries.timeseries("24h_1h", m, orders, min_(10))
    o = kpi.kpi_orders(points).first()
    assert (o.orders, o.shipped, o.holds, o.hold_rate, o.backlog, o.updated_at) == (10, 1, 2, 0.2, 0, T0)
    e = kpi.kpi_events(points).first()
    assert (e.event_total, e.event_errors, e.error_rate, len(e.delay_p95_sec), e.delay_p95_sec[22]) == (10, 2, 0.2, 24, 4)
    assert kpi.kpi_alerts(points).first().OPEN == 2
    empty = kpi.kpi_orders(points.where("false")).first()
    assert (empty.orders, empty.hold_rate, empty.updated_at) == (0, 0.0, None)


def test_summary_without_windows(spark):
    events, orders = tables(spark, [event(1, "SHIPPED", 0)], [("a", "PAID", min_(-60)), ("b", "DELIVERED", min_(-60 * 24))])
    row = kpi.summary(orders, events, _metrics(spark, []), min_(10)).first()
    assert (row.orders_today, row.shipped_today, row.backlog, row.completed_now, row.window_start, row.orders_window) == (1, 1, 1, 1, None, 0)
    assert row.metrics_created_at == "2026-02-01T09:10:00.000"
    rate = kpi.on_time_rate(orders, min_(70)).first()
    assert (rate.backlog, rate.late_orders, rate.on_time_rate) == (1, 1, 0.0)


def test_seoul_days(spark):
    day = datetime(2026, 2, 1, 14, 59, tzinfo=timezone.utc)
    df = spark.createDataFrame([(day,), (day + timedelta(minutes=1),)], "t timestamp")
    like = df.schema["t"].dataType
    got = [r.d.astimezone(timezone.utc) for r in df.selectExpr(f"{day_start('t', like, 'Asia/Seoul')} AS d").collect()]
    assert got == [datetime(2026, 1, 31, 15, tzinfo=timezone.utc), datetime(2026, 2, 1, 15, tzinfo=timezone.utc)]
    text = spark.range(1).selectExpr(f"{kpi._stamp_text(at(day, like), 'Asia/Seoul')} AS s").first().s
    assert text == "2026-02-01T23:59:00.000+09:00"


def test_lists(spark):
    events, _ = tables(spark, [event(i, "HOLD" if i % 2 else "PAID", i, order=f"ord-{i % 3}", ops="ACK" if i == 1 else None) for i in range(12)] + [event(99, order=None)], [])
    assert [r.event_id for r in lists.events_page(events, "ORD-_", "hol", True, 10).collect()] == ["e11", "e9", "e7", "e5", "e3", "e1"]
    assert lists.events_page(events, limit=10).where("order_id IS NULL").count() == 0
    assert [r.event_id for r in lists.events_of_order(events, "ord-1", 10).collect()] == ["e10", "e7", "e4", "e1"]
    assert lists.alerts_page(events, kind="HOLD").count() == 0
    assert [r.alert_key for r in lists.alerts_page(events, status="ACK").collect()] == ["event:e1"]
    for name, limit in [("recent_orders", 0), ("recent_orders", 201), ("events_page", 9), ("order_detail", 1001)]:
        with pytest.raises(ValueError):
            lists.clamp_limit(name, limit)
    keys = spark.createDataFrame([("event:a:b",), ("hold:o",), ("x",)], "k string")
    got = keys.selectExpr(f"{lists.alert_kind('k')} AS kind", f"{lists.alert_target('k')} AS target").collect()
    assert [tuple(r) for r in got] == [("EVENT", "a:b"), ("HOLD", "o"), (None, None)]


ACTION = "seq bigint, event_id string, new_status string, note string, operator string, at timestamp_ntz"


def test_ops_steps(spark):
    events, orders = tables(spark, [event(1, "HOLD", 5)], [("o1", "HOLD", T0)])
    states = ["ACK", "ACK", "RESOLVED", "RETRY_REQUESTED"]
    actions = spark.createDataFrame([(i, "e1", s, None, "kim", T0) for i, s in enumerate(states)] + [(9, "gone", "ACK", None, "kim", T0)], ACTION)
    moves = ops.ops_transitions(events, actions).orderBy("seq").collect()
    assert [(r.prev_status, r.new_status) for r in moves] == [("OPEN", "ACK"), ("ACK", "RESOLVED"), ("RESOLVED", "RETRY_REQUESTED")]
    metrics = rollup.rollup(events, orders, T0, min_(30), min_(30))
    moved = ops.ops_counter_deltas(ops.ops_transitions(events, actions), metrics).first()
    after = rollup.rollup(ops.apply_ops(events, actions), orders, T0, min_(30), min_(30)).first()
    for c in ("alerts_open", "alerts_ack", "alerts_resolved", "alerts_retry"):
        assert moved[c] == after[c]
    audit = {r.seq: (r.e_prev_found, r.prev_status, r.chg_count, r.metrics_updated) for r in ops.ops_audit(events, actions, metrics).collect()}
    assert audit == {0: (1, "OPEN", 1, 1), 1: (1, "ACK", 0, 0), 2: (1, "ACK", 1, 1), 3: (1, "RESOLVED", 1, 1), 9: (0, None, 0, 0)}


@pytest.mark.parametrize("split", [Split(), TINY])
def test_counters_floor_like_a_loop(spark, split):
    rng = random.Random(3)
    names = list(ops.ALERT_COUNTERS)
    start = {min_(30 * w): {s: rng.randrange(3) for s in names} for w in range(20)}
    rows = []
    for seq in range(600):
        a, b = rng.sample(names, 2)
        rows.append((seq, "e", a, b, min_(30 * rng.randrange(20) + rng.randrange(30))))
    for seq, _, a, b, t in rows:
        counters = start[floor_bucket(t)]
        for s in names:
            counters.setdefault("_" + s, counters[s])
            counters["_" + s] = max(counters["_" + s] - (s == a) + (s == b), 0)
    transitions = spark.createDataFrame(rows, "seq bigint, event_id string, prev_status string, new_status string, ingested_at timestamp_ntz")
    metrics = _metrics(spark, [{"window_start": w} | {ops.ALERT_COUNTERS[s]: c[s] for s in names} for w, c in start.items()])
    for r in ops.ops_counter_deltas(transitions, metrics, split).collect():
        for s in names:
            assert r[ops.ALERT_COUNTERS[s]] == start[r.window_start].get("_" + s, start[r.window_start][s])


def test_requests(spark):
    rows = [(1, "event:e1", "retry", None), (2, "hold:o1", "resolve", "n"), (3, "bad", "ack", None), (4, "event:e1", "drop", None), (5, "hold:o2", "ack", None)]
    requests = spark.createDataFrame([(*r, "kim", T0) for r in rows], "seq bigint, alert_key string, request string, note string, operator string, at timestamp_ntz")
    actions = ops.requests_to_actions(requests)
    on_events, on_holds, cleared = ops.split_actions(actions)
    assert [(r.event_id, r.new_status, r.note) for r in on_events.collect()] == [("e1", "RETRY_REQUESTED", "retry requested")]
    assert sorted((r.order_id, r.new_status) for r in on_holds.collect()) == [("o1", "RESOLVED"), ("o2", "ACK")]
    assert [r.order_id for r in cleared.collect()] == ["o1"]
