"""Live windows over several micro-batches, in any order of rows, against the batch rollup."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from holdfast.operators import rollup
from holdfast.session import scratch_path
from holdfast.sources.tables import read_table, write_metrics
from holdfast.streaming import live

T0 = datetime(2026, 2, 1, 9, 0)
END = T0 + timedelta(hours=30)
EVENT = "seq bigint, order_id string, current_status string, ops_status string, occurred_at timestamp_ntz, ingested_at timestamp_ntz"


def events(spark, n=400):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        at = T0 + timedelta(seconds=rng.randrange(30 * 3600))
        if i % 7 == 0:
            at = T0 + timedelta(hours=20, seconds=rng.randrange(1000))  # one busy window
        status = rng.choice(["PAID", "SHIPPED", "HOLD", "HOLD", "PICKING"])
        order = None if i % 31 == 0 else f"o{rng.randrange(60)}"
        rows.append((i, order, status, rng.choice([None, "ACK", "OPEN", "RESOLVED"]), None if i % 29 == 0 else at - timedelta(seconds=rng.randrange(900)), at))
    rows.append((n, "o1", "PAID", None, T0, None))
    return spark.createDataFrame(rows, EVENT)


@pytest.fixture(scope="module")
def orders(spark):
    states = ["PAID", "HOLD", "ORDER_HOLD", "SHIPPED"]
    rows = [(f"o{i}", states[i % 4], T0 + timedelta(minutes=25 * i)) for i in range(60)]
    return spark.createDataFrame(rows, "order_id string, current_status string, created_at timestamp_ntz")


def stream_of(spark, df, parts, order):
    path = scratch_path(spark, "source")
    rows = df.collect()
    random.Random(parts).shuffle(rows) if order == "shuffled" else rows.sort(key=lambda r: (r.ingested_at is None, r.ingested_at or T0))
    for i in range(parts):
        spark.createDataFrame(rows[i::parts] if order == "shuffled" else rows[i * len(rows) // parts : (i + 1) * len(rows) // parts], df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def rows_of(metrics):
    return sorted(map(repr, metrics.select(*rollup.WINDOW_COLUMNS).collect()))


@pytest.mark.parametrize(("parts", "order"), [(1, "shuffled"), (2, "shuffled"), (10, "shuffled"), (5, "in order")])
def test_any_split_equals_batch(spark, orders, parts, order):
    df = events(spark)
    out = scratch_path(spark, "live")
    live.run_windows(stream_of(spark, df, parts, order), out, f"{out}-checkpoint")
    assert rows_of(live.live_metrics(spark, out, orders, T0, END, END)) == rows_of(rollup.rollup(df, orders, T0, END, END))
    # a range inside reads and gives its windows only
    a, b = T0 + timedelta(hours=3), T0 + timedelta(hours=21)
    assert rows_of(live.live_metrics(spark, out, orders, a, b, END)) == rows_of(rollup.rollup(df, orders, a, b, END))
    counts = live.window_counts(spark, out).agg({"ingest_count": "sum", "late_rows": "sum"}).first()
    late = live.late_rows(spark, out)
    assert counts["sum(ingest_count)"] == df.where("ingested_at IS NOT NULL").count()
    assert counts["sum(late_rows)"] == late.count() == late.select("seq").distinct().count()
    assert (late.count() > 0) == (order == "shuffled" and parts > 1)


def test_late_rows_are_those_behind_the_stored_clock(spark):
    minutes = [[0, 5, 40], [300, 10], [61, 179, 150, 301], [179]]
    out = scratch_path(spark, "live")
    seq = 0
    for batch, batch_minutes in enumerate(minutes):
        rows = []
        for m in batch_minutes:
            rows.append((seq, "o", "PAID", None, T0, T0 + timedelta(minutes=m)))
            seq += 1
        live.add_batch(spark.createDataFrame(rows, EVENT), batch, out)
    # 300 minutes close the windows that end by minute 180: those of 10 (its own batch, not yet), then 61, 179 and 150
    assert sorted(r.seq for r in live.late_rows(spark, out).collect()) == [5, 6, 7, 9]


def test_repeated_and_empty_batches(spark, orders):
    df = events(spark, 150)
    out = scratch_path(spark, "live")
    halves = [df.where("seq % 2 = 0"), df.where("seq % 2 = 1")]
    live.add_batch(halves[0], 0, out)
    live.add_batch(df.where("seq % 3 = 0"), 1, out)  # fails later and is repeated with other rows
    live.add_batch(halves[1], 1, out)
    live.add_batch(df.where("false"), 2, out)
    assert rows_of(live.live_metrics(spark, out, orders, T0, END, END)) == rows_of(rollup.rollup(df, orders, T0, END, END))


def test_refresh_rewrites_only_touched_windows(spark, orders):
    df = events(spark)
    out, store = scratch_path(spark, "live"), scratch_path(spark, "store")
    early, late = df.where("seq < 300"), df.where("seq >= 300 AND order_id < 'o3'")
    live.add_batch(early, 0, out)
    write_metrics(spark, live.live_metrics(spark, out, orders, T0, END, T0), store)
    live.add_batch(late, 1, out)
    live.refresh(spark, out, 1, orders, END, store)
    live.add_batch(df.where("false"), 2, out)
    live.refresh(spark, out, 2, orders, END, store)
    both = early.unionByName(late)
    stored = {r.window_start: r for r in read_table(spark, store).collect()}
    fresh = {r.ts for r in live.touched(spark, out, 1).collect()}
    want = {r.window_start: r for r in rollup.rollup(both, orders, T0, END, END).collect()}
    assert set(stored) == set(want) and 0 < len(fresh) < len(want)
    for at, row in stored.items():
        assert row.created_at == (END if at in fresh else T0)
        assert (row.ingest_count, row.holds, row.delay_p95_sec, row.orders) == (want[at].ingest_count, want[at].holds, want[at].delay_p95_sec, want[at].orders)
