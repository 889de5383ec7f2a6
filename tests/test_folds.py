"""Sequential rules against plain loops, whole and cut into segments."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from holdfast.operators import rules
from holdfast.operators.rules import Burst
from holdfast.plans.folds import AnchoredWindow, ArrivalBurst
from holdfast.plans.segments import Split, lag_in_key, running_in_key

T0 = datetime(2026, 2, 1, 9, 30)
# Cuts keys of a few dozen rows into many small segments.
TINY = Split(min_rows=4, samples=10**6, per_segment=2)

times = st.lists(st.integers(0, 60), min_size=1, max_size=40)


def arrival_loop(ts: list[int], width: int, limit: int) -> list[bool]:
    kept, out = [], []
    for t in ts:
        kept = sorted([x for x in kept + [t] if x >= t - width])
        out.append(len(kept) > limit)
    return out


def anchored_loop(ts: list[int], width: int, limit: int) -> list[bool]:
    anchor, count, out = None, 0, []
    for t in ts:
        if anchor is None or t - anchor > width:
            anchor, count = t, 1
        else:
            count += 1
        out.append(count > limit)
    return out


@settings(max_examples=300, deadline=None)
@given(times, st.integers(0, 20), st.integers(1, 6), st.integers(0, 40))
def test_arrival_walk_and_segments(ts, width, limit, cut):
    fold = ArrivalBurst(width, limit)
    want = arrival_loop(ts, width, limit)
    flags, _ = fold.walk(None, np.array(ts))
    assert flags.tolist() == want
    head, tail = np.array(ts[:cut]), np.array(ts[cut:])
    if len(head) and len(tail):
        state = fold.compose(None, fold.summarize(head))
        assert state == fold.walk(None, head)[1]
        assert fold.walk(state, tail)[0].tolist() == want[cut:]


@settings(max_examples=300, deadline=None)
@given(times, st.integers(0, 20), st.integers(1, 6), st.lists(st.integers(1, 39), max_size=4))
def test_anchored_walk_and_segments(ts, width, limit, cuts):
    ts = sorted(ts)
    fold = AnchoredWindow(width, limit)
    want = anchored_loop(ts, width, limit)
    assert fold.walk(None, np.array(ts))[0].tolist() == want
    bounds = sorted({c for c in cuts if c < len(ts)})
    pieces = [np.array(ts[a:b]) for a, b in zip([0, *bounds], [*bounds, len(ts)])]
    state, got = None, []
    for piece in pieces:
        flags, after = fold.walk(state, piece)
        got += flags.tolist()
        state = fold.compose(state, fold.summarize(piece))
        assert state == after
    assert got == want


def _rows(spark, seed: int, in_order: bool):
    """One key with most rows, several small ones, equal times included."""
    rng = random.Random(seed)
    rows = []
    for seq in range(400):
        key = "hot" if rng.random() < 0.6 else f"u{rng.randrange(8)}"
        second = seq // 3 if in_order else rng.randrange(130)
        rows.append((seq, key, T0 + timedelta(seconds=second), rng.randrange(-5, 6)))
    return rows, spark.createDataFrame(rows, "seq bigint, user_id string, created_at timestamp_ntz, v bigint")


@pytest.mark.parametrize("split", [Split(), TINY])
def test_lag_and_running_equal_plain_windows(spark, split):
    _, df = _rows(spark, 1, in_order=False)
    w = Window.partitionBy("user_id").orderBy("created_at", "seq")
    got = lag_in_key(df, ["user_id"], ["created_at", "seq"], "v", 5, "back", split=split)
    got = running_in_key(got, ["user_id"], ["created_at", "seq"], "v", "sum", "total", split=split)
    got = running_in_key(got, ["user_id"], ["created_at", "seq"], "v", "min", "low", split=split)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = got.withColumns({"b": F.lag("v", 5).over(w), "t": F.sum("v").over(upto), "l": F.min("v").over(upto)})
    wrong = want.where("NOT (back <=> b) OR NOT (total <=> t) OR NOT (low <=> l)")
    assert want.count() == 400 and wrong.count() == 0


@pytest.mark.parametrize("split", [Split(), TINY])
def test_lag_counts_only_chosen_rows(spark, split):
    _, df = _rows(spark, 2, in_order=True)
    got = lag_in_key(df, ["user_id"], ["created_at", "seq"], "seq", 2, "back", where="v > 0", split=split)
    w = Window.partitionBy("user_id").orderBy("created_at", "seq")
    want = df.where("v > 0").withColumn("back", F.lag("seq", 2).over(w)).select("seq", "back").collect()
    chosen = {r.seq: r.back for r in got.where("v > 0").collect()}
    assert chosen == {r.seq: r.back for r in want}
    assert got.where("v <= 0 AND back IS NOT NULL").count() == 0


@pytest.mark.parametrize("split", [Split(), TINY])
def test_burst_modes_equal_loops(spark, split):
    burst = Burst(4.0, 3)
    rows, df = _rows(spark, 3, in_order=False)
    by_key: dict[str, list] = {}
    for r in rows:
        by_key.setdefault(r[1], []).append(r)
    second = lambda r: int((r[2] - T0).total_seconds())
    arrival, event_time, anchored = {}, {}, {}
    for group in by_key.values():
        arrival |= dict(zip([r[0] for r in group], arrival_loop([second(r) for r in group], 4, 3)))
        ordered = sorted(group, key=lambda r: (r[2], r[0]))
        event_time |= dict(zip([r[0] for r in ordered], arrival_loop([second(r) for r in ordered], 4, 3)))
        anchored |= dict(zip([r[0] for r in ordered], anchored_loop([second(r) for r in ordered], 4, 3)))
    flags = lambda got, name: {r.seq: r[name] for r in got.collect()}
    assert flags(rules.burst_flag(df, ["user_id"], burst, "f", mode=rules.ARRIVAL, split=split), "f") == arrival
    assert flags(rules.burst_flag(df, ["user_id"], burst, "f", split=split), "f") == event_time
    pairs = df.withColumn("product_id", F.lit("p"))
    assert flags(rules.rule_anchored_burst(pairs, burst, "f", split=split), "f") == anchored
    assert any(arrival.values()) and any(anchored.values())
