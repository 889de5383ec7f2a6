"""Sequential per-key rules, cut into segments so that no key is bound to one task.

Each rule can say, for one segment, what it does to any state that comes in; that summary
is small. Summaries are composed in order per key, and each segment then starts from its
own incoming state. Spark partitions, shuffles and sorts the rows; Python only walks the
times of one segment.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from holdfast.plans.segments import CUT, DEFAULT_SPLIT, SEG, Split, segmented

# Send this module's functions to the workers whole, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class AnchoredWindow:
    """Flags rows after the first ``limit`` within ``width`` of the window's first row.

    A window opens at a row; the first row more than ``width`` later opens the next.
    State: [first time of the open window, rows in it], or None before any row.
    """

    width: int
    limit: int

    def walk(self, state: list | None, times: np.ndarray) -> tuple[np.ndarray, list | None]:
        flags = np.zeros(len(times), dtype=bool)
        anchor, seen = state or (None, 0)
        i = 0
        while i < len(times):
            if anchor is None or times[i] > anchor + self.width:
                anchor, seen = int(times[i]), 0
            end = int(np.searchsorted(times, anchor + self.width, side="right"))
            flags[min(end, i + max(0, self.limit - seen)):end] = True
            seen += end - i
            i = end
        return flags, state if anchor is None else [anchor, seen]

    def walk_arrivals(self, state: list | None, times: np.ndarray) -> tuple[np.ndarray, list | None]:
        """The same for rows in arrival order, whose times may go back: a row before the
        window's end belongs to it, however early. Only rows that open a window are stepped on."""
        flags = np.zeros(len(times), dtype=bool)
        anchor, seen = state or (None, 0)
        i = 0
        while i < len(times):
            if anchor is None or times[i] > anchor + self.width:
                anchor, seen = int(times[i]), 0
            end, block = i, 64
            while end < len(times):
                late = np.flatnonzero(times[end:end + block] > anchor + self.width)
                if len(late):
                    end += int(late[0])
                    break
                end, block = min(len(times), end + block), block * 2
            flags[min(end, i + max(0, self.limit - seen)):end] = True
            seen += end - i
            i = end
        return flags, state if anchor is None else [anchor, seen]

    def summarize(self, times: np.ndarray) -> list:
        """[rows, steps]: which final window each possible first new window leads to."""
        n = len(times)
        reach = int(np.searchsorted(times, times[0] + self.width, side="right"))
        starts, opening = np.unique(times[: reach + 1], return_index=True)
        window, of = np.unique(opening, return_inverse=True)
        while True:
            following = np.searchsorted(times, times[window] + self.width, side="right")
            if not (following < n).any():
                break
            window, merged = np.unique(np.where(following < n, following, window), return_inverse=True)
            of = merged[of]
        final = window[of]
        last_of_step = np.append(final[1:] != final[:-1], True)
        steps = [[int(t), int(times[e]), n - int(e)] for t, e in zip(starts[last_of_step], final[last_of_step])]
        return [n, steps]

    def compose(self, state: list | None, summary: list) -> list:
        rows, steps = summary
        for start, anchor, seen in steps:
            if state is None or start > state[0] + self.width:
                return [anchor, seen]
        return [state[0], state[1] + rows]


@dataclass(frozen=True)
class ArrivalBurst:
    """Flags a row when more than ``limit`` kept times, its own included, remain.

    Rows come in arrival order. Each drops, for good, kept times older than ``width``
    before its own. Whether more than ``limit`` remain depends only on the ``limit``
    largest kept times, so that is the state.
    """

    width: int
    limit: int

    def walk(self, state: list | None, times: np.ndarray) -> tuple[np.ndarray, list]:
        flags = np.zeros(len(times), dtype=bool)
        kept = sorted(state or [])
        for i, t in enumerate(times.tolist()):
            while kept and kept[0] < t - self.width:
                heapq.heappop(kept)
            flags[i] = len(kept) >= self.limit
            heapq.heappush(kept, t)
            if len(kept) > self.limit:
                heapq.heappop(kept)
        return flags, sorted(kept)

    def summarize(self, times: np.ndarray) -> list:
        return [int(times.max()), self.walk(None, times)[1]]

    def compose(self, state: list | None, summary: list) -> list:
        newest, kept = summary
        survivors = [t for t in state or [] if t >= newest - self.width]
        return sorted(survivors + kept)[-self.limit:]


Fold = AnchoredWindow | ArrivalBurst
Batches = Iterator[pa.RecordBatch]


def _times(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("_time"))


def _starts(batch: pa.RecordBatch) -> np.ndarray:
    """Where segments begin in a batch, and its first row, which may continue one."""
    begins = np.asarray(batch.column("_rank")) == 1
    begins[0] = True
    return np.flatnonzero(begins)


def _flagging(fold: Fold, names: Sequence[str]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        state: Any = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            times, ranks, carried = _times(batch), np.asarray(batch.column("_rank")), batch.column("_state")
            has_state = np.asarray(carried.is_valid())
            flags = np.zeros(len(times), dtype=bool)
            starts = _starts(batch)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(times)]):
                if ranks[a] == 1:
                    if b - a <= fold.limit and b < len(times) and not has_state[a]:
                        continue  # a whole segment too short to exceed the limit
                    state = json.loads(carried[a].as_py()) if has_state[a] else None
                flags[a:b], state = fold.walk(state, times[a:b])
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(flags)], [*names, "_flag"])

    return run


def _summarizing(fold: Fold, group: Sequence[str]) -> Callable[[Batches], Batches]:
    names = [*group, SEG]

    def emit(first: pa.RecordBatch, times: list[np.ndarray]) -> pa.RecordBatch:
        summary = json.dumps(fold.summarize(np.concatenate(times)))
        return pa.RecordBatch.from_arrays([*[first.column(n) for n in names], pa.array([summary])], [*names, "_summary"])

    def run(batches: Batches) -> Batches:
        first, times = None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts, ranks, moments = _starts(batch), np.asarray(batch.column("_rank")), _times(batch)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(moments)]):
                if ranks[a] == 1:
                    if first is not None:
                        yield emit(first, times)
                    first, times = batch.slice(a, 1), []
                times.append(moments[a:b])
        if first is not None:
            yield emit(first, times)

    return run


def _composing(fold: Fold, group: Sequence[str]) -> Callable[[pa.Table], pa.Table]:
    def run(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by(SEG)
        state, states = None, []
        for summary in parts.column("_summary").to_pylist():
            states.append(None if state is None else json.dumps(state))
            state = fold.compose(state, json.loads(summary))
        return parts.select([*group, SEG]).append_column("_state", pa.array(states, pa.string()))

    return run


def _with_states(work: DataFrame, group: Sequence[str], fold: Fold, fields: Sequence[str]) -> DataFrame:
    """Rows with the state that comes into their segment."""
    place = [*group, SEG]
    place_type = [work.schema[n] for n in place]
    heavy = work.where(f"{CUT} AND _in").select(*place, "_rank", "_time")
    summaries = heavy.mapInArrow(_summarizing(fold, group), T.StructType([*place_type, T.StructField("_summary", T.StringType())]))
    # One row per segment of a cut key: bounded, see Split.
    carry = summaries.groupBy(*group).applyInArrow(
        _composing(fold, group), T.StructType([*place_type, T.StructField("_state", T.StringType())])
    )
    return work.sparkSession.sql(
        f"""
        SELECT /*+ BROADCAST(c) */ {', '.join('w.' + c for c in fields)}, c._state
        FROM {{work}} w LEFT JOIN {{carry}} c ON {' AND '.join(f'w.{c} <=> c.{c}' for c in place)}
        """,
        work=work,
        carry=carry,
    )


def fold_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    time: str,
    fold: Fold,
    out: str,
    where: str | None = None,
    source: DataFrame | None = None,
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """Flags of a sequential rule over each key's ordered rows satisfying ``where``.

    ``time`` is an expression in microseconds.
    """
    work, group, cut = segmented(df, keys, order, where, source, split)
    place = [*group, SEG]
    # The window leaves each partition sorted by (group, segment, order), which the walk uses.
    ranked = f"row_number() OVER (PARTITION BY {', '.join(place)} ORDER BY {', '.join(order)}) AS _rank"
    work = work.selectExpr("*", f"{time} AS _time", ranked)
    names = [*df.columns, "_in"]
    fields = [*names, "_rank", "_time"]
    carried = _with_states(work, group, fold, fields) if cut else work.selectExpr(*fields, "CAST(NULL AS string) AS _state")
    result = T.StructType([*[work.schema[n] for n in names], T.StructField("_flag", T.BooleanType())])
    flagged = carried.mapInArrow(_flagging(fold, names), result)
    return flagged.selectExpr(*df.columns, f"_flag AND _in AS {out}")
