"""Keyed state on streams: burst rules and the live order snapshot.

State per key is small (the burst limit's worth of times; one order row). A bucket's rows of
one micro-batch meet in one call, at most a micro-batch if a key is heavy: bound it
with the source's rate option (maxOffsetsPerTrigger, maxFilesPerTrigger).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from datetime import timedelta
from itertools import pairwise
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from holdfast.functions.times import micros
from holdfast.operators.rules import Burst
from holdfast.plans.folds import AnchoredWindow, ArrivalBurst, Fold

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY = T.StructType([T.StructField("key", T.StringType())])
_STATE = T.StructType([T.StructField("json", T.StringType())])
# Keys are handled in so many groups, so that a key costs its rows and not a call of its own.
BUCKETS = 1024
# Columns added for that; the rows' way to Python keeps no names that begin with an underscore.
KEY, BUCKET = "keyed_by", "keyed_bucket"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeyedState(StatefulProcessor):
    """One JSON value per key, kept for many keys at a time: a call handles a bucket of keys with its rows of the
    micro-batch, and looks up only the keys that have rows. An idle key's value expires after the time to live."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.values = handle.getMapState("values", _KEY, _STATE, self.ttl_ms)

    def load(self, key: str) -> Any:
        found = self.values.getValue((key,))
        return None if found is None else json.loads(found[0])

    def save(self, key: str, value: Any) -> None:
        self.values.updateValue((key,), (json.dumps(value),))

    def runs(self, rows: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, list[tuple[str, int, int]]]:
        """The bucket's rows, key by key in arrival order, and where each key's rows begin and end."""
        batch = pd.concat(list(rows))
        codes = pd.factorize(batch[KEY])[0]
        order = np.lexsort((batch["seq"].to_numpy(), codes))
        batch, codes = batch.iloc[order], codes[order]
        ends = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
        keys = batch[KEY].to_numpy()
        return batch, [(keys[a], a, b) for a, b in pairwise(ends)]

    def close(self) -> None:
        pass


class BurstState(KeyedState):
    """Walks each key's rows in arrival order and emits them with the rule's verdict."""

    def __init__(self, fold: Fold, out: str, columns: Sequence[str], ttl_ms: int | None) -> None:
        super().__init__(ttl_ms)
        self.fold, self.out, self.columns = fold, out, list(columns)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        batch, runs = self.runs(rows)
        walk = getattr(self.fold, "walk_arrivals", self.fold.walk)
        times, flags = batch["time_us"].to_numpy(), np.zeros(len(batch), dtype=bool)
        for own, a, b in runs:
            flags[a:b], state = walk(self.load(own), times[a:b])
            self.save(own, state)
        yield batch[self.columns].assign(**{self.out: flags})


class OrderState(KeyedState):
    """Each order's snapshot with fill-forward and the completeness gate."""

    def __init__(self, columns: Sequence[str], whole: Sequence[str], filled: Sequence[str], required: Sequence[str], ttl_ms: int | None) -> None:
        super().__init__(ttl_ms)
        self.columns, self.whole, self.filled, self.required = list(columns), set(whole), list(filled), list(required)

    def _plain(self, batch: pd.DataFrame, name: str) -> list:
        """A column's values, null as None; whole numbers as such even when nulls came with them."""
        values, present = batch[name].tolist(), batch[name].notna().tolist()
        return [(int(v) if name in self.whole else v) if p else None for v, p in zip(values, present)]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        batch, runs = self.runs(rows)
        names = [c for c in batch.columns if c not in (KEY, BUCKET)]
        values, current = list(zip(*(self._plain(batch, c) for c in names))), []
        for own, a, b in runs:
            stored = self.load(own)
            for given in values[a:b]:
                row = dict(zip(names, given))
                for name in self.filled:
                    row[name] = row[name] or (stored or {}).get(name)
                if all(row[name] for name in (*self.required, *self.filled)):
                    row["created_at"] = row["ingested_at"] if stored is None else stored["created_at"]
                    stored = row
            if stored is not None:
                self.save(own, stored)
                current.append([stored[c] for c in self.columns])
        if current:
            yield pd.DataFrame(current, columns=self.columns, dtype=object)


def _milliseconds(idle: timedelta | None) -> int | None:
    return None if idle is None else int(idle.total_seconds() * 1000)


def _keyed(df: DataFrame, keys: Sequence[str], processor: KeyedState, schema: T.StructType, mode: str) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    time_mode = "None" if processor.ttl_ms is None else "ProcessingTime"
    named = ", ".join(keys)
    df = df.selectExpr("*", f"to_json(struct({named})) AS {KEY}", f"CAST(pmod(xxhash64({named}), {BUCKETS}) AS int) AS {BUCKET}")
    return df.groupBy(BUCKET).transformWithStateInPandas(processor, schema, mode, time_mode)


def stream_burst(
    rows: DataFrame,
    keys: Sequence[str],
    burst: Burst,
    out: str = "burst",
    time: str = "created_at",
    anchored: bool = False,
    idle: timedelta | None = None,
    mode: str = "append",
) -> DataFrame:
    """Burst verdicts as rows arrive, with the batch rules' arrival or anchored semantics.

    ``rows`` are the rows the rule counts (those that passed the rules before it), with a
    bigint ``seq`` in arrival order. ``idle`` forgets a key after that much processing
    time without rows; choose it well above the window plus the stream's lag. It is for
    streams that run on: with it, an availableNow run keeps making batches.
    """
    width = round(burst.seconds * 1e6)
    fold: Fold = AnchoredWindow(width, burst.limit) if anchored else ArrivalBurst(width, burst.limit)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.BooleanType())])
    processor = BurstState(fold, out, rows.columns, _milliseconds(idle))
    return _keyed(rows.selectExpr("*", f"{micros(rows, time)} AS time_us"), keys, processor, schema, mode)


def stream_orders(rows: DataFrame, filled: Sequence[str], required: Sequence[str], idle: timedelta | None = None) -> DataFrame:
    """The current row of every order touched by a batch (update mode).

    ``rows`` has a bigint ``seq``, ``ingested_at`` and otherwise text columns; times are
    passed as microseconds, see :func:`as_micros`.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("created_at", T.LongType())])
    whole = [f.name for f in schema if isinstance(f.dataType, T.LongType)]
    processor = OrderState([f.name for f in schema], whole, filled, required, _milliseconds(idle))
    return _keyed(rows, ["order_id"], processor, schema, "update")


def as_micros(rows: DataFrame, times: Sequence[str]) -> DataFrame:
    """Times as microseconds, which keep their exact value inside keyed state."""
    return rows.selectExpr(*[f"{micros(rows, c)} AS {c}" if c in times else c for c in rows.columns])


def from_micros(rows: DataFrame, times: Sequence[str]) -> DataFrame:
    """Microseconds back to times without a zone."""
    back = "timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ '1970-01-01 00:00:00') AS {c}"
    return rows.selectExpr(*[back.format(c=c) if c in times else c for c in rows.columns])
