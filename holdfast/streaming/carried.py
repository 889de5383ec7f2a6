"""Burst verdicts of micro-batches that go on from the state earlier batches stored.

Each batch writes, under its id, the state of the keys it touched: as many times as the
burst's limit, or one open window. A key's rows of one batch meet in one task, which walks them
one Arrow batch at a time: bound them with the source's rate option.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.times import micros
from holdfast.operators.rules import Burst, Flagger
from holdfast.plans.folds import AnchoredWindow, ArrivalBurst, Fold
from holdfast.session import staged
from holdfast.streaming.runner import BATCH, read_batches, write_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STATE = T.StructType([T.StructField("_key", T.StringType()), T.StructField("_state", T.StringType())])
_ARRIVAL = ["ingested_at", "partition", "offset"]


def _walking(fold: Fold, names: Sequence[str]):
    """Flags of a partition sorted by key, where a key's stored state comes before its rows in arrival order.

    Only one Arrow batch is held at a time. A key's new state follows as a row of its own when the key ends.
    """
    walk = getattr(fold, "walk_arrivals", fold.walk)

    def states(ended: list[tuple[str, str]], like: pa.RecordBatch) -> pa.RecordBatch:
        given = {"_key": [k for k, _ in ended], "_state": [s for _, s in ended]}
        columns = [pa.array(given[n], t) if n in given else pa.nulls(len(ended), t) for n, t in zip(like.schema.names, like.schema.types)]
        return pa.RecordBatch.from_arrays(columns, schema=like.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, counted = None, None, False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, stored = batch.column("_key"), batch.column("_state")
            is_stored = np.asarray(stored.is_valid())
            times = pc.if_else(stored.is_valid(), 0, batch.column("_time")).to_numpy(zero_copy_only=False)
            flags, ended = np.zeros(len(times), dtype=bool), []
            begins = np.flatnonzero(np.asarray(pc.not_equal(keys[1:], keys[:-1]))) + 1
            for a, b in pairwise([0, *begins.tolist(), len(times)]):
                own = keys[a].as_py()
                if own != key:
                    if counted:
                        ended.append((key, json.dumps(state)))
                    key, state, counted = own, None, False
                if is_stored[a]:
                    state, a = json.loads(stored[a].as_py()), a + 1
                if a < b:
                    flags[a:b], state = walk(state, times[a:b])
                    counted = True
            columns = [*[batch.column(n) for n in names], pa.array(flags), pa.nulls(len(flags), pa.string())]
            flagged = pa.RecordBatch.from_arrays(columns, [*names, "_flag", "_state"])
            yield flagged.filter(pa.array(~is_stored)) if is_stored.any() else flagged
            if ended:
                yield states(ended, flagged)
        if counted:
            yield states([(key, json.dumps(state))], flagged)

    return run


def carried_flag(rows: DataFrame, keys: Sequence[str], fold: Fold, out: str, where: str, time: str, path: str, batch_id: int) -> DataFrame:
    """Flags rows satisfying ``where`` in arrival order, after all batches before this one.

    Null keys count as empty, and rows that do not count get false. Repeating a batch
    reads only older states and replaces what it wrote. A task walks all keys of its partition,
    sorted, so a key costs its rows and not a call of its own.
    """
    key = f"to_json(array({', '.join(f"coalesce(CAST({k} AS string), '')" for k in keys)}))"
    marked = rows.selectExpr("*", f"coalesce({where}, false) AS _in", f"{key} AS _key", f"{micros(rows, time)} AS _time")
    counted = marked.where("_in")
    stored = read_batches(rows.sparkSession, path, _STATE, batch_id)
    stored = stored.join(counted.select("_key").distinct(), "_key", "left_semi").groupBy("_key").agg(F.max_by("_state", BATCH).alias("_state"))
    names = [*rows.columns, "_key"]
    fields = [T.StructField(n, marked.schema[n].dataType) for n in names]
    schema = T.StructType([*fields, T.StructField("_flag", T.BooleanType()), T.StructField("_state", T.StringType())])
    walked = counted.select(*names, "_time").unionByName(stored, allowMissingColumns=True)
    walked = walked.repartition("_key").sortWithinPartitions("_key", F.col("_state").isNull(), *_ARRIVAL)
    flagged = walked.mapInArrow(_walking(fold, names), schema)
    flagged = staged(flagged, "flagged")
    write_batch(flagged.where("_state IS NOT NULL").select("_key", "_state"), batch_id, path)
    others = marked.where("NOT _in").selectExpr(*rows.columns, f"false AS {out}")
    return flagged.where("_state IS NULL").selectExpr(*rows.columns, f"_flag AS {out}").unionByName(others)


def carried(path: str, batch_id: int, anchored: bool = False) -> Flagger:
    """The bursts of a profile with state below ``path``, one folder per rule."""

    def flag(rows: DataFrame, keys: Sequence[str], burst: Burst, out: str, where: str, time: str) -> DataFrame:
        width = round(burst.seconds * 1e6)
        fold = AnchoredWindow(width, burst.limit) if anchored else ArrivalBurst(width, burst.limit)
        return carried_flag(rows, keys, fold, out, where, time, f"{path}/{'_'.join(keys)}", batch_id)

    return flag
