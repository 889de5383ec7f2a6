"""Continuous intake: messages to raw, error, ledger, order and alert tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.normalize import is_filled
from holdfast.functions.times import as_utc
from holdfast.operators import intake, quarantine, snapshot
from holdfast.sources.messages import decode_messages, land_raw, split_bad
from holdfast.sources.tables import alert_payloads, append_ledger, first_arrivals
from holdfast.session import staged
from holdfast.streaming import held
from holdfast.streaming.carried import carried
from holdfast.streaming.runner import BATCH, read_batches, run_available, write_batch

LINK_PREFIX = "/orders/"
PART, ALSO = "part", "part_also"
# Hash parts of ledger rows whose id was given by the sender.
GIVEN_PARTS = 16
Products = DataFrame | Callable[[SparkSession], DataFrame] | None


def current_orders(updates: DataFrame) -> DataFrame:
    """The last version of every order."""
    kept = ", ".join(c for c in updates.columns if c not in ("order_id", BATCH))
    return updates.sparkSession.sql(
        f"SELECT order_id, last.* FROM (SELECT order_id, max_by(struct({kept}), {BATCH}) AS last FROM {{updates}} GROUP BY order_id)",
        updates=updates,
    )


def run_snapshots(rows: DataFrame, profile: str, out: str, checkpoint: str) -> None:
    """Folds a stream of classified rows into order states, batch by batch; see :func:`read_snapshots`."""
    run_available(rows, lambda df, batch_id: write_batch(snapshot.order_states(df, profile), batch_id, out), checkpoint)


def read_snapshots(spark: SparkSession, out: str, profile: str) -> DataFrame:
    """The orders of all batches, whatever the split and order of their rows."""
    return snapshot.orders_of(snapshot.merged_states(read_batches(spark, out), profile), profile)


def _parts(profile: str) -> list[str]:
    """Where a ledger row is stored, and where else a row with its event id may be.

    A derived id names the order and time of the event (or its position, whose message has one time), so the
    day of the event goes with the id. Ids given by the sender may come with any time and go by their hash.
    """
    given = is_filled("given_event_id") if profile in ("ingest", "paid_anomaly") else "false"
    own_time = "created_at" if profile in ("cascade", "anchored") else "occurred_at"
    hashed, day = f"concat('g', pmod(xxhash64(event_id), {GIVEN_PARTS}))", f"concat('d', date_format({as_utc(own_time)}, 'yyyy-MM-dd'))"
    return [f"CASE WHEN {given} THEN {hashed} ELSE {day} END AS {PART}", f"CASE WHEN {given} THEN {day} ELSE {hashed} END AS {ALSO}"]


def stored_ledger(spark: SparkSession, out: str, entries: DataFrame, batch_id: int) -> DataFrame:
    """The (event_id) rows of earlier batches in the parts that ``entries`` fall into: no other part is read."""
    parts = [r[0] for r in entries.selectExpr(f"explode(array({PART}, {ALSO}))").distinct().collect()]  # days of one batch
    return read_batches(spark, f"{out}/ledger", entries.drop(ALSO).schema, batch_id).where(F.col(PART).isin(parts)).select("event_id")


def append_entries(entries: DataFrame, batch_id: int, out: str) -> None:
    """Stores the ledger rows of a batch whose ids no earlier batch has."""
    fresh = append_ledger(stored_ledger(entries.sparkSession, out, entries, batch_id), entries).drop(ALSO)
    fresh.write.mode("overwrite").partitionBy(PART).parquet(f"{out}/ledger/{BATCH}={batch_id}")


def intake_batch(
    messages: DataFrame, batch_id: int, products: Products, profile: str, out: str, lookback: float | None = None, **limits
) -> None:
    """Processes one micro-batch; every table gets the batch's rows under its id.

    ``products`` is a frame, or a reader called with the batch's session, which then sees
    the list as it is at that batch. ``lookback`` and ``limits`` replace the profile's own.

    Raw rows and ledger are written before the snapshot. Orders and suspect rows are written as the
    batch has them, to be merged by the reader, so only the ledger's ids and the quarantine look at older batches, and
    only at those parts that the batch's rows fall into. A repeated batch overwrites what it wrote and reads only older
    batches, so it changes nothing twice.
    """
    spark = messages.sparkSession
    if callable(products):
        products = products(spark)
    decoded = staged(decode_messages(messages), "decoded")
    good, errors = split_bad(decoded)
    options = {} if profile == "ingest" else {**limits, "flag": carried(f"{out}/bursts", batch_id, profile == "anchored")}
    normal = staged(intake.normalize(good), "normal")
    rows = staged(intake.with_event_id(intake.classify(normal, products, profile, **options), profile), "classified")
    write_batch(errors, batch_id, f"{out}/errors")
    write_batch(land_raw(rows), batch_id, f"{out}/raw")
    entries = staged(first_arrivals(intake.ledger_input(rows, profile, *_parts(profile))), "entries")
    append_entries(entries, batch_id, out)

    writes = intake.snapshot_input(rows, profile)
    write_batch(snapshot.order_states(writes, profile), batch_id, f"{out}/orders")
    if profile in ("ingest", "paid_anomaly"):
        write_batch(snapshot.suspects(writes), batch_id, f"{out}/suspects")
    else:
        default = quarantine.CASCADE_LOOKBACK if profile == "cascade" else quarantine.PAIR_LOOKBACK
        held.mark_batch(rows, batch_id, f"{out}/held", default if lookback is None else lookback, profile == "anchored")
    write_batch(alert_payloads(rows, LINK_PREFIX, "ingested_at"), batch_id, f"{out}/alerts")


def run_intake(
    messages: DataFrame, products: Products, profile: str, out: str, checkpoint: str, lookback: float | None = None, **limits
) -> None:
    """Runs the intake over all messages there are.

    Rules on single rows, bursts, quarantine and the snapshot continue across batches, so the size of
    a batch changes no verdict. Bursts are counted in arrival order, which is that of the batches.
    """
    run_available(messages, lambda df, batch_id: intake_batch(df, batch_id, products, profile, out, lookback, **limits), checkpoint)


def read_intake(spark: SparkSession, out: str, profile: str) -> dict[str, DataFrame]:
    """The tables of an intake run: errors, raw, ledger, orders, alerts, and rejects where the profile has a gate.

    Quarantined orders, and ledger rows written by their last trigger, are on HOLD.
    """
    tables = {name: read_batches(spark, f"{out}/{name}") for name in ("errors", "raw", "ledger", "alerts")}
    states = snapshot.merged_states(read_batches(spark, f"{out}/orders"), profile)
    tables["orders"] = snapshot.orders_of(states, profile)
    if profile in ("ingest", "paid_anomaly"):
        starts = states.where("_start IS NOT NULL").selectExpr("order_id", "_start.seq AS start")
        tables["rejects"] = snapshot.rejected_suspects(read_batches(spark, f"{out}/suspects"), starts)
        return tables
    marks = held.marks_of(spark, f"{out}/held")
    if profile == "anchored":
        tables["orders"] = held.held_pairs(tables["orders"], marks)
        return tables
    tables["orders"] = held.held_orders(tables["orders"], marks)
    entries = tables["ledger"].withColumnRenamed("reason_code", "reason")
    tables["ledger"] = quarantine.quarantine_ledger(entries, marks).withColumnRenamed("reason", "reason_code")
    return tables
