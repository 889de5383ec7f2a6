"""The registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import binding
from holdfast.functions.times import as_utc
from holdfast.operators import intake, kpi, lists, ops, quarantine, rollup, rules, snapshot, timeseries
from holdfast.session import scratch_path, staged
from holdfast.sources.messages import decode_messages, land_raw, read_messages, split_bad
from holdfast.sources.tables import alert_payloads, append_ledger, first_arrivals, read_table, write_metrics
from holdfast.stored import stored
from holdfast.streaming import held, live, keyed, runner, windows
from holdfast.streaming import intake as streamed

Query = Callable[[SparkSession, str], DataFrame]

# The real limits never fire on the driver's sparse events, so the queries widen them.
WIDE_USER = rules.Burst(86_400.0, 5)
WIDE_PRODUCT = rules.Burst(21_600.0, 5)
WIDE_PAID = rules.Burst(172_800.0, 3)
WIDE_ANCHORED = rules.Burst(864_000.0, 3)
WIDE_LOOKBACK = 86_400.0
ONE_ORDER = "ord-0"

_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _created(rows: DataFrame) -> DataFrame:
    """Ledger rows with the columns the rules and the snapshot read."""
    return rows.selectExpr(
        "seq", "event_id", "order_id", "user_id", "product_id", "product_name", "shipping_address", "current_stage", "current_status",
        "event_type AS last_event_type", "occurred_at AS last_occurred_at", "occurred_at AS created_at", "occurred_at", "ingested_at",
        "reason_code AS hold_reason_code", "ops_status AS hold_ops_status", "ops_operator AS hold_ops_operator", "k",
    )


def _coarse(rows: DataFrame) -> DataFrame:
    """Five product groups, so that (user, product) pairs repeat."""
    return intake.with_columns(rows, {"product_id": "CAST(k % 5 AS string)"})


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes, written as a file topic and read back through the message source."""
    path = scratch_path(spark, "topic")
    binding.messages(spark, sf_dir).write.parquet(path)
    return read_messages(spark, "parquet", {"path": path}, stream=False)


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_bad(decode_messages(_messages(spark, sf_dir)))
    return intake.with_event_id(intake.classify(intake.normalize(good), None, "ingest"), "ingest")


# --- sources, sinks, normalisation ---------------------------------------------------


@query
def ledger_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.ledger(spark, sf_dir).drop("k")


def _redelivered(rows: DataFrame) -> DataFrame:
    """Every event delivered again, later and with another status."""
    slim = rows.select("event_id", "seq", "order_id", "current_status")
    return slim.unionByName(slim.selectExpr("event_id", "seq + 1000000000L AS seq", "order_id", "'AGAIN' AS current_status"))


@query
def ledger_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_arrivals(_redelivered(binding.ledger(spark, sf_dir)))


@query
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return append_ledger(rows.where("current_status = 'HOLD'"), _redelivered(rows))


@query
def raw_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, errors = split_bad(decode_messages(_messages(spark, sf_dir)))
    return errors.selectExpr("error_type", "kafka_topic", "kafka_offset", f"{as_utc('occurred_at')} AS occurred_at")


@query
def raw_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land_raw(_normalized(spark, sf_dir))
    part = lambda path, name: f"get_json_object(raw_payload, '$.{path}') AS {name}"
    return landed.selectExpr(
        "raw_id.partition AS part", "kafka_offset", part("order_id", "order_id"), part("product_name", "product_name"),
        part("_meta.kafka_topic", "meta_topic"), part("_meta.kafka_offset", "meta_offset"), part("_meta.ingested_at", "meta_ingested_at"),
        part("_meta.derived_event_id", "meta_event_id"),
    )


@query
def normalize_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).selectExpr(
        "offset", "order_id", "user_id", "product_id", "product_name", "shipping_address", "current_stage", "current_status", "event_type",
        "ledger_status", "reason_code", f"{as_utc('occurred_at')} AS occurred_at", f"{as_utc('created_at')} AS created_at",
    )


@query
def event_id_v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).select("offset", "event_id")


@query
def latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    delays = intake.latency_columns("event_produced_at", "ingested_at", "ingested_at")
    return _normalized(spark, sf_dir).selectExpr("offset", *[f"round({e}, 6) AS {n}" for n, e in delays.items()])


@query
def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = binding.ledger(spark, sf_dir).withColumnRenamed("reason_code", "reason")
    log = alert_payloads(held, "/orders/", "occurred_at")
    item = lambda i: f"get_json_object(alert_data, '$.attachments[0].fields[{i}].value')"
    return log.selectExpr(
        "alert_id", "order_id", "send_status", "get_json_object(alert_data, '$.text') AS title", f"{item(0)} AS reason",
        f"{item(1)} AS shown_id", f"{item(2)} AS url",
    )


# --- rules ---------------------------------------------------------------------------


@query
def rule_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.ledger(spark, sf_dir).selectExpr("seq", f"{rules.rule_required()} AS reason")


@query
def rule_bad_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binding.ledger(spark, sf_dir).selectExpr("seq", f"{rules.rule_bad_address()} AS reason")


@query
def rule_stock_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.with_stock(binding.ledger(spark, sf_dir), binding.products(spark, sf_dir))
    return rows.selectExpr("seq", f"{rules.rule_stock_cascade()} AS reason")


@query
def rule_stock_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.with_stock(binding.ledger(spark, sf_dir), binding.products(spark, sf_dir))
    return rows.selectExpr("seq", f"{rules.rule_stock_paid()} AS reason")


@query
def burst_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _created(binding.ledger(spark, sf_dir))
    return rules.burst_flag(rows, ["user_id"], WIDE_USER, "burst").select("seq", "burst")


@query
def burst_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _created(binding.ledger(spark, sf_dir))
    return rules.burst_flag(rows, ["product_id"], WIDE_PRODUCT, "burst").select("seq", "burst")


@query
def burst_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _created(binding.ledger(spark, sf_dir))
    return rules.classify_cascade(rows, binding.products(spark, sf_dir), WIDE_USER, WIDE_PRODUCT).select("seq", "reason")


@query
def burst_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    decided = rules.hold_decision(rules.classify_paid(rows, binding.products(spark, sf_dir), WIDE_PAID), "paid_anomaly")
    return decided.select("seq", "hold_reason", "current_status")


@query
def burst_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival mode over rows that arrive out of time order."""
    rows = intake.with_columns(_created(binding.ledger(spark, sf_dir)), {"seq": "(seq + 40 * (k % 7)) * 10000000000L + seq"})
    return rules.burst_flag(rows, ["user_id"], WIDE_USER, "burst", mode=rules.ARRIVAL).select("seq", "burst")


@query
def burst_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _coarse(_created(binding.ledger(spark, sf_dir)))
    return rules.rule_anchored_burst(rows, WIDE_ANCHORED).select("seq", "burst")


@query
def hold_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intake.with_columns(_coarse(_created(binding.ledger(spark, sf_dir))), {"current_stage": "CASE WHEN k % 6 = 0 THEN 'HOLD' ELSE current_stage END"})
    decided = rules.hold_decision(rules.classify_anchored(rows, WIDE_ANCHORED), "anchored")
    return decided.select("seq", "hold_reason", "current_status", "current_stage")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = rules.classify_cascade(_created(binding.ledger(spark, sf_dir)), binding.products(spark, sf_dir), WIDE_USER, WIDE_PRODUCT)
    slim = ["seq", "event_id", "order_id", "user_id", "product_id", "created_at", "reason", "current_status"]
    return staged(rules.hold_decision(decided, "cascade").select(*slim), "classified")


@query
def quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.quarantine_orders(_classified(spark, sf_dir), WIDE_LOOKBACK)


@query
def quarantine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir)
    marked = quarantine.quarantine_ledger(rows, quarantine.quarantine_cascade(rows, WIDE_LOOKBACK))
    return marked.select("seq", "order_id", "current_status", "reason")


def _classified_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = rules.classify_anchored(_coarse(_created(binding.ledger(spark, sf_dir))), WIDE_ANCHORED)
    rows = rules.hold_decision(decided, "anchored")
    slim = ["seq", "order_id", "user_id", "product_id", "created_at", "reason", "hold_reason", "current_status"]
    return staged(rows.select(*slim), "classified")


@query
def quarantine_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.quarantine_pair(_classified_pairs(spark, sf_dir), WIDE_LOOKBACK)


# --- snapshot ------------------------------------------------------------------------


def _gappy(rows: DataFrame) -> DataFrame:
    """Rows with gaps in every field the gate looks at."""
    return intake.with_columns(
        _created(rows),
        {
            "user_id": "CASE WHEN k % 5 <> 0 THEN user_id END",
            "product_name": "CASE WHEN k % 7 = 0 THEN '' ELSE product_name END",
            "current_stage": "CASE WHEN k % 11 <> 0 THEN current_stage END",
            "current_status": "CASE WHEN k % 17 = 0 THEN '' ELSE current_status END",
        },
    )


_SHOWN = [
    "order_id", "user_id", "product_id", "product_name", "shipping_address", "current_stage", "current_status", "last_event_type",
    "last_occurred_at", "hold_reason_code", "raw_reference", "created_at",
]


@query
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intake.with_columns(_created(binding.ledger(spark, sf_dir)), {"shipping_address": "concat('to ', user_id)"})
    return snapshot.fold_orders(rows, "ingest").select(*_SHOWN, "hold_ops_status", "hold_ops_operator")


@query
def snapshot_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.fold_orders(_gappy(binding.ledger(spark, sf_dir)), "paid_anomaly").select(*_SHOWN)


@query
def snapshot_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = snapshot.rejected_rows(_gappy(binding.ledger(spark, sf_dir)))
    return rejected.selectExpr("seq", "order_id", "array_join(missing, ',') AS missing")


@query
def snapshot_sticky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.fold_orders(_created(binding.ledger(spark, sf_dir)), "cascade").select(*_SHOWN)


@query
def snapshot_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.fold_orders(_created(binding.ledger(spark, sf_dir)), "anchored").select(*_SHOWN)


_STATE = [
    "order_id", "product_id", "current_stage", "current_status", "last_event_type", "last_occurred_at", "hold_reason_code", "created_at",
]


@query
def order_status_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    actions = binding.order_actions(rows).where("kind = 'STATUS'")
    return snapshot.apply_status_change(binding.order_state(rows).select(*_STATE), actions, binding.products(spark, sf_dir))


@query
def status_change_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    actions = binding.order_actions(rows).where("kind = 'STATUS'")
    return snapshot.status_change_ledger(binding.order_state(rows), actions, binding.products(spark, sf_dir), "concat('act-', seq)")


@query
def hold_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    orders = binding.order_state(rows).select("order_id", "current_status", "hold_ops_status", "hold_ops_operator")
    return snapshot.hold_ops_update(orders, binding.order_actions(rows).where("kind = 'HOLD_OPS'"))


@query
def clear_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return snapshot.clear_hold(binding.order_state(rows).select(*_STATE), binding.order_actions(rows).where("kind = 'CLEAR'"))


# --- rollup --------------------------------------------------------------------------


def _rounded(metrics: DataFrame) -> DataFrame:
    new = {c: f"round({c}, 6)" for c, kind in metrics.dtypes if kind == "double"}
    return intake.with_columns(metrics, new)


@query
def rollup_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(binding.metrics(spark, sf_dir))


@query
def rollup_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup with dead letters and rejected rows counted per window."""
    rows = binding.ledger(spark, sf_dir)
    errors = rows.where("k >= 95").selectExpr("ingested_at AS occurred_at")
    rejects = snapshot.rejected_rows(_gappy(rows)).select("ingested_at")
    over = binding.times(rows)
    counted = rollup.rollup(rows, binding.order_state(rows), over.start, over.as_of, over.as_of, errors, rejects)
    return counted.select("window_start", "ingest_count", "parse_errors", "schema_missing")


@query
def rollup_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows missing behind a store that stops a day early."""
    kept = stored(spark, sf_dir)
    early = kept.metrics(spark).where(F.col("window_end") <= F.lit(kept.times.as_of - timedelta(days=1)).cast("timestamp_ntz"))
    rows = binding.ledger(spark, sf_dir)
    return _rounded(rollup.fill_gaps(rows, binding.order_state(rows), early, kept.times.as_of))


@query
def rollup_reroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return _rounded(rollup.reroll_recent(rows, binding.order_state(rows), binding.times(rows).asked))


@query
def rollup_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    empty = spark.createDataFrame([], "window_start timestamp_ntz, window_end timestamp_ntz")
    return _rounded(rollup.backfill(rows, binding.order_state(rows), empty, binding.times(rows).asked, backfill_days=7))


@query
def metrics_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored windows after an upsert of their last two days, by an earlier run's moment."""
    rows = binding.ledger(spark, sf_dir)
    orders, over = binding.order_state(rows), binding.times(rows)
    path = scratch_path(spark, "metrics_window")
    write_metrics(spark, rollup.rollup(rows, orders, over.start, over.as_of - timedelta(days=1), over.as_of), path)
    write_metrics(spark, rollup.rollup(rows, orders, over.as_of - timedelta(days=2), over.as_of, over.asked), path)
    return _rounded(read_table(spark, path))


@query
def latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollup.latest_window(stored(spark, sf_dir).metrics(spark)))


@query
def max_window_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.max_window_end(stored(spark, sf_dir).metrics(spark))


# --- dashboards: over the stored windows of their range -------------------------------


def _points(spark: SparkSession, sf_dir: str, preset: str) -> DataFrame:
    kept = stored(spark, sf_dir)
    asked = kept.times.asked
    return timeseries.timeseries(preset, kept.metrics(spark, *timeseries.preset_range(preset, asked)), kept.orders(spark), asked)


@query
def ts_12h_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_points(spark, sf_dir, "12h_30m"))


@query
def ts_24h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_points(spark, sf_dir, "24h_1h"))


@query
def ts_7d_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_points(spark, sf_dir, "7d_1d"))


@query
def ts_30d_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_points(spark, sf_dir, "30d_1d"))


@query
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(spark, sf_dir)
    asked = kept.times.asked
    return _rounded(kpi.summary(kept.orders(spark), kept.ledger(spark, asked), kept.metrics(spark), asked))


@query
def kpi_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(kpi.kpi_orders(_points(spark, sf_dir, "24h_1h")))


@query
def kpi_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = _rounded(kpi.kpi_events(_points(spark, sf_dir, "12h_30m")))
    listed = ["delay_p95_sec", "ingest_count", "parse_errors", "schema_missing"]
    return intake.with_columns(row, {c: f"array_join(transform({c}, v -> CAST(v AS string)), ',')" for c in listed})


@query
def kpi_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.kpi_alerts(_points(spark, sf_dir, "7d_1d"))


@query
def on_time_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(spark, sf_dir)
    return _rounded(kpi.on_time_rate(kept.orders(spark), kept.times.asked))


# --- lists ---------------------------------------------------------------------------


@query
def recent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.recent_orders(binding.orders(spark, sf_dir), 20)


@query
def orders_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.orders_page(binding.orders(spark, sf_dir), status="PICKING", stage="FULFILLMENT", q="ORD-1", limit=200)


@query
def order_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.order_one(binding.orders(spark, sf_dir), binding.products(spark, sf_dir), ONE_ORDER)


@query
def events_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.events_page(binding.ledger(spark, sf_dir), order_id="rd-1_", event_type="ERR", only_error=True, limit=300)


@query
def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.events_of_order(binding.ledger(spark, sf_dir), ONE_ORDER)


@query
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return lists.alerts(rows, binding.order_state(rows), 50)


@query
def alerts_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.alerts_page(binding.ledger(spark, sf_dir), status="ACK", kind="EVENT")


@query
def order_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.alerts_of_order(binding.ledger(spark, sf_dir), ONE_ORDER)


@query
def alert_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = binding.ledger(spark, sf_dir).selectExpr(
        "seq", "CASE k % 3 WHEN 0 THEN concat('event:', event_id) WHEN 1 THEN concat('hold:', order_id, ':x') ELSE event_id END AS alert_key"
    )
    return keys.selectExpr("seq", f"{lists.alert_kind('alert_key')} AS kind", f"{lists.alert_target('alert_key')} AS target")


# --- operator actions ----------------------------------------------------------------


@query
def ops_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    applied = ops.apply_ops(rows.select("event_id", "current_status", "ops_status", "ops_operator"), binding.event_actions(rows))
    return applied


@query
def ops_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = binding.ledger(spark, sf_dir).selectExpr(
        "seq", "CASE WHEN k % 4 = 0 THEN concat('hold:', order_id) WHEN k % 4 = 3 THEN event_id ELSE concat('event:', event_id) END AS alert_key",
        "get(array('ack', 'resolve', 'retry', 'drop'), CAST(seq % 4 AS int)) AS request", "CASE WHEN k % 5 = 0 THEN 'seen' END AS note",
        "'op' AS operator", "ingested_at AS at",
    )
    return ops.requests_to_actions(requests)


@query
def ops_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return ops.ops_transitions(rows, binding.event_actions(rows))


@query
def ops_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    moved = ops.ops_counter_deltas(ops.ops_transitions(rows, binding.event_actions(rows)), stored(spark, sf_dir).metrics(spark))
    return moved.select("window_start", "alerts_open", "alerts_ack", "alerts_resolved", "alerts_retry")


@query
def ops_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.ledger(spark, sf_dir)
    return ops.ops_audit(rows, binding.event_actions(rows), stored(spark, sf_dir).metrics(spark))


# --- streams, run over the events file until it is read ------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = spark.readStream.schema(binding.EVENTS_SCHEMA).option("pathGlobFilter", "events.parquet")
    return binding.bind(files.parquet(sf_dir))


def _collected(spark: SparkSession, stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream into a fresh table, and reads that."""
    out = scratch_path(spark, name)
    runner.run_available(stream, lambda df, batch: runner.write_batch(df, batch, f"{out}/rows"), f"{out}/checkpoint", mode)
    return runner.read_batches(spark, f"{out}/rows")


@query
def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = _collected(spark, windows.stream_counts(_event_stream(spark, sf_dir)), "stream_rollup", "update")
    counts = windows.current_counts(updates)
    return intake.with_columns(counts, {c: f"CAST({c} AS timestamp_ntz)" for c in ("window_start", "window_end")})


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_stream(spark, sf_dir).select("event_id", "order_id", "ingested_at")
    twice = rows.unionByName(_event_stream(spark, sf_dir).select("event_id", "order_id", "ingested_at"))
    return _collected(spark, windows.stream_dedup(twice), "stream_dedup").select("event_id", "order_id")


@query
def stream_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_stream(spark, sf_dir).selectExpr("seq", "user_id", "occurred_at AS created_at")
    return _collected(spark, keyed.stream_burst(rows, ["user_id"], WIDE_USER), "stream_burst").select("seq", "burst")


@query
def stream_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_stream(spark, sf_dir).selectExpr("seq", "user_id", "CAST(k % 5 AS string) AS product_id", "occurred_at AS created_at")
    flagged = keyed.stream_burst(rows, ["user_id", "product_id"], WIDE_ANCHORED, anchored=True)
    return _collected(spark, flagged, "stream_anchored").select("seq", "burst")


@query
def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = ["last_occurred_at", "ingested_at"]
    shown = [c for c in _SHOWN if c not in ("raw_reference", "created_at")]
    rows = _gappy(_event_stream(spark, sf_dir)).select("seq", *shown, "ingested_at")
    live = keyed.stream_orders(keyed.as_micros(rows, times), snapshot.FILLED_FORWARD, snapshot.REQUIRED_OWN)
    updates = _collected(spark, live, "stream_snapshot", "update").withColumnRenamed("seq", "raw_reference")
    latest = streamed.current_orders(updates)
    return keyed.from_micros(latest, [*times, "created_at"]).select(*_SHOWN)


@query
def stream_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the continuous intake; the orders it ends with."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "intake")
    binding.messages(spark, sf_dir).write.parquet(topic)
    messages = read_messages(spark, "parquet", {"path": topic})
    streamed.run_intake(messages, None, "ingest", f"{out}/tables", f"{out}/checkpoint")
    orders = streamed.read_intake(spark, f"{out}/tables", "ingest")["orders"]
    return orders.selectExpr(
        "order_id", "user_id", "product_id", "product_name", "shipping_address", "current_stage", "current_status", "last_event_type",
        f"{as_utc('last_occurred_at')} AS last_occurred_at", "hold_reason_code", "raw_reference.offset AS last_offset",
        f"{as_utc('created_at')} AS created_at",
    )


# --- streams over several micro-batches ----------------------------------------------

BATCHES = 4


def _split_stream(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """The rows as a stream of BATCHES micro-batches that each hold rows of all times."""
    path = scratch_path(spark, name)
    mixed = rows.withColumn("_batch", F.expr(f"CAST(pmod(xxhash64(seq), {BATCHES}) AS int)"))
    for batch in range(BATCHES):
        mixed.where(F.col("_batch") == batch).drop("_batch").coalesce(8).write.parquet(f"{path}/{batch}")
    files = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 8)
    return files.parquet(path)


def _slices(rows: DataFrame, order: str) -> list[DataFrame]:
    """The rows in BATCHES parts that follow each other by a number."""
    at = rows.selectExpr(f"percentile_approx({order}, array({', '.join(str(i / BATCHES) for i in range(1, BATCHES))})) AS cuts").first()["cuts"] or []
    low, high = [None, *at], [*at, None]
    inside = lambda a, b: " AND ".join([*([] if a is None else [f"{order} >= {a}"]), *([] if b is None else [f"{order} < {b}"])]) or "true"
    return [rows.where(inside(a, b)) for a, b in zip(low, high)]


@query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts of micro-batches out of time order; late rows are counted and kept."""
    out = scratch_path(spark, "live")
    live.run_windows(_split_stream(spark, binding.ledger(spark, sf_dir), "ledger"), f"{out}/tables", f"{out}/checkpoint")
    return live.window_counts(spark, f"{out}/tables").drop("late_rows").withColumnRenamed("ingest_count", "event_total")


@query
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics windows, percentiles and distinct held orders included, from what micro-batches added."""
    rows, out = binding.ledger(spark, sf_dir), scratch_path(spark, "live")
    live.run_windows(_split_stream(spark, rows, "ledger"), f"{out}/tables", f"{out}/checkpoint")
    over = binding.times(rows)
    return _rounded(live.live_metrics(spark, f"{out}/tables", binding.order_state(rows), over.start, over.as_of, over.as_of))


def _quarantined(spark: SparkSession, rows: DataFrame, pair: bool) -> tuple[DataFrame, DataFrame]:
    """(rows, marks) of a stream of classified rows that goes on in BATCHES runs, in order of arrival."""
    topic, out = scratch_path(spark, "classified"), scratch_path(spark, "held")
    for part in _slices(rows, "seq"):
        part.write.mode("append").parquet(topic)
        stream = spark.readStream.schema(rows.schema).parquet(topic)
        runner.run_available(stream, lambda df, batch: held.mark_batch(df, batch, f"{out}/tables", WIDE_LOOKBACK, pair), f"{out}/checkpoint")
    return spark.read.parquet(topic), held.marks_of(spark, f"{out}/tables")


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, marks = _quarantined(spark, _classified(spark, sf_dir), False)
    return quarantine.quarantine_orders(rows, quarantined=marks)


@query
def stream_quarantine_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, marks = _quarantined(spark, _classified(spark, sf_dir), False)
    return quarantine.quarantine_ledger(rows, marks).select("seq", "order_id", "current_status", "reason")


@query
def stream_quarantine_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, marks = _quarantined(spark, _classified_pairs(spark, sf_dir), True)
    last = rows.where("order_id IS NOT NULL").groupBy("order_id").agg(F.max_by(F.struct("seq", "current_status", "hold_reason"), "seq").alias("l"))
    orders = last.selectExpr("order_id", "l.seq AS raw_reference", "l.current_status AS current_status", "l.hold_reason AS hold_reason_code")
    return held.held_pairs(orders, marks).drop("raw_reference")


def _snapshots(spark: SparkSession, sf_dir: str, profile: str) -> DataFrame:
    out = scratch_path(spark, "states")
    rows = _created(binding.ledger(spark, sf_dir))
    streamed.run_snapshots(_split_stream(spark, rows, "rows"), profile, f"{out}/states", f"{out}/checkpoint")
    return streamed.read_snapshots(spark, f"{out}/states", profile).select(*_SHOWN)


@query
def stream_snapshot_sticky(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir, "cascade")


@query
def stream_snapshot_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir, "anchored")


def _profile_run(spark: SparkSession, sf_dir: str, profile: str, rows: DataFrame, **limits) -> DataFrame:
    """Orders of a topic that grows in BATCHES steps, in order of arrival, the intake running after each."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "intake")
    for part in _slices(binding.envelopes(rows), "unix_micros(ingested_at)"):
        part.write.mode("append").parquet(topic)
        messages = read_messages(spark, "parquet", {"path": topic})
        listed = lambda session: binding.products(session, sf_dir)
        streamed.run_intake(messages, listed, profile, f"{out}/tables", f"{out}/checkpoint", WIDE_LOOKBACK, **limits)
    orders = streamed.read_intake(spark, f"{out}/tables", profile)["orders"]
    return orders.selectExpr(
        "order_id", "user_id", "product_id", "current_stage", "current_status", f"{as_utc('last_occurred_at')} AS last_occurred_at", "hold_reason_code",
        "raw_reference.offset AS reference", f"{as_utc('created_at')} AS created_at",
    )


@query
def stream_intake_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_run(spark, sf_dir, "cascade", binding.ledger(spark, sf_dir), user_burst=WIDE_USER, product_burst=WIDE_PRODUCT)


@query
def stream_intake_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_run(spark, sf_dir, "paid_anomaly", binding.ledger(spark, sf_dir), burst=WIDE_PAID)


@query
def stream_intake_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_run(spark, sf_dir, "anchored", _coarse(binding.ledger(spark, sf_dir)), burst=WIDE_ANCHORED)
