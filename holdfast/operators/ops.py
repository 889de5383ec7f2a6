"""Operator actions on event alerts, as an append-only input folded over the ledger.

``actions``: (seq, event_id, new_status, note, operator, at).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast.plans.nested import nested
from holdfast.functions.times import bucket_start
from holdfast.operators.lists import alert_kind, alert_target
from holdfast.plans.segments import DEFAULT_SPLIT, Split, lag_in_key, running_in_key
from holdfast.vocabulary import ALERT_COLUMNS, ALERT_COUNTERS, quoted

# Requests and the state each sets.
STATE_OF_REQUEST = {"ack": "ACK", "resolve": "RESOLVED", "retry": "RETRY_REQUESTED"}
RETRY_NOTE = "retry requested"

_OPS = {"ops_status": "new_status", "ops_note": "note", "ops_operator": "operator", "ops_updated_at": "at"}


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Requests that are no action, with what is wrong: BAD_KEY or UNKNOWN_REQUEST."""
    known = quoted(STATE_OF_REQUEST)
    wrong = f"CASE WHEN {alert_kind('alert_key')} IS NULL THEN 'BAD_KEY' WHEN NOT coalesce(request IN ({known}), false) THEN 'UNKNOWN_REQUEST' END"
    return requests.selectExpr("seq", "alert_key", "request", f"{wrong} AS error_type").where("error_type IS NOT NULL")


def requests_to_actions(requests: DataFrame) -> DataFrame:
    """Requests (seq, alert_key, request, note, operator, at) as actions with their kind.

    Adds ``kind`` and ``target``; requests with a bad key or an unknown verb are in
    :func:`rejected_requests`. A retry without a note gets the standard one.
    """
    states = quoted(x for pair in STATE_OF_REQUEST.items() for x in pair)
    parsed = requests.selectExpr(
        "seq", f"{alert_kind('alert_key')} AS kind", f"{alert_target('alert_key')} AS target",
        f"try_element_at(map({states}), request) AS new_status",
        f"CASE WHEN request = 'retry' THEN coalesce(nullif(note, ''), '{RETRY_NOTE}') ELSE note END AS note", "operator", "at",
    )
    return parsed.where("kind IS NOT NULL AND new_status IS NOT NULL")


def split_actions(actions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Actions on events, actions on held orders, and the hold clearings (resolved holds)."""
    fields = ["seq", "new_status", "note", "operator", "at"]
    on_events = actions.where("kind = 'EVENT'").selectExpr("target AS event_id", *fields)
    on_holds = actions.where("kind = 'HOLD'").selectExpr("target AS order_id", *fields)
    return on_events, on_holds, on_holds.where("new_status = 'RESOLVED'").select("order_id", "seq", "at")


def apply_ops(events: DataFrame, actions: DataFrame) -> DataFrame:
    """Events with the last action's state, note, operator and time."""
    kept = ", ".join(f"e.{c}" for c in events.columns if c not in _OPS)
    new = ", ".join(
        f"CASE WHEN a.last IS NOT NULL THEN a.last.{s} ELSE {'e.' + c if c in events.columns else 'NULL'} END AS {c}" for c, s in _OPS.items()
    )
    return events.sparkSession.sql(
        nested(
            f"""        SELECT {kept}, {new} FROM {{events}} e LEFT JOIN @a a ON e.event_id = a.event_id""",
            a=f"SELECT event_id, max_by(struct(new_status, note, operator, at), seq) AS last FROM {{actions}} GROUP BY event_id",
        ),
        events=events,
        actions=actions,
    )


def _steps(events: DataFrame, actions: DataFrame, split: Split) -> DataFrame:
    """Actions with the state before each (null state = OPEN); found says the event exists."""
    lagged = lag_in_key(actions, ["event_id"], ["seq"], "new_status", 1, "_previous", split=split)
    return events.sparkSession.sql(
        f"""
        SELECT {', '.join('a.' + c for c in actions.columns)}, e.ingested_at, e.event_id IS NOT NULL AS found,
          CASE WHEN e.event_id IS NOT NULL THEN coalesce(a._previous, e.ops_status, 'OPEN') END AS prev_status
        FROM {{lagged}} a LEFT JOIN {{events}} e ON a.event_id = e.event_id
        """,
        lagged=lagged,
        events=events,
    )


def ops_transitions(events: DataFrame, actions: DataFrame, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """State changes only: (seq, event_id, prev_status, new_status, ingested_at, at)."""
    changed = _steps(events, actions, split).where("found AND NOT (prev_status <=> new_status)")
    return changed.select("seq", "event_id", "prev_status", "new_status", "ingested_at", "at")


def ops_counter_deltas(transitions: DataFrame, metrics: DataFrame, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Stored windows with their alert counters moved by the transitions, in order.

    A counter never goes below 0 at any step. With running sums r of a counter's moves
    and start value s, the end value is s + r_last + max(0, -min(s, s + r)).
    """
    moves = transitions.selectExpr(
        f"{bucket_start('ingested_at')} AS window_start", "seq",
        "inline(array(struct(prev_status AS state, -1L AS move), struct(new_status AS state, 1L AS move)))",
    ).where(f"state IN ({quoted(ALERT_COUNTERS)})")
    running = running_in_key(moves, ["window_start", "state"], ["seq"], "move", "sum", "_run", split=split)
    net = ", ".join(f"sum(CASE WHEN state = '{s}' THEN move END) AS net_{c}" for s, c in ALERT_COUNTERS.items())
    low = ", ".join(f"min(CASE WHEN state = '{s}' THEN _run END) AS low_{c}" for s, c in ALERT_COUNTERS.items())
    moved = "m.{c} + coalesce(n.net_{c}, 0) + greatest(0, -least(m.{c}, m.{c} + coalesce(n.low_{c}, 0))) AS {c}"
    columns = ", ".join(moved.format(c=c) if c in ALERT_COLUMNS else f"m.{c}" for c in metrics.columns)
    return metrics.sparkSession.sql(
        nested(
            f"""        SELECT {columns} FROM {{metrics}} m LEFT JOIN @n n ON m.window_start = n.window_start""",
            n=f"SELECT window_start, {net}, {low} FROM {{running}} GROUP BY window_start",
        ),
        metrics=metrics,
        running=running,
    )


def ops_audit(events: DataFrame, actions: DataFrame, metrics: DataFrame, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Per action: was the event found, its state before, did it change, was a window touched.

    Windows are aligned to the bucket, so "contains the time" is an equality. window()
    drops rows without a time, so actions on unknown events borrow their own.
    """
    return events.sparkSession.sql(
        nested(
            f"""
            SELECT s.seq, s.event_id AS arg_event_id, s.new_status AS arg_new_status, CAST(s.found AS bigint) AS e_prev_found, s.prev_status,
              CAST(s.changed AS bigint) AS chg_count, CAST(s.found AS bigint) AS event_updated,
              CAST(s.changed AND m.window_start IS NOT NULL AS bigint) AS metrics_updated
            FROM @stepped s LEFT JOIN (SELECT DISTINCT window_start FROM {{metrics}}) m ON s.changed AND s.bucket = m.window_start
            """,
            stepped=f"SELECT *, found AND NOT (prev_status <=> new_status) AS changed, {bucket_start('coalesce(ingested_at, at)')} AS bucket FROM {{steps}}",
        ),
        steps=_steps(events, actions, split),
        metrics=metrics,
    )
