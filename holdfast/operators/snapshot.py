"""Folding the ledger into one current row per order.

Every fold is one grouped aggregate: partial aggregation collapses a heavy order's rows
before the shuffle, and nothing is collected per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.plans.nested import nested
from holdfast.functions.normalize import is_filled
from holdfast.vocabulary import HOLD

# Fields that a later row may take over from the stored order.
FILLED_FORWARD = ["user_id", "product_id", "product_name", "shipping_address"]
# Fields that must come with the row itself.
REQUIRED_OWN = ["order_id", "current_stage", "current_status"]

_HOLD_OPS = ["hold_ops_status", "hold_ops_note", "hold_ops_operator", "hold_ops_updated_at"]
_SNAPSHOT_LATEST = ["current_stage", "current_status", "last_event_type", "last_occurred_at", "hold_reason_code"]


# Fields that stay as the order's first row had them.
_STICKY_FIRST = [
    *FILLED_FORWARD, "current_stage", "last_event_type", "created_at", "event_produced_at", "latency_p_to_k_sec", "latency_p_to_d_sec",
]
_PARTIAL_FIRST = [*FILLED_FORWARD, "last_event_type", "last_occurred_at", "created_at"]


def _present(names: list[str], df: DataFrame) -> list[str]:
    return [n for n in names if n in df.columns]


def _all_filled(names: list[str]) -> str:
    return "(" + " AND ".join(is_filled(n) for n in names) + ")"


_COMPLETE = _all_filled(REQUIRED_OWN + FILLED_FORWARD)


def fold_latest(rows: DataFrame, hold_ops: bool = True) -> DataFrame:
    """Latest-row-wins snapshot with fill-forward and the completeness gate.

    A row is written when its own stage and status are there and the four descriptive
    fields are there or already stored. So an order starts at its first complete row;
    from then on every row with stage and status is written. A descriptive field is the
    last filled value among rows with stage and status: the first complete row fills all
    four, so earlier values can never win. Other fields come from the last written row,
    nulls included.
    """
    latest = ", ".join(_present(_SNAPSHOT_LATEST + (_HOLD_OPS if hold_ops else []), rows))
    filled = ", ".join(f"max_by({c}, CASE WHEN {is_filled(c)} THEN seq END) AS {c}" for c in FILLED_FORWARD)
    start = f"CASE WHEN {_all_filled(FILLED_FORWARD)} THEN seq END"
    return rows.sparkSession.sql(
        f"""
        SELECT order_id, {', '.join(FILLED_FORWARD)}, _last.*, created_at FROM (
          SELECT order_id, {filled}, min({start}) AS _start,
            max_by(struct({latest}, seq AS raw_reference), seq) AS _last,
            min_by(ingested_at, {start}) AS created_at
          FROM {{rows}} WHERE {_all_filled(REQUIRED_OWN)} GROUP BY order_id
        ) WHERE _start IS NOT NULL
        """,
        rows=rows,
    )


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Rows the gate keeps out of the snapshot, with the names of their missing fields.

    Once an order is stored, the descriptive fields no longer count as missing. Rows
    without an order id stay out of the join, where they would all meet in one partition.
    """
    starts = rows.where(_COMPLETE).groupBy("order_id").agg(F.min("seq").alias("start"))
    return rejected_suspects(suspects(rows), starts)


def suspects(rows: DataFrame) -> DataFrame:
    """Rows that lack some field, and are rejected unless their order is stored and fills it."""
    return rows.where(f"NOT {_COMPLETE}")


def rejected_suspects(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The rejected among suspect ``rows``; ``starts`` has each stored order's first complete row (order_id, start)."""
    cols = ", ".join(f"r.{c}" for c in rows.columns)
    absent = [f"CASE WHEN NOT {is_filled(c)} THEN '{c}' END" for c in REQUIRED_OWN]
    absent += [f"CASE WHEN NOT _stored AND NOT {is_filled(c)} THEN '{c}' END" for c in FILLED_FORWARD]
    return rows.sparkSession.sql(
        nested(
            f"""
            SELECT * EXCEPT (_stored) FROM (
              SELECT *, array_compact(array({', '.join(absent)})) AS missing FROM @judged
            ) WHERE size(missing) > 0
            """,
            judged=f"""
              SELECT {cols}, coalesce(s.start < r.seq, false) AS _stored
              FROM (SELECT * FROM {{rows}} WHERE {is_filled('order_id')}) r LEFT JOIN {{starts}} s ON r.order_id = s.order_id
              UNION ALL
              SELECT {cols}, false FROM {{rows}} r WHERE NOT {is_filled('order_id')}
            """,
        ),
        rows=rows,
        starts=starts,
    )


def fold_sticky_hold(rows: DataFrame) -> DataFrame:
    """HOLD never leaves, the first reason is kept, the rest stays as first written."""
    return rows.sparkSession.sql(
        f"""
        SELECT order_id, f.*, CASE WHEN held THEN '{HOLD}' ELSE l.current_status END AS current_status, hold_reason_code, l.last_occurred_at
        FROM (
          SELECT order_id,
            min_by(struct({', '.join(_present(_STICKY_FIRST, rows))}, seq AS raw_reference), seq) AS f,
            max_by(struct(current_status, last_occurred_at), seq) AS l,
            bool_or(current_status = '{HOLD}') AS held,
            min_by(hold_reason_code, CASE WHEN hold_reason_code IS NOT NULL THEN seq END) AS hold_reason_code
          FROM {{rows}} WHERE order_id IS NOT NULL GROUP BY order_id
        )
        """,
        rows=rows,
    )


def fold_partial(rows: DataFrame) -> DataFrame:
    """Stage, status, reason and raw reference follow the last row; the rest the first."""
    first = _present(_PARTIAL_FIRST, rows)
    return rows.sparkSession.sql(
        f"""
        SELECT order_id, f.*, l.* FROM (
          SELECT order_id, min_by(struct({', '.join(first)}), seq) AS f,
            max_by(struct(current_stage, current_status, hold_reason_code, seq AS raw_reference), seq) AS l
          FROM {{rows}} WHERE order_id IS NOT NULL GROUP BY order_id
        )
        """,
        rows=rows,
    )


FOLDS = {
    "ingest": fold_latest,
    "paid_anomaly": lambda rows: fold_latest(rows, hold_ops=False),
    "cascade": fold_sticky_hold,
    "anchored": fold_partial,
}


def fold_orders(rows: DataFrame, profile: str) -> DataFrame:
    """The snapshot of a profile."""
    if profile not in FOLDS:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(FOLDS)}")
    return FOLDS[profile](rows)


def _state(rows: DataFrame, profile: str) -> dict[str, tuple[str, str]]:
    """What a profile's snapshot keeps of an order's rows: aggregate and value of each part.

    Every part is a smallest or greatest row by arrival, or a flag, so states of disjoint sets of
    rows merge with the same aggregates, in any order.
    """
    if profile in ("ingest", "paid_anomaly"):
        latest = _present(_SNAPSHOT_LATEST + (_HOLD_OPS if profile == "ingest" else []), rows)
        state = {f"_{c}": ("max", f"CASE WHEN {is_filled(c)} THEN struct(seq, {c} AS value) END") for c in FILLED_FORWARD}
        state["_start"] = ("min", f"CASE WHEN {_all_filled(FILLED_FORWARD)} THEN struct(seq, ingested_at AS created_at) END")
        state["_last"] = ("max", f"struct(seq AS raw_reference, {', '.join(latest)})")
        return state
    if profile == "cascade":
        return {
            "_first": ("min", f"struct(seq AS raw_reference, {', '.join(_present(_STICKY_FIRST, rows))})"),
            "_last": ("max", "struct(seq, current_status, last_occurred_at)"),
            "_held": ("bool_or", f"current_status = '{HOLD}'"),
            "_reason": ("min", "CASE WHEN hold_reason_code IS NOT NULL THEN struct(seq, hold_reason_code) END"),
        }
    return {
        "_first": ("min", f"struct(seq, {', '.join(_present(_PARTIAL_FIRST, rows))})"),
        "_last": ("max", "struct(seq AS raw_reference, current_stage, current_status, hold_reason_code)"),
    }


def order_states(rows: DataFrame, profile: str) -> DataFrame:
    """One mergeable state per order, whatever part of its rows ``rows`` holds."""
    if profile not in FOLDS:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(FOLDS)}")
    gate = _all_filled(REQUIRED_OWN) if profile in ("ingest", "paid_anomaly") else "order_id IS NOT NULL"
    parts = [F.expr(f"{how}({value})").alias(name) for name, (how, value) in _state(rows, profile).items()]
    return rows.where(gate).groupBy("order_id").agg(*parts)


def merged_states(states: DataFrame, profile: str) -> DataFrame:
    """One state per order out of any number of them."""
    how = lambda c: "bool_or" if c == "_held" else "min" if c in ("_start", "_first", "_reason") else "max"
    return states.groupBy("order_id").agg(*[F.expr(f"{how(c)}({c})").alias(c) for c in states.columns if c.startswith("_")])


def orders_of(states: DataFrame, profile: str) -> DataFrame:
    """The snapshot of merged states, as :func:`fold_orders` gives it for all their rows."""
    if profile in ("ingest", "paid_anomaly"):
        return states.where("_start IS NOT NULL").selectExpr("order_id", *[f"_{c}.value AS {c}" for c in FILLED_FORWARD], "_last.*", "_start.created_at AS created_at")
    if profile == "cascade":
        status = f"CASE WHEN _held THEN '{HOLD}' ELSE _last.current_status END AS current_status"
        return states.selectExpr("order_id", "_first.*", status, "_reason.hold_reason_code AS hold_reason_code", "_last.last_occurred_at AS last_occurred_at")
    return states.selectExpr("order_id", "_first.*", "_last.*").drop("seq")


def _replaced(df: DataFrame, new: dict[str, str], alias: str = "o") -> str:
    """The frame's columns with some of them replaced by expressions."""
    return ", ".join(f"{new[c]} AS {c}" if c in new else f"{alias}.{c}" for c in df.columns)


def status_changes(orders: DataFrame, actions: DataFrame, products: DataFrame) -> DataFrame:
    """Accepted operator status changes: only for orders whose product is known."""
    return orders.sparkSession.sql(
        """
        SELECT a.* FROM {actions} a LEFT SEMI JOIN (
          SELECT o.order_id FROM {orders} o LEFT SEMI JOIN {products} p ON o.product_id = p.product_id
        ) k ON a.order_id = k.order_id
        """,
        orders=orders,
        actions=actions,
        products=products,
    )


def apply_status_change(orders: DataFrame, actions: DataFrame, products: DataFrame) -> DataFrame:
    """Orders after ``actions`` (seq, order_id, next_status, at).

    The last change gives status, type and time. Any change to something other than HOLD
    clears the reason, and no later change brings it back.
    """
    new = {
        "current_status": "coalesce(c.last.next_status, o.current_status)",
        "last_event_type": "coalesce(c.last.next_status, o.last_event_type)",
        "last_occurred_at": "coalesce(c.last.at, o.last_occurred_at)",
        "hold_reason_code": "CASE WHEN c.clears THEN NULL ELSE o.hold_reason_code END",
    }
    return orders.sparkSession.sql(
        nested(
            f"""        SELECT {_replaced(orders, new)} FROM {{orders}} o LEFT JOIN @c c ON o.order_id = c.order_id""",
            c=f"""
              SELECT order_id, max_by(struct(next_status, at), seq) AS last, bool_or(next_status <> '{HOLD}') AS clears
              FROM {{accepted}} GROUP BY order_id
            """,
        ),
        orders=orders,
        accepted=status_changes(orders, actions, products),
    )


def status_change_ledger(orders: DataFrame, actions: DataFrame, products: DataFrame, event_id: str) -> DataFrame:
    """Ledger rows of accepted changes: type and status are the new status, no reason."""
    return status_changes(orders, actions, products).selectExpr(
        f"{event_id} AS event_id", "order_id", "next_status AS event_type", "next_status AS current_status",
        "CAST(NULL AS string) AS reason_code", "at AS occurred_at", "at AS ingested_at",
    )


def hold_ops_update(orders: DataFrame, actions: DataFrame) -> DataFrame:
    """Orders with the last hold action's status, note, operator and time.

    ``actions``: (seq, order_id, new_status, note, operator, at).
    """
    kept = ", ".join(f"o.{c}" for c in orders.columns if c not in _HOLD_OPS)
    before = [f"o.{c}" if c in orders.columns else "NULL" for c in _HOLD_OPS]
    new = ", ".join(
        f"CASE WHEN a.last IS NOT NULL THEN a.last.{f} ELSE {old} END AS {c}"
        for c, f, old in zip(_HOLD_OPS, ["new_status", "note", "operator", "at"], before)
    )
    return orders.sparkSession.sql(
        nested(
            f"""        SELECT {kept}, {new} FROM {{orders}} o LEFT JOIN @a a ON o.order_id = a.order_id""",
            a=f"SELECT order_id, max_by(struct(new_status, note, operator, at), seq) AS last FROM {{actions}} GROUP BY order_id",
        ),
        orders=orders,
        actions=actions,
    )


def clear_hold(orders: DataFrame, actions: DataFrame) -> DataFrame:
    """Cleared orders go back to PAID with type HOLD_CLEARED; their reason stays.

    ``actions``: (seq, order_id, at).
    """
    new = {
        "current_status": "CASE WHEN a.at IS NOT NULL THEN 'PAID' ELSE o.current_status END",
        "last_event_type": "CASE WHEN a.at IS NOT NULL THEN 'HOLD_CLEARED' ELSE o.last_event_type END",
        "last_occurred_at": "coalesce(a.at, o.last_occurred_at)",
    }
    return orders.sparkSession.sql(
        nested(
            f"""        SELECT {_replaced(orders, new)} FROM {{orders}} o LEFT JOIN @a a ON o.order_id = a.order_id""",
            a=f"SELECT order_id, max_by(at, seq) AS at FROM {{actions}} GROUP BY order_id",
        ),
        orders=orders,
        actions=actions,
    )
