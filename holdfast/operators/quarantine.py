"""Retroactive holds: a burst trigger also holds the key's recent orders.

Read as a loop, every trigger updates the orders of its key. Here each order asks for the
last trigger (in arrival order) of its key that is not later than its creation time plus
the lookback. That is a running maximum over triggers and orders merged by time, so no
trigger is ever paired with all orders of its key, and a heavy key is cut like any other
ordered scan.

``classified`` frames have seq, order_id, user_id, product_id, created_at, reason (the
rule's verdict) and current_status (HOLD where there is a reason). They are read several
times, so hand in a stored frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from holdfast.plans.nested import nested
from holdfast.functions.times import span
from holdfast.plans.segments import DEFAULT_SPLIT, Split, running_in_key
from holdfast.vocabulary import FRAUD_PRODUCT, FRAUD_USER, HOLD

# Lookbacks in seconds.
CASCADE_LOOKBACK = 60.0
PAIR_LOOKBACK = 15.0


def first_writes(rows: DataFrame) -> DataFrame:
    """Per order: arrival, user, product and creation time of its first row."""
    return rows.sparkSession.sql(
        """
        SELECT order_id, f.* FROM (
          SELECT order_id, min_by(struct(seq, user_id, product_id, created_at), seq) AS f
          FROM {rows} WHERE order_id IS NOT NULL GROUP BY order_id
        )
        """,
        rows=rows,
    )


def last_trigger(
    orders: DataFrame, triggers: DataFrame, keys: Sequence[str], lookback: float, rows: DataFrame, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """(order_id, trigger): arrival of the last trigger of the order's key reaching the order.

    ``orders`` has order_id, the keys and created_at; ``triggers`` the keys, created_at
    and seq. A trigger reaches orders created up to ``lookback`` seconds before it, and
    all later ones. ``rows`` are the rows both come from, to place the cuts by.
    """
    k = ", ".join(keys)
    keyed = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    # A probe comes after the triggers of its own instant. Order among equal rows cannot
    # change a maximum but must be fixed for the cuts, so a hash completes it.
    merged = orders.sparkSession.sql(
        f"""
        SELECT {k}, created_at + {span(lookback)} AS _at, 1 AS _kind, xxhash64(order_id) AS _tie, order_id, NULL AS _seq
        FROM {{orders}} WHERE {keyed}
        UNION ALL
        SELECT {k}, created_at, 0, xxhash64(seq), NULL, seq FROM {{triggers}}
        """,
        orders=orders,
        triggers=triggers,
    )
    spread = rows.selectExpr(*keys, "created_at AS _at", "1 AS _kind", "xxhash64(seq) AS _tie")
    scanned = running_in_key(merged, keys, ["_at", "_kind", "_tie"], "_seq", "max", "_last", source=spread, split=split)
    return scanned.where("_kind = 1 AND _last IS NOT NULL").selectExpr("order_id", "_last AS trigger")


def quarantine_cascade(classified: DataFrame, lookback: float = CASCADE_LOOKBACK, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """Orders that some user or product trigger holds: (order_id, q_seq, q_reason).

    The last trigger by arrival decides the reason; triggers that arrived before the
    order was first written do not count.
    """
    return cascade_marks(first_writes(classified), classified, lookback, classified, split)


def cascade_marks(first: DataFrame, classified: DataFrame, lookback: float, rows: DataFrame, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """(order_id, q_seq, q_reason) of the orders with first rows ``first`` that triggers in ``classified`` reach.

    ``rows`` are rows to place the cuts of heavy keys by.
    """
    users = classified.where(f"reason = '{FRAUD_USER}'")
    items = classified.where(f"reason = '{FRAUD_PRODUCT}'")
    return classified.sparkSession.sql(
        nested(
            f"""
            SELECT r.order_id, max(r.trigger) AS q_seq, max_by(r.reason, r.trigger) AS q_reason
            FROM @reached r JOIN {{first}} f ON r.order_id = f.order_id AND r.trigger >= f.seq
            GROUP BY r.order_id
            """,
            reached=f"""
              SELECT order_id, trigger, '{FRAUD_USER}' AS reason FROM {{by_user}}
              UNION ALL SELECT order_id, trigger, '{FRAUD_PRODUCT}' FROM {{by_product}}
            """,
        ),
        by_user=last_trigger(first, users, ["user_id"], lookback, rows, split),
        by_product=last_trigger(first, items, ["product_id"], lookback, rows, split),
        first=first,
    )


def quarantine_orders(
    classified: DataFrame, lookback: float = CASCADE_LOOKBACK, split: Split = DEFAULT_SPLIT, quarantined: DataFrame | None = None
) -> DataFrame:
    """Final status and reason per order: (order_id, current_status, hold_reason_code).

    Sticky: any own HOLD stays, and the first own reason is kept unless a trigger matched.
    ``quarantined`` gives marks (order_id, q_reason) that are known already.
    """
    return classified.sparkSession.sql(
        nested(
            f"""
            SELECT o.order_id,
              CASE WHEN o.held OR q.q_reason IS NOT NULL THEN '{HOLD}' ELSE o.status END AS current_status,
              coalesce(q.q_reason, o.reason) AS hold_reason_code
            FROM @own o LEFT JOIN {{quarantined}} q ON o.order_id = q.order_id
            """,
            own=f"""
              SELECT order_id, bool_or(current_status = '{HOLD}') AS held, max_by(current_status, seq) AS status,
                min_by(reason, CASE WHEN reason IS NOT NULL THEN seq END) AS reason
              FROM {{classified}} WHERE order_id IS NOT NULL GROUP BY order_id
            """,
        ),
        classified=classified,
        quarantined=quarantine_cascade(classified, lookback, split) if quarantined is None else quarantined,
    )


def quarantine_ledger(ledger: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Ledger rows already written when their order's last trigger came take its reason.

    ``ledger`` has seq, order_id, current_status and reason.
    """
    kept = ", ".join(f"l.{c}" for c in ledger.columns if c not in ("current_status", "reason"))
    return ledger.sparkSession.sql(
        f"""
        SELECT {kept},
          CASE WHEN q.q_seq >= l.seq THEN '{HOLD}' ELSE l.current_status END AS current_status,
          CASE WHEN q.q_seq >= l.seq THEN q.q_reason ELSE l.reason END AS reason
        FROM {{ledger}} l LEFT JOIN {{quarantined}} q ON l.order_id = q.order_id
        """,
        ledger=ledger,
        quarantined=quarantined,
    )


def quarantine_pair(classified: DataFrame, lookback: float = PAIR_LOOKBACK, split: Split = DEFAULT_SPLIT) -> DataFrame:
    """The anchored profile: (order_id, current_status, hold_reason_code).

    A trigger holds other open orders of the same user and product. It acts on an order
    whose last own row is not HOLD and came before the trigger; a trigger after the last
    own row is always another order's. ``classified`` also has hold_reason.
    """
    triggers = classified.where(f"reason = '{FRAUD_USER}'")
    reached = last_trigger(first_writes(classified), triggers, ["user_id", "product_id"], lookback, classified, split)
    return classified.sparkSession.sql(
        nested(
            f"""
            SELECT order_id,
              CASE WHEN hit THEN '{HOLD}' ELSE last.current_status END AS current_status,
              CASE WHEN hit THEN '{FRAUD_USER}' ELSE last.hold_reason END AS hold_reason_code
            FROM @marked
            """,
            own=f"""
              SELECT order_id, max_by(struct(seq, current_status, hold_reason), seq) AS last
              FROM {{classified}} WHERE order_id IS NOT NULL GROUP BY order_id
            """,
            marked=f"""
              SELECT o.order_id, o.last, coalesce(o.last.current_status <> '{HOLD}' AND r.trigger > o.last.seq, false) AS hit
              FROM @own o LEFT JOIN {{reached}} r ON o.order_id = r.order_id
            """,
        ),
        classified=classified,
        reached=reached,
    )
