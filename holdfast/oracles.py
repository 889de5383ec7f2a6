"""DuckDB SQL for the registered queries, over the driver's tables."""

from __future__ import annotations

# The bound ledger, orders and products, as in binding.py.
_BASE = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
s AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'PAID' WHEN 'click' THEN 'PICKING'
    WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 'CANCELED' ELSE 'PACKED' END
    WHEN 'purchase' THEN CASE WHEN k % 2 = 1 THEN 'DELIVERED' ELSE 'SHIPPED' END ELSE 'HOLD' END AS status,
    ([NULL, 'OPEN', 'ACK', 'RESOLVED', 'RETRY_REQUESTED'])[event_id % 5 + 1] AS state
  FROM e
),
led AS (
  SELECT event_id AS seq, CAST(event_id AS VARCHAR) AS event_id, 'ord-' || (event_id // 4) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(k AS VARCHAR) AS product_id, 'item ' || k AS product_name,
    CASE WHEN k % 13 = 0 THEN '' WHEN k % 17 = 0 THEN 'Unknown st' ELSE 'addr-' || user_id END AS shipping_address,
    CASE WHEN status = 'PAID' THEN 'PAYMENT' WHEN status IN ('PICKING', 'PACKED') THEN 'FULFILLMENT'
      WHEN status IN ('SHIPPED', 'DELIVERED') THEN 'LOGISTICS' ELSE 'SYSTEM' END AS current_stage,
    status AS current_status, upper(event_type) AS event_type,
    CASE WHEN status = 'HOLD' THEN (['FUL-VALID', 'FUL-INV', 'FUL-FRAUD-USER', 'FUL-FRAUD-PROD'])[k % 4 + 1] END AS reason_code,
    ts AS occurred_at, ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS ingested_at,
    CASE WHEN status = 'HOLD' THEN state END AS ops_status,
    CASE WHEN status = 'HOLD' AND state IS NOT NULL THEN 'op-' || (event_id % 7) END AS ops_operator, k
  FROM s
),
prod AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_size - 5 AS stock FROM part),
ord AS (
  SELECT l.order_id, l.user_id, l.product_id, l.product_name, l.shipping_address, l.current_stage, l.current_status,
    l.event_type AS last_event_type, l.occurred_at AS last_occurred_at, l.reason_code AS hold_reason_code,
    l.ops_status AS hold_ops_status, l.ops_operator AS hold_ops_operator, f.created_at
  FROM led l JOIN (SELECT order_id, max(seq) AS seq, min(occurred_at) AS created_at FROM led GROUP BY order_id) f USING (order_id, seq)
),
bounds AS (
  SELECT *, as_of - INTERVAL 350 MINUTE AS asked FROM (
    SELECT time_bucket(INTERVAL 30 MINUTE, least(min(occurred_at), min(ingested_at))) AS first,
      time_bucket(INTERVAL 30 MINUTE, max(ingested_at)) + INTERVAL 30 MINUTE AS as_of FROM led)
)"""

# The buckets that hold all rows, the moment the dashboards are asked at, and its bucket, hour and day.
_FIRST = "(SELECT first FROM bounds)"
_AS_OF = "(SELECT as_of FROM bounds)"
_DAY = "(SELECT asked FROM bounds)"
_BUCKET = "(SELECT time_bucket(INTERVAL 30 MINUTE, asked) FROM bounds)"
_HOUR = "(SELECT date_trunc('hour', asked) FROM bounds)"
_TODAY = "(SELECT CAST(date_trunc('day', asked) AS TIMESTAMP) FROM bounds)"


def _metrics(start: str = _FIRST, end: str = _AS_OF, as_of: str = _AS_OF) -> str:
    """The metrics windows of [start, end) as a part named mw."""
    return f"""
spine AS (SELECT unnest(generate_series({start}, {end} - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) AS ts),
ev AS (
  SELECT time_bucket(INTERVAL '30 minutes', ingested_at) AS ts, count(*) FILTER (current_status = 'PAID') AS payments,
    count(*) FILTER (current_status = 'SHIPPED') AS shipped, count(*) AS n, count(*) FILTER (current_status = 'HOLD') AS errors,
    quantile_cont(epoch_us(ingested_at) - epoch_us(occurred_at), 0.95) / 1e6 AS p95,
    count(*) FILTER (current_status = 'HOLD' AND coalesce(ops_status, 'OPEN') = 'OPEN') AS a_open,
    count(*) FILTER (current_status = 'HOLD' AND ops_status = 'ACK') AS a_ack,
    count(*) FILTER (current_status = 'HOLD' AND ops_status = 'RESOLVED') AS a_resolved,
    count(*) FILTER (current_status = 'HOLD' AND ops_status = 'RETRY_REQUESTED') AS a_retry
  FROM led GROUP BY 1
),
oc AS (SELECT time_bucket(INTERVAL '30 minutes', created_at) AS ts, count(*) AS n FROM ord GROUP BY 1),
hd AS (
  SELECT time_bucket(INTERVAL '30 minutes', l.ingested_at) AS ts, count(DISTINCT l.order_id) AS n
  FROM led l JOIN ord o USING (order_id) WHERE o.current_status IN ('HOLD', 'ORDER_HOLD') GROUP BY 1
),
nw AS (
  SELECT count(*) FILTER (current_status = 'PAID') AS backlog, count(*) FILTER (current_status = 'HOLD') AS holds_now,
    count(*) FILTER (current_status = 'PAID' AND created_at < {as_of} - INTERVAL 2 HOUR) AS late_orders
  FROM ord
),
mw AS (
  SELECT sp.ts AS window_start, sp.ts + INTERVAL 30 MINUTE AS window_end, coalesce(oc.n, 0) AS orders, coalesce(ev.payments, 0) AS payments,
    coalesce(ev.shipped, 0) AS shipped, coalesce(hd.n, 0) AS holds, coalesce(round(coalesce(hd.n, 0) / nullif(oc.n, 0), 6), 0.0) AS hold_rate,
    coalesce(ev.n, 0) AS ingest_count, CAST(0 AS BIGINT) AS parse_errors, CAST(0 AS BIGINT) AS schema_missing,
    nw.backlog, nw.holds_now, nw.late_orders, coalesce(ev.n, 0) AS event_total, coalesce(ev.errors, 0) AS event_errors,
    coalesce(round(ev.p95, 6), 0.0) AS delay_p95_sec, coalesce(ev.a_open, 0) AS alerts_open, coalesce(ev.a_ack, 0) AS alerts_ack,
    coalesce(ev.a_resolved, 0) AS alerts_resolved, coalesce(ev.a_retry, 0) AS alerts_retry, {as_of} AS created_at
  FROM spine sp LEFT JOIN ev ON ev.ts = sp.ts LEFT JOIN oc ON oc.ts = sp.ts LEFT JOIN hd ON hd.ts = sp.ts CROSS JOIN nw
)"""


def _base(text: str, *parts: str) -> str:
    return "WITH RECURSIVE " + ", ".join([_BASE, *parts]) + "\n" + text


def _mw(text: str, *parts: str) -> str:
    return _base(text, _metrics(), *parts)


# --- messages ------------------------------------------------------------------------

# What normalisation should make of the envelopes built in binding.py.
_NORMAL = """
norm AS (
  SELECT seq AS "offset", order_id, user_id, product_id, product_name, nullif(shipping_address, '') AS shipping_address, current_stage,
    CASE WHEN k % 19 <> 0 THEN current_status END AS current_status,
    CASE WHEN k % 7 = 1 THEN 'ORDER_CREATED' WHEN k % 3 = 0 THEN event_type WHEN k % 19 <> 0 THEN current_status ELSE 'UNKNOWN' END AS event_type,
    reason_code, CASE WHEN k = 94 THEN ingested_at ELSE occurred_at END AS occurred_at, occurred_at AS created_at, ingested_at
  FROM led WHERE k < 95
),
named AS (
  SELECT *, order_id || '|' || event_type || '|' || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS name FROM norm
),
digest AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(name)) AS d FROM named),
ids AS (
  SELECT *, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-'
    || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS event_id
  FROM digest
)"""

# --- rules ---------------------------------------------------------------------------

_STATIC = """
st AS (
  SELECT l.*, CASE WHEN trim(user_id) = '' OR trim(l.product_id) = '' OR length(trim(shipping_address)) < 5 THEN 'FUL-VALID'
    WHEN p.product_id IS NULL THEN 'FUL-VALID' WHEN p.stock <= 0 THEN 'FUL-INV' END AS static
  FROM led l LEFT JOIN prod p ON l.product_id = p.product_id
),
bu AS (
  SELECT seq, count(*) OVER (PARTITION BY user_id ORDER BY occurred_at RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) > 5 AS hit
  FROM st WHERE static IS NULL
),
bp AS (
  SELECT seq, count(*) OVER (PARTITION BY product_id ORDER BY occurred_at RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) > 5 AS hit
  FROM st JOIN bu USING (seq) WHERE NOT bu.hit
),
cls AS (
  SELECT st.*, coalesce(static, CASE WHEN bu.hit THEN 'FUL-FRAUD-USER' WHEN bp.hit THEN 'FUL-FRAUD-PROD' END) AS reason
  FROM st LEFT JOIN bu USING (seq) LEFT JOIN bp USING (seq)
)"""

_QUARANTINE = _STATIC + """,
cl AS (SELECT * REPLACE (CASE WHEN reason IS NOT NULL THEN 'HOLD' ELSE current_status END AS current_status) FROM cls),
fw AS (SELECT * FROM cl QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1),
hits AS (
  SELECT f.order_id, g.seq, g.reason FROM fw f JOIN cl g
    ON g.seq >= f.seq AND f.occurred_at >= g.occurred_at - INTERVAL 1 DAY
    AND ((g.reason = 'FUL-FRAUD-USER' AND g.user_id = f.user_id) OR (g.reason = 'FUL-FRAUD-PROD' AND g.product_id = f.product_id))
),
q AS (SELECT order_id, max(seq) AS q_seq, arg_max(reason, seq) AS q_reason FROM hits GROUP BY order_id)"""


def _anchored(rows: str, out: str) -> str:
    """Windows of 10 days anchored at their first row, more than 3 rows, over a part."""
    return f"""
nx AS (
  SELECT a.seq, a.user_id, a.product_id, a.occurred_at, min(b.occurred_at) AS following
  FROM {rows} a LEFT JOIN {rows} b ON a.user_id = b.user_id AND a.product_id = b.product_id AND b.occurred_at > a.occurred_at + INTERVAL 10 DAY
  GROUP BY ALL
),
chain AS (
  SELECT user_id, product_id, occurred_at, following FROM nx QUALIFY row_number() OVER (PARTITION BY user_id, product_id ORDER BY occurred_at) = 1
  UNION ALL
  SELECT n.user_id, n.product_id, n.occurred_at, n.following
  FROM chain c JOIN nx n ON n.user_id = c.user_id AND n.product_id = c.product_id AND n.occurred_at = c.following
),
opened AS (SELECT n.seq, n.user_id, n.product_id, n.occurred_at, c.occurred_at AS anchor FROM nx n ASOF JOIN chain c
  ON n.user_id = c.user_id AND n.product_id = c.product_id AND n.occurred_at >= c.occurred_at),
{out} AS (SELECT seq, row_number() OVER (PARTITION BY user_id, product_id, anchor ORDER BY occurred_at) > 3 AS burst FROM opened)"""


_PAIRS = "pairs AS (SELECT * REPLACE (CAST(k % 5 AS VARCHAR) AS product_id) FROM led)"
_BAD = """CASE WHEN user_id = '' OR length(shipping_address) < 5 OR contains(shipping_address, '?') OR contains(shipping_address, 'Unknown')
  OR contains(shipping_address, '123') OR contains(shipping_address, 'NULL') THEN 'FUL-VALID' END"""
_HELD_PAIRS = [
    _PAIRS,
    f"kept AS (SELECT * FROM pairs WHERE {_BAD} IS NULL)",
    _anchored("kept", "anch"),
    f"ac AS (SELECT p.*, coalesce({_BAD}, CASE WHEN a.burst THEN 'FUL-FRAUD-USER' END) AS reason FROM pairs p LEFT JOIN anch a USING (seq))",
]

# --- snapshot ------------------------------------------------------------------------

_GAPPY = """
gp AS (
  SELECT seq, order_id, nullif(CASE WHEN k % 5 <> 0 THEN user_id END, '') AS user_id, product_id,
    CASE WHEN k % 7 <> 0 THEN product_name END AS product_name, nullif(shipping_address, '') AS shipping_address,
    CASE WHEN k % 11 <> 0 THEN current_stage END AS current_stage, CASE WHEN k % 17 <> 0 THEN current_status END AS current_status,
    event_type, occurred_at, reason_code, ingested_at
  FROM led
),
seeds AS (
  SELECT order_id, min(seq) AS seed FROM gp
  WHERE user_id IS NOT NULL AND product_name IS NOT NULL AND shipping_address IS NOT NULL AND current_stage IS NOT NULL AND current_status IS NOT NULL
  GROUP BY order_id
)"""

_STATE = "o.order_id, o.product_id, o.current_stage"
_ACT = """
act AS (
  SELECT seq, order_id, (['STATUS', 'HOLD_OPS', 'CLEAR'])[k % 3 + 1] AS kind, (['PICKING', 'HOLD', 'SHIPPED'])[(k // 3) % 3 + 1] AS next_status,
    (['ACK', 'RESOLVED'])[k % 2 + 1] AS new_status, 'op-' || (k % 5) AS operator, ingested_at + INTERVAL 5 MINUTE AS "at"
  FROM led
),
acc AS (SELECT a.* FROM act a JOIN ord o USING (order_id) SEMI JOIN prod p ON o.product_id = p.product_id WHERE a.kind = 'STATUS')"""

# --- operator actions ----------------------------------------------------------------

_OPS = """
oa AS (
  SELECT seq * 4 + j AS seq, CASE WHEN j = 3 THEN 'gone-' || event_id ELSE event_id END AS event_id,
    (['ACK', 'RESOLVED', 'RETRY_REQUESTED'])[(k + j * (k % 2)) % 3 + 1] AS new_status, CASE WHEN j = 1 THEN 'second look' END AS note,
    'op-' || j AS operator, ingested_at + to_minutes(j + 1) AS "at"
  FROM led CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j) WHERE current_status = 'HOLD'
),
steps AS (
  SELECT a.*, l.ingested_at, l.event_id IS NOT NULL AS found,
    CASE WHEN l.event_id IS NOT NULL THEN coalesce(lag(a.new_status) OVER (PARTITION BY a.event_id ORDER BY a.seq), l.ops_status, 'OPEN') END AS prev_status
  FROM oa a LEFT JOIN led l USING (event_id)
),
tr AS (SELECT * FROM steps WHERE found AND prev_status <> new_status)"""

_COUNTERS = {"OPEN": "alerts_open", "ACK": "alerts_ack", "RESOLVED": "alerts_resolved", "RETRY_REQUESTED": "alerts_retry"}
_MOVES = """
mv AS (
  SELECT time_bucket(INTERVAL '30 minutes', ingested_at) AS ts, seq, prev_status AS state, -1 AS move FROM tr
  UNION ALL SELECT time_bucket(INTERVAL '30 minutes', ingested_at), seq, new_status, 1 FROM tr
),
run AS (SELECT *, sum(move) OVER (PARTITION BY ts, state ORDER BY seq) AS r FROM mv),
net AS (SELECT ts, state, sum(move) AS total, min(r) AS low FROM run GROUP BY ts, state)"""


def _moved(state: str, column: str) -> str:
    one = f"FROM net WHERE net.ts = mw.window_start AND net.state = '{state}'"
    total, low = f"coalesce((SELECT total {one}), 0)", f"coalesce((SELECT low {one}), 0)"
    return f"CAST({column} + {total} + greatest(0, -least({column}, {column} + {low})) AS BIGINT) AS {column}"


# --- time series ---------------------------------------------------------------------

_SUM = "CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}"
_FLOWS = ["orders", "payments", "shipped", "holds"]
_INGEST = ["ingest_count", "parse_errors", "schema_missing"]
_EVENTS = ["event_total", "event_errors"]
_ALERTS = list(_COUNTERS.values())


def _each(template: str, *groups: list[str]) -> str:
    return ", ".join(template.format(c=c) for g in groups for c in g)


def _held_between(start: str, end: str) -> str:
    return f"(SELECT count(*) FROM ord WHERE current_status = 'HOLD' AND created_at >= {start} AND created_at < {end})"


_TS_12H = f"""
pts AS (
  SELECT t.ts, {_each('coalesce(max({c}), 0) AS {c}', _FLOWS, _INGEST, ['backlog', 'late_orders'], _EVENTS)},
    coalesce(max(delay_p95_sec), 0) AS delay_p95_sec, {_each(_SUM, _ALERTS)},
    {_held_between(_BUCKET + " - INTERVAL 690 MINUTE", _BUCKET)} AS holds_now
  FROM (SELECT unnest(generate_series({_BUCKET} - INTERVAL 690 MINUTE, {_BUCKET}, INTERVAL 30 MINUTE)) AS ts) t
  LEFT JOIN mw ON mw.window_start = t.ts GROUP BY t.ts
)"""

_TS_24H = f"""
pts AS (
  SELECT t.ts, {_each(_SUM, _FLOWS, _EVENTS, _ALERTS)}, coalesce(arg_max(delay_p95_sec, window_end), 0) AS delay_p95_sec,
    coalesce(arg_max(backlog, window_end), 0) AS backlog, CASE WHEN count(mw.window_start) = 0 THEN 0 ELSE
    {_held_between(_HOUR + " - INTERVAL 23 HOUR", _HOUR)} END AS holds_now
  FROM (SELECT unnest(generate_series({_HOUR} - INTERVAL 23 HOUR, {_HOUR}, INTERVAL 1 HOUR)) AS ts) t
  LEFT JOIN mw ON date_trunc('hour', mw.window_start) = t.ts GROUP BY t.ts
)"""


def _daily(days: int) -> str:
    first, after = f"{_TODAY} - INTERVAL {days - 1} DAY", f"{_TODAY} + INTERVAL 1 DAY"
    return f"""
pts AS (
  SELECT CAST(date_trunc('day', window_start) AS TIMESTAMP) AS ts, {_each(_SUM, _FLOWS, _INGEST, _EVENTS, _ALERTS)},
    arg_max_null(delay_p95_sec, window_end) AS delay_p95_sec, arg_max_null(backlog, window_end) AS backlog,
    arg_max_null(late_orders, window_end) AS late_orders, {_held_between(first, after)} AS holds_now
  FROM mw WHERE window_start >= {first} AND window_start < {after} GROUP BY 1
)"""


_ORDER_LIST = "order_id, current_stage, current_status, hold_reason_code, last_event_type, last_occurred_at, created_at"
_EVENT_LIST = "event_id, order_id, event_type, current_status, reason_code, occurred_at, ingested_at"
_ALERT = """'event:' || event_id AS alert_key, 'EVENT' AS kind, coalesce(ops_status, 'OPEN') AS status, order_id, event_id, reason_code AS reason,
  {time} AS occurred_at, ops_operator AS operator"""


def _fill(column: str) -> str:
    return f"arg_max({column}, g.seq) FILTER ({column} IS NOT NULL) AS {column}"


ORACLES: dict[str, str] = {
    "ledger_bind": _base("SELECT * EXCLUDE (k) FROM led"),
    "ledger_dedup": _base(
        """
        SELECT event_id, seq, order_id, current_status FROM (
          SELECT event_id, seq, order_id, current_status FROM led
          UNION ALL SELECT event_id, seq + 1000000000, order_id, 'AGAIN' FROM led
        ) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq) = 1"""
    ),
    "ledger_append": _base("SELECT event_id, seq, order_id, current_status FROM led WHERE current_status <> 'HOLD'"),
    "raw_split": _base(
        """
        SELECT CASE k WHEN 98 THEN 'PARSE_ERROR' WHEN 95 THEN 'NOT_OBJECT' ELSE 'EMPTY_JSON' END AS error_type, 'event' AS kafka_topic,
          seq AS kafka_offset, ingested_at AS occurred_at FROM led WHERE k >= 95"""
    ),
    "raw_land": _base(
        """
        SELECT CAST("offset" % 4 AS INTEGER) AS part, "offset" AS kafka_offset, order_id, product_name, 'event' AS meta_topic,
          CAST("offset" AS VARCHAR) AS meta_offset, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS meta_ingested_at,
          event_id AS meta_event_id FROM ids""",
        _NORMAL,
    ),
    "normalize_event": _base(
        """
        SELECT "offset", order_id, user_id, product_id, product_name, shipping_address, current_stage, current_status, event_type,
          coalesce(current_status, event_type) AS ledger_status, reason_code, occurred_at, created_at FROM norm""",
        _NORMAL,
    ),
    "event_id_v5": _base('SELECT "offset", event_id FROM ids', _NORMAL),
    "latency": _base(
        """
        SELECT "offset", round((epoch_us(ingested_at) - epoch_us(created_at)) / 1e6, 6) AS latency_p_to_k_sec,
          round((epoch_us(ingested_at) - epoch_us(created_at)) / 1e6, 6) AS latency_p_to_d_sec FROM norm""",
        _NORMAL,
    ),
    "alert_log": _base(
        """
        SELECT 'alert:' || event_id AS alert_id, order_id, 'PENDING' AS send_status, '*Risk Detected! Order Blocked*' AS title,
          reason_code AS reason, order_id AS shown_id, '/orders/' || order_id AS url FROM led WHERE reason_code IS NOT NULL"""
    ),
    "rule_required": _base(
        "SELECT seq, CASE WHEN trim(user_id) = '' OR trim(product_id) = '' OR length(trim(shipping_address)) < 5 THEN 'FUL-VALID' END AS reason FROM led"
    ),
    "rule_bad_address": _base(f"SELECT seq, {_BAD} AS reason FROM led"),
    "rule_stock_cascade": _base(
        """
        SELECT l.seq, CASE WHEN p.product_id IS NULL THEN 'FUL-VALID' WHEN p.stock <= 0 THEN 'FUL-INV' END AS reason
        FROM led l LEFT JOIN prod p ON l.product_id = p.product_id"""
    ),
    "rule_stock_paid": _base(
        """
        SELECT l.seq, CASE WHEN l.current_status = 'PAID' AND (p.product_id IS NULL OR p.stock <= 0) THEN 'FUL-INV' END AS reason
        FROM led l LEFT JOIN prod p ON l.product_id = p.product_id"""
    ),
    "burst_user": _base(
        """
        SELECT seq, count(*) OVER (PARTITION BY user_id ORDER BY occurred_at RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) > 5 AS burst
        FROM led"""
    ),
    "burst_product": _base(
        """
        SELECT seq, count(*) OVER (PARTITION BY product_id ORDER BY occurred_at RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) > 5 AS burst
        FROM led"""
    ),
    "burst_cascade": _base("SELECT seq, reason FROM cls", _STATIC),
    "burst_paid": _base(
        """
        SELECT seq, reason AS hold_reason, CASE WHEN reason IS NOT NULL THEN 'HOLD' ELSE current_status END AS current_status FROM (
          SELECT l.seq, l.current_status, coalesce(
            CASE WHEN l.current_status = 'PAID' AND (p.product_id IS NULL OR p.stock <= 0) THEN 'FUL-INV' END,
            CASE WHEN b.hit THEN 'FUL-FRAUD-PROD' END) AS reason
          FROM led l LEFT JOIN prod p ON l.product_id = p.product_id LEFT JOIN (
            SELECT seq, count(*) OVER (PARTITION BY product_id ORDER BY occurred_at RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW) >= 4 AS hit
            FROM led WHERE current_status = 'PAID') b USING (seq)
        )"""
    ),
    # A row drops every kept row more than a day older. So a row is dropped by the first
    # later arrival that is more than a day newer; what is left at a row is arrivals so
    # far minus drops so far.
    "burst_arrival": _base(
        """
        SELECT r.seq, r.n - count(d.dropped) > 5 AS burst FROM ranked r LEFT JOIN drops d ON d.user_id = r.user_id AND d.dropped <= r.seq
        GROUP BY r.seq, r.n""",
        """
arr AS (SELECT user_id, occurred_at, (seq + 40 * (k % 7)) * 10000000000 + seq AS seq FROM led),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS n FROM arr),
drops AS (
  SELECT a.user_id, a.seq, min(b.seq) AS dropped FROM arr a JOIN arr b
    ON a.user_id = b.user_id AND b.seq > a.seq AND b.occurred_at > a.occurred_at + INTERVAL 1 DAY GROUP BY a.user_id, a.seq
)""",
    ),
    "burst_anchored": _base("SELECT seq, burst FROM anch", _PAIRS, _anchored("pairs", "anch")),
    "hold_anchored": _base(
        """
        SELECT seq, coalesce(reason, CASE WHEN k % 6 = 0 OR current_stage = 'HOLD' THEN 'SYSTEM_HOLD' END) AS hold_reason,
          CASE WHEN reason IS NOT NULL OR k % 6 = 0 THEN 'HOLD' ELSE current_status END AS current_status,
          CASE WHEN k % 6 = 0 THEN 'HOLD' ELSE current_stage END AS current_stage FROM ac""",
        *_HELD_PAIRS,
    ),
    "quarantine_orders": _base(
        """
        SELECT o.order_id, CASE WHEN o.held OR q.q_seq IS NOT NULL THEN 'HOLD' ELSE o.status END AS current_status,
          coalesce(q.q_reason, o.reason) AS hold_reason_code
        FROM (
          SELECT order_id, bool_or(current_status = 'HOLD') AS held, arg_max(current_status, seq) AS status,
            arg_min(reason, seq) FILTER (reason IS NOT NULL) AS reason FROM cl GROUP BY order_id
        ) o LEFT JOIN q USING (order_id)""",
        _QUARANTINE,
    ),
    "quarantine_ledger": _base(
        """
        SELECT c.seq, c.order_id, CASE WHEN q.q_seq >= c.seq THEN 'HOLD' ELSE c.current_status END AS current_status,
          CASE WHEN q.q_seq >= c.seq THEN q.q_reason ELSE c.reason END AS reason FROM cl c LEFT JOIN q USING (order_id)""",
        _QUARANTINE,
    ),
    "quarantine_pair": _base(
        """
        SELECT l.order_id, CASE WHEN hit THEN 'HOLD' ELSE l.current_status END AS current_status,
          CASE WHEN hit THEN 'FUL-FRAUD-USER' ELSE l.reason END AS hold_reason_code
        FROM (
          SELECT l.*, l.current_status <> 'HOLD' AND EXISTS (
            SELECT 1 FROM av g JOIN af f ON g.user_id = f.user_id AND g.product_id = f.product_id AND f.occurred_at >= g.occurred_at - INTERVAL 1 DAY
            WHERE f.order_id = l.order_id AND g.reason = 'FUL-FRAUD-USER' AND g.seq > l.seq AND g.order_id <> l.order_id) AS hit
          FROM al l
        ) l""",
        *_HELD_PAIRS,
        "av AS (SELECT * REPLACE (CASE WHEN reason IS NOT NULL THEN 'HOLD' ELSE current_status END AS current_status) FROM ac)",
        "af AS (SELECT * FROM av QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq) = 1)",
        "al AS (SELECT * FROM av QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1)",
    ),
    "snapshot_latest": _base(
        """
        SELECT o.order_id, o.user_id, o.product_id, o.product_name, 'to ' || o.user_id AS shipping_address, o.current_stage, o.current_status,
          o.last_event_type, o.last_occurred_at, o.hold_reason_code, m.seq AS raw_reference, m.created_at, o.hold_ops_status, o.hold_ops_operator
        FROM ord o JOIN (SELECT order_id, max(seq) AS seq, arg_min(ingested_at, seq) AS created_at FROM led GROUP BY order_id) m USING (order_id)"""
    ),
    "snapshot_fill": _base(
        f"""
        SELECT g.order_id, {', '.join(_fill(c) for c in ('user_id', 'product_id', 'product_name', 'shipping_address'))},
          arg_max(current_stage, g.seq) AS current_stage, arg_max(current_status, g.seq) AS current_status,
          arg_max(event_type, g.seq) AS last_event_type, arg_max(occurred_at, g.seq) AS last_occurred_at,
          arg_max_null(reason_code, g.seq) AS hold_reason_code, max(g.seq) AS raw_reference, arg_min(ingested_at, g.seq) AS created_at
        FROM gp g JOIN seeds s ON g.order_id = s.order_id AND g.seq >= s.seed
        WHERE current_stage IS NOT NULL AND current_status IS NOT NULL GROUP BY g.order_id""",
        _GAPPY,
    ),
    "snapshot_rejects": _base(
        """
        SELECT * FROM (
          SELECT g.seq, g.order_id, concat_ws(',', CASE WHEN current_stage IS NULL THEN 'current_stage' END,
            CASE WHEN current_status IS NULL THEN 'current_status' END,
            CASE WHEN NOT stored AND user_id IS NULL THEN 'user_id' END, CASE WHEN NOT stored AND product_name IS NULL THEN 'product_name' END,
            CASE WHEN NOT stored AND shipping_address IS NULL THEN 'shipping_address' END) AS missing
          FROM (SELECT g.*, coalesce(s.seed < g.seq, false) AS stored FROM gp g LEFT JOIN seeds s USING (order_id)) g
        ) WHERE missing <> ''""",
        _GAPPY,
    ),
    "snapshot_sticky": _base(
        """
        SELECT order_id, arg_min(user_id, seq) AS user_id, arg_min(product_id, seq) AS product_id, arg_min(product_name, seq) AS product_name,
          arg_min(shipping_address, seq) AS shipping_address, arg_min(current_stage, seq) AS current_stage,
          CASE WHEN bool_or(current_status = 'HOLD') THEN 'HOLD' ELSE arg_max(current_status, seq) END AS current_status,
          arg_min(event_type, seq) AS last_event_type, arg_max(occurred_at, seq) AS last_occurred_at,
          arg_min(reason_code, seq) FILTER (reason_code IS NOT NULL) AS hold_reason_code, min(seq) AS raw_reference,
          arg_min(occurred_at, seq) AS created_at FROM led GROUP BY order_id"""
    ),
    "snapshot_partial": _base(
        """
        SELECT order_id, arg_min(user_id, seq) AS user_id, arg_min(product_id, seq) AS product_id, arg_min(product_name, seq) AS product_name,
          arg_min(shipping_address, seq) AS shipping_address, arg_max(current_stage, seq) AS current_stage,
          arg_max(current_status, seq) AS current_status, arg_min(event_type, seq) AS last_event_type, arg_min(occurred_at, seq) AS last_occurred_at,
          arg_max_null(reason_code, seq) AS hold_reason_code, max(seq) AS raw_reference, arg_min(occurred_at, seq) AS created_at
        FROM led GROUP BY order_id"""
    ),
    "order_status_change": _base(
        f"""
        SELECT {_STATE}, coalesce(c.next_status, o.current_status) AS current_status, coalesce(c.next_status, o.last_event_type) AS last_event_type,
          coalesce(c."at", o.last_occurred_at) AS last_occurred_at, CASE WHEN c.clears THEN NULL ELSE o.hold_reason_code END AS hold_reason_code, o.created_at
        FROM ord o LEFT JOIN (
          SELECT order_id, arg_max(next_status, seq) AS next_status, arg_max("at", seq) AS "at", bool_or(next_status <> 'HOLD') AS clears
          FROM acc GROUP BY order_id) c USING (order_id)""",
        _ACT,
    ),
    "status_change_ledger": _base(
        """
        SELECT 'act-' || seq AS event_id, order_id, next_status AS event_type, next_status AS current_status, CAST(NULL AS VARCHAR) AS reason_code,
          "at" AS occurred_at, "at" AS ingested_at FROM acc""",
        _ACT,
    ),
    "hold_ops": _base(
        """
        SELECT o.order_id, o.current_status, coalesce(a.new_status, o.hold_ops_status) AS hold_ops_status, CAST(NULL AS VARCHAR) AS hold_ops_note,
          coalesce(a.operator, o.hold_ops_operator) AS hold_ops_operator, a."at" AS hold_ops_updated_at
        FROM ord o LEFT JOIN (SELECT * FROM act WHERE kind = 'HOLD_OPS' QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1) a
          USING (order_id)""",
        _ACT,
    ),
    "clear_hold": _base(
        f"""
        SELECT {_STATE}, CASE WHEN a."at" IS NULL THEN o.current_status ELSE 'PAID' END AS current_status,
          CASE WHEN a."at" IS NULL THEN o.last_event_type ELSE 'HOLD_CLEARED' END AS last_event_type, coalesce(a."at", o.last_occurred_at) AS last_occurred_at,
          o.hold_reason_code, o.created_at
        FROM ord o LEFT JOIN (SELECT order_id, arg_max("at", seq) AS "at" FROM act WHERE kind = 'CLEAR' GROUP BY order_id) a USING (order_id)""",
        _ACT,
    ),
    "rollup_30m": _mw("SELECT * FROM mw"),
    "rollup_errors": _mw(
        """
        SELECT mw.window_start, mw.ingest_count, coalesce(b.n, 0) AS parse_errors, coalesce(r.n, 0) AS schema_missing
        FROM mw LEFT JOIN (SELECT time_bucket(INTERVAL '30 minutes', ingested_at) AS ts, count(*) AS n FROM led WHERE k >= 95 GROUP BY 1) b
          ON b.ts = mw.window_start
        LEFT JOIN (
          SELECT time_bucket(INTERVAL '30 minutes', g.ingested_at) AS ts, count(*) AS n FROM gp g LEFT JOIN seeds s USING (order_id)
          WHERE current_stage IS NULL OR current_status IS NULL
            OR (coalesce(s.seed >= g.seq, true) AND (user_id IS NULL OR product_name IS NULL OR shipping_address IS NULL)) GROUP BY 1
        ) r ON r.ts = mw.window_start""",
        _GAPPY,
    ),
    "rollup_gaps": _mw(f"SELECT * FROM mw WHERE window_start >= {_AS_OF} - INTERVAL 1 DAY"),
    "rollup_reroll": _base("SELECT * FROM mw", _metrics(f"{_BUCKET} - INTERVAL 2 HOUR", _BUCKET, _DAY)),
    "rollup_backfill": _base("SELECT * FROM mw", _metrics(f"{_BUCKET} - INTERVAL 7 DAY", _BUCKET, _DAY)),
    "metrics_store": _mw(
        f"""
        SELECT * EXCLUDE (late_orders, created_at),
          CASE WHEN fresh THEN (SELECT count(*) FROM ord WHERE current_status = 'PAID' AND created_at < {_DAY} - INTERVAL 2 HOUR) ELSE late_orders END AS late_orders,
          CASE WHEN fresh THEN {_DAY} ELSE created_at END AS created_at
        FROM (SELECT *, window_start >= {_AS_OF} - INTERVAL 2 DAY AS fresh FROM mw)"""
    ).replace("* EXCLUDE (late_orders, created_at)", "* EXCLUDE (late_orders, created_at, fresh)"),
    "latest_window": _mw("SELECT * FROM mw ORDER BY window_end DESC LIMIT 1"),
    "max_window_end": _mw("SELECT max(window_end) AS max_end FROM mw"),
    "ts_12h_30m": _mw("SELECT * FROM pts", _TS_12H),
    "ts_24h_1h": _mw("SELECT * FROM pts", _TS_24H),
    "ts_7d_1d": _mw("SELECT * FROM pts", _daily(7)),
    "ts_30d_1d": _mw("SELECT * FROM pts", _daily(30)),
    "summary": _mw(
        f"""
        SELECT count(*) FILTER (today) AS orders_today,
          (SELECT count(*) FROM led WHERE current_status = 'SHIPPED' AND CAST(occurred_at AS DATE) = CAST({_TODAY} AS DATE)) AS shipped_today,
          count(*) FILTER (today AND current_status = 'PAID') AS backlog, count(*) FILTER (today AND current_status = 'HOLD') AS holds_now,
          count(*) FILTER (current_status IN ('PICKING', 'PACKED', 'SHIPPED')) AS in_progress_now,
          count(*) FILTER (current_status IN ('DELIVERED', 'CANCELED')) AS completed_now, CAST(0 AS BIGINT) AS late_shipments,
          any_value(w.window_start) AS window_start, any_value(w.window_end) AS window_end, any_value(w.orders) AS orders_window,
          any_value(w.payments) AS payments_window, any_value(w.shipped) AS shipped_window, any_value(w.holds) AS holds_window,
          any_value(w.hold_rate) AS hold_rate, any_value(w.ingest_count) AS ingest_count, any_value(w.parse_errors) AS parse_errors,
          any_value(w.schema_missing) AS schema_missing, any_value(strftime(w.created_at, '%Y-%m-%dT%H:%M:%S.%g')) AS metrics_created_at
        FROM (SELECT *, CAST(created_at AS DATE) = CAST({_TODAY} AS DATE) AS today FROM ord) o
        CROSS JOIN (SELECT * FROM mw ORDER BY window_end DESC LIMIT 1) w"""
    ),
    "kpi_orders": _mw(
        """
        SELECT max(ts) AS updated_at, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(shipped) AS BIGINT) AS shipped, CAST(sum(holds) AS BIGINT) AS holds,
          arg_max(backlog, ts) AS backlog, arg_min(holds_now, ts) AS holds_now, CAST(0 AS BIGINT) AS late_orders,
          coalesce(round(sum(holds) / nullif(sum(orders), 0), 6), 0) AS hold_rate FROM pts""",
        _TS_24H,
    ),
    "kpi_events": _mw(
        f"""
        SELECT max(ts) AS updated_at, CAST(sum(event_total) AS BIGINT) AS event_total, CAST(sum(event_errors) AS BIGINT) AS event_errors,
          coalesce(round(sum(event_errors) / nullif(sum(event_total), 0), 6), 0) AS error_rate,
          {_each("string_agg(CAST(CAST(trunc({c}) AS BIGINT) AS VARCHAR), ',' ORDER BY ts) AS {c}", ["delay_p95_sec", *_INGEST])} FROM pts""",
        _TS_12H,
    ),
    "kpi_alerts": _mw(
        f"SELECT max(ts) AS updated_at, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {s}' for s, c in _COUNTERS.items())} FROM pts",
        _daily(7),
    ),
    "on_time_rate": _base(
        f"""
        SELECT backlog, late_orders, round(least(greatest(1 - late_orders / greatest(backlog, 1), 0.0), 1.0), 6) AS on_time_rate FROM (
          SELECT count(*) FILTER (current_status NOT IN ('DELIVERED', 'CANCELED')) AS backlog,
            count(*) FILTER (current_status = 'PAID' AND created_at < {_DAY} - INTERVAL 2 HOUR) AS late_orders FROM ord)"""
    ),
    "recent_orders": _base(f"SELECT {_ORDER_LIST} FROM ord ORDER BY created_at DESC NULLS FIRST, order_id DESC LIMIT 20"),
    "orders_page": _base(
        f"""
        SELECT {_ORDER_LIST} FROM ord WHERE current_status = 'PICKING' AND current_stage = 'FULFILLMENT' AND order_id ILIKE '%ORD-1%'
        ORDER BY created_at DESC NULLS FIRST, order_id DESC LIMIT 200"""
    ),
    "order_one": _base(
        "SELECT o.* EXCLUDE (product_name), p.product_name FROM ord o JOIN prod p USING (product_id) WHERE o.order_id = 'ord-0'"
    ),
    "events_page": _base(
        f"""
        SELECT {_EVENT_LIST} FROM led WHERE order_id ILIKE '%rd-1_%' AND event_type ILIKE '%ERR%' AND reason_code IS NOT NULL
        ORDER BY ingested_at DESC NULLS FIRST, event_id DESC LIMIT 300"""
    ),
    "order_events": _base(f"SELECT {_EVENT_LIST} FROM led WHERE order_id = 'ord-0' ORDER BY ingested_at DESC LIMIT 200"),
    "alerts": _base(
        f"""
        SELECT * FROM (
          SELECT {_ALERT.format(time='occurred_at')} FROM led WHERE reason_code IS NOT NULL
          UNION ALL
          SELECT 'hold:' || order_id, 'HOLD', coalesce(hold_ops_status, 'OPEN'), order_id, NULL, hold_reason_code, last_occurred_at, hold_ops_operator
          FROM ord WHERE hold_reason_code IS NOT NULL
        ) ORDER BY occurred_at DESC NULLS FIRST, alert_key DESC LIMIT 50"""
    ),
    "alerts_page": _base(
        f"""
        SELECT * FROM (SELECT {_ALERT.format(time='ingested_at')} FROM led WHERE reason_code IS NOT NULL) WHERE status = 'ACK'
        ORDER BY occurred_at DESC NULLS FIRST, alert_key DESC LIMIT 300"""
    ),
    "order_alerts": _base(f"SELECT {_ALERT.format(time='occurred_at')} FROM led WHERE reason_code IS NOT NULL AND order_id = 'ord-0'"),
    "alert_keys": _base(
        """
        SELECT seq, CASE k % 3 WHEN 0 THEN 'EVENT' WHEN 1 THEN 'HOLD' END AS kind,
          CASE k % 3 WHEN 0 THEN event_id WHEN 1 THEN order_id || ':x' END AS target FROM led"""
    ),
    "ops_apply": _base(
        """
        SELECT l.event_id, l.current_status, coalesce(a.new_status, l.ops_status) AS ops_status, a.note AS ops_note,
          coalesce(a.operator, l.ops_operator) AS ops_operator, a."at" AS ops_updated_at
        FROM led l LEFT JOIN (SELECT * FROM oa QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY seq DESC) = 1) a USING (event_id)""",
        _OPS,
    ),
    "ops_requests": _base(
        """
        SELECT seq, CASE WHEN k % 4 = 0 THEN 'HOLD' ELSE 'EVENT' END AS kind, CASE WHEN k % 4 = 0 THEN order_id ELSE event_id END AS target,
          (['ACK', 'RESOLVED', 'RETRY_REQUESTED'])[seq % 4 + 1] AS new_status,
          CASE WHEN k % 5 = 0 THEN 'seen' WHEN seq % 4 = 2 THEN 'retry requested' END AS note, 'op' AS operator, ingested_at AS "at"
        FROM led WHERE k % 4 <> 3 AND seq % 4 <> 3"""
    ),
    "ops_transitions": _base("SELECT seq, event_id, prev_status, new_status, ingested_at, \"at\" FROM tr", _OPS),
    "ops_counters": _mw(f"SELECT window_start, {', '.join(_moved(s, c) for s, c in _COUNTERS.items())} FROM mw", _OPS, _MOVES),
    "ops_audit": _mw(
        """
        SELECT s.seq, s.event_id AS arg_event_id, s.new_status AS arg_new_status, CAST(found AS BIGINT) AS e_prev_found, prev_status,
          CAST(found AND prev_status <> s.new_status AS BIGINT) AS chg_count, CAST(found AS BIGINT) AS event_updated,
          CAST(found AND prev_status <> s.new_status AND m.window_start IS NOT NULL AS BIGINT) AS metrics_updated
        FROM steps s LEFT JOIN mw m ON m.window_start <= s.ingested_at AND s.ingested_at < m.window_end""",
        _OPS,
    ),
    "stream_rollup": _base(
        """
        SELECT time_bucket(INTERVAL '30 minutes', ingested_at) AS window_start, time_bucket(INTERVAL '30 minutes', ingested_at) + INTERVAL 30 MINUTE AS window_end,
          count(*) FILTER (current_status = 'PAID') AS payments, count(*) FILTER (current_status = 'SHIPPED') AS shipped, count(*) AS ingest_count,
          count(*) FILTER (current_status = 'HOLD') AS event_errors,
          count(*) FILTER (current_status = 'HOLD' AND coalesce(ops_status, 'OPEN') = 'OPEN') AS alerts_open,
          count(*) FILTER (current_status = 'HOLD' AND ops_status = 'ACK') AS alerts_ack,
          count(*) FILTER (current_status = 'HOLD' AND ops_status = 'RESOLVED') AS alerts_resolved,
          count(*) FILTER (current_status = 'HOLD' AND ops_status = 'RETRY_REQUESTED') AS alerts_retry
        FROM led GROUP BY ALL"""
    ),
    "stream_dedup": _base("SELECT event_id, order_id FROM led"),
}
ORACLES["stream_burst"] = ORACLES["burst_user"]
ORACLES["stream_anchored"] = ORACLES["burst_anchored"]
ORACLES["stream_snapshot"] = ORACLES["snapshot_fill"]
ORACLES["stream_intake"] = _base(
    """
    SELECT n.order_id, arg_max(user_id, n.pos) AS user_id, arg_max(product_id, n.pos) AS product_id, arg_max(product_name, n.pos) AS product_name,
      arg_max(shipping_address, n.pos) FILTER (shipping_address IS NOT NULL) AS shipping_address, arg_max(current_stage, n.pos) AS current_stage,
      arg_max(current_status, n.pos) AS current_status, arg_max(event_type, n.pos) AS last_event_type, arg_max(occurred_at, n.pos) AS last_occurred_at,
      arg_max_null(reason_code, n.pos) AS hold_reason_code, arg_max("offset", n.pos) AS last_offset, arg_min(ingested_at, n.pos) AS created_at
    FROM arrived n JOIN (
      SELECT order_id, min(pos) AS start FROM arrived WHERE shipping_address IS NOT NULL AND current_status IS NOT NULL GROUP BY order_id
    ) s ON n.order_id = s.order_id AND n.pos >= s.start
    WHERE current_status IS NOT NULL GROUP BY n.order_id""",
    _NORMAL,
    "arrived AS (SELECT *, row_number() OVER (ORDER BY ingested_at, \"offset\" % 4, \"offset\") AS pos FROM norm)",
)
ORACLES["stream_late_rows"] = ORACLES["stream_rollup"].replace("count(*) AS ingest_count", "count(*) AS event_total")
ORACLES["stream_metrics"] = ORACLES["rollup_30m"]
ORACLES["stream_quarantine"] = ORACLES["quarantine_orders"]
ORACLES["stream_quarantine_ledger"] = ORACLES["quarantine_ledger"]
ORACLES["stream_quarantine_pair"] = ORACLES["quarantine_pair"]
ORACLES["stream_snapshot_sticky"] = ORACLES["snapshot_sticky"]
ORACLES["stream_snapshot_partial"] = ORACLES["snapshot_partial"]

# --- profiles of the continuous intake, in order of arrival ---------------------------

_TAKEN = """
taken AS (
  SELECT n.*, coalesce(current_status, 'PAID') AS status, row_number() OVER (ORDER BY ingested_at, "offset" % 4, "offset") AS pos,
    p.product_id IS NOT NULL AS known, p.stock
  FROM norm n LEFT JOIN prod p ON n.product_id = p.product_id
)"""


def _arrival(out: str, rows: str, key: str, time: str, interval: str, limit: int) -> str:
    """A part (pos, hit): more than ``limit`` rows of the key are kept, where each row drops older ones for good."""
    return f"""
{out}_n AS (SELECT {key} AS key, pos, {time} AS t, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS n FROM {rows}),
{out}_d AS (
  SELECT a.key, a.pos, min(b.pos) AS dropped FROM {out}_n a JOIN {out}_n b ON a.key = b.key AND b.pos > a.pos AND b.t > a.t + INTERVAL {interval} GROUP BY a.key, a.pos
),
{out} AS (
  SELECT r.pos, r.n - count(d.dropped) > {limit} AS hit FROM {out}_n r LEFT JOIN {out}_d d ON d.key = r.key AND d.dropped <= r.pos GROUP BY r.pos, r.n
)"""


ORACLES["stream_intake_cascade"] = _base(
    """
    SELECT c.order_id, arg_min(user_id, pos) AS user_id, arg_min(product_id, pos) AS product_id, arg_min(current_stage, pos) AS current_stage,
      CASE WHEN bool_or(c.reason IS NOT NULL OR status = 'HOLD') OR any_value(q.q_seq) IS NOT NULL THEN 'HOLD' ELSE arg_max(status, pos) END AS current_status,
      arg_max(created_at, pos) AS last_occurred_at, coalesce(any_value(q.q_reason), arg_min(c.reason, pos) FILTER (c.reason IS NOT NULL)) AS hold_reason_code,
      arg_min("offset", pos) AS reference, arg_min(created_at, pos) AS created_at
    FROM judged c LEFT JOIN q ON c.order_id = q.order_id GROUP BY c.order_id""",
    _NORMAL,
    _TAKEN,
    """
sta AS (
  SELECT *, CASE WHEN trim(user_id) = '' OR trim(product_id) = '' OR length(trim(coalesce(shipping_address, ''))) < 5 OR NOT known THEN 'FUL-VALID'
    WHEN stock <= 0 THEN 'FUL-INV' END AS static FROM taken
),
users AS (SELECT * FROM sta WHERE static IS NULL)""",
    _arrival("bu", "users", "user_id", "created_at", "1 DAY", 5),
    "items AS (SELECT users.* FROM users JOIN bu USING (pos) WHERE NOT hit)",
    _arrival("bp", "items", "product_id", "created_at", "6 HOUR", 5),
    """
judged AS (
  SELECT sta.*, coalesce(static, CASE WHEN bu.hit THEN 'FUL-FRAUD-USER' WHEN bp.hit THEN 'FUL-FRAUD-PROD' END) AS reason
  FROM sta LEFT JOIN bu USING (pos) LEFT JOIN bp USING (pos)
),
fw AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos) = 1),
hits AS (
  SELECT f.order_id, g.pos, g.reason FROM fw f JOIN judged g ON g.pos >= f.pos AND f.created_at >= g.created_at - INTERVAL 1 DAY
    AND ((g.reason = 'FUL-FRAUD-USER' AND g.user_id = f.user_id) OR (g.reason = 'FUL-FRAUD-PROD' AND g.product_id = f.product_id))
),
q AS (SELECT order_id, max(pos) AS q_seq, arg_max(reason, pos) AS q_reason FROM hits GROUP BY order_id)""",
)
ORACLES["stream_intake_paid"] = _base(
    """
    SELECT j.order_id, arg_max(user_id, pos) AS user_id, arg_max(product_id, pos) AS product_id, arg_max(current_stage, pos) AS current_stage,
      arg_max(CASE WHEN reason IS NOT NULL THEN 'HOLD' ELSE coalesce(current_status, 'UNKNOWN') END, pos) AS current_status,
      arg_max(occurred_at, pos) AS last_occurred_at, arg_max_null(reason, pos) AS hold_reason_code, arg_max("offset", pos) AS reference,
      arg_min(ingested_at, pos) AS created_at
    FROM judged j JOIN (SELECT order_id, min(pos) AS start FROM judged WHERE shipping_address IS NOT NULL GROUP BY order_id) s
      ON j.order_id = s.order_id AND j.pos >= s.start GROUP BY j.order_id""",
    _NORMAL,
    _TAKEN,
    "paid AS (SELECT * FROM taken WHERE current_status = 'PAID')",
    _arrival("bp", "paid", "product_id", "occurred_at", "2 DAY", 3),
    """
judged AS (
  SELECT taken.*, CASE WHEN current_status = 'PAID' AND (NOT known OR stock <= 0) THEN 'FUL-INV' WHEN bp.hit THEN 'FUL-FRAUD-PROD' END AS reason
  FROM taken LEFT JOIN bp USING (pos)
)""",
)
ORACLES["stream_intake_anchored"] = _base(
    """
    SELECT l.order_id, f.user_id, f.product_id, l.current_stage, CASE WHEN hit THEN 'HOLD' ELSE l.now END AS current_status,
      f.created_at AS last_occurred_at, CASE WHEN hit THEN 'FUL-FRAUD-USER' ELSE l.reason END AS hold_reason_code, l."offset" AS reference, f.created_at
    FROM (
      SELECT l.*, now <> 'HOLD' AND EXISTS (
        SELECT 1 FROM judged g JOIN fw f ON g.user_id = f.user_id AND g.product_id = f.product_id AND f.created_at >= g.created_at - INTERVAL 1 DAY
        WHERE f.order_id = l.order_id AND g.reason = 'FUL-FRAUD-USER' AND g.pos > l.pos) AS hit
      FROM (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos DESC) = 1) l
    ) l JOIN fw f ON l.order_id = f.order_id""",
    _NORMAL,
    _TAKEN,
    f"""
pairs AS (
  SELECT t.* REPLACE (CAST(CAST(t.product_id AS INTEGER) % 5 AS VARCHAR) AS product_id), {_BAD.replace("length(shipping_address)", "length(coalesce(shipping_address, ''))")} AS static FROM taken t
),
open_n AS (SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY pos) AS n FROM pairs WHERE static IS NULL),
walk AS (
  SELECT user_id, product_id, pos, n, created_at AS anchor, 1 AS seen FROM open_n WHERE n = 1
  UNION ALL
  SELECT x.user_id, x.product_id, x.pos, x.n, CASE WHEN x.created_at > w.anchor + INTERVAL 10 DAY THEN x.created_at ELSE w.anchor END,
    CASE WHEN x.created_at > w.anchor + INTERVAL 10 DAY THEN 1 ELSE w.seen + 1 END
  FROM walk w JOIN open_n x ON x.user_id = w.user_id AND x.product_id = w.product_id AND x.n = w.n + 1
),
judged AS (
  SELECT p.*, coalesce(static, CASE WHEN w.seen > 3 THEN 'FUL-FRAUD-USER' END) AS reason,
    CASE WHEN static IS NOT NULL OR w.seen > 3 THEN 'HOLD' ELSE status END AS now
  FROM pairs p LEFT JOIN walk w USING (pos)
),
fw AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY pos) = 1)""",
)
