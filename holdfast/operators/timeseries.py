"""Dashboard time series over the stored 30-minute windows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame

from holdfast.plans.nested import nested
from holdfast.functions.times import BUCKET, at, between, day_start, floor_bucket, floor_hour, hour_start, spine, type_of
from holdfast.vocabulary import ALERT_COLUMNS, EVENT_COLUMNS, FLOW_COLUMNS, HOLD, INGEST_COLUMNS


def _each(template: str, names: list[str]) -> str:
    return ", ".join(template.format(c=c) for c in names)


def last_value_by(value: str, order: str) -> str:
    """Value at the greatest ``order``, a null value included."""
    return f"max_by({value}, {order})"


def holds_in_range(orders: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row: orders now on HOLD and created in [start, end)."""
    created = between("created_at", type_of(orders, "created_at"), start, end)
    return orders.where(f"current_status = '{HOLD}' AND {created}").selectExpr("count(*) AS holds_now")


def ts_12h_30m(metrics: DataFrame, orders: DataFrame, as_of: datetime) -> DataFrame:
    """24 half-hour points, the last being the bucket in progress at ``as_of``.

    Repeated rows of one window collapse by maximum, alert counts add up.
    """
    last = floor_bucket(as_of)
    first = last - timedelta(hours=11, minutes=30)
    like = type_of(metrics, "window_start")
    levels = [*FLOW_COLUMNS, *INGEST_COLUMNS, "backlog", "late_orders", *EVENT_COLUMNS, "delay_p95_sec"]
    return metrics.sparkSession.sql(
        nested(
            f"""
            SELECT s.ts, {_each('coalesce(a.{c}, 0) AS {c}', [*levels, *ALERT_COLUMNS])}, (SELECT holds_now FROM {{held}}) AS holds_now
            FROM {{spine}} s LEFT JOIN @a a ON s.ts = a.ts ORDER BY s.ts
            """,
            a=f"""
              SELECT window_start AS ts, {_each('max({c}) AS {c}', levels)}, {_each('sum({c}) AS {c}', ALERT_COLUMNS)}
              FROM {{metrics}}
              WHERE {between('window_start', like, first, last + BUCKET)} AND window_end <= {at(last + BUCKET, like)}
              GROUP BY window_start
            """,
        ),
        metrics=metrics,
        held=holds_in_range(orders, first, last),
        spine=spine(metrics.sparkSession, first, last, BUCKET, like),
    )


def ts_24h_1h(metrics: DataFrame, orders: DataFrame, as_of: datetime) -> DataFrame:
    """24 hourly points: sums of flows, the hour's last delay and backlog.

    ``holds_now`` is the count for the whole range, zero at hours without windows.
    """
    hour = timedelta(hours=1)
    last = floor_hour(as_of)
    first = last - timedelta(hours=23)
    like = type_of(metrics, "window_start")
    sums = [*FLOW_COLUMNS, *EVENT_COLUMNS, *ALERT_COLUMNS]
    return metrics.sparkSession.sql(
        nested(
            f"""
            SELECT s.ts, {_each('coalesce(a.{c}, 0) AS {c}', [*sums, 'delay_p95_sec', 'backlog'])},
              CASE WHEN a.ts IS NULL THEN 0L ELSE (SELECT holds_now FROM {{held}}) END AS holds_now
            FROM {{spine}} s LEFT JOIN @a a ON s.ts = a.ts ORDER BY s.ts
            """,
            m=f"""
              SELECT *, {hour_start('window_start')} AS ts FROM {{metrics}}
              WHERE {between('window_start', like, first, last + hour)} AND window_end <= {at(last + hour, like)}
            """,
            a=f"""
              SELECT ts, {_each('sum({c}) AS {c}', sums)}, {last_value_by('delay_p95_sec', 'window_end')} AS delay_p95_sec,
                {last_value_by('backlog', 'window_end')} AS backlog
              FROM @m GROUP BY ts
            """,
        ),
        metrics=metrics,
        held=holds_in_range(orders, first, last),
        spine=spine(metrics.sparkSession, first, last, hour, like),
    )


def local_date(as_of: datetime, tz: str | None) -> date:
    """The local day of a moment; a naive moment is already local time."""
    return as_of.astimezone(ZoneInfo(tz)).date() if tz and as_of.tzinfo else as_of.date()


def ts_daily(metrics: DataFrame, orders: DataFrame, as_of: datetime, days: int, tz: str | None = None) -> DataFrame:
    """Daily points for ``days`` days, today included; days without windows are absent."""
    today = datetime.combine(local_date(as_of, tz), datetime.min.time())
    if tz:
        today = today.replace(tzinfo=ZoneInfo(tz))
    first, after = today - timedelta(days=days - 1), today + timedelta(days=1)
    like = type_of(metrics, "window_start")
    sums = [*FLOW_COLUMNS, *INGEST_COLUMNS, *EVENT_COLUMNS, *ALERT_COLUMNS]
    lasts = ", ".join(f"{last_value_by(c, 'window_end')} AS {c}" for c in ("delay_p95_sec", "backlog", "late_orders"))
    return metrics.sparkSession.sql(
        nested(
            f"""        SELECT *, (SELECT holds_now FROM {{held}}) AS holds_now FROM @a a ORDER BY ts""",
            m=f"SELECT *, {day_start('window_start', like, tz)} AS ts FROM {{metrics}} WHERE {between('window_start', like, first, after)}",
            a=f"SELECT ts, {_each('sum({c}) AS {c}', sums)}, {lasts} FROM @m GROUP BY ts",
        ),
        metrics=metrics,
        held=holds_in_range(orders, first, after),
    )


def ts_7d_1d(metrics: DataFrame, orders: DataFrame, as_of: datetime, tz: str | None = None) -> DataFrame:
    return ts_daily(metrics, orders, as_of, 7, tz)


def ts_30d_1d(metrics: DataFrame, orders: DataFrame, as_of: datetime, tz: str | None = None) -> DataFrame:
    return ts_daily(metrics, orders, as_of, 30, tz)


def preset_range(preset: str, as_of: datetime, tz: str | None = None) -> tuple[datetime, datetime]:
    """[first, after) of the windows a preset shows, to read just those."""
    if preset == "12h_30m":
        last = floor_bucket(as_of)
        return last - timedelta(hours=11, minutes=30), last + BUCKET
    if preset == "24h_1h":
        last = floor_hour(as_of)
        return last - timedelta(hours=23), last + timedelta(hours=1)
    today = datetime.combine(local_date(as_of, tz), datetime.min.time())
    return today - timedelta(days=int(preset.split("d")[0]) - 1), today + timedelta(days=1)


PRESETS = {"12h_30m": ts_12h_30m, "24h_1h": ts_24h_1h, "7d_1d": ts_7d_1d, "30d_1d": ts_30d_1d}


def timeseries(preset: str, metrics: DataFrame, orders: DataFrame, as_of: datetime, tz: str | None = None) -> DataFrame:
    """The points of a preset; unknown presets are refused."""
    if preset not in PRESETS:
        raise ValueError(f"invalid preset {preset!r}, expected one of {list(PRESETS)}")
    build = PRESETS[preset]
    return build(metrics, orders, as_of, tz) if preset.endswith("1d") else build(metrics, orders, as_of)
