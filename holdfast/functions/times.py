"""Time expressions that work on both TIMESTAMP and TIMESTAMP_NTZ columns.

Expressions are SQL text, here and in the other modules: one step of an operator is then
parsed and analysed as a whole.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BUCKET = timedelta(minutes=30)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def at(moment: datetime, like: T.DataType) -> str:
    """A time literal of the same type as a column.

    Naive moments are wall-clock time of the session zone, aware ones are instants.
    """
    if moment.tzinfo is None:
        text = f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'"
    else:
        text = f"TIMESTAMP_LTZ '{moment.astimezone(timezone.utc).isoformat(sep=' ')}'"
    return f"CAST({text} AS {like.simpleString()})"


def span(seconds: float | timedelta) -> str:
    """A day-time interval."""
    if isinstance(seconds, timedelta):
        seconds = seconds.total_seconds()
    return f"make_dt_interval(0, 0, 0, {seconds:.6f})"


def micros(df: DataFrame, name: str) -> str:
    """Microseconds since the epoch, as bigint."""
    if isinstance(type_of(df, name), T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {name})"
    return f"unix_micros({name})"


def seconds_between(earlier: str, later: str) -> str:
    return f"timestampdiff(MICROSECOND, {earlier}, {later}) / 1e6D"


def bucket_start(ts: str) -> str:
    """Start of the 30-minute bucket holding ``ts``; rows where it is null are dropped."""
    return f"window({ts}, '30 minutes').start"


def hour_start(ts: str) -> str:
    return f"window({ts}, '1 hour').start"


def floor_bucket(moment: datetime) -> datetime:
    """Driver-side counterpart of :func:`bucket_start` for range ends."""
    return moment.replace(minute=moment.minute - moment.minute % 30, second=0, microsecond=0)


def floor_hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)


def day_start(ts: str, like: T.DataType, tz: str | None = None) -> str:
    """Midnight of the local day of ``ts`` in ``tz`` (default: the session zone).

    ``window(ts, '1 day')`` always cuts at UTC midnight, so it is of no use here.
    """
    if tz is None:
        return f"CAST(to_date({ts}) AS {like.simpleString()})"
    local = f"convert_timezone(current_timezone(), '{tz}', CAST({ts} AS timestamp_ntz))"
    midnight = f"convert_timezone('{tz}', current_timezone(), CAST(to_date({local}) AS timestamp_ntz))"
    return f"CAST({midnight} AS {like.simpleString()})"


def between(name: str, like: T.DataType, start: datetime, end: datetime) -> str:
    """start <= name < end, against literals, so that the scan can use it."""
    return f"({name} >= {at(start, like)} AND {name} < {at(end, like)})"


def spine(spark: SparkSession, start: datetime, last: datetime, step: timedelta, like: T.DataType) -> DataFrame:
    """One row ``ts`` per step from ``start`` to ``last``, both included; empty when start > last."""
    points = f"sequence({at(start, like)}, {at(last, like)}, {span(step)})"
    if start > last:
        points = f"CAST(array() AS array<{like.simpleString()}>)"
    return spark.sql(f"SELECT explode({points}) AS ts")


def as_utc(instant: str) -> str:
    """Wall-clock UTC time of an instant, without a zone."""
    return f"convert_timezone(current_timezone(), 'UTC', CAST({instant} AS timestamp_ntz))"


def from_utc(wall: str) -> str:
    """The instant of a UTC wall-clock time, whatever the session zone."""
    return f"CAST(convert_timezone('UTC', current_timezone(), {wall}) AS timestamp)"


def instant_text(instant: str) -> str:
    """UTC text of an instant, microseconds always present."""
    return f"concat(date_format({as_utc(instant)}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
