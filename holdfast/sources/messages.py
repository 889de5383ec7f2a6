"""Reading order messages, decoding them, and setting the bad ones aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from holdfast.functions.times import instant_text
from holdfast.vocabulary import EMPTY_JSON, MESSAGE_SCHEMA, NOT_OBJECT, PARSE_ERROR, quoted

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


def _from_kafka(raw: DataFrame) -> DataFrame:
    return raw.selectExpr("topic", "partition", "offset", "CAST(value AS string) AS value", "timestamp AS ingested_at")


def read_messages(spark: SparkSession, fmt: str, options: dict[str, str], stream: bool = True, starting: str = "earliest") -> DataFrame:
    """Envelopes (topic, partition, offset, value, ingested_at) from a topic or files.

    ``fmt`` is ``kafka`` (needs the Kafka package on the cluster) or a file format whose
    files hold the envelope columns. ``starting`` is ``earliest`` or ``latest`` for a topic.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be earliest or latest")
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**options)
    if fmt == "kafka":
        return _from_kafka(reader.option("startingOffsets", starting).load())
    return reader.schema(ENVELOPE).load()


ARRIVAL = "struct(ingested_at, partition, offset)"
"""Arrival order across partitions: ingest time, then position."""

# Texts that hold no message although they are valid JSON.
EMPTY_TEXTS = ["null", "[]", '""', "0", "0.0", "-0", "-0.0", "false"]


def _bad_kind(value: str) -> str:
    """Dead-letter kind of a message text, null for a filled object.

    Decided on the text itself: a decoded ``{}`` looks like an object of nulls.
    """
    bare = f"regexp_replace({value}, r'\\s', '')"
    return f"""CASE
      WHEN json_object_keys({value}) IS NOT NULL THEN CASE WHEN size(json_object_keys({value})) = 0 THEN '{EMPTY_JSON}' END
      WHEN {bare} IN ({quoted(EMPTY_TEXTS)}) THEN '{EMPTY_JSON}'
      WHEN try_parse_json({value}) IS NULL THEN '{PARSE_ERROR}' ELSE '{NOT_OBJECT}' END"""


def decode_messages(df: DataFrame) -> DataFrame:
    """Adds ``record`` (all text fields) and ``bad`` (null for usable messages).

    Nested addresses keep their JSON text. Messages that are no object decode to nulls.
    """
    decoded = f"from_json(value, '{MESSAGE_SCHEMA.simpleString()}', map('mode', 'PERMISSIVE')) AS record"
    return df.selectExpr("*", decoded, f"{_bad_kind('value')} AS bad")


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable messages, and error-log rows of the others."""
    good = decoded.where("bad IS NULL").drop("bad")
    errors = decoded.where("bad IS NOT NULL").selectExpr(
        "bad AS error_type", "topic AS kafka_topic", "offset AS kafka_offset", "ingested_at AS occurred_at"
    )
    return good, errors


def land_raw(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Raw rows: the payload with a ``_meta`` object, keyed by its position in the topic.

    ``df`` has the envelope and event_id; ``extra`` adds fields to ``_meta`` (a profile's
    source, final status and hold reason).
    """
    more = "".join(f", '{name}', {value}" for name, value in (extra or {}).items())
    meta = f"""to_json(named_struct('kafka_topic', topic, 'kafka_partition', partition, 'kafka_offset', offset,
      'ingested_at', {instant_text('ingested_at')}, 'derived_event_id', event_id{more}))"""
    # The payload text is kept as sent; only its closing brace moves behind the new field.
    opened = "regexp_replace(value, r'\\s*\\}\\s*$', '')"
    comma = "CASE WHEN size(json_object_keys(value)) > 0 THEN ',' ELSE '' END"
    return df.selectExpr(
        "struct(topic, partition, offset) AS raw_id",
        f"concat({opened}, {comma}, '\"_meta\":', {meta}, '}}') AS raw_payload",
        "offset AS kafka_offset",
        "ingested_at",
    )
