"""Decoding and shaping of raw messages: JSON decode, typing, payload flatten,
topic routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.constants import SENSOR_TYPES, TOPIC_MAP
from verdant.functions.columns import (iso_string, message_key, parse_timestamp, sensor_type_of_topic,
                                       topic_of_sensor_type)
from verdant.schemas import MESSAGE_SCHEMA

CORRUPT = "_corrupt_record"


def parse_messages(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, landing_col: str | None = None,
                   topic_col: str = "topic", value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Envelope (topic, binary/string JSON value) -> one parsed row per message (``split_messages`` takes it on).

    Permissive decode against a fixed schema: a wrong-typed field becomes
    NULL, unknown fields are ignored.  ``raw_value`` holds the text of the
    messages that can't be landed only.
    """
    parse_schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    text = F.col(value_col).cast("string")
    landed = (F.col(landing_col).cast("timestamp_ntz") if landing_col
              else F.current_timestamp().cast("timestamp_ntz"))
    parsed = df.select(
        F.from_json(text, parse_schema, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}).alias("d"),
        text.alias("__raw"),
        F.col(topic_col).alias("source_topic"),
        landed.alias("bronze_landed_at"),
        *[F.col(c) for c in keep],
    )
    ok = F.col("d").isNotNull() & F.col("d.facility_id").isNotNull()
    reason = (F.when(ok, F.lit(None).cast("string"))
               .when(F.col("d").isNull(), F.lit("empty"))
               .when(F.col(f"d.{CORRUPT}").isNotNull(), F.lit("malformed"))
               .otherwise(F.lit("no_facility")))
    return parsed.select(*[F.col(f"d.{f.name}").alias(f.name) for f in schema.fields], "source_topic", "bronze_landed_at",
                         F.when(~ok, F.col("__raw")).alias("raw_value"), reason.alias("reason"), *keep)


def split_messages(parsed: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parsed messages -> (Bronze rows with landing ``date`` and ``hour``, quarantined messages)."""
    good = (parsed.where(F.col("reason").isNull())
                  .select(*schema.names, "source_topic", "bronze_landed_at", *keep)
                  .withColumn("date", F.to_date("bronze_landed_at"))
                  .withColumn("hour", F.hour("bronze_landed_at")))
    return good, parsed.where(F.col("reason").isNotNull()).select("source_topic", "raw_value", "bronze_landed_at", "reason", *keep)


def decode_messages(df: DataFrame, schema: T.StructType = MESSAGE_SCHEMA, landing_col: str | None = None,
                    topic_col: str = "topic", value_col: str = "value",
                    keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Envelope (topic, binary/string JSON value) -> Bronze rows + quarantine.

    Adds ``source_topic``, ``bronze_landed_at`` (``landing_col`` or the
    current time), and the landing ``date`` and ``hour``.  Rows that cannot be
    attributed to a facility (malformed text, NULL, missing ``facility_id``)
    go to the quarantine frame with their raw text instead of a NULL
    partition.  ``keep`` carries envelope columns (e.g. ``offset``) through.
    """
    return split_messages(parse_messages(df, schema, landing_col, topic_col, value_col, keep), schema, keep)


def type_readings(df: DataFrame, topic_map: Mapping[str, str] = TOPIC_MAP) -> DataFrame:
    """Bronze strings -> typed readings.

    ``value`` -> double (``try_cast``), ISO ``timestamp`` -> ``event_ts`` and
    ``ingested_at`` -> timestamps (with or without fraction; garbage -> NULL),
    ``sensor_type`` from the topic (unknown topic -> NULL).
    """
    out = df.withColumn("value", F.col("value").try_cast("double"))
    if "timestamp" in df.columns:
        out = out.withColumn("event_ts", parse_timestamp("timestamp")).drop("timestamp")
    if "ingested_at" in df.columns:
        out = out.withColumn("ingested_at", parse_timestamp("ingested_at"))
    return out.withColumn("sensor_type", sensor_type_of_topic("source_topic", topic_map))


def flatten_payload(df: DataFrame, sensor_types: Sequence[str] = SENSOR_TYPES,
                    ingested_at: Column | None = None, topic_map: Mapping[str, str] = TOPIC_MAP) -> DataFrame:
    """Poll documents -> one message row per reading.

    Known sensor groups only (absent and unknown groups are skipped), each
    reading of a group exploded, facility fields and group fields copied
    onto it, ``ingested_at`` stamped (ISO text), ``topic`` from its type.
    Per-row explodes: no shuffle.
    """
    stamp = ingested_at if ingested_at is not None else iso_string(F.current_timestamp())
    groups = (df.select("facility_id", "crop_type", "growth_week", stamp.alias("__ingested_at"),
                        F.explode("readings").alias("sensor_type", "grp"))
                .where(F.col("sensor_type").isin(list(sensor_types))))
    rows = groups.select("facility_id", "crop_type", "growth_week", "sensor_type", "__ingested_at",
                         F.col("grp.facility_aggregate").alias("facility_aggregate"),
                         F.col("grp.sensor_count").alias("sensor_count"),
                         F.col("grp.healthy_sensor_count").alias("healthy_sensor_count"),
                         F.explode("grp.sensors").alias("r"))
    return rows.select(
        F.col("r.sensor_id").alias("sensor_id"),
        F.col("r.value").alias("value"),
        F.col("r.unit").alias("unit"),
        F.col("r.timestamp").alias("timestamp"),
        F.col("r.is_peer_outlier").alias("is_peer_outlier"),
        F.col("r.peer_deviation").alias("peer_deviation"),
        "facility_id", "crop_type", "growth_week",
        F.col("__ingested_at").alias("ingested_at"),
        "facility_aggregate", "sensor_count", "healthy_sensor_count",
        topic_of_sensor_type("sensor_type", topic_map).alias("topic"),
    )


def route_topics(df: DataFrame, topic_map: Mapping[str, str] = TOPIC_MAP, type_col: str = "sensor_type",
                 fields: Sequence[str] | None = None) -> DataFrame:
    """Message rows -> (topic, key, JSON value) for a topic sink; unknown types dropped.

    The key names the sensor (facility and sensor id), so a broker keeps all
    messages of a sensor on one partition, in order.

    The topic comes from ``type_col`` through ``topic_map``; rows that
    already carry a ``topic`` (e.g. from ``flatten_payload``) and no type
    column keep theirs.
    """
    fields = list(fields or [f.name for f in MESSAGE_SCHEMA.fields if f.name in df.columns])
    if type_col in df.columns:
        topic = topic_of_sensor_type(type_col, topic_map)
    else:
        topic = F.when(F.col("topic").isin(list(topic_map.values())), F.col("topic"))
    return (df.withColumn("__topic", topic).where(F.col("__topic").isNotNull())
              .select(F.col("__topic").alias("topic"), message_key(df.columns).alias("key"),
                      F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value")))
