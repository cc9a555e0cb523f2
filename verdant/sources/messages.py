"""Topic message sources: a broker stream, or files with the same columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.constants import TOPIC_MAP
from verdant.functions.columns import iso_string, message_key, unit_of_sensor_type
from verdant.schemas import ENVELOPE_SCHEMA


KAFKA_MISSING = ("the Kafka source/sink needs the spark-sql-kafka-0-10 package on the classpath "
                 "(e.g. spark.jars.packages=org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)")


def kafka_guard(action):
    """Run ``action()``; a missing Kafka connector becomes a clear error."""
    try:
        return action()
    except Exception as err:  # noqa: BLE001 - re-raised with the fix
        text = str(err)
        if "kafka" in text.lower() and ("data source" in text.lower() or "DATA_SOURCE_NOT_FOUND" in text):
            raise RuntimeError(KAFKA_MISSING) from err
        raise


def read_messages(spark: SparkSession, fmt: str, options: Mapping[str, str] | None = None,
                  topics: Sequence[str] = tuple(TOPIC_MAP.values()), path: str | None = None,
                  stream: bool = True) -> DataFrame:
    """Subscribe to ``topics``.

    ``fmt="kafka"`` uses the Kafka source (``subscribe``; offsets from
    ``options``, e.g. ``startingOffsets``); progress lives in the streaming
    checkpoint, and the broker's timestamp is ``landed_at``.  Any file format (``parquet``, ``json``) reads envelope files
    with the columns of ``ENVELOPE_SCHEMA`` from ``path`` and
    keeps the subscribed topics.
    """
    opts = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        return kafka_guard(lambda: reader.format("kafka").option("subscribe", ",".join(topics))
                           .options(**opts).load()
                           .withColumn("landed_at", F.col("timestamp").cast("timestamp_ntz")))
    df = reader.format(fmt).schema(ENVELOPE_SCHEMA).options(**opts).load(path)
    return df.where(F.col("topic").isin(list(topics)))


def message_struct(readings: DataFrame) -> DataFrame:
    """Readings -> the fields of one message (as travels on a topic)."""
    return readings.select(
        "sensor_id", "value",
        unit_of_sensor_type("sensor_type").alias("unit"),
        iso_string("event_ts").alias("timestamp"),
        F.lit(False).alias("is_peer_outlier"),
        F.lit(None).cast("double").alias("peer_deviation"),
        "facility_id", "crop_type", "growth_week",
        iso_string("landed_at").alias("ingested_at"),
        F.lit(None).cast("double").alias("facility_aggregate"),
        F.lit(None).cast("int").alias("sensor_count"),
        F.lit(None).cast("int").alias("healthy_sensor_count"),
        "source_topic", "event_id", "landed_at",
    )


def envelopes_from_readings(readings: DataFrame, partitions: int = 1) -> DataFrame:
    """Readings -> message envelopes (topic, JSON bytes, offset, landed_at, key, partition).

    Messages are spread over ``partitions`` by their key, as a broker does;
    offsets grow by arrival within a partition and are not comparable across
    partitions (each starts at a place of its own).  A projection: no shuffle.
    """
    msg = message_struct(readings)
    fields = [c for c in msg.columns if c not in ("source_topic", "event_id", "landed_at")]
    key = message_key()
    partition = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    return msg.select(
        F.col("source_topic").alias("topic"),
        F.to_json(F.struct(*[F.col(c) for c in fields])).cast("binary").alias("value"),
        (F.col("event_id") + partition * F.lit(1_000_000_007)).alias("offset"),
        F.col("landed_at").cast("timestamp_ntz").alias("landed_at"),
        key.cast("binary").alias("key"),
        partition.alias("partition"),
    )
