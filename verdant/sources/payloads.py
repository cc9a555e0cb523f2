"""Poll-payload documents: nested JSON, one per facility poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.constants import FACILITIES
from verdant.functions.columns import iso_string, mean_parts, rounded_mean, unit_of_sensor_type
from verdant.operators.quality import peer_outliers
from verdant.schemas import PAYLOAD_SCHEMA


def read_payloads(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Landed poll documents (JSON lines) against the declared schema."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(PAYLOAD_SCHEMA).json(path)


def parse_payloads(df: DataFrame, text_col: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> payload columns (plus the ``keep`` columns)."""
    keep = list(keep or [])
    return df.select(F.from_json(F.col(text_col), PAYLOAD_SCHEMA).alias("p"), *keep).select("p.*", *keep)


def payloads_from_readings(readings: DataFrame) -> DataFrame:
    """Readings as poll documents (JSON text in ``payload``): one per facility and minute.

    A document holds a group per sensor type, with its sensors (flagged
    against their peers of the poll) and the group's aggregate fields;
    ``landed_at`` is that of its last reading.  A poll is small (the sensors
    of one facility), so its readings are collected into its document.
    """
    loc = F.lit(None).cast("string")
    for fac, info in FACILITIES.items():
        loc = F.when(F.col("facility_id") == fac, F.lit(info["location"])).otherwise(loc)
    poll = F.date_trunc("minute", "event_ts").cast("timestamp_ntz")
    keys = ("facility_id", "crop_type", "growth_week", "sensor_type", "poll_ts")
    flagged = peer_outliers(readings.withColumn("poll_ts", poll), keys)
    reading = F.struct(
        F.col("sensor_id"), F.col("value"), unit_of_sensor_type("sensor_type").alias("unit"),
        iso_string("event_ts").alias("timestamp"), F.col("is_peer_outlier"), F.col("peer_deviation"))
    healthy = F.col("value").isNotNull() & ~F.col("is_peer_outlier")
    groups = flagged.groupBy(*keys).agg(
        F.sort_array(F.collect_list(reading)).alias("sensors"), *mean_parts(F.when(healthy, F.col("value"))),
        F.count(F.lit(1)).cast("int").alias("sensor_count"), F.count_if(healthy).cast("int").alias("healthy_sensor_count"),
        F.max("landed_at").alias("landed_at"))
    group = F.struct("sensors", rounded_mean(2).alias("facility_aggregate"), "sensor_count", "healthy_sensor_count")
    polls = groups.groupBy("facility_id", "crop_type", "growth_week", "poll_ts").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("sensor_type"), group.alias("group")))).alias("readings"),
        F.max("landed_at").alias("landed_at"))
    doc = F.struct("facility_id", "crop_type", "growth_week", loc.alias("location"),
                   iso_string("poll_ts").alias("polled_at"), "readings")
    return polls.select(F.to_json(doc).alias("payload"), "landed_at")
