"""The deterministic ``readings`` view over the ``events`` table.

Pure projection of ``events`` (no shuffle, no row dropped), so every query
built on it scales with ``events``.  The same definition, in SQL, is the
oracle's fixture (``verdant.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.session import ensure_session

# Event type -> sensor type of the fixture.
EVENT_SENSOR_TYPES = {
    "view": "temperature",
    "click": "humidity",
    "purchase": "co2",
    "signup": "light",
    "error": "airflow",
}


def readings_from_events(events: DataFrame) -> DataFrame:
    fac = F.when(F.col("user_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    stype = F.col("event_type")
    sensor_type = F.lit(None).cast("string")
    for event_type, name in reversed(list(EVENT_SENSOR_TYPES.items())):
        sensor_type = F.when(stype == event_type, F.lit(name)).otherwise(sensor_type)
    base = events.select("event_id", "ts", "user_id", "value",
                         fac.alias("fac"), sensor_type.alias("sensor_type"))
    v = F.col("value")
    value = (F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("double"))
             .when(F.col("event_id") % 97 == 0, F.lit(-1.0))
             .when(F.col("sensor_type") == "temperature", F.lit(13) + v / F.lit(7))
             .when(F.col("sensor_type") == "humidity", F.lit(58) + v / F.lit(7))
             .when(F.col("sensor_type") == "co2", F.lit(500) + v * F.lit(71) / F.lit(7))
             .when(F.col("sensor_type") == "light", F.lit(100) + v * F.lit(43) / F.lit(7))
             .otherwise(v / F.lit(91)))
    return base.select(
        "event_id",
        F.concat(F.lit("facility_"), F.col("fac")).alias("facility_id"),
        F.when(F.col("fac") == "A", F.lit("tomato")).otherwise(F.lit("cucumber")).alias("crop_type"),
        F.when(F.col("fac") == "A", F.lit(6)).otherwise(F.lit(4)).alias("growth_week"),
        "sensor_type",
        F.concat(F.lit("sensors."), F.col("sensor_type")).alias("source_topic"),
        F.concat(F.col("sensor_type"), F.lit("_"), F.col("fac"), F.lit("_zone"),
                    (F.col("user_id") % 3 + 1).cast("string")).alias("sensor_id"),
        F.concat(F.col("sensor_type"), F.lit("_u"), F.col("user_id").cast("string")).alias("device_id"),
        value.alias("value"),
        F.col("ts").alias("event_ts"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                          (F.col("event_id") % 120))).alias("landed_at"),
    )


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return readings_from_events(events)
