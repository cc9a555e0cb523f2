"""Declared schemas.  JSON is never schema-inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: one reading as it travels on a topic (all fields nullable).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("sensor_id", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("is_peer_outlier", T.BooleanType(), True),
    T.StructField("peer_deviation", T.DoubleType(), True),
    T.StructField("facility_id", T.StringType(), True),
    T.StructField("crop_type", T.StringType(), True),
    T.StructField("growth_week", T.IntegerType(), True),
    T.StructField("ingested_at", T.StringType(), True),
    T.StructField("facility_aggregate", T.DoubleType(), True),
    T.StructField("sensor_count", T.IntegerType(), True),
    T.StructField("healthy_sensor_count", T.IntegerType(), True),
])

# Message envelope of a topic source (the columns a Kafka source yields that
# the jobs use).  File-backed test streams carry the same columns.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("landed_at", T.TimestampNTZType(), True),
    T.StructField("key", T.BinaryType(), True),
    T.StructField("partition", T.IntegerType(), True),
])

PAYLOAD_READING = T.StructType([
    T.StructField("sensor_id", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("is_peer_outlier", T.BooleanType(), True),
    T.StructField("peer_deviation", T.DoubleType(), True),
])

PAYLOAD_GROUP = T.StructType([
    T.StructField("sensors", T.ArrayType(PAYLOAD_READING, True), True),
    T.StructField("facility_aggregate", T.DoubleType(), True),
    T.StructField("sensor_count", T.IntegerType(), True),
    T.StructField("healthy_sensor_count", T.IntegerType(), True),
])

# One poll document per facility.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("facility_id", T.StringType(), True),
    T.StructField("crop_type", T.StringType(), True),
    T.StructField("growth_week", T.IntegerType(), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("polled_at", T.StringType(), True),
    T.StructField("readings", T.MapType(T.StringType(), PAYLOAD_GROUP, True), True),
])

# Tables of the jobs, partition columns included: declared, so that folder
# names are never type-inferred.
_LANDING = [
    T.StructField("source_topic", T.StringType(), True),
    T.StructField("bronze_landed_at", T.TimestampNTZType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("hour", T.IntegerType(), True),
]
BRONZE_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, *_LANDING])

SILVER_SCHEMA = T.StructType([
    *[T.StructField(f.name, T.TimestampNTZType() if f.name == "ingested_at" else f.dataType, True)
      for f in MESSAGE_SCHEMA.fields if f.name != "timestamp"],
    *_LANDING,
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("sensor_type", T.StringType(), True),
    T.StructField("anomaly_type", T.StringType(), True),
    T.StructField("is_anomaly", T.BooleanType(), True),
    T.StructField("silver_processed_at", T.TimestampNTZType(), True),
    T.StructField("event_date", T.DateType(), True),
])

VPD_SCHEMA = T.StructType([
    T.StructField("facility_id", T.StringType(), True),
    T.StructField("temperature_sensor_id", T.StringType(), True),
    T.StructField("humidity_sensor_id", T.StringType(), True),
    T.StructField("event_ts", T.TimestampNTZType(), True),
    T.StructField("humidity_ts", T.TimestampNTZType(), True),
    T.StructField("temperature", T.DoubleType(), True),
    T.StructField("humidity", T.DoubleType(), True),
    T.StructField("vpd_kpa", T.DoubleType(), True),
    T.StructField("window_start", T.TimestampNTZType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("hour", T.IntegerType(), True),
])
