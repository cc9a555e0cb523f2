"""Column-building functions (JVM-side expressions, no UDFs)."""

from verdant.functions.columns import (
    anomaly_type,
    band_label,
    epoch_seconds,
    iso_string,
    nan_to_null,
    ntz_literal,
    parse_timestamp,
    range_score,
    range_violation,
    rounded_mean,
    sensor_type_of_topic,
    topic_of_sensor_type,
    unit_of_sensor_type,
    vpd_kpa,
)

__all__ = [
    "anomaly_type", "band_label", "epoch_seconds", "iso_string", "nan_to_null", "ntz_literal",
    "parse_timestamp", "range_score", "range_violation", "rounded_mean", "sensor_type_of_topic",
    "topic_of_sensor_type", "unit_of_sensor_type", "vpd_kpa",
]
