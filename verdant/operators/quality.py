"""Data-quality operators: sensor statistics, anomaly classes, peer outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.constants import PEER_SIGMA, RANGE_LIMITS, STAT_SIGMA
from verdant.functions.columns import anomaly_type, mean_parts, nan_to_null, rounded_mean
from verdant.operators.joins import join_null_safe, join_small

SENSOR_KEYS = ("facility_id", "sensor_id")


def sensor_stats(df: DataFrame, keys: Sequence[str] = SENSOR_KEYS, value: str = "value") -> DataFrame:
    """Per-sensor count, mean and sample stddev (NaN ignored).

    A grouped aggregate with map-side partial aggregation: a sensor holding a
    third of all rows costs one partial row per input split, not a hot task.
    """
    v = nan_to_null(value)
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("stddev"),
    )


def with_sensor_stats(df: DataFrame, keys: Sequence[str] = SENSOR_KEYS, value: str = "value",
                      mean: str = "sensor_mean", stddev: str = "sensor_stddev",
                      leave_one_out: bool = False) -> DataFrame:
    """Attach each row's sensor mean and stddev (whole-input scope).

    Equivalent to ``avg/stddev OVER (PARTITION BY keys)`` but computed as an
    aggregate joined back behind a size check: no sort of the whole input by
    sensor and no single task per sensor.

    ``leave_one_out`` excludes the row's own value from its statistics (a
    3-sigma rule that includes the point can never fire for 10 or fewer
    readings).  It is derived per row from (n, mean, M2) by removing one
    value (Welford downdate), so it stays one aggregate and one join.
    """
    stats = sensor_stats(df, keys, value).select(
        *keys, F.col("n").alias("__n"), F.col("mean").alias(mean), F.col("stddev").alias(stddev))
    out = join_small(df, stats, keys, how="left", null_safe=True)
    if leave_one_out:
        v, n, m, sd = nan_to_null(value), F.col("__n"), F.col(mean), F.col(stddev)
        m2 = F.coalesce(sd * sd * (n - 1), F.lit(0.0))
        m_loo = (m * n - v) / (n - 1)
        m2_loo = m2 - (v - m) * (v - m_loo)
        out = (out.withColumn(stddev, F.when(v.isNull(), sd)
                              .when(n >= 3, F.sqrt(F.greatest(m2_loo, F.lit(0.0)) / (n - 2))))
                  .withColumn(mean, F.when(v.isNull(), m).when(n >= 2, m_loo)))
    return out.drop("__n")


def classify_anomalies(df: DataFrame, limits: Mapping[str, tuple] = RANGE_LIMITS,
                       n_sigma: float = STAT_SIGMA, keys: Sequence[str] = SENSOR_KEYS,
                       value: str = "value", sensor_type: str = "sensor_type",
                       leave_one_out: bool = False) -> DataFrame:
    """Add ``anomaly_type`` (dropout > statistical > range > NULL) and ``is_anomaly``.

    ``leave_one_out=True`` judges each value against the statistics of the
    other readings of its sensor (default: all readings, as originally).
    """
    out = with_sensor_stats(df, keys, value, leave_one_out=leave_one_out)
    return (out.withColumn("anomaly_type", anomaly_type(value, sensor_type, "sensor_mean",
                                                        "sensor_stddev", n_sigma, limits))
               .withColumn("is_anomaly", F.col("anomaly_type").isNotNull())
               .drop("sensor_mean", "sensor_stddev"))


def peer_outliers(df: DataFrame, group_keys: Sequence[str], value: str = "value",
                  n_sigma: float = PEER_SIGMA, scale: int = 3) -> DataFrame:
    """Flag readings far from their peers (same facility, type and poll).

    ``is_peer_outlier`` when the group has at least 2 non-NULL values, the
    sample stddev is positive and ``abs(v - mean) > n_sigma * stddev``;
    ``peer_deviation = round(v - mean, scale)`` for outliers, else NULL.

    There are about as many groups as polls, so their statistics are no small
    side by nature.  The join is left to run time: adaptive execution knows
    their shuffled size and broadcasts them if they are small, else joins by
    shuffle and splits hot groups.  Nothing runs when the plan is built.
    """
    v = nan_to_null(value)
    stats = df.groupBy(*group_keys).agg(
        F.count(v).alias("__peer_n"), F.avg(v).alias("__peer_mean"), F.stddev_samp(v).alias("__peer_sd"))
    out = join_null_safe(df, stats, group_keys, "left")
    flag = (v.isNotNull() & (F.col("__peer_n") >= 2) & (F.col("__peer_sd") > 0)
            & (F.abs(v - F.col("__peer_mean")) > F.lit(n_sigma) * F.col("__peer_sd")))
    flag = F.coalesce(flag, F.lit(False))
    return (out.withColumn("is_peer_outlier", flag)
               .withColumn("peer_deviation",
                           F.when(flag, F.round(v - F.col("__peer_mean"), scale)))
               .drop("__peer_n", "__peer_mean", "__peer_sd"))


def facility_aggregate(df: DataFrame, group_keys: Sequence[str], value: str = "value",
                       outlier: str = "is_peer_outlier", scale: int = 2) -> DataFrame:
    """Per poll group: mean of healthy values, sensor count, healthy count.

    Healthy = value not NULL and not a peer outlier.  Mean is NULL when no
    value is healthy; it is the exact decimal mean, rounded half up.  A NaN is no value.
    """
    healthy = nan_to_null(value).isNotNull() & ~F.coalesce(F.col(outlier), F.lit(False))
    agg = df.groupBy(*group_keys).agg(
        *mean_parts(F.when(healthy, F.col(value))),
        F.count(F.lit(1)).alias("sensor_count"),
        F.count_if(healthy).alias("healthy_sensor_count"),
    )
    return agg.select(*group_keys, rounded_mean(scale).alias("facility_aggregate"),
                      "sensor_count", "healthy_sensor_count")
