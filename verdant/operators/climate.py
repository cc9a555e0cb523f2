"""30-minute climate facts: windowed aggregates, pivot, VPD and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.constants import (BAND_SECONDS, CROP_PROFILES, SCORE_RANGES, SENSOR_TYPES, VPD_SCALE,
                               WINDOW_MINUTES)
from verdant.functions.columns import mean_parts, nan_to_null, range_score, rounded_mean, vpd_kpa
from verdant.operators.bandjoin import band_join

GROUP_KEYS = ("facility_id", "crop_type", "growth_week")
SCORED_TYPES = ("temperature", "humidity", "co2", "light")
RATE_TYPES = ("temperature", "humidity", "co2")


def window_start(ts: str, minutes: int = WINDOW_MINUTES):
    """Epoch-aligned tumbling window start ([start, start + minutes))."""
    return F.window(F.col(ts), f"{int(minutes)} minutes").start


def climate_by_window(df: DataFrame, keys: Sequence[str] = GROUP_KEYS, topic: str = "sensor_type",
                      ts: str = "event_ts", value: str = "value", minutes: int = WINDOW_MINUTES,
                      clean_only: bool = False) -> DataFrame:
    """Per (keys, window, topic): stats of clean readings and the anomaly rate.

    ``avg_value`` (3 dp, see ``rounded_mean``), ``zone_variance`` (sample
    stddev, 3 dp) and ``reading_count`` cover clean readings; ``n_all``, ``n_anomalous`` and
    ``anomaly_rate`` (4 dp) cover every reading of the window.  With
    ``clean_only=True`` anomalous rows are removed first, as the original job
    did, which makes every rate 0.
    """
    src = df.where(~F.col("is_anomaly")) if clean_only else df
    agg = (src.withColumn("window_start", window_start(ts, minutes))
              .groupBy(*keys, "window_start", topic).agg(*climate_aggregates(value)))
    return agg.select(*keys, "window_start", topic, rounded_mean(3).alias("avg_value"), *CLIMATE_STATS)


CLIMATE_STATS = ("zone_variance", "reading_count", "n_all", "n_anomalous", "anomaly_rate")


def climate_aggregates(value: str = "value") -> list:
    """The aggregates of ``climate_by_window``, batch or streaming (``rounded_mean(3)`` finishes the mean)."""
    clean_value = F.when(~F.col("is_anomaly"), F.col(value))
    n_all, n_bad = F.count(F.lit(1)), F.count_if(F.col("is_anomaly"))
    return [*mean_parts(clean_value),
            F.round(F.stddev_samp(nan_to_null(clean_value)), 3).alias("zone_variance"),
            F.count(clean_value).alias("reading_count"),
            n_all.alias("n_all"),
            n_bad.alias("n_anomalous"),
            F.round(F.try_divide(n_bad.cast("double"), n_all), 4).alias("anomaly_rate")]


def zone_spread(df: DataFrame, keys: Sequence[str] = GROUP_KEYS, topic: str = "sensor_type",
                ts: str = "event_ts", value: str = "value", sensor: str = "sensor_id",
                minutes: int = WINDOW_MINUTES, scale: int = 3) -> DataFrame:
    """Spread across zones: sample stddev of the per-sensor means of clean
    readings in each (keys, window, topic), with the number of zones.

    ``zone_variance`` of ``climate_by_window`` is the stddev over all
    readings; this is the across-zone variant (uneven distribution in the
    house).  Two grouped aggregates, both with partial aggregation.
    """
    per_zone = (df.where(~F.col("is_anomaly") & F.col(value).isNotNull())
                  .withColumn("window_start", window_start(ts, minutes))
                  .groupBy(*keys, "window_start", topic, sensor)
                  .agg(F.avg(value).alias("__zone_mean")))
    return (per_zone.groupBy(*keys, "window_start", topic)
                    .agg(F.round(F.stddev_samp("__zone_mean"), scale).alias("zone_spread"),
                         F.count(F.lit(1)).alias("zone_count")))


def pivot_climate(long_df: DataFrame, types: Sequence[str] = SENSOR_TYPES,
                  keys: Sequence[str] = GROUP_KEYS, topic: str = "sensor_type") -> DataFrame:
    """Long (one row per topic) -> wide (one row per facility window).

    Explicit pivot values (no discovery job).  Columns are ``avg_<type>``,
    ``variance_<type>``, ``anomaly_rate_<type>`` and ``reading_count_<type>``.
    There is one input row per cell, so ``max`` is the cell value.
    """
    wide = (long_df.groupBy(*keys, "window_start")
                   .pivot(topic, list(types))
                   .agg(F.max("avg_value").alias("avg"),
                        F.max("zone_variance").alias("variance"),
                        F.max("anomaly_rate").alias("anomaly_rate"),
                        F.max("reading_count").alias("reading_count")))
    renames = {}
    for t in types:
        for stat in ("avg", "variance", "anomaly_rate", "reading_count"):
            renames[f"{t}_{stat}"] = f"{stat}_{t}"
    return wide.withColumnsRenamed(renames)


def vpd_pairs(readings: DataFrame, keys: Sequence[str] = ("facility_id",), ts: str = "event_ts",
              seconds: int = BAND_SECONDS, scale: int = VPD_SCALE,
              temperature: str = "temperature", humidity: str = "humidity",
              id_col: str = "event_id", keep_humidity_ts: bool = False) -> DataFrame:
    """Every clean temperature reading paired with every clean humidity reading
    of the same facility within ``seconds`` (whole seconds), with its VPD.

    ``id_col`` identifies a reading on each side (``temperature_<id_col>``,
    ``humidity_<id_col>``); ``event_ts`` is the temperature reading's time.
    """
    clean = readings.where(~F.col("is_anomaly"))
    t = clean.where(F.col("sensor_type") == temperature).select(
        *keys, F.col(id_col).alias(f"temperature_{id_col}"), F.col(ts).alias("event_ts"),
        F.col("value").alias("temperature"))
    h = clean.where(F.col("sensor_type") == humidity).select(
        *keys, F.col(id_col).alias(f"humidity_{id_col}"), F.col(ts).alias("humidity_ts"),
        F.col("value").alias("humidity"))
    pairs = band_join(t, h, keys, "event_ts", "humidity_ts", seconds)
    extra = ["humidity_ts"] if keep_humidity_ts else []
    return pairs.select(*keys, f"temperature_{id_col}", f"humidity_{id_col}", "event_ts", *extra,
                        "temperature", "humidity",
                        vpd_kpa("temperature", "humidity", scale).alias("vpd_kpa"))


def vpd_by_window(pairs: DataFrame, keys: Sequence[str] = ("facility_id",), ts: str = "event_ts",
                  minutes: int = WINDOW_MINUTES, scale: int = VPD_SCALE) -> DataFrame:
    """round(avg(vpd_kpa), 4) per (keys, window of the temperature reading)."""
    agg = (pairs.withColumn("window_start", window_start(ts, minutes))
                .groupBy(*keys, "window_start").agg(*mean_parts("vpd_kpa")))
    return agg.select(*keys, "window_start", rounded_mean(scale).alias("avg_vpd"))


def mean_of_scores(cols: Sequence[str], scale: int = 2):
    """round(mean of 2-dp scores, scale) in exact decimal arithmetic (half-up).

    Scores carry two decimals, so their mean often ends in an exact 5 at the
    third decimal; decimal arithmetic rounds that tie the same way on every
    engine instead of by the binary error of a double sum.  NULL-propagating.
    """
    total = None
    for c in cols:
        term = F.col(c).cast("decimal(12,2)")
        total = term if total is None else total + term
    return F.round(total / F.lit(len(cols)), scale).cast("double")


def climate_score(wide: DataFrame, ranges: Mapping[str, tuple] = SCORE_RANGES,
                  clamp: bool = False) -> DataFrame:
    """``score_<type>`` per scored type and their mean ``climate_score`` (2 dp).

    NULL-propagating: one missing type leaves ``climate_score`` NULL.
    """
    out = wide
    for t, (low, high) in ranges.items():
        out = out.withColumn(f"score_{t}", range_score(F.col(f"avg_{t}"), low, high, clamp))
    return out.withColumn("climate_score", mean_of_scores([f"score_{t}" for t in ranges]))


def overall_anomaly_rate(wide: DataFrame, types: Sequence[str] = RATE_TYPES) -> DataFrame:
    """round(mean of the types' anomaly rates * 100, 4): a percentage."""
    total = None
    for t in types:
        total = F.col(f"anomaly_rate_{t}") if total is None else total + F.col(f"anomaly_rate_{t}")
    return wide.withColumn("overall_anomaly_rate", F.round(total / F.lit(len(types)) * F.lit(100), 4))


def profiles_frame(spark: SparkSession, profiles: Mapping[str, Mapping[str, tuple]] = CROP_PROFILES,
                   types: Sequence[str] = SCORED_TYPES) -> DataFrame:
    """Crop profile table: one row per crop with ``low_<type>``/``high_<type>``.

    Built from literals inside the JVM (``inline`` of an array of structs),
    so no Python worker is involved and the plan is a local relation.
    """
    structs = []
    for crop, p in profiles.items():
        fields = [F.lit(crop).alias("crop_type")]
        for t in types:
            fields += [F.lit(float(p[t][0])).alias(f"low_{t}"), F.lit(float(p[t][1])).alias(f"high_{t}")]
        structs.append(F.struct(*fields))
    return spark.range(1).select(F.inline(F.array(*structs)))


def crop_score(wide: DataFrame, profiles: Mapping[str, Mapping[str, tuple]] = CROP_PROFILES,
               types: Sequence[str] = SCORED_TYPES, clamp: bool = False) -> DataFrame:
    """Scores against each row's own crop profile (a broadcast lookup).

    The profile table is built from a literal with one row per crop, so its
    size is known before it is broadcast.
    """
    prof = profiles_frame(wide.sparkSession, profiles, types)
    out = wide.join(F.broadcast(prof), "crop_type", "left")
    for t in types:
        score = range_score(F.col(f"avg_{t}"), F.col(f"low_{t}"), F.col(f"high_{t}"), clamp)
        out = out.withColumn(f"crop_score_{t}", F.when(F.col(f"low_{t}").isNotNull(), score))
    out = out.withColumn("crop_climate_score", mean_of_scores([f"crop_score_{t}" for t in types]))
    return out.drop(*[f"{side}_{t}" for t in types for side in ("low", "high")])


def build_gold(readings: DataFrame, minutes: int = WINDOW_MINUTES, keys: Sequence[str] = GROUP_KEYS,
               seconds: int = BAND_SECONDS, clean_only: bool = False,
               vpd: DataFrame | None = None) -> DataFrame:
    """Classified readings -> one row per (facility, crop, week, window).

    Wide climate stats, ``avg_vpd`` of the window (left join), scores and the
    overall anomaly rate.  ``vpd`` may pass precomputed pairs (e.g. a written
    VPD table); otherwise they are derived from ``readings`` (readings are
    identified by ``event_id`` when present, else by ``sensor_id``).
    """
    long_df = climate_by_window(readings, keys, minutes=minutes, clean_only=clean_only)
    # Hash the (already aggregated, five rows per window) long form on the
    # join key: that partitioning satisfies both the pivot's grouping and
    # the VPD join, so the wide rows are not shuffled a second time.
    wide = pivot_climate(long_df.repartition("facility_id", "window_start"), SENSOR_TYPES, keys)
    id_col = "event_id" if "event_id" in readings.columns else "sensor_id"
    pairs = vpd if vpd is not None else vpd_pairs(readings, seconds=seconds, id_col=id_col)
    vpd_w = vpd_by_window(pairs, minutes=minutes)
    gold = wide.join(vpd_w, ["facility_id", "window_start"], "left")
    gold = climate_score(gold)
    return overall_anomaly_rate(gold)


GOLD_COLUMNS = (
    ["facility_id", "crop_type", "growth_week", "window_start"]
    + [f"avg_{t}" for t in SENSOR_TYPES]
    + [f"variance_{t}" for t in SENSOR_TYPES]
    + [f"anomaly_rate_{t}" for t in SENSOR_TYPES]
    + [f"reading_count_{t}" for t in SENSOR_TYPES]
    + ["avg_vpd"] + [f"score_{t}" for t in SCORED_TYPES] + ["climate_score", "overall_anomaly_rate"]
)

# Columns of the serving fact table (the processing stamp is added on write).
SERVING_COLUMNS = ["facility_id", "crop_type", "growth_week", "window_start",
                   "avg_temperature", "avg_humidity", "avg_co2", "avg_light", "avg_airflow",
                   "avg_vpd", "climate_score", "variance_temperature", "overall_anomaly_rate"]
