"""Streaming forms of the windowed climate aggregate and the band join.

Both bound their state with watermarks, so they run indefinitely: a window
is emitted (append mode) once the watermark passes its end, and band-join
state older than the watermark minus the band is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.constants import BAND_SECONDS, WINDOW_MINUTES
from verdant.functions.columns import epoch_seconds, rounded_mean, vpd_kpa
from verdant.operators.climate import CLIMATE_STATS, GROUP_KEYS, climate_aggregates


def streaming_climate(silver: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = GROUP_KEYS,
                      minutes: int = WINDOW_MINUTES, ts: str = "event_ts") -> DataFrame:
    """Watermarked 30-minute climate aggregate over a stream of Silver rows.

    Same columns as ``climate_by_window``.  The engine drops rows later than
    ``delay`` behind the watermark; the Gold run repairs their windows, as it
    recomputes every event window that a landed reading touches.
    """
    # Watermarks need zoned timestamps: event time is UTC wall clock, the
    # session zone is UTC, so the cast keeps the instant.
    return (silver.withColumn("__event_time", F.col(ts).cast("timestamp"))
                  .withWatermark("__event_time", delay)
                  .groupBy(*keys, F.window("__event_time", f"{int(minutes)} minutes").alias("w"),
                           "sensor_type")
                  .agg(*climate_aggregates())
                  .select(*keys, F.col("w.start").cast("timestamp_ntz").alias("window_start"), "sensor_type",
                          rounded_mean(3).alias("avg_value"), *CLIMATE_STATS))


def streaming_band_join(silver: DataFrame, delay: str = "2 minutes", seconds: int = BAND_SECONDS,
                        keys: Sequence[str] = ("facility_id",), id_col: str = "sensor_id") -> DataFrame:
    """Stream-stream VPD pairs: clean temperature x clean humidity within ``seconds``.

    Both sides carry a watermark; the join condition holds the equi keys, a
    time bin (as in the batch ``band_join``), the exact whole-second residual
    and an event-time range, which lets the engine evict old state.
    """
    w = int(seconds)
    clean = silver.where(~F.col("is_anomaly"))
    t = (clean.where(F.col("sensor_type") == "temperature")
              .select(*keys, F.col(id_col).alias(f"temperature_{id_col}"), F.col("event_ts"),
                      F.col("value").alias("temperature"))
              .withColumn("t_time", F.col("event_ts").cast("timestamp"))
              .withWatermark("t_time", delay)
              .withColumn("t_sec", epoch_seconds("event_ts"))
              .withColumn("t_bin", F.floor(F.col("t_sec") / F.lit(w))))
    rk = {k: f"h_{k}" for k in keys}
    h = (clean.where(F.col("sensor_type") == "humidity")
              .select(*[F.col(k).alias(rk[k]) for k in keys], F.col(id_col).alias(f"humidity_{id_col}"),
                      F.col("event_ts").alias("humidity_ts"), F.col("value").alias("humidity"))
              .withColumn("h_time", F.col("humidity_ts").cast("timestamp"))
              .withWatermark("h_time", delay)
              .withColumn("h_sec", epoch_seconds("humidity_ts"))
              .withColumn("h_bin", F.explode(F.array(*[F.floor(F.col("h_sec") / F.lit(w)) + F.lit(d)
                                                       for d in (-1, 0, 1)]))))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(rk[k]))
    span = F.expr(f"INTERVAL {w + 1} SECONDS")
    cond = (cond & (F.col("t_bin") == F.col("h_bin"))
            & (F.abs(F.col("t_sec") - F.col("h_sec")) <= F.lit(w))
            & (F.col("t_time") >= F.col("h_time") - span)
            & (F.col("t_time") <= F.col("h_time") + span))
    joined = t.join(h, cond, "inner")
    return joined.select(*keys, f"temperature_{id_col}", f"humidity_{id_col}", "event_ts", "humidity_ts",
                         "temperature", "humidity", vpd_kpa("temperature", "humidity").alias("vpd_kpa"))
