"""Gold run: Silver readings -> VPD pairs, 30-minute facts and the serving table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.constants import BAND_SECONDS, WINDOW_MINUTES
from verdant.operators.climate import GOLD_COLUMNS, SERVING_COLUMNS, build_gold, vpd_pairs, window_start
from verdant.operators.serving import GOLD_KEYS, latest_by_key
from verdant.plans.events import landing_hours
from verdant.schemas import SILVER_SCHEMA, VPD_SCHEMA
from verdant.session import ensure_session
from verdant.sinks.tables import _in_partitions, _nullable, replace_windows
from verdant.sources.tables import hours_predicate, path_exists, read_table, run_bounds, select_run

WINDOW_KEYS = ("facility_id", "window_start")
TABLE_PARTITIONS = ("facility_id", "date")
#: Columns that differ from run to run for the same rows.
STAMPS = ("gold_processed_at",)


def touched_windows(silver: DataFrame, start: datetime | str, end: datetime | str,
                    minutes: int = WINDOW_MINUTES, seconds: int = BAND_SECONDS) -> DataFrame:
    """(facility_id, window_start, date) of the event windows that readings landed in [start, end) can change.

    A reading changes the window of its event time, however late it landed; a
    humidity reading also those of temperatures up to ``seconds`` away.  Readings
    without facility or event time touch nothing.
    """
    landed = select_run(silver, start, end, landed_col="bronze_landed_at")
    reach = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds + 1))     # the band counts whole seconds
    ev = F.col("event_ts")
    times = F.when(F.col("sensor_type") == "humidity", F.array(ev - reach, ev, ev + reach)).otherwise(F.array(ev))
    return (landed.where("facility_id is not null and event_ts is not null")
                  .select("facility_id", F.explode(times).alias("__at"))
                  .select("facility_id", window_start("__at", minutes).alias("window_start")).distinct()
                  .withColumn("date", F.to_date("window_start")))


def window_readings(silver: DataFrame, windows: DataFrame, minutes: int = WINDOW_MINUTES,
                    seconds: int = BAND_SECONDS) -> DataFrame:
    """All Silver readings of the windows, and the humidity readings within ``seconds`` of one, with ``inside``.

    One join on (facility, window): a neighbour of a wanted window is wanted
    for its first or last seconds only.
    """
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    reach = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds + 1))
    w = F.col("window_start")
    uses = [F.struct(at.alias("window_start"), *[F.lit(name == use).alias(name) for name in ("inside", "begin", "finish")])
            for at, use in ((w, "inside"), (w + step, "begin"), (w - step, "finish"))]
    wide = (windows.select("facility_id", F.explode(F.array(*uses)).alias("w")).select("facility_id", "w.*")
                   .groupBy("facility_id", "window_start").agg(*[F.max(c).alias(c) for c in ("inside", "begin", "finish")]))
    near = silver.withColumn("window_start", window_start("event_ts", minutes)).join(wide, list(WINDOW_KEYS))
    edge = (F.col("begin") & (F.col("event_ts") < w + reach)) | (F.col("finish") & (F.col("event_ts") >= w + step - reach))
    return near.where(F.col("inside") | ((F.col("sensor_type") == "humidity") & edge)).drop("begin", "finish")


def window_pairs(readings: DataFrame, seconds: int = BAND_SECONDS, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """VPD pairs whose temperature reading lies inside the windows, as rows of the VPD table."""
    pairs = vpd_pairs(readings.where(F.col("inside") | (F.col("sensor_type") == "humidity")).drop("window_start"),
                      id_col="sensor_id", keep_humidity_ts=True, seconds=seconds)
    return (pairs.withColumn("window_start", window_start("event_ts", minutes))
                 .withColumn("date", F.to_date("window_start")).withColumn("hour", F.hour("window_start"))
                 .select(*VPD_SCHEMA.names))


def run_gold(spark: SparkSession, silver_path: str, gold_path: str, vpd_path: str, serving_path: str,
             start: datetime | str, end: datetime | str, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Recompute the event windows touched by a run and replace them in the three tables.

    The run takes the readings landed in [start, end) (UTC, or ISO times with
    a zone) and recomputes each event window they touch from all its readings.

    * ``vpd_path``: pairs, computed once, replaced per window, and used for
      the facts;
    * ``gold_path``: full fact rows per (facility, crop, week, window), crop
      and week possibly NULL, replaced per window;
    * ``serving_path``: the 14-column serving table keyed by (facility,
      window): value columns and the stamp are updated, ``crop_type`` and
      ``growth_week`` keep their first value; several fact rows of one
      serving key are reduced to the latest (growth week, crop); rows of a
      window without facts are removed.
    Silver's event index names the landing partitions that hold these windows;
    no other partition is opened.  Only partitions with a changed window are
    written, so a rerun over the same Silver rows writes no file.
    Reruns, late readings, repeated messages and reclassified readings leave
    the tables as one run over all readings would.
    """
    ensure_session(spark)
    start, end = run_bounds(start, end)
    silver = read_table(spark, silver_path, SILVER_SCHEMA)
    windows = touched_windows(silver, start, end, minutes).checkpoint(eager=True)
    landed = hours_predicate(landing_hours(spark, silver_path, windows, minutes))
    readings = window_readings(silver.where(landed), windows, minutes).checkpoint(eager=True)    # feeds the pairs and the facts
    hours = windows.withColumn("hour", F.hour("window_start"))
    pairs = replace_windows(spark, vpd_path, window_pairs(readings, minutes=minutes), hours, WINDOW_KEYS, (*TABLE_PARTITIONS, "hour"))
    pairs = pairs.drop("window_start", "date", "hour")
    inside = readings.where("inside").drop("window_start", "inside")
    stamp = F.current_timestamp().cast("timestamp_ntz")
    facts = (build_gold(inside, minutes=minutes, vpd=pairs).select(*GOLD_COLUMNS).withColumn("gold_processed_at", stamp)
             .withColumn("date", F.to_date("window_start")))
    facts = replace_windows(spark, gold_path, facts, windows, WINDOW_KEYS, TABLE_PARTITIONS, STAMPS)
    _serve(spark, serving_path, facts, windows)
    return facts


def _serve(spark: SparkSession, path: str, facts: DataFrame, windows: DataFrame) -> None:
    """Replace the windows' serving rows; a row that was served before keeps its crop and week."""
    serving = facts.select(*SERVING_COLUMNS, "gold_processed_at", "date")
    # The serving key is coarser than the facts': if a facility changed crop or
    # week inside a window, the row of the latest week (then crop) is served.
    ranked = serving.withColumn("__week", F.coalesce("growth_week", F.lit(-(1 << 31))))
    rows = latest_by_key(ranked, GOLD_KEYS, ("__week", "crop_type"), [c for c in serving.columns if c not in GOLD_KEYS])
    rows = rows.select(*serving.columns)
    if path_exists(spark, path):
        old = _in_partitions(read_table(spark, path, _nullable(rows.schema)), windows.select(*TABLE_PARTITIONS).distinct(), TABLE_PARTITIONS)
        old = old.select(*GOLD_KEYS, F.struct("crop_type", "growth_week").alias("__old"))
        rows = rows.join(old, list(GOLD_KEYS), "left")
        rows = rows.select(*[F.when(F.col("__old").isNotNull(), F.col(f"__old.{c}")).otherwise(F.col(c)).alias(c)
                             if c in ("crop_type", "growth_week") else F.col(c) for c in serving.columns])
    replace_windows(spark, path, rows, windows, WINDOW_KEYS, TABLE_PARTITIONS, STAMPS)
