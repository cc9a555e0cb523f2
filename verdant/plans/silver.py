"""Silver run: Bronze landing partitions -> typed, quality-classified readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.operators.decode import type_readings
from verdant.operators.quality import SENSOR_KEYS, classify_anomalies
from verdant.plans.events import index_run
from verdant.schemas import BRONZE_SCHEMA, SILVER_SCHEMA
from verdant.session import ensure_session
from verdant.sinks.tables import write_partitions
from verdant.sources.tables import path_exists, read_table, select_run

SILVER_PARTITIONS = ("facility_id", "date", "hour")
#: Sensor statistics of a run: per landing hour, so a class does not depend on the span of the run.
RUN_STAT_KEYS = (*SENSOR_KEYS, "date", "hour")


def silver_frame(bronze: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """The Silver rows of every landing hour that overlaps [start, end).

    A run owns whole landing-hour partitions, so rerunning it (or running the
    next half hour of the same hour) replaces them completely: no duplicates
    and no half-processed hours.  Sensor statistics span one landing hour:
    one long run classifies like the hourly runs it stands for.
    ``event_date`` serves the Gold run's search by event time.
    """
    run = select_run(bronze, start, end, landed_col="bronze_landed_at", whole_partitions=True)
    out = (classify_anomalies(type_readings(run), keys=RUN_STAT_KEYS)
           .withColumn("silver_processed_at", F.current_timestamp().cast("timestamp_ntz"))
           .withColumn("event_date", F.to_date("event_ts")))
    return out.select(*SILVER_SCHEMA.names)


def write_silver(spark: SparkSession, silver: DataFrame, silver_path: str, start: datetime | str, end: datetime | str) -> None:
    """Write the rows of a run's landing hours, then their event index."""
    write_partitions(silver, silver_path, SILVER_PARTITIONS)
    if path_exists(spark, silver_path):
        index_run(spark, silver_path, start, end)


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str, start: datetime | str,
               end: datetime | str) -> DataFrame:
    """Build and write the Silver partitions of one run; returns them as read back."""
    ensure_session(spark)
    silver = silver_frame(read_table(spark, bronze_path, BRONZE_SCHEMA), start, end)
    write_silver(spark, silver, silver_path, start, end)
    return select_run(read_table(spark, silver_path, SILVER_SCHEMA), start, end, landed_col="bronze_landed_at",
                      whole_partitions=True)
