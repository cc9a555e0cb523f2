"""Event index of a Silver table: which landing partitions hold the readings of an event hour.

Silver is partitioned by landing time, a Gold run searches by event time.  The
index has one row per (facility, event hour, landing hour), a few per landing
partition, in partitions of the event date.  It is kept by the Silver run and
lets a Gold run open only the landing partitions that hold its windows, however
old the table is and however late a reading landed.
"""

from __future__ import annotations

from datetime import datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.constants import BAND_SECONDS, WINDOW_MINUTES
from verdant.schemas import SILVER_SCHEMA
from verdant.sinks.tables import write_partitions
from verdant.sources.tables import days_predicate, partition_predicate, path_exists, read_table, run_bounds

INDEX_SCHEMA = T.StructType([
    T.StructField("facility_id", T.StringType(), True),
    T.StructField("event_hour", T.TimestampNTZType(), True),
    T.StructField("landed_date", T.DateType(), True),
    T.StructField("landed_hour", T.IntegerType(), True),
    T.StructField("event_date", T.DateType(), True),
])
INDEX_PARTITIONS = ("event_date",)


def index_of(silver_path: str) -> str:
    """Where the index of a Silver table lies: next to it."""
    return f"{silver_path.rstrip('/')}_events"


def event_entries(silver: DataFrame) -> DataFrame:
    """The index rows of Silver readings; a reading without facility or event time has none."""
    hour = F.date_trunc("hour", "event_ts").cast("timestamp_ntz")
    return (silver.where("facility_id is not null and event_ts is not null")
                  .select("facility_id", hour.alias("event_hour"), F.col("date").alias("landed_date"), F.col("hour").alias("landed_hour"))
                  .distinct().withColumn("event_date", F.to_date("event_hour")))


def update_index(spark: SparkSession, silver_path: str, start: datetime | None = None, end: datetime | None = None) -> None:
    """Replace the entries of the landing hours that overlap [start, end) by those of the written Silver rows.

    Only the event dates of these rows are rewritten.  An entry of another date
    whose readings are gone stays: it costs a partition read and no result.
    Without a span the index is built anew from the whole table.
    """
    path = index_of(silver_path)
    silver = read_table(spark, silver_path, SILVER_SCHEMA)
    whole = start is None
    span = F.lit(True) if whole else partition_predicate(start, end)
    entries = event_entries(silver.where(span)).checkpoint(eager=True)
    days = [r[0] for r in entries.select("event_date").distinct().collect()]
    if not days:
        return
    if not whole and path_exists(spark, path):
        others = read_table(spark, path, INDEX_SCHEMA).where(days_predicate(days, "event_date"))
        others = others.where(~partition_predicate(start, end, "landed_date", "landed_hour"))
        listed = F.col("event_date").isin(days)
        entries = others.where(listed).select(*entries.columns).union(entries).checkpoint(eager=True)
    write_partitions(entries, path, INDEX_PARTITIONS)


def landing_hours(spark: SparkSession, silver_path: str, windows: DataFrame, minutes: int = WINDOW_MINUTES,
                  seconds: int = BAND_SECONDS) -> list[datetime]:
    """The landing hours that hold readings of the windows, or within ``seconds`` of them.

    At most one number per hour of the table is collected.  A Silver table
    written without an index gets one first.
    """
    if not path_exists(spark, silver_path):
        return []
    path = index_of(silver_path)
    if not path_exists(spark, path):
        update_index(spark, silver_path)
    reach = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds + 1))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0))
    first = F.date_trunc("hour", F.col("window_start") - reach).cast("timestamp_ntz")
    last = F.col("window_start") + step + reach
    hour = F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
    hours = windows.select("facility_id", F.explode(F.sequence(first, last, hour)).alias("event_hour")).distinct()
    days = [r[0] for r in hours.select(F.to_date("event_hour")).distinct().collect()]
    index = read_table(spark, path, INDEX_SCHEMA).where(days_predicate(days, "event_date"))
    found = index.join(hours, ["facility_id", "event_hour"], "left_semi").select("landed_date", "landed_hour").distinct()
    return [datetime.combine(r["landed_date"], time(r["landed_hour"])) for r in found.collect()]


def index_run(spark: SparkSession, silver_path: str, start: datetime | str, end: datetime | str) -> None:
    """Index the landing hours of a Silver run."""
    update_index(spark, silver_path, *run_bounds(start, end))
