"""Bronze landing: topic stream -> decoded rows -> partitioned Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdant.constants import TOPIC_MAP
from verdant.operators.decode import decode_messages, parse_messages, split_messages
from verdant.session import ensure_session
from verdant.sources.messages import read_messages
from verdant.sources.tables import path_exists

BRONZE_PARTITIONS = ("facility_id", "date", "hour")


# Default micro-batch bounds: a backlog (after downtime, or a first start) is
# landed in many bounded batches instead of one unbounded one.
MAX_OFFSETS_PER_TRIGGER = "20000000"
MAX_FILES_PER_TRIGGER = "2000"


def bounded_batches(fmt: str, options: Mapping[str, str] | None) -> dict[str, str]:
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("maxOffsetsPerTrigger", MAX_OFFSETS_PER_TRIGGER)
    else:
        opts.setdefault("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
    return opts


# Writers of the newest landing hours of a facility in a micro-batch: a live
# batch has one hour, so few facilities would otherwise mean few writers.
# Earlier hours (a backlog has many) have one writer each.
WRITERS_PER_PARTITION = 4
NEWEST_HOURS = 2
# Innermost folder of a table written batch by batch: a repeated batch
# replaces its own folders.
BATCH = "batch"


def quarantine_of(path: str) -> str:
    """Where messages that a table can't take go by default: a folder next to it."""
    return f"{path.rstrip('/')}_quarantine"


def bronze_stream(messages: DataFrame, landing_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Decode a message stream (or batch) into Bronze rows and quarantined rows."""
    return decode_messages(messages, landing_col=landing_col)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def land_batch(bronze_path: str, quarantine_path: str, landing_col: str | None = None,
               writers_per_partition: int = WRITERS_PER_PARTITION):
    """The ``foreachBatch`` function: one parsed pass over a batch with two outputs.

    The batch is decoded once and kept while both outputs are written.  Each
    output has the batch's number as its innermost partition.  Numbers grow
    while a stream runs, so such a batch is new and only appended; the first
    batch of a start may be a repetition (``foreachBatch`` is at-least-once)
    and replaces its own partitions, whatever a failed attempt left there.
    Every message lands exactly once, in one of the two.
    """
    done: list[int] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newer = bool(done) and batch_id > done[-1]
        parsed = parse_messages(batch, landing_col=landing_col).persist()
        try:
            good, bad = split_messages(parsed)
            newest = F.col("bronze_landed_at") >= F.date_trunc("hour", F.current_timestamp()).cast("timestamp_ntz") - F.make_dt_interval(
                F.lit(0), F.lit(NEWEST_HOURS - 1), F.lit(0), F.lit(0))
            salt = F.when(newest, F.pmod(F.xxhash64("sensor_id", "timestamp"), F.lit(writers_per_partition))).otherwise(F.lit(0))
            # An explicit count (the session's shuffle partitions) keeps the writers
            # parallel: a micro-batch's write is bound by its file count, which a
            # byte-based coalescing of the shuffle would serialise.
            writers = int(spark.conf.get("spark.sql.shuffle.partitions"))
            spread = good.repartition(writers, *[F.col(c) for c in BRONZE_PARTITIONS], salt)
            for rows, path, cols in ((spread, bronze_path, BRONZE_PARTITIONS), (bad, quarantine_path, ())):
                mode = "append" if newer or not path_exists(spark, path) else "overwrite"
                (rows.withColumn(BATCH, F.lit(batch_id)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
                     .partitionBy(*cols, BATCH).parquet(path))
            done.append(batch_id)
        finally:
            parsed.unpersist()

    return land


def start_bronze(spark: SparkSession, bronze_path: str, checkpoint: str, fmt: str = "kafka",
                 source_path: str | None = None, options: Mapping[str, str] | None = None,
                 topics: Sequence[str] = tuple(TOPIC_MAP.values()), trigger: str | None = "30 seconds",
                 quarantine_path: str | None = None, landing_col: str | None = None,
                 writers_per_partition: int = WRITERS_PER_PARTITION) -> list[StreamingQuery]:
    """Start the Bronze landing stream (one query): topics read and parsed once, two outputs a batch.

    Rows land under (facility, date, hour, batch); malformed messages under
    ``quarantine_path`` (by default a folder next to the table), by batch.  The
    upstream is at-least-once and not deduplicated, as in the original; a
    repeated batch replaces itself (``land_batch``).  A micro-batch writes one
    file per landing hour of a facility, and up to ``writers_per_partition``
    for the newest hours.
    Micro-batches are bounded by the source's per-trigger limits
    (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``).  ``trigger`` is a
    processing-time interval, or ``"availableNow"`` for backfill and tests.
    """
    ensure_session(spark)
    opts = bounded_batches(fmt, options)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")     # land everything retained
    messages = read_messages(spark, fmt, opts, topics, path=source_path, stream=True)
    if landing_col is None:     # part of the stream's plan: a repeated batch gets its first attempt's time, and partitions
        landing_col = "__landed"
        messages = messages.withColumn(landing_col, F.current_timestamp())
    land = land_batch(bronze_path, quarantine_path or quarantine_of(bronze_path), landing_col, writers_per_partition)
    return [_trigger(messages.writeStream.foreachBatch(land).option("checkpointLocation", f"{checkpoint}/bronze"), trigger).start()]
