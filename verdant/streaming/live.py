"""Live path: topic stream -> latest value per sensor, merged every micro-batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdant.constants import TOPIC_MAP
from verdant.functions.columns import parse_timestamp, sensor_type_of_topic
from verdant.operators.decode import decode_messages
from verdant.operators.serving import LIVE_KEYS, LIVE_UPDATE_COLS, reduce_updates
from verdant.session import ensure_session
from verdant.sinks.tables import merge_into_table
from verdant.sources.messages import read_messages
from verdant.streaming.bronze import bounded_batches, quarantine_of

#: The live table's partitions: hash buckets of its key, so a batch rewrites the buckets of its keys only.
LIVE_PARTITIONS = ("bucket",)
LIVE_BUCKETS = 64


def live_bucket(buckets: int = LIVE_BUCKETS) -> Column:
    """The bucket of a live row's key (facility and sensor)."""
    return F.pmod(F.xxhash64(*LIVE_KEYS), F.lit(buckets)).cast("int")


def live_batch(messages: DataFrame, topic_map: Mapping[str, str] = TOPIC_MAP) -> tuple[DataFrame, DataFrame]:
    """Envelopes -> (live rows with an ``arrival`` order, rows that can't be served).

    ``arrival`` is (arrival time in microseconds, offset).  Times are
    comparable between broker partitions and offsets are not, so an offset
    only orders messages of the same instant.  A source without arrival times
    (files written by a topic file sink) takes the reading's event time.
    ``is_anomaly`` is ``value IS NULL`` (a NaN is not flagged).  Malformed
    messages, unknown topics and readings without a sensor are the second frame.
    """
    for name, kind in (("offset", "long"), ("landed_at", "timestamp_ntz")):
        if name not in messages.columns:
            messages = messages.withColumn(name, F.lit(None).cast(kind))
    good, bad = decode_messages(messages, keep=["offset", "landed_at"])
    recorded = parse_timestamp("timestamp")
    micros = lambda ts: F.unix_micros(ts.cast("timestamp"))
    rows = good.select(
        "facility_id", "sensor_id",
        sensor_type_of_topic("source_topic", topic_map).alias("sensor_type"),
        "value", "unit",
        F.col("value").isNull().alias("is_anomaly"),
        recorded.alias("recorded_at"),
        F.struct(F.coalesce(micros(F.col("landed_at")), micros(recorded)).alias("at"),
                 F.coalesce("offset", F.lit(0)).alias("offset")).alias("arrival"),
        "source_topic", F.to_json(F.struct("sensor_id", "value", "timestamp")).alias("raw_value"), "bronze_landed_at",
    )
    served = F.col("sensor_type").isNotNull() & F.col("sensor_id").isNotNull()
    extra = ["source_topic", "raw_value", "bronze_landed_at"]
    lost = (rows.where(~served).select(*extra, F.when(F.col("sensor_type").isNull(), "unknown_topic").otherwise("no_sensor").alias("reason"))
                .unionByName(bad.select(*extra, "reason")))
    return rows.where(served).drop(*extra), lost


def merge_live_batch(live_path: str, order_by: str = "arrival", quarantine_path: str | None = None,
                     buckets: int = LIVE_BUCKETS):
    """The ``foreachBatch`` function: reduce a batch to its latest rows and merge.

    The table lies in ``buckets`` hash buckets of its key (fixed for a table's
    life); only the buckets of the batch's keys are read and rewritten.
    The table keeps each row's ``arrival`` and a row is only replaced by a
    later one, so a replayed batch (``foreachBatch`` is at-least-once) or
    batches out of order leave the same table as consuming every message in
    order.  Rows that can't be served replace the batch's folder under
    ``quarantine_path``.
    """
    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        rows, lost = live_batch(batch)
        if order_by != "arrival":
            own = F.unix_micros(F.col(order_by).cast("timestamp"))
            rows = rows.withColumn("arrival", F.struct(own.alias("at"), F.col("arrival.offset").alias("offset")))
        # Reduced before it is kept: one row per key reaches the checkpoint, the
        # list of touched buckets and the merge.
        rows = reduce_updates(rows, LIVE_KEYS, LIVE_UPDATE_COLS, "arrival").withColumn("bucket", live_bucket(buckets))
        merge_into_table(batch.sparkSession, live_path, rows, LIVE_KEYS, LIVE_UPDATE_COLS,
                         LIVE_PARTITIONS, newer_than="arrival")
        if quarantine_path:
            lost.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")

    return merge_batch


def start_live(spark: SparkSession, live_path: str, checkpoint: str, fmt: str = "kafka",
               source_path: str | None = None, options: Mapping[str, str] | None = None,
               topics: Sequence[str] = tuple(TOPIC_MAP.values()), trigger: str | None = "10 seconds",
               order_by: str = "arrival", quarantine_path: str | None = None, buckets: int = LIVE_BUCKETS) -> StreamingQuery:
    """Maintain ``live_readings`` (one row per facility and sensor).

    Value, unit, is_anomaly and recorded_at are replaced by the newest
    message; ``sensor_type`` keeps its first value.  Arrival order wins by
    default (a late message overwrites a newer one, as in the original);
    ``order_by="recorded_at"`` lets event time win instead.  Progress
    (offsets) lives in the checkpoint.  Messages that can't be served go to
    ``quarantine_path`` (by default next to the table).
    """
    ensure_session(spark)
    opts = bounded_batches(fmt, options)
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")       # a live view starts from now
    messages = read_messages(spark, fmt, opts, topics, path=source_path, stream=True)
    writer = (messages.writeStream.foreachBatch(merge_live_batch(live_path, order_by, quarantine_path or quarantine_of(live_path), buckets))
              .option("checkpointLocation", f"{checkpoint}/live"))
    if trigger in (None, "availableNow"):
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
