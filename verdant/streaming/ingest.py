"""Ingestion: landed poll documents -> one message per reading -> its topic.

The stream reads poll payloads (JSON lines, declared schema), explodes every
known sensor group into readings stamped with ``ingested_at``, serialises
each reading and routes it to the topic of its sensor type.  Per-row work
only (explodes and projections): no shuffle, no state.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from verdant.constants import TOPIC_MAP
from verdant.operators.decode import flatten_payload, route_topics
from verdant.session import ensure_session
from verdant.schemas import PAYLOAD_SCHEMA
from verdant.sources.messages import kafka_guard


def start_ingest(spark: SparkSession, payload_path: str, checkpoint: str, sink_fmt: str = "kafka",
                 sink_path: str | None = None, options: Mapping[str, str] | None = None,
                 trigger: str | None = "10 seconds", topic_map: Mapping[str, str] = TOPIC_MAP,
                 max_files_per_trigger: int = 2000) -> StreamingQuery:
    """Start the ingestion stream.

    ``sink_fmt="kafka"`` writes (topic, value) rows to the broker given in
    ``options`` (``kafka.bootstrap.servers``); a file format writes one
    folder per topic under ``sink_path`` (replay, tests).  The checkpoint
    makes the file sink exactly-once; the Kafka sink is at-least-once.
    """
    ensure_session(spark)
    docs = (spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger))
            .schema(PAYLOAD_SCHEMA).json(payload_path))
    messages = route_topics(flatten_payload(docs, topic_map=topic_map), topic_map)
    writer = messages.writeStream.option("checkpointLocation", f"{checkpoint}/ingest").options(**(options or {}))
    if sink_fmt == "kafka":
        writer = writer.format("kafka")
    else:
        writer = writer.format(sink_fmt).option("path", sink_path).partitionBy("topic")
    if trigger in (None, "availableNow"):
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return kafka_guard(lambda: writer.outputMode("append").start())
