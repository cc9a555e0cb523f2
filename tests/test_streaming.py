"""Streams give the batch result: Bronze landing, live merge, watermarked forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdant.schemas import ENVELOPE_SCHEMA

from tests.conftest import SF_SMALL, rows
from verdant.operators.decode import decode_messages, type_readings
from verdant.operators.quality import classify_anomalies
from verdant.operators.serving import live_latest
from verdant.operators.climate import climate_by_window, vpd_pairs
from verdant.sources.fixture import load_readings
from verdant.sources.messages import envelopes_from_readings
from verdant.streaming.bronze import start_bronze
from verdant.streaming.live import start_live
from verdant.functions.columns import unit_of_sensor_type
from verdant.operators.serving import latest_by_key
from verdant.streaming.windowed import streaming_band_join, streaming_climate


def _land_envelopes(spark, path, parts=3):
    env = envelopes_from_readings(load_readings(spark, SF_SMALL))
    # Several files so that the stream sees several micro-batches.
    env.repartitionByRange(parts, "offset").write.mode("overwrite").parquet(path)
    return env


def test_bronze_stream_equals_batch_and_is_exactly_once(spark, tmp_path):
    src, out, ck = str(tmp_path / "src"), str(tmp_path / "bronze"), str(tmp_path / "ck")
    env = _land_envelopes(spark, src)
    for _ in range(2):   # a second start over the same checkpoint must add nothing
        for q in start_bronze(spark, out, ck, fmt="parquet", source_path=src, trigger="availableNow",
                              options={"maxFilesPerTrigger": "1"}, landing_col="landed_at",
                              quarantine_path=str(tmp_path / "quarantine")):
            q.awaitTermination()
    got = spark.read.parquet(out)
    want, _ = decode_messages(env, landing_col="landed_at")
    cols = [c for c in want.columns]
    assert got.count() == 1000
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_live_stream_equals_batch_latest(spark, tmp_path):
    src, live, ck = str(tmp_path / "src"), str(tmp_path / "live"), str(tmp_path / "ck")
    _land_envelopes(spark, src, parts=4)
    q = start_live(spark, live, ck, fmt="parquet", source_path=src, trigger="availableNow",
                   options={"maxFilesPerTrigger": "1"})
    q.awaitTermination()
    got = spark.read.parquet(live).drop("arrival")
    arrived = load_readings(spark, SF_SMALL).withColumn("arrival", F.struct("landed_at", "event_id"))
    want = latest_by_key(arrived.withColumn("unit", unit_of_sensor_type("sensor_type"))
                         .withColumn("is_anomaly", F.col("value").isNull()).withColumn("recorded_at", F.col("event_ts")),
                         ["facility_id", "sensor_id"], ["landed_at", "event_id"],
                         ["sensor_type", "value", "unit", "is_anomaly", "recorded_at"])
    cols = ["facility_id", "sensor_id", "sensor_type", "value", "unit", "is_anomaly", "recorded_at"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def _silver_files(spark, path):
    env = envelopes_from_readings(load_readings(spark, SF_SMALL))
    good, _ = decode_messages(env, landing_col="landed_at")
    silver = classify_anomalies(type_readings(good))
    silver.repartitionByRange(4, "event_ts").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_streaming_climate_matches_batch_for_closed_windows(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = _silver_files(spark, path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", "1").parquet(path)
    q = (streaming_climate(stream, delay="1 hour").writeStream.format("memory").queryName("clim")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("clim")
    assert got.count() > 0
    want = climate_by_window(batch).join(got.select("facility_id", "window_start", "sensor_type"),
                                         ["facility_id", "window_start", "sensor_type"], "left_semi")
    assert rows(got) == rows(want.select(*got.columns))


def test_streaming_band_join_matches_batch(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = _silver_files(spark, path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", "1").parquet(path)
    # Files are picked by modification time, not by time range: a delay longer
    # than the fixture span keeps every file on time.
    q = (streaming_band_join(stream, delay="60 days").writeStream.format("memory").queryName("pairs")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("pairs")
    want = vpd_pairs(batch, id_col="sensor_id", keep_humidity_ts=True)
    assert got.count() == want.count() == 3
    assert rows(got) == rows(want.select(*got.columns))


def test_ingest_then_bronze_chain(spark, tmp_path):
    """Poll documents -> ingest stream -> topic files -> Bronze stream: every reading lands once."""
    from verdant.sources.payloads import payloads_from_readings
    from verdant.streaming.ingest import start_ingest
    docs, topics, bronze = str(tmp_path / "docs"), str(tmp_path / "topics"), str(tmp_path / "bronze")
    r = load_readings(spark, SF_SMALL)
    payloads_from_readings(r).select("payload").write.text(docs)
    start_ingest(spark, docs, str(tmp_path / "ck"), sink_fmt="parquet", sink_path=topics,
                 trigger="availableNow").awaitTermination()
    landed = spark.read.parquet(topics)
    by_topic = {x["topic"]: x["count"] for x in landed.groupBy("topic").count().collect()}
    assert by_topic == {x["source_topic"]: x["count"] for x in r.groupBy("source_topic").count().collect()}
    for q in start_bronze(spark, bronze, str(tmp_path / "ck2"), fmt="parquet", source_path=topics,
                          trigger="availableNow"):
        q.awaitTermination()
    b = spark.read.parquet(bronze)
    assert b.count() == r.count()
    assert rows(b.select("sensor_id", "value", "source_topic")) == \
        rows(r.select("sensor_id", "value", r["source_topic"]))


def test_streaming_band_join_evicts_state(spark, tmp_path):
    """With input in event-time order, a short watermark loses no pair and state is evicted."""
    import time as _time
    path = str(tmp_path / "silver")
    env = envelopes_from_readings(load_readings(spark, "/root/testdata/sf0.01"))
    good, _ = decode_messages(env, landing_col="landed_at")
    silver = classify_anomalies(type_readings(good)).checkpoint(eager=True)
    days = [("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-16"), ("2024-01-16", "2024-01-24"),
            ("2024-01-24", "2024-02-01")]
    for lo, hi in days:       # one file per time range, written in order (file order = time order)
        (silver.where((F.col("event_ts") >= F.lit(lo).cast("timestamp_ntz"))
                      & (F.col("event_ts") < F.lit(hi).cast("timestamp_ntz")))
               .coalesce(1).write.mode("append").parquet(path))
        _time.sleep(1.1)
    stream = spark.readStream.schema(silver.schema).option("maxFilesPerTrigger", "1").parquet(path)
    q = (streaming_band_join(stream, delay="10 minutes").writeStream.format("memory").queryName("pairs_evict")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("pairs_evict")
    want = vpd_pairs(silver, id_col="sensor_id", keep_humidity_ts=True)
    assert rows(got) == rows(want.select(*got.columns))
    removed = sum(op.get("numRowsRemoved", 0) for p in q.recentProgress for op in p.get("stateOperators", []))
    assert removed > 0


def test_live_stream_event_time_order(spark, tmp_path):
    """order_by="recorded_at": the newest event time wins, whatever the arrival order."""
    from verdant.operators.serving import latest_by_key, live_rows
    src, live, ck = str(tmp_path / "src"), str(tmp_path / "live"), str(tmp_path / "ck")
    _land_envelopes(spark, src, parts=4)
    q = start_live(spark, live, ck, fmt="parquet", source_path=src, trigger="availableNow",
                   options={"maxFilesPerTrigger": "1"}, order_by="recorded_at")
    q.awaitTermination()
    got = spark.read.parquet(live)
    want = latest_by_key(live_rows(load_readings(spark, SF_SMALL), sensor_col="sensor_id"),
                         ["facility_id", "sensor_id"], ["recorded_at", "arrival"])
    cols = ["facility_id", "sensor_id", "sensor_type", "value", "unit", "is_anomaly", "recorded_at"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_live_table_takes_newer_rows_from_any_partition(spark, tmp_path):
    """A great offset on one broker partition does not hold back a newer reading with a small one elsewhere."""
    import datetime as dt
    import json
    import time as _time
    src, live = str(tmp_path / "src"), str(tmp_path / "live")

    def land(value, at, offset, partition, sensor="t1", topic="sensors.temperature"):
        body = {"sensor_id": sensor, "value": value, "timestamp": at, "facility_id": "A", "unit": "celsius"}
        spark.createDataFrame([(topic, json.dumps(body).encode(), offset, dt.datetime.fromisoformat(at), b"k", partition)],
                              ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        _time.sleep(1.1)

    land(1.0, "2024-01-01T10:00:00", 5000, 0)
    land(2.0, "2024-01-01T10:00:10", 120, 1)
    land(1.5, "2024-01-01T10:00:05", 6000, 0)          # older, consumed later
    land(9.0, "2024-01-01T10:00:20", 1, 0, sensor=None)
    start_live(spark, live, str(tmp_path / "ck"), fmt="parquet", source_path=src, trigger="availableNow",
               options={"maxFilesPerTrigger": "1"}).awaitTermination()
    assert [r["value"] for r in spark.read.parquet(live).collect()] == [2.0]
    lost = spark.read.parquet(live + "_quarantine").collect()
    assert [r["reason"] for r in lost] == ["no_sensor"]


def test_bronze_batch_is_read_and_parsed_once_and_repeats_safely(spark, tmp_path):
    """One scan a batch for both outputs; a repeated batch replaces its own rows."""
    from verdant.streaming.bronze import land_batch
    env = envelopes_from_readings(load_readings(spark, SF_SMALL)).limit(200)
    bad = env.limit(3).withColumn("value", F.lit("{oops").cast("binary"))
    src = str(tmp_path / "src")
    env.unionByName(bad).write.parquet(src)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    batch = spark.read.parquet(src)
    batch = batch.mapInArrow(counted, batch.schema)
    land = land_batch(str(tmp_path / "b"), str(tmp_path / "q"), "landed_at")
    restarted = land_batch(str(tmp_path / "b"), str(tmp_path / "q"), "landed_at")
    for attempt, number, times in ((land, 0, 1), (land, 1, 2), (land, 1, 3), (restarted, 1, 4), (restarted, 2, 5)):
        attempt(batch, number)
        assert seen.value == 203 * times
    for path, n in (("b", 200), ("q", 3)):
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / path)).groupBy("batch").count().collect())) == [(0, n), (1, n), (2, n)]


def test_live_batch_rewrites_its_buckets_only(spark, tmp_path):
    import glob

    from verdant.streaming.live import live_bucket, merge_live_batch
    live = str(tmp_path / "live")
    env = envelopes_from_readings(load_readings(spark, SF_SMALL))
    merge = merge_live_batch(live, buckets=16)
    merge(env, 0)
    before = set(glob.glob(f"{live}/**/*.parquet", recursive=True))
    one = spark.read.parquet(live).orderBy("sensor_id").limit(1).select("facility_id", "sensor_id").collect()[0]
    again = load_readings(spark, SF_SMALL).where((F.col("facility_id") == one.facility_id) & (F.col("sensor_id") == one.sensor_id))
    later = envelopes_from_readings(again).withColumn("landed_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    merge(later, 1)
    gone = before - set(glob.glob(f"{live}/**/*.parquet", recursive=True))
    bucket = spark.createDataFrame([one]).select(live_bucket(16)).first()[0]
    assert len(before) > 5 and gone and all(f"bucket={bucket}/" in f for f in gone)
