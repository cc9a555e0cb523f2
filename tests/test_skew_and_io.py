"""Hot keys (a third of all rows on one key) and the remaining sources/sinks."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from tests.test_plans import plan
from verdant.operators.bandjoin import band_join, band_join_naive
from verdant.operators.decode import flatten_payload, route_topics
from verdant.operators.quality import classify_anomalies
from verdant.operators.serving import latest_by_key
from verdant.sinks.tables import write_topics
from verdant.sources.fixture import load_readings
from verdant.sources.messages import read_messages
from verdant.sources.payloads import payloads_from_readings, read_payloads
from verdant.streaming.bronze import start_bronze


def _hot(spark, n=3000):
    # One sensor carries a third of the rows.
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.lit("facility_A").alias("facility_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
         .alias("sensor_id"),
        F.lit("co2").alias("sensor_type"),
        (F.lit(900.0) + (F.col("id") % 17) + F.when(F.col("id") == 3, F.lit(5000.0)).otherwise(0.0)).alias("value"))


def test_hot_sensor_classification_matches_window(spark):
    df = _hot(spark)
    got = classify_anomalies(df)
    assert "Exchange hashpartitioning" not in plan(got)       # the hot sensor is never shuffled
    w = Window.partitionBy("facility_id", "sensor_id")
    ref = (df.withColumn("m", F.avg("value").over(w)).withColumn("s", F.stddev_samp("value").over(w))
             .select("event_id", F.when(F.abs(F.col("value") - F.col("m")) > 3 * F.col("s"), F.lit("statistical"))
                     .when(F.col("value") > 5000, F.lit("range")).alias("anomaly_type")))
    assert rows(got.select("event_id", "anomaly_type")) == rows(ref)
    assert got.where("event_id = 3").collect()[0]["anomaly_type"] == "statistical"


def test_hot_key_latest_and_band_join(spark):
    df = _hot(spark)
    latest = {r["sensor_id"]: r["event_id"] for r in latest_by_key(df, ["facility_id", "sensor_id"], "event_id")
              .collect()}
    assert latest["hot"] == 2997 and len(latest) == 51
    base = dt.datetime(2024, 1, 1)
    # A third of the left rows fall in one 60-s bin.
    left = spark.range(600).select(F.lit("f").alias("k"), F.col("id").alias("lid"),
                                   (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(
                                       F.lit(0), F.lit(0), F.lit(0),
                                       F.when(F.col("id") % 3 == 0, F.lit(30)).otherwise(F.col("id") * 7)))
                                   .alias("lts"))
    right = left.select("k", F.col("lid").alias("rid"), F.col("lts").alias("rts"))
    a = band_join(left, right, ["k"], "lts", "rts", 60)
    b = band_join_naive(left, right, ["k"], "lts", "rts", 60)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_topic_sink_round_trip(spark, tmp_path):
    r = load_readings(spark, SF_SMALL)
    routed = route_topics(r.select("sensor_id", "value", "facility_id", "sensor_type"))
    out = str(tmp_path / "topics")
    write_topics(routed.withColumn("value", F.col("value").cast("binary")), fmt="parquet", path=out)
    back = read_messages(spark, "parquet", topics=["sensors.co2"], path=out, stream=False)
    landed = spark.read.parquet(out)
    counts = {x["topic"]: x["n"] for x in landed.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {x["source_topic"]: x["n"] for x in r.groupBy("source_topic").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == want
    one = landed.where("topic = 'sensors.co2'").select(F.col("value").cast("string")).first()[0]
    assert set(json.loads(one)) <= {"sensor_id", "value", "facility_id"}
    assert back.count() == want["sensors.co2"] and {x["topic"] for x in back.collect()} == {"sensors.co2"}


def test_payload_files_and_quarantine_stream(spark, tmp_path):
    r = load_readings(spark, SF_SMALL)
    docs = str(tmp_path / "docs")
    payloads_from_readings(r).select("payload").write.text(docs)
    flat = flatten_payload(read_payloads(spark, docs), ingested_at=F.lit("x"))
    assert flat.count() == r.count()
    # A bad message lands in quarantine, not in a NULL partition.
    src = str(tmp_path / "src")
    spark.createDataFrame([("sensors.co2", b"{oops", 1, dt.datetime(2024, 1, 1)),
                           ("sensors.co2", json.dumps({"facility_id": "facility_A", "sensor_id": "c",
                                                       "value": 1.0}).encode(), 2, dt.datetime(2024, 1, 1))],
                          "topic string, value binary, offset long, landed_at timestamp_ntz").write.parquet(src)
    qs = start_bronze(spark, str(tmp_path / "bronze"), str(tmp_path / "ck"), fmt="parquet", source_path=src,
                      trigger="availableNow", landing_col="landed_at", quarantine_path=str(tmp_path / "q"))
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "q")).collect()
    assert len(bad) == 1 and bad[0]["reason"] == "malformed" and bad[0]["raw_value"] == "{oops"


def test_bronze_salted_writers_keep_all_rows(spark, tmp_path):
    import glob
    src, out = str(tmp_path / "src"), str(tmp_path / "bronze")
    from verdant.sources.messages import envelopes_from_readings
    envelopes_from_readings(load_readings(spark, SF_SMALL)).write.parquet(src)
    for q in start_bronze(spark, out, str(tmp_path / "ck"), fmt="parquet", source_path=src,
                          trigger="availableNow", landing_col="landed_at", writers_per_partition=3):
        q.awaitTermination()
    assert spark.read.parquet(out).count() == 1000
    per_dir = {}
    for f in glob.glob(f"{out}/facility_id=*/date=*/hour=*/batch=*/*.parquet"):
        d = f.rsplit("/", 1)[0]
        per_dir[d] = per_dir.get(d, 0) + 1
    assert max(per_dir.values()) <= 3


def test_kafka_without_connector_fails_clearly(spark):
    import pytest
    from verdant.sources.messages import KAFKA_MISSING
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_messages(spark, "kafka", {"kafka.bootstrap.servers": "localhost:1"})
    assert "spark-sql-kafka" in KAFKA_MISSING


def test_kafka_sink_without_connector_fails_clearly(spark):
    import pytest
    df = spark.createDataFrame([("sensors.co2", "{}")], "topic string, value string")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        write_topics(df, fmt="kafka", options={"kafka.bootstrap.servers": "localhost:1"})
