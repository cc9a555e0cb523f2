"""Tier 3: properties. Binned join = naive join; stats join = window; merges idempotent."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID, rows
from verdant.operators.bandjoin import band_join, band_join_naive
from verdant.operators.quality import classify_anomalies, with_sensor_stats
from verdant.sources.fixture import load_readings


def _sides(spark):
    c = classify_anomalies(load_readings(spark, SF_MID)).where(~F.col("is_anomaly"))
    t = c.where("sensor_type = 'temperature'").select("facility_id", F.col("event_id").alias("tid"),
                                                      F.col("event_ts").alias("tts"))
    h = c.where("sensor_type = 'humidity'").select("facility_id", F.col("event_id").alias("hid"),
                                                   F.col("event_ts").alias("hts"))
    return t, h


def test_binned_equals_naive_on_fixture(spark):
    t, h = _sides(spark)
    a = band_join(t, h, ["facility_id"], "tts", "hts", 60)
    b = band_join_naive(t, h, ["facility_id"], "tts", "hts", 60)
    assert a.count() == 88
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_binned_join_has_equi_keys(spark):
    t, h = _sides(spark)
    plan = band_join(t, h, ["facility_id"], "tts", "hts", 60)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "__band_bin" in plan


def test_stats_join_equals_window(spark):
    r = load_readings(spark, SF_MID)
    w = Window.partitionBy("facility_id", "sensor_id")
    by_window = r.select("event_id", F.round(F.avg("value").over(w), 9).alias("m"),
                         F.round(F.stddev_samp("value").over(w), 9).alias("s"))
    by_join = with_sensor_stats(r).select("event_id", F.round("sensor_mean", 9).alias("m"),
                                          F.round("sensor_stddev", 9).alias("s"))
    assert rows(by_window) == rows(by_join)


BASE = dt.datetime(2024, 3, 1)
offsets = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 600_000_000)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets, offsets, st.integers(1, 90))
def test_band_join_property(spark, left, right, seconds):
    ldf = spark.createDataFrame([(k, i, BASE + dt.timedelta(microseconds=u)) for i, (k, u) in enumerate(left)],
                                "k string, lid int, lts timestamp_ntz")
    rdf = spark.createDataFrame([(k, i, BASE + dt.timedelta(microseconds=u)) for i, (k, u) in enumerate(right)],
                                "k string, rid int, rts timestamp_ntz")
    got = sorted((r["lid"], r["rid"]) for r in band_join(ldf, rdf, ["k"], "lts", "rts", seconds).collect())
    want = sorted((i, j) for i, (k1, u1) in enumerate(left) for j, (k2, u2) in enumerate(right)
                  if k1 == k2 and abs(u1 // 1_000_000 - u2 // 1_000_000) <= seconds)
    assert got == want


keys_st = st.integers(0, 6)
row_st = st.tuples(keys_st, st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(0, 9)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, max_size=8, unique_by=lambda r: r[0]), st.lists(row_st, max_size=10))
def test_merge_matches_row_by_row_upsert(spark, target, updates):
    """merge_upsert == applying the updates one by one in arrival order to a keyed table."""
    from verdant.operators.serving import merge_upsert
    schema = "k int, kind string, v int, seq int"
    t = spark.createDataFrame([(k, kind, v, -1) for k, kind, v in target], schema)
    u = spark.createDataFrame([(k, kind, v, i) for i, (k, kind, v) in enumerate(updates)], schema)
    got = {r["k"]: (r["kind"], r["v"]) for r in merge_upsert(t, u, ["k"], ["v", "seq"], order_by="seq").collect()}
    model = {k: (kind, v) for k, kind, v in target}
    for k, kind, v in updates:                      # ON CONFLICT: update v, keep kind
        model[k] = (model[k][0], v) if k in model else (kind, v)
    assert got == model
