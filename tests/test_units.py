"""Tier 1: hand-built rows for every branch (FIXTURES.md section C)."""

from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from verdant.constants import GAUGE_BANDS
from verdant.functions.columns import band_label, parse_timestamp, range_score, vpd_kpa
from verdant.operators.bandjoin import band_join
from verdant.operators.climate import climate_by_window, climate_score, crop_score, pivot_climate
from verdant.operators.decode import decode_messages, flatten_payload, route_topics, type_readings
from verdant.operators.quality import classify_anomalies, facility_aggregate, peer_outliers
from verdant.operators.serving import (current_anomalies, latest_by_key, live_gauges, merge_upsert,
                                       threshold_band)
from verdant.sources.payloads import parse_payloads
from verdant.sources.tables import select_run

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def env(spark, items):
    return spark.createDataFrame(
        [(t, None if v is None else v.encode()) for t, v in items], "topic string, value binary")


# --- JSON decode ------------------------------------------------------------

def test_decode_permissive_and_quarantine(spark):
    good_msg = json.dumps({"sensor_id": "t1", "value": 21.5, "facility_id": "facility_A", "growth_week": 6,
                           "extra": 1})
    items = [
        ("sensors.temperature", good_msg),
        ("sensors.temperature", "{not json"),
        ("sensors.temperature", ""),
        ("sensors.temperature", None),
        ("sensors.humidity", '{"sensor_id": 7, "value": "wet", "facility_id": "facility_B", "growth_week": 2.5}'),
        ("sensors.humidity", '{"sensor_id": "h1", "value": NaN, "facility_id": "facility_B"}'),
        ("sensors.co2", '{"sensor_id": "c1", "value": 900.0}'),
    ]
    good, bad = decode_messages(env(spark, items), landing_col=None)
    g = {r["sensor_id"]: r for r in good.collect()}
    assert set(g) == {"t1", "7", "h1"}
    assert g["t1"]["value"] == 21.5 and g["t1"]["growth_week"] == 6
    assert g["7"]["value"] is None and g["7"]["growth_week"] is None    # wrong type -> NULL field
    assert math.isnan(g["h1"]["value"])                                # NaN literal accepted
    assert g["t1"]["date"] is not None and g["t1"]["hour"] is not None
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["empty", "empty", "malformed", "no_facility"]


def test_parse_timestamp_forms(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:07.179575",), ("2024-01-01T10:00:07",), ("garbage",),
                                (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 0, 7, 179575), dt.datetime(2024, 1, 1, 10, 0, 7), None, None]


def test_type_readings(spark):
    df = spark.createDataFrame([("s", 1.0, "2024-01-01T00:00:00", "2024-01-01T00:00:01", "sensors.co2"),
                                ("s", 2.0, "bad", None, "sensors.unknown")],
                               "sensor_id string, value double, timestamp string, ingested_at string, "
                               "source_topic string")
    out = type_readings(df).collect()
    assert out[0]["event_ts"] == dt.datetime(2024, 1, 1) and out[0]["sensor_type"] == "co2"
    assert out[1]["event_ts"] is None and out[1]["sensor_type"] is None


# --- Payload flatten and routing --------------------------------------------

def test_flatten_payload(spark):
    doc = {"facility_id": "facility_A", "crop_type": "tomato", "growth_week": 6, "polled_at": "x",
           "readings": {
               "temperature": {"sensors": [{"sensor_id": "a", "value": 20.0, "timestamp": "t"},
                                           {"sensor_id": "b", "value": None, "timestamp": "t"}],
                               "facility_aggregate": 20.0, "sensor_count": 2, "healthy_sensor_count": 1},
               "co2": {"sensors": [], "facility_aggregate": None, "sensor_count": 0, "healthy_sensor_count": 0},
               "sound": {"sensors": [{"sensor_id": "z", "value": 1.0}], "facility_aggregate": 1.0,
                         "sensor_count": 1, "healthy_sensor_count": 1}}}
    df = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    flat = flatten_payload(parse_payloads(df), ingested_at=F.lit("now")).collect()
    assert sorted(r["sensor_id"] for r in flat) == ["a", "b"]          # empty group, unknown type skipped
    assert all(r["topic"] == "sensors.temperature" and r["sensor_count"] == 2 for r in flat)
    assert all(r["crop_type"] == "tomato" and r["ingested_at"] == "now" for r in flat)


def test_route_topics_drops_unknown(spark):
    df = spark.createDataFrame([("a", 1.0, "humidity"), ("b", 2.0, "sound")],
                               "sensor_id string, value double, sensor_type string")
    out = route_topics(df).collect()
    assert len(out) == 1 and out[0]["topic"] == "sensors.humidity"
    assert json.loads(out[0]["value"]) == {"sensor_id": "a", "value": 1.0}


# --- Classification ----------------------------------------------------------

def readings(spark, rows):
    return spark.createDataFrame(rows, "event_id long, facility_id string, sensor_id string, "
                                       "sensor_type string, value double")


def classes(df):
    return {r["event_id"]: r["anomaly_type"] for r in classify_anomalies(df).collect()}


def test_classify_branches(spark):
    rows = [(1, "f", "s1", "temperature", None), (2, "f", "s2", "temperature", float("nan")),
            (3, "f", "s3", "temperature", 50.0), (4, "f", "s4", "temperature", 50.1),
            (5, "f", "s5", "temperature", 5.0), (6, "f", "s6", "temperature", 4.99),
            (7, "f", "h", "humidity", 100.0), (8, "f", "h2", "humidity", -0.1),
            (9, "f", "c", "co2", 5000.5), (10, "f", "l", "light", 2000.0), (11, "f", "a", "airflow", 5.01),
            (12, "f", "u", "unknown", -5.0)]
    got = classes(readings(spark, rows))
    assert got == {1: "dropout", 2: "dropout", 3: None, 4: "range", 5: None, 6: "range", 7: None,
                   8: "range", 9: "range", 10: None, 11: "range", 12: None}


def test_statistical_needs_enough_rows(spark):
    # 10 rows with one outlier: max z = 9/sqrt(10) < 3 -> never statistical.
    ten = [(i, "f", "s", "co2", 1000.0) for i in range(9)] + [(9, "f", "s", "co2", 3000.0)]
    assert classes(readings(spark, ten))[9] is None
    # 11 rows: 10/sqrt(11) > 3 -> statistical (range check not reached).
    eleven = [(i, "f", "s", "co2", 1000.0) for i in range(10)] + [(10, "f", "s", "co2", 3000.0)]
    assert classes(readings(spark, eleven))[10] == "statistical"


def test_nan_does_not_poison_statistics(spark):
    rows = [(i, "f", "s", "co2", 1000.0) for i in range(10)] + [(10, "f", "s", "co2", 3000.0),
                                                               (11, "f", "s", "co2", float("nan"))]
    got = classes(readings(spark, rows))
    assert got[10] == "statistical" and got[11] == "dropout"


def test_single_row_sensor(spark):
    assert classes(readings(spark, [(1, "f", "s", "co2", 100.0)])) == {1: "range"}


def test_null_keys_keep_their_statistics(spark):
    rows = [(i, None, "s", "co2", 1000.0) for i in range(10)] + [(10, None, "s", "co2", 3000.0)]
    assert classes(readings(spark, rows))[10] == "statistical"


# --- VPD and scores ------------------------------------------------------------

def test_vpd_edges(spark):
    df = spark.createDataFrame([(25.0, 0.0), (25.0, 100.0), (-237.3, 50.0), (None, 50.0)],
                               "t double, h double")
    got = [r[0] for r in df.select(vpd_kpa("t", "h")).collect()]
    assert got[0] == round(0.6108 * math.exp(17.27 * 25 / (25 + 237.3)), 4)
    assert got[1] == 0.0
    assert got[2] is None and got[3] is None


def test_range_score(spark):
    df = spark.createDataFrame([(20.0,), (23.0,), (26.0,), (17.0,), (38.0,), (None,)], "v double")
    got = [r[0] for r in df.select(range_score("v", 20, 26)).collect()]
    assert got == [100.0, 100.0, 100.0, 50.0, -100.0, None]
    clamped = [r[0] for r in df.select(range_score("v", 20, 26, clamp=True)).collect()]
    assert clamped == [100.0, 100.0, 100.0, 50.0, 0.0, None]


def test_climate_score_tie_is_exact(spark):
    # temperature score 83.34 + 3 x 100 = 383.34 -> mean 95.835 exactly -> 95.84 (half up)
    wide = spark.createDataFrame([(19.0004, 70.0, 900.0, 400.0)], "avg_temperature double, "
                                 "avg_humidity double, avg_co2 double, avg_light double")
    one = climate_score(wide).collect()[0]
    assert one["score_temperature"] == 83.34 and one["climate_score"] == 95.84
    light0 = climate_score(wide.withColumn("avg_light", F.lit(0.0))).collect()[0]
    assert light0["score_light"] == 50.0
    w2 = spark.createDataFrame([("tomato", 20.0, 65.0, 800.0, None)], "crop_type string, avg_temperature double, "
                               "avg_humidity double, avg_co2 double, avg_light double")
    r = crop_score(w2).collect()[0]
    assert r["crop_score_temperature"] == 100.0 and r["crop_climate_score"] is None


def test_threshold_bands(spark):
    df = spark.createDataFrame([("facility_A", "temperature", 19.99), ("facility_A", "temperature", 20.0),
                                ("facility_A", "temperature", 30.0), ("facility_B", "light", 149.0),
                                ("facility_B", "light", 500.0), ("facility_C", "light", 1.0),
                                ("facility_A", "co2", None)],
                               "facility_id string, sensor_type string, gauge_value double")
    got = [r["band"] for r in threshold_band(df).collect()]
    assert got == ["blue", "green", "red", "red", "yellow", None, None]
    lbl = df.select(band_label("gauge_value", GAUGE_BANDS[("facility_A", "co2")]).alias("b")).collect()
    assert lbl[0]["b"] == "red"


# --- Peer outliers and facility aggregate --------------------------------------

def peer_df(spark, values):
    return spark.createDataFrame([(i, "f", "co2", "p", v) for i, v in enumerate(values)],
                                 "event_id long, facility_id string, sensor_type string, poll string, value double")


@pytest.mark.parametrize("values,outliers", [
    ([], []), ([5.0], []), ([1.0, 1.0, 9.0], []), ([1.0, 1.0, 1.0, 1.0, 9.0], []),
    ([1.0, 1.0, 1.0, 1.0, 1.0, 9.0], [5]), ([2.0, 2.0, 2.0], []), ([1.0, 1.0, 1.0, 1.0, 1.0, 9.0, None], [5]),
])
def test_peer_outliers(spark, values, outliers):
    if not values:
        df = peer_df(spark, [1.0]).limit(0)
    else:
        df = peer_df(spark, values)
    out = peer_outliers(df, ("facility_id", "sensor_type", "poll")).collect()
    assert sorted(r["event_id"] for r in out if r["is_peer_outlier"]) == outliers
    for r in out:
        assert (r["peer_deviation"] is not None) == r["is_peer_outlier"]


def test_facility_aggregate(spark):
    df = peer_df(spark, [1.0, 1.0, 1.0, 1.0, 1.0, 9.0, None])
    flagged = peer_outliers(df, ("facility_id", "sensor_type", "poll"))
    r = facility_aggregate(flagged, ("facility_id", "sensor_type", "poll")).collect()[0]
    assert (r["facility_aggregate"], r["sensor_count"], r["healthy_sensor_count"]) == (1.0, 7, 5)
    nothing = facility_aggregate(peer_df(spark, [None, None]).withColumn("is_peer_outlier", F.lit(False)),
                                 ("facility_id", "sensor_type", "poll")).collect()[0]
    assert nothing["facility_aggregate"] is None and nothing["healthy_sensor_count"] == 0


# --- Band join -------------------------------------------------------------------

def test_band_join_edges(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 59, 900000)   # near a bin edge
    left = spark.createDataFrame([("f", 1, base), ("g", 2, base), ("f", 3, None)],
                                 "facility_id string, lid int, lts timestamp_ntz")
    right = spark.createDataFrame([
        ("f", 10, base + dt.timedelta(seconds=60)),           # 60 s: in
        ("f", 11, base + dt.timedelta(seconds=61)),           # 61 s: out
        ("f", 12, base + dt.timedelta(seconds=60, microseconds=50000)),  # sub-second: truncates to 60 s? no
        ("f", 13, base - dt.timedelta(seconds=60)),           # -60 s: in
        ("g", 14, base),                                      # other facility
        ("f", 15, None),
    ], "facility_id string, rid int, rts timestamp_ntz")
    got = sorted((r["lid"], r["rid"]) for r in band_join(left, right, ["facility_id"], "lts", "rts", 60).collect())
    # base = ..:00:59.9 -> whole second 59; +60.05 s = 01:59.95 -> second 119: diff 60 -> in
    assert got == [(1, 10), (1, 12), (1, 13), (2, 14)]


def test_band_join_left(spark):
    left = spark.createDataFrame([("f", 1, T0), ("f", 2, T0 + dt.timedelta(hours=1))],
                                 "facility_id string, lid int, lts timestamp_ntz")
    right = spark.createDataFrame([("f", 10, T0)], "facility_id string, rid int, rts timestamp_ntz")
    got = sorted((r["lid"], r["rid"]) for r in band_join(left, right, ["facility_id"], "lts", "rts", 60,
                                                           how="left").collect())
    assert got == [(1, 10), (2, None)]


# --- Windowed aggregate ------------------------------------------------------------

def test_anomaly_rate_cases(spark):
    rows = [("f", "c", 1, T0, "temperature", None, True),
            ("f", "c", 1, T0, "temperature", 1.0, True),
            ("f", "c", 1, T0, "humidity", None, True),
            ("f", "c", 1, T0, "co2", 900.0, False),
            ("f", "c", 1, T0, "co2", 901.0, True)]
    df = spark.createDataFrame(rows, "facility_id string, crop_type string, growth_week int, event_ts timestamp_ntz, "
                                     "sensor_type string, value double, is_anomaly boolean")
    long_df = climate_by_window(df)
    got = {r["sensor_type"]: (r["n_all"], r["n_anomalous"], r["anomaly_rate"], r["avg_value"], r["reading_count"])
           for r in long_df.collect()}
    assert got["temperature"] == (2, 2, 1.0, None, 0)
    assert got["humidity"] == (1, 1, 1.0, None, 0)
    assert got["co2"] == (2, 1, 0.5, 900.0, 1)
    wide = pivot_climate(long_df).collect()[0]
    assert wide["anomaly_rate_light"] is None and wide["avg_co2"] == 900.0
    assert climate_by_window(df, clean_only=True).where("sensor_type = 'co2'").collect()[0]["anomaly_rate"] == 0.0


# --- Merge and latest-by-key -----------------------------------------------------------

LIVE = "facility_id string, sensor_id string, sensor_type string, value double, seq long"


def test_merge_upsert_semantics(spark):
    target = spark.createDataFrame([("f", "a", "temp", 1.0, 1), ("f", "b", "temp", 2.0, 1)], LIVE)
    updates = spark.createDataFrame([("f", "a", "OTHER", None, 5),      # update: NULL wins, type kept
                                     ("f", "c", "hum", 3.0, 5),         # insert
                                     (None, "d", "hum", 4.0, 5),        # NULL key rejected
                                     ("f", "c", "hum", 3.5, 6)],        # duplicate: last wins
                                    LIVE)
    out = merge_upsert(target, updates, ["facility_id", "sensor_id"], ["value", "seq"], order_by="seq")
    got = {r["sensor_id"]: (r["sensor_type"], r["value"], r["seq"]) for r in out.collect()}
    assert got == {"a": ("temp", None, 5), "b": ("temp", 2.0, 1), "c": ("hum", 3.5, 6)}
    again = merge_upsert(out, updates, ["facility_id", "sensor_id"], ["value", "seq"], order_by="seq")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    empty = merge_upsert(target, updates.limit(0), ["facility_id", "sensor_id"], ["value"])
    assert sorted(map(tuple, empty.collect())) == sorted(map(tuple, target.collect()))


def test_latest_by_key(spark):
    df = spark.createDataFrame([("f", "a", "t", 1.0, 1), ("f", "a", "t", None, 3), ("f", "a", "t", 9.0, 2),
                                ("f", "b", "t", 5.0, None), ("f", "b", "t", 6.0, 4)], LIVE)
    got = {r["sensor_id"]: r["value"] for r in latest_by_key(df, ["facility_id", "sensor_id"], "seq").collect()}
    assert got == {"a": None, "b": 6.0}      # NULL latest value kept; NULL order never wins


def test_gauges_and_current_anomalies(spark):
    live = spark.createDataFrame([
        ("facility_A", "x", "airflow", 0.12345, False, T0), ("facility_A", "y", "airflow", 0.2, False, T0),
        ("facility_A", "z", "temperature", None, True, None),
        ("facility_A", "w", "temperature", None, True, T0)],
        "facility_id string, sensor_id string, sensor_type string, value double, is_anomaly boolean, "
        "recorded_at timestamp_ntz")
    g = {r["sensor_type"]: r["gauge_value"] for r in live_gauges(live).collect()}
    assert g == {"airflow": 0.162}
    top = [r["sensor_id"] for r in current_anomalies(live, 5).collect()]
    assert top == ["z", "w"]      # NULL time first, as SQL DESC


# --- Run window -----------------------------------------------------------------------------

def test_select_run_crosses_midnight(spark):
    times = [dt.datetime(2024, 1, 9, 22, 29, 59), dt.datetime(2024, 1, 9, 22, 30), dt.datetime(2024, 1, 9, 23, 59),
             dt.datetime(2024, 1, 10, 0, 15), dt.datetime(2024, 1, 10, 1, 30)]
    df = spark.createDataFrame([(t,) for t in times], "landed_at timestamp_ntz") \
        .withColumn("date", F.to_date("landed_at")).withColumn("hour", F.hour("landed_at"))
    got = [r[0] for r in select_run(df, "2024-01-09 22:30:00", "2024-01-10 01:30:00").select("landed_at").collect()]
    assert got == times[1:4]
    whole = select_run(df, "2024-01-09 22:30:00", "2024-01-10 01:30:00", whole_partitions=True).count()
    assert whole == 5   # 22:29:59 shares the 22h partition, 01:30 the 01h partition


def test_leave_one_out_statistics(spark):
    import statistics
    vals = [1000.0] * 6 + [1003.0, 998.0, 1001.0, 3000.0, None]
    df = readings(spark, [(i, "f", "s", "co2", v) for i, v in enumerate(vals)])
    from verdant.operators.quality import with_sensor_stats
    got = {r["event_id"]: (r["sensor_mean"], r["sensor_stddev"])
           for r in with_sensor_stats(df, leave_one_out=True).collect()}
    for i, v in enumerate(vals):
        if v is None:
            continue
        others = [x for j, x in enumerate(vals) if j != i and x is not None]
        assert got[i][0] == pytest.approx(statistics.mean(others), rel=1e-12)
        assert got[i][1] == pytest.approx(statistics.stdev(others), rel=1e-9)
    # 10 readings with one outlier: all-in 3-sigma cannot fire, leave-one-out does.
    assert classes(df)[9] is None
    loo = {r["event_id"]: r["anomaly_type"] for r in classify_anomalies(df, leave_one_out=True).collect()}
    assert loo[9] == "statistical" and loo[0] is None


def test_zone_spread(spark):
    from verdant.operators.climate import zone_spread
    rows_ = [("f", "c", 1, T0, "temperature", "z1", 20.0, False), ("f", "c", 1, T0, "temperature", "z1", 22.0, False),
             ("f", "c", 1, T0, "temperature", "z2", 25.0, False), ("f", "c", 1, T0, "temperature", "z3", 99.0, True)]
    df = spark.createDataFrame(rows_, "facility_id string, crop_type string, growth_week int, event_ts timestamp_ntz, "
                                      "sensor_type string, sensor_id string, value double, is_anomaly boolean")
    r = zone_spread(df).collect()[0]
    assert r["zone_count"] == 2 and r["zone_spread"] == round(((21 - 23) ** 2 + (25 - 23) ** 2) ** 0.5, 3)


def test_no_value_raises_and_means_are_exact(spark):
    """NaN, huge values and ties: no aggregate raises, means round half up on the values' decimal forms."""
    import datetime as dt
    ts = dt.datetime(2024, 1, 1, 10, 5)
    values = {"nan": [float("nan"), 2.0], "big": [1e13, 1e13], "huge": [1e300, 1e300], "tie": [0.0005, 0.0006, 0.0004, 0.0005],
              "tie2": [2.0005, 2.0005], "null": [None, None]}
    data = [("A", k, "s", v, ts, False, "c", 1, False) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(data, "facility_id string, sensor_type string, sensor_id string, value double, event_ts timestamp_ntz, "
                                     "is_anomaly boolean, crop_type string, growth_week int, is_peer_outlier boolean")
    means = {r["sensor_type"]: r["avg_value"] for r in climate_by_window(df).collect()}
    assert means == {"nan": 2.0, "big": 1e13, "huge": 1e300, "tie": 0.001, "tie2": 2.001, "null": None}
    gauges = {r["sensor_type"]: r["gauge_value"] for r in live_gauges(df, {k: 2 for k in values}).collect()}
    assert gauges == {"nan": 2.0, "big": 1e13, "huge": 1e300, "tie": 0.0, "tie2": 2.0, "null": None}
    polls = {r["sensor_type"]: (r["facility_aggregate"], r["healthy_sensor_count"])
             for r in facility_aggregate(df, ["facility_id", "sensor_type"]).collect()}
    assert polls["nan"] == (2.0, 1) and polls["big"] == (1e13, 2) and polls["null"] == (None, 0)
    assert peer_outliers(df, ["facility_id", "sensor_type"]).count() == len(data)
