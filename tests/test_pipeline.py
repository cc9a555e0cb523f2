"""Silver and Gold runs over written tables: idempotent, whole partitions, keyed merges."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import SF_MID, rows
from verdant.operators.climate import GOLD_COLUMNS, build_gold, vpd_pairs
from verdant.plans.gold import run_gold, touched_windows
from verdant.plans.silver import run_silver
from verdant.schemas import VPD_SCHEMA
from verdant.sinks.tables import merge_into_table, write_partitions
from verdant.sources.fixture import load_readings
from verdant.sources.messages import envelopes_from_readings
from verdant.sources.tables import read_table, run_bounds
from verdant.streaming.bronze import BRONZE_PARTITIONS, bronze_stream

START, END = "2024-01-10 10:00:00", "2024-01-10 10:30:00"


def _bronze(spark, path):
    good, _ = bronze_stream(envelopes_from_readings(load_readings(spark, SF_MID)), landing_col="landed_at")
    write_partitions(good, path, BRONZE_PARTITIONS)
    return spark.read.parquet(path)


def test_silver_run_owns_whole_hours_and_is_idempotent(spark, tmp_path):
    bronze = _bronze(spark, str(tmp_path / "bronze"))
    silver_path = str(tmp_path / "silver")
    n1 = run_silver(spark, str(tmp_path / "bronze"), silver_path, START, END).count()
    expected = bronze.where((F.col("date") == dt.date(2024, 1, 10)) & (F.col("hour") == 10)).count()
    assert n1 == expected > 0
    run_silver(spark, str(tmp_path / "bronze"), silver_path, START, END)            # retry
    run_silver(spark, str(tmp_path / "bronze"), silver_path, "2024-01-10 10:30:00", "2024-01-10 11:00:00")
    assert spark.read.parquet(silver_path).count() == expected                      # no duplicates
    s = spark.read.parquet(silver_path)
    assert {"anomaly_type", "is_anomaly", "event_ts", "sensor_type"} <= set(s.columns)


def _window(column="event_ts"):
    return F.window(column, "30 minutes").start


def test_gold_run_recomputes_whole_windows(spark, tmp_path):
    _bronze(spark, str(tmp_path / "bronze"))
    silver_path = str(tmp_path / "silver")
    run_silver(spark, str(tmp_path / "bronze"), silver_path, "2024-01-10 00:00:00", "2024-01-11 00:00:00")
    paths = {k: str(tmp_path / k) for k in ("gold", "vpd", "serving")}
    for _ in range(2):                                                               # a run and its retry
        run_gold(spark, silver_path, paths["gold"], paths["vpd"], paths["serving"], START, END)
    gold = spark.read.parquet(paths["gold"])
    keys = ["facility_id", "crop_type", "growth_week", "window_start"]
    assert gold.count() == gold.select(*keys).distinct().count() > 0
    silver = spark.read.parquet(silver_path)
    windows = touched_windows(silver, START, END).select("facility_id", "window_start")
    inside = silver.withColumn("window_start", _window()).join(windows, ["facility_id", "window_start"], "left_semi").drop("window_start")
    want = build_gold(inside, vpd=vpd_pairs(inside, id_col="sensor_id")).select(*[c for c in GOLD_COLUMNS if c != "avg_vpd"])
    assert rows(gold.select(*want.columns)) == rows(want)
    serving = spark.read.parquet(paths["serving"])
    assert serving.count() == gold.count()
    assert serving.select("facility_id", "window_start").distinct().count() == serving.count()
    # A whole-day run has VPD pairs at this scale: the written table equals the computed pairs.
    day = {k: str(tmp_path / f"day_{k}") for k in ("gold", "vpd", "serving")}
    run_gold(spark, silver_path, day["gold"], day["vpd"], day["serving"], "2024-01-10 00:00:00", "2024-01-11T01:00:00+01:00")
    pairs = vpd_pairs(silver, id_col="sensor_id", keep_humidity_ts=True)
    vpd = spark.read.parquet(day["vpd"]).drop("date", "hour", "window_start")
    assert vpd.count() > 0 and rows(vpd) == rows(pairs.select(*vpd.columns))


MESSAGES = "topic string, value binary, offset long, landed_at timestamp_ntz"


def _msg(sensor, value, ts, landed=None, kind="temperature", facility="facility_A", crop="tomato", week=6):
    body = {"sensor_id": sensor, "value": value, "timestamp": ts, "facility_id": facility, "crop_type": crop, "growth_week": week}
    return Row(topic=f"sensors.{kind}", value=json.dumps(body).encode(), offset=0,
               landed_at=dt.datetime.fromisoformat(landed or ts))


def _land(spark, path, messages):
    good, _ = bronze_stream(spark.createDataFrame(messages, MESSAGES), landing_col="landed_at")
    write_partitions(good, path, BRONZE_PARTITIONS)


def _paths(tmp_path):
    return [str(tmp_path / n) for n in ("s", "g", "v", "sv")]


def test_reruns_do_not_multiply_repeated_messages(spark, tmp_path):
    """One repeated message: the VPD table has its two pairs after any number of runs."""
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    t = _msg("t1", 22.0, "2024-02-01T10:05:00")
    _land(spark, b, [t, t, _msg("h1", 70.0, "2024-02-01T10:05:30", kind="humidity")])
    run_silver(spark, b, s, "2024-02-01 10:00", "2024-02-01 10:30")
    for _ in range(3):
        run_gold(spark, s, g, v, sv, "2024-02-01 10:00", "2024-02-01 10:30")
        assert spark.read.parquet(v).count() == 2 and spark.read.parquet(g).count() == spark.read.parquet(sv).count() == 1
    assert spark.read.parquet(sv).first()["avg_vpd"] == 0.7932


def test_reclassified_reading_loses_its_pair(spark, tmp_path):
    """A rerun that finds the temperature anomalous removes its pair, and an emptied partition."""
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    good = [_msg("t1", 22.0, "2024-02-01T10:05:00"), _msg("h1", 70.0, "2024-02-01T10:05:30", kind="humidity")]
    _land(spark, b, good)
    run_silver(spark, b, s, "2024-02-01 10:00", "2024-02-01 11:00")
    run_gold(spark, s, g, v, sv, "2024-02-01 10:00", "2024-02-01 10:30")
    assert spark.read.parquet(v).count() == 1
    _land(spark, b, [_msg("t1", 99.0, "2024-02-01T10:05:00"), good[1]])             # Bronze of the hour, corrected
    run_silver(spark, b, s, "2024-02-01 10:00", "2024-02-01 11:00")
    run_gold(spark, s, g, v, sv, "2024-02-01 10:00", "2024-02-01 10:30")
    assert read_table(spark, v, VPD_SCHEMA).count() == 0
    row = spark.read.parquet(sv).first()
    assert row["avg_vpd"] is None and row["avg_temperature"] is None and row["avg_humidity"] == 70.0


def test_null_weeks_late_readings_and_neighbour_windows(spark, tmp_path):
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    _land(spark, b, [_msg("t1", 20.0, "2024-02-01T10:29:50", week=None), _msg("t2", 22.0, "2024-02-01T10:05:00", week="six")])
    run_silver(spark, b, s, "2024-02-01 10:00", "2024-02-01 11:00")
    run_gold(spark, s, g, v, sv, "2024-02-01 10:00", "2024-02-01 11:00")
    facts = spark.read.parquet(g).collect()
    assert [(r["growth_week"], r["avg_temperature"]) for r in facts] == [(None, 21.0)] and spark.read.parquet(sv).count() == 1
    # Three hours late, in the next window: its humidity still pairs with the temperature at 10:29:50.
    _land(spark, b, [_msg("h1", 70.0, "2024-02-01T10:30:20", "2024-02-01T13:40:00", kind="humidity")])
    run_silver(spark, b, s, "2024-02-01 13:30", "2024-02-01 14:00")
    run_gold(spark, s, g, v, sv, "2024-02-01 13:30", "2024-02-01 14:00")
    served = {r["window_start"].minute: r for r in spark.read.parquet(sv).collect()}
    assert set(served) == {0, 30} and served[0]["avg_vpd"] is not None and served[30]["avg_humidity"] == 70.0


def test_long_run_equals_hourly_runs(spark, tmp_path):
    """Classes depend on the landing hour alone: one three-hour run equals three hourly runs."""
    _bronze(spark, str(tmp_path / "bronze"))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    run_silver(spark, str(tmp_path / "bronze"), one, "2024-01-10 10:00", "2024-01-10 13:00")
    for h in (10, 11, 12):
        run_silver(spark, str(tmp_path / "bronze"), many, f"2024-01-10 {h}:00", f"2024-01-10 {h + 1}:00")
    a, b = (spark.read.parquet(p).drop("silver_processed_at") for p in (one, many))
    assert a.count() > 0 and rows(a) == rows(b)


def test_numeric_facility_ids_stay_text(spark, tmp_path):
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    _land(spark, b, [_msg("t1", 20.0, "2024-02-01T10:05:00", facility="007")])
    for _ in range(2):
        out = run_silver(spark, b, s, "2024-02-01T10:00:00+00:00", "2024-02-01T13:00:00+02:00")
        assert [r["facility_id"] for r in out.collect()] == ["007"]
        facts = run_gold(spark, s, g, v, sv, "2024-02-01T10:00:00+00:00", "2024-02-01T13:00:00+02:00")
        assert [r["facility_id"] for r in facts.collect()] == ["007"]


def test_run_windows(spark):
    assert run_bounds("2024-01-10T10:00:00+00:00", "2024-01-10T13:00:00+02:00") == (dt.datetime(2024, 1, 10, 10), dt.datetime(2024, 1, 10, 11))
    assert run_bounds("2024-01-10 10:00", "2024-01-10T11:00:00Z")[1] == dt.datetime(2024, 1, 10, 11)
    for start, end in (("2024-01-10 00:00", "2024-01-10 00:00"), ("2024-01-10 01:00", "2024-01-10 00:00")):
        with pytest.raises(ValueError, match="must start before"):
            run_bounds(start, end)


def test_merge_into_table_keeps_first_columns_and_other_partitions(spark, tmp_path):
    path = str(tmp_path / "serving")
    schema = "facility_id string, window_start timestamp_ntz, crop_type string, v double, date date"
    w1, w2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)
    first = spark.createDataFrame([("A", w1, "tomato", 1.0, w1.date()), ("A", w2, "tomato", 5.0, w2.date())],
                                  schema)
    merge_into_table(spark, path, first, ["facility_id", "window_start"], ["v"], ["facility_id", "date"])
    upd = spark.createDataFrame([("A", w1, "cucumber", None, w1.date()), ("B", w1, "cucumber", 2.0, w1.date())],
                                schema)
    merge_into_table(spark, path, upd, ["facility_id", "window_start"], ["v"], ["facility_id", "date"])
    merge_into_table(spark, path, upd, ["facility_id", "window_start"], ["v"], ["facility_id", "date"])
    got = {(r["facility_id"], r["window_start"]): (r["crop_type"], r["v"])
           for r in spark.read.parquet(path).collect()}
    assert got == {("A", w1): ("tomato", None), ("A", w2): ("tomato", 5.0), ("B", w1): ("cucumber", 2.0)}


def test_late_reading_refreshes_its_window(spark, tmp_path):
    """A reading that lands in a later run still updates its event window (D4)."""
    bronze_path, (silver, gold, vpd, serving) = str(tmp_path / "b"), _paths(tmp_path)
    _land(spark, bronze_path, [_msg("t1", 20.0, "2024-02-01T10:05:00", "2024-02-01T10:05:30"),
                               _msg("t2", 22.0, "2024-02-01T10:10:00", "2024-02-01T10:10:30")])
    run_silver(spark, bronze_path, silver, "2024-02-01 10:00:00", "2024-02-01 10:30:00")
    run_gold(spark, silver, gold, vpd, serving, "2024-02-01 10:00:00", "2024-02-01 10:30:00")
    first = spark.read.parquet(serving).collect()
    assert len(first) == 1 and first[0]["avg_temperature"] == 21.0
    _land(spark, bronze_path, [_msg("t3", 30.0, "2024-02-01T10:20:00", "2024-02-02T11:40:00")])     # lands a day late
    run_silver(spark, bronze_path, silver, "2024-02-02 11:30:00", "2024-02-02 12:00:00")
    run_gold(spark, silver, gold, vpd, serving, "2024-02-02 11:30:00", "2024-02-02 12:00:00")
    after = spark.read.parquet(serving).collect()
    assert len(after) == 1 and after[0]["window_start"] == dt.datetime(2024, 2, 1, 10, 0)
    assert after[0]["avg_temperature"] == 24.0            # (20 + 22 + 30) / 3, whole window
    assert spark.read.parquet(gold).count() == 1


def test_job_entry_points(spark, tmp_path):
    from verdant.plans.jobs import main
    bronze_path = str(tmp_path / "bronze")
    _bronze(spark, bronze_path)
    s, g, v, sv = (str(tmp_path / n) for n in ("s", "g", "v", "sv"))
    assert main(["silver", "--bronze", bronze_path, "--silver", s, "--start", START, "--end", END]) == 0
    assert main(["gold", "--silver", s, "--gold", g, "--vpd", v, "--serving", sv, "--start", START,
                 "--end", END]) == 0
    assert spark.read.parquet(sv).count() > 0


def test_serving_key_collision_is_deterministic(spark, tmp_path):
    """Two crops in one facility window (D5): one serving row, the later growth week."""
    rows_ = [_msg("a", 21.0, "2024-02-01T10:05:00"), _msg("b", 21.0, "2024-02-01T10:06:00", crop="pepper", week=7)]
    b, s, g, v, sv = (str(tmp_path / n) for n in ("b", "s", "g", "v", "sv"))
    _land(spark, b, rows_)
    run_silver(spark, b, s, "2024-02-01 10:00:00", "2024-02-01 10:30:00")
    run_gold(spark, s, g, v, sv, "2024-02-01 10:00:00", "2024-02-01 10:30:00")
    assert spark.read.parquet(g).count() == 2
    served = spark.read.parquet(sv).collect()
    assert len(served) == 1 and (served[0]["crop_type"], served[0]["growth_week"]) == ("pepper", 7)


def test_readme_usage_on_silver(spark, tmp_path):
    from verdant.operators.serving import climate_trends
    from verdant.schemas import SILVER_SCHEMA
    from verdant.sources.tables import read_table, select_run
    _bronze(spark, str(tmp_path / "bronze"))
    run_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "2024-01-10 00:00", "2024-01-11 00:00")
    silver = read_table(spark, str(tmp_path / "silver"), SILVER_SCHEMA)
    run = select_run(silver, "2024-01-10 10:00", "2024-01-10 10:30", landed_col="bronze_landed_at")
    gold = build_gold(run)
    assert gold.count() > 0
    assert climate_trends(gold, as_of="2024-01-10 10:30").count() > 0


def test_stream_job_entry_points(spark, tmp_path):
    from verdant.plans.jobs import main
    from verdant.sources.payloads import payloads_from_readings
    docs, topics, bronze = str(tmp_path / "docs"), str(tmp_path / "topics"), str(tmp_path / "bronze")
    payloads_from_readings(load_readings(spark, "/root/testdata/sf0.001")).select("payload").write.text(docs)
    assert main(["ingest", "--payloads", docs, "--checkpoint", str(tmp_path / "ck1"), "--sink-format", "parquet",
                 "--sink-path", topics, "--trigger", "availableNow"]) == 0
    assert main(["bronze", "--bronze", bronze, "--checkpoint", str(tmp_path / "ck2"), "--source-format", "parquet",
                 "--source-path", topics, "--trigger", "availableNow"]) == 0
    assert main(["live", "--live", str(tmp_path / "live"), "--checkpoint", str(tmp_path / "ck3"),
                 "--source-format", "parquet", "--source-path", topics, "--trigger", "availableNow"]) == 0
    assert spark.read.parquet(bronze).count() == 1000
    from verdant.operators.serving import latest_by_key, live_rows
    got = spark.read.parquet(str(tmp_path / "live"))
    want = latest_by_key(live_rows(load_readings(spark, "/root/testdata/sf0.001"), sensor_col="sensor_id"),
                         ["facility_id", "sensor_id"], "recorded_at")
    cols = ["facility_id", "sensor_id", "sensor_type", "value", "unit", "is_anomaly", "recorded_at"]
    assert got.count() == 30 and rows(got.select(*cols)) == rows(want.select(*cols))


def test_runs_over_nothing_are_empty_and_typed(spark, tmp_path):
    """No Bronze data at all: Silver and Gold runs succeed with empty, typed results."""
    s = run_silver(spark, str(tmp_path / "no-bronze"), str(tmp_path / "s"), START, END)
    assert s.count() == 0 and {"anomaly_type", "is_anomaly", "event_ts"} <= set(s.columns)
    facts = run_gold(spark, str(tmp_path / "s"), str(tmp_path / "g"), str(tmp_path / "v"), str(tmp_path / "sv"),
                     START, END)
    assert facts.count() == 0 and "climate_score" in facts.columns


def _files(path):
    import glob
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_rerun_writes_no_file_and_a_late_reading_only_its_partitions(spark, tmp_path):
    """The change set: unchanged windows keep their files in all three tables."""
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    _land(spark, b, [_msg(f"{k}{d}", 22.0 if k == "t" else 70.0, f"2024-02-0{d}T10:05:00", kind="temperature" if k == "t" else "humidity")
                     for d in (1, 2, 3) for k in "th"])
    run_silver(spark, b, s, "2024-02-01", "2024-02-04")
    run_gold(spark, s, g, v, sv, "2024-02-01", "2024-02-04")
    before = {p: _files(p) for p in (g, v, sv)}
    assert all(len(f) == 3 for f in before.values())
    run_gold(spark, s, g, v, sv, "2024-02-01", "2024-02-04")
    assert {p: _files(p) for p in (g, v, sv)} == before                               # same names, same bytes
    _land(spark, b, [_msg("t9", 26.0, "2024-02-02T10:20:00", "2024-02-04T09:10:00")])  # two days late, no partner in reach
    run_silver(spark, b, s, "2024-02-04 09:00", "2024-02-04 10:00")
    run_gold(spark, s, g, v, sv, "2024-02-01", "2024-02-05")
    after = {p: _files(p) for p in (g, v, sv)}
    assert after[v] == before[v]
    for p in (g, sv):
        assert len(after[p]) == 3 and len(set(after[p]) & set(before[p])) == 2
    served = {r["window_start"].day: r["avg_temperature"] for r in spark.read.parquet(sv).collect()}
    assert served == {1: 22.0, 2: 24.0, 3: 22.0}


def test_index_follows_reruns_and_missing_indexes(spark, tmp_path):
    import shutil

    from verdant.plans.events import index_of, landing_hours
    b, (s, g, v, sv) = str(tmp_path / "b"), _paths(tmp_path)
    _land(spark, b, [_msg("t1", 22.0, "2024-02-01T10:05:00", "2024-02-01T12:00:10"), _msg("t2", 22.0, "2024-02-01T10:59:59")])
    for _ in range(2):
        run_silver(spark, b, s, "2024-02-01 10:00", "2024-02-01 13:00")
        assert spark.read.parquet(index_of(s)).count() == 2
    windows = spark.createDataFrame([("facility_A", dt.datetime(2024, 2, 1, 10))], "facility_id string, window_start timestamp_ntz")
    want = [dt.datetime(2024, 2, 1, 10), dt.datetime(2024, 2, 1, 12)]
    assert sorted(landing_hours(spark, s, windows)) == want
    other = spark.createDataFrame([("facility_B", dt.datetime(2024, 2, 1, 10))], windows.schema)
    assert landing_hours(spark, s, other) == []
    shutil.move(index_of(s), index_of(s) + "_old")
    assert sorted(landing_hours(spark, s, windows)) == want                            # built anew


def test_digests_tell_nulls_apart(spark):
    from verdant.sinks.tables import changed_windows
    schema = "k int, a int, b int, stamp int"
    old = spark.createDataFrame([(1, None, 1, 0), (2, 5, 5, 0), (3, 1, 1, 0), (5, 1, 2, 0), (5, 3, 4, 0)], schema)
    new = spark.createDataFrame([(1, 1, None, 9), (2, 5, 5, 9), (4, 1, 1, 9), (5, 3, 4, 9), (5, 1, 2, 8)], schema)
    assert sorted(r.k for r in changed_windows(old, new, ["k"], ["stamp"]).collect()) == [1, 3, 4]
