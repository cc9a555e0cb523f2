"""Plan shape checks: pruning and pushdown reach the scan, no quadratic joins,
broadcast only behind the size check, partial aggregation before shuffles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
import __spark_entry__ as E
from verdant.operators.joins import join_small
from verdant.sinks.tables import write_partitions
from verdant.sources.fixture import load_readings
from verdant.sources.tables import select_run


def plan(df) -> str:
    """The formatted physical plan (as ``df.explain("formatted")`` prints it)."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_run_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "landed")
    r = load_readings(spark, SF_SMALL).withColumn("date", F.to_date("landed_at")).withColumn(
        "hour", F.hour("landed_at"))
    write_partitions(r, path, ["date", "hour"])
    sel = select_run(spark.read.parquet(path), "2024-01-09 22:30:00", "2024-01-10 01:30:00")
    text = plan(sel)
    part = [ln for ln in text.splitlines() if ln.startswith("PartitionFilters:")]
    assert part and "date" in part[0] and "hour" in part[0]
    assert "PushedFilters: [IsNotNull(landed_at), GreaterThanOrEqual(landed_at" in text
    lo = F.lit("2024-01-09 22:30:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-10 01:30:00").cast("timestamp_ntz")
    assert sel.count() == r.where((F.col("landed_at") >= lo) & (F.col("landed_at") < hi)).count()


def test_scans_read_only_needed_columns(spark):
    text = plan(E.queries()["sensor_stats"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text


def test_no_quadratic_join_anywhere(spark):
    for name in ("vpd_pairs", "gold_climate", "upsert_gold", "climate_trends"):
        text = plan(E.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_stats_side_is_broadcast_and_readings_not_shuffled(spark):
    text = plan(E.queries()["anomaly_classify"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text     # readings are never shuffled to classify


def _hinted(df) -> bool:
    """Whether the plan carries our explicit broadcast hint (not Spark's own choice)."""
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_join_small_falls_back_beyond_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    bounded = join_small(big, small, ["k"], max_rows=5)
    assert not _hinted(bounded) and bounded.count() == 100
    assert _hinted(join_small(big, small, ["k"], max_rows=50))


def test_aggregates_are_partial_before_shuffle(spark):
    from verdant.operators.serving import latest_by_key
    text = plan(latest_by_key(load_readings(spark, SF_SMALL), ["facility_id", "device_id"], "event_id"))
    # The input is reduced by hash alone: no sort aggregate, and the row is found by a join back.
    assert "HashAggregate" in text and "partial_max" in text
    assert "SortAggregate" not in text and "max_by" not in text


def test_merges_reduce_by_hash(spark):
    text = plan(E.queries()["upsert_live"](spark, SF_SMALL))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_peer_join_runs_nothing_when_built(spark):
    """No job until the result is asked for; the join is adaptive."""
    from verdant.operators.quality import peer_outliers

    tracker = spark.sparkContext.statusTracker()
    readings = load_readings(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("peer-build", "peer-build")
    df = peer_outliers(readings, ["facility_id", "sensor_type", "event_ts"])
    jobs = tracker.getJobIdsForGroup("peer-build")
    spark.sparkContext.setJobGroup("rest", "rest")
    assert len(jobs) == 0 and "AdaptiveSparkPlan" in plan(df)


def _scanned(df) -> set[str]:
    """Files that the rows of a scan come from."""
    return {r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}


def test_gold_read_does_not_grow_with_the_table(spark, tmp_path):
    """A run's windows open the landing partitions that the event index names: as many for 30 as for 200 days."""
    import datetime as dt

    from verdant.plans.events import landing_hours, update_index
    from verdant.plans.gold import window_readings
    from verdant.plans.silver import SILVER_PARTITIONS
    from verdant.schemas import SILVER_SCHEMA
    from verdant.sources.tables import hours_predicate, read_table

    opened = []
    for days in (30, 200):
        path = str(tmp_path / f"silver{days}")
        at = F.make_dt_interval(F.col("id").cast("int"), F.lit(0), F.lit(0), F.lit(0)) + F.lit("2024-01-01 10:10:00").cast("timestamp_ntz")
        # Every 7th reading lands a day late; one of the first day's lands 25 days late.
        late = F.make_dt_interval(F.when(F.col("id") == 0, 25).when(F.col("id") % 7 == 3, 1).otherwise(0), F.lit(0), F.lit(1), F.lit(0))
        base = spark.range(days).select(F.lit("A").alias("facility_id"), F.lit("t").alias("sensor_id"), F.lit(20.0).alias("value"),
                                        F.lit("temperature").alias("sensor_type"), at.alias("event_ts"), (at + late).alias("bronze_landed_at"),
                                        F.lit(False).alias("is_anomaly"))
        missing = [f for f in SILVER_SCHEMA.fields if f.name not in (*base.columns, "date", "hour", "event_date")]
        rows = (base.withColumn("date", F.to_date("bronze_landed_at")).withColumn("hour", F.hour("bronze_landed_at"))
                    .withColumn("event_date", F.to_date("event_ts"))
                    .select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]))
        write_partitions(rows.select(*SILVER_SCHEMA.names), path, SILVER_PARTITIONS)
        update_index(spark, path)
        times = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 11, 10), dt.datetime(2024, 1, 26, 10)]
        windows = spark.createDataFrame([("A", t) for t in times], "facility_id string, window_start timestamp_ntz")
        hours = landing_hours(spark, path, windows)
        assert dt.datetime(2024, 1, 26, 10) in hours                        # where the first day's reading landed
        silver = read_table(spark, path, SILVER_SCHEMA).where(hours_predicate(hours))
        text = plan(silver)
        assert [ln for ln in text.splitlines() if ln.startswith("PartitionFilters:") and "hour" in ln and "date" in ln]
        opened.append(len(_scanned(silver)))
        got = window_readings(silver, windows)
        assert sorted(r["event_ts"].day for r in got.collect()) == [1, 11, 26]
    assert opened[0] == opened[1] <= 5


def test_one_scan_for_any_number_of_facilities(spark, tmp_path):
    from verdant.sources.tables import facility_union

    path = str(tmp_path / "f")
    spark.range(300).select("id", F.when(F.col("id") % 11 > 0, F.concat(F.lit("f"), F.col("id") % 11)).alias("facility_id")).write.parquet(path)
    df = spark.read.parquet(path)
    for branches in (None, [f"f{i}" for i in range(1, 11)] + [None], ["f1", "f1", None]):
        out = facility_union(df, branches)
        assert plan(out).count("Scan parquet") // 2 == 1 and out.columns == ["id", "facility_id"]
    assert facility_union(df).count() == facility_union(df, [f"f{i}" for i in range(1, 11)] + [None]).count() == 300
    n = df.where("facility_id = 'f1'").count()
    assert out.count() == 2 * n + df.where("facility_id is null").count()


def test_trend_panel_prunes_the_written_table(spark, tmp_path):
    import datetime as dt

    from verdant.plans.panels import panel, register_serving_views

    path = str(tmp_path / "serving")
    rows = [("A", dt.datetime(2024, 1, d, h), float(d)) for d in range(1, 29) for h in (1, 13)]
    facts = spark.createDataFrame(rows, "facility_id string, window_start timestamp_ntz, climate_score double").withColumn("date", F.to_date("window_start"))
    write_partitions(facts, path, ["facility_id", "date"])
    register_serving_views(facts=spark.read.parquet(path))
    out = panel(spark, "trend", column="climate_score", as_of="2024-01-21 00:00:00", hours=24)
    assert [ln for ln in plan(out).splitlines() if ln.startswith("PartitionFilters:") and "date" in ln]
    assert [r["time"] for r in out.collect()] == [dt.datetime(2024, 1, 20, 1), dt.datetime(2024, 1, 20, 13)]


def test_gold_run_classifies_nothing_and_pairs_once(spark, tmp_path):
    """A Gold run reads Silver's classes; the pairs it serves come from the written table."""
    import inspect

    from verdant.plans import gold
    text = inspect.getsource(gold)
    assert "classify_anomalies" not in text and text.count("vpd_pairs(") == 1


def test_join_small_byte_bound(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k").withColumn("v", F.lit("x" * 10))
    assert not _hinted(join_small(big, small, ["k"], max_bytes=100))          # 10 rows x 36 bytes
    assert _hinted(join_small(big, small, ["k"], max_bytes=10_000))
