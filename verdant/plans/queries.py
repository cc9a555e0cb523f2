"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator key.

Every query starts from the given ``events`` table through the ``readings``
projection (``verdant.sources.fixture``), so its work grows with the data.
Column names match the oracle SQL in ``verdant.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.constants import GAUGE_SCALES, SCORE_BANDS, TREND_HOURS
from verdant.functions.columns import band_label, iso_string, ntz_literal
from verdant.operators.climate import (GOLD_COLUMNS, SCORED_TYPES, SERVING_COLUMNS, build_gold,
                                       climate_by_window, climate_score, crop_score, pivot_climate,
                                       vpd_by_window, vpd_pairs, zone_spread)
from verdant.operators.decode import decode_messages, flatten_payload, route_topics, type_readings
from verdant.operators.quality import classify_anomalies, facility_aggregate, peer_outliers, sensor_stats
from verdant.operators.serving import (GOLD_KEYS, LIVE_KEYS, LIVE_UPDATE_COLS, TREND_METRICS, climate_trends,
                                       current_anomalies, live_gauges, live_latest, live_rows, merge_upsert,
                                       threshold_band)
from verdant.sources.fixture import load_readings
from verdant.sources.messages import envelopes_from_readings, message_struct
from verdant.sources.payloads import parse_payloads, payloads_from_readings
from verdant.session import scratch_path
from verdant.sources.tables import facility_union, read_table, select_run, spread_input, union_facilities
from verdant.sinks.tables import write_partitions, write_topics
from verdant.streaming.bronze import BRONZE_PARTITIONS, quarantine_of, start_bronze
from verdant.streaming.live import start_live
from verdant.plans.gold import run_gold
from verdant.plans.panels import panel, register_serving_views
from verdant.plans.silver import run_silver, silver_frame, write_silver
from verdant.schemas import BRONZE_SCHEMA, MESSAGE_SCHEMA, VPD_SCHEMA

# Fixed query parameters (shared with the oracle SQL).
RUN_START = "2024-01-09 22:30:00"
RUN_END = "2024-01-10 01:30:00"
TREND_AS_OF = "2024-01-21 00:00:00"
FIRST_BATCH_FROM = "2024-01-15 00:00:00"   # upsert_live: first batch = event_ts >= this
SECOND_BATCH_TO = "2024-01-21 00:00:00"    # upsert_live: second batch = event_ts < this
GOLD_RUN1_TO = "2024-01-21 00:00:00"       # upsert_gold: first run = days 1..20
GOLD_RUN2_FROM = "2024-01-15 00:00:00"     # upsert_gold: second run = days 15..30
TOP_N_ANOMALIES = 20
BROKER_PARTITIONS = 3                      # live_stream: partitions the messages are spread over
POLL_UNIT = "day"                          # peer group = (facility, type, event day)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_readings(spark, sf_dir)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_anomalies(_readings(spark, sf_dir))


def q_sensor_stats(spark, sf_dir):
    s = sensor_stats(_readings(spark, sf_dir))
    return s.select("facility_id", "sensor_id", "n", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"))


def q_anomaly_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("event_id", "anomaly_type", "is_anomaly")


def q_anomaly_classify_loo(spark, sf_dir):
    """Classification judging each value against the other readings of its sensor."""
    c = classify_anomalies(_readings(spark, sf_dir), leave_one_out=True)
    return c.select("event_id", "anomaly_type", "is_anomaly")


def q_zone_spread(spark, sf_dir):
    """Across-zone spread of clean readings per facility window and type."""
    return zone_spread(_classified(spark, sf_dir))


def q_climate_30min(spark, sf_dir):
    long_df = climate_by_window(_classified(spark, sf_dir), clean_only=True)
    return long_df.select("facility_id", "crop_type", "growth_week", "window_start", "sensor_type",
                          "avg_value", "zone_variance", "reading_count")


def q_anomaly_rate(spark, sf_dir):
    long_df = climate_by_window(_classified(spark, sf_dir))
    return long_df.select("facility_id", "window_start", "sensor_type", "n_all", "n_anomalous",
                          "anomaly_rate")


def _wide(spark, sf_dir):
    return pivot_climate(climate_by_window(_classified(spark, sf_dir)))


def q_climate_pivot(spark, sf_dir):
    return _wide(spark, sf_dir)


def q_vpd_pairs(spark, sf_dir):
    return vpd_pairs(_classified(spark, sf_dir))


def q_vpd_30min(spark, sf_dir):
    return vpd_by_window(vpd_pairs(_classified(spark, sf_dir)))


def q_climate_score(spark, sf_dir):
    scored = climate_score(_wide(spark, sf_dir))
    return scored.select("facility_id", "window_start", *[f"score_{t}" for t in SCORED_TYPES],
                         "climate_score")


def q_crop_score(spark, sf_dir):
    scored = crop_score(_wide(spark, sf_dir))
    return scored.select("facility_id", "window_start", "crop_type",
                         *[f"crop_score_{t}" for t in SCORED_TYPES], "crop_climate_score")


def q_gold_climate(spark, sf_dir):
    return build_gold(_classified(spark, sf_dir)).select(*GOLD_COLUMNS)


def _decoded(spark, sf_dir):
    env = envelopes_from_readings(spread_input(_readings(spark, sf_dir)))
    good, _quarantine = decode_messages(env, landing_col="landed_at")
    return good


def q_json_decode(spark, sf_dir):
    return _decoded(spark, sf_dir)


def _land_envelopes(spark, sf_dir, broken: bool = False) -> str:
    """Envelopes derived from ``events``, landed as files for a file stream.

    With ``broken`` some messages are cut short, empty, or name no facility.
    """
    path = scratch_path(spark, "landing")
    readings = spread_input(_readings(spark, sf_dir))
    if broken:
        n = F.col("event_id")
        readings = readings.withColumn("facility_id", F.when(n % 41 != 5, F.col("facility_id")))
    env = envelopes_from_readings(readings, BROKER_PARTITIONS)
    if broken:
        n = F.pmod("offset", F.lit(1_000_000_007))
        text = F.col("value").cast("string")
        env = env.withColumn("value", F.when(n % 31 == 3, F.substring(text, 1, 25)).when(n % 37 != 4, text).cast("binary"))
    env.write.parquet(path)
    return path


def q_bronze_landing(spark, sf_dir):
    """The Bronze streaming job end to end: file stream -> decode -> partitioned
    Parquet (checkpointed, exactly-once), read back from the table root."""
    source = _land_envelopes(spark, sf_dir)
    bronze = scratch_path(spark, "bronze")
    for q in start_bronze(spark, bronze, scratch_path(spark, "bronze-ckpt"), fmt="parquet",
                          source_path=source, trigger="availableNow", landing_col="landed_at"):
        q.awaitTermination()
    return read_table(spark, bronze, BRONZE_SCHEMA).select(*BRONZE_SCHEMA.names)


def q_quarantine(spark, sf_dir):
    """The Bronze job over a topic with broken messages: what landed beside the table, by reason.

    ``n_landed`` counts the messages of the topic that reached the table.
    """
    source = _land_envelopes(spark, sf_dir, broken=True)
    bronze = scratch_path(spark, "bronze")
    for q in start_bronze(spark, bronze, scratch_path(spark, "bronze-ckpt"), fmt="parquet",
                          source_path=source, trigger="availableNow", landing_col="landed_at"):
        q.awaitTermination()
    raw = F.when(F.col("reason") == "no_facility", F.get_json_object("raw_value", "$.sensor_id")).otherwise(F.col("raw_value"))
    bad = spark.read.parquet(quarantine_of(bronze)).select("source_topic", raw.alias("raw_value"), "reason")
    landed = (spark.read.parquet(bronze).groupBy("source_topic").agg(F.count(F.lit(1)).alias("n"))
              .select("source_topic", F.concat(F.lit("landed "), F.col("n").cast("string")).alias("raw_value"), F.lit("none").alias("reason")))
    return bad.unionByName(landed)


def q_live_stream(spark, sf_dir):
    """The live path end to end: messages of several broker partitions -> per-batch latest -> keyed merge."""
    source = _land_envelopes(spark, sf_dir)
    live = scratch_path(spark, "live")
    q = start_live(spark, live, scratch_path(spark, "live-ckpt"), fmt="parquet", source_path=source,
                   trigger="availableNow", options={"maxFilesPerTrigger": "4"})
    q.awaitTermination()
    return spark.read.parquet(live).select("facility_id", "sensor_id", "sensor_type", "value", "unit",
                                           "is_anomaly", "recorded_at")


def q_silver_typed(spark, sf_dir):
    return type_readings(_decoded(spark, sf_dir))


def q_silver_readings(spark, sf_dir):
    """Typed readings classified as the Silver run does.

    Classification reads its input twice (statistics, then rows), so the
    decoded readings are written once to the shared checkpoint folder and
    read back -- as in the pipeline, where Bronze is a written table -- and
    the JSON is parsed once instead of twice.
    """
    path = scratch_path(spark, "typed")
    type_readings(_decoded(spark, sf_dir)).write.parquet(path)
    return classify_anomalies(spark.read.parquet(path))


def q_topic_route(spark, sf_dir):
    msgs = message_struct(spread_input(_readings(spark, sf_dir))).withColumn(
        "sensor_type", F.regexp_replace("source_topic", r"^sensors\.", ""))
    routed = route_topics(msgs)
    back = routed.select("topic", F.get_json_object("value", "$.sensor_id").alias("sensor_id"))
    return back.groupBy("topic").agg(F.count(F.lit(1)).alias("n_messages"),
                                     F.count_distinct("sensor_id").alias("n_sensors"))


def q_topic_sink(spark, sf_dir):
    """Messages written to their topics and read back: key and the fields of the JSON text."""
    path = scratch_path(spark, "topics")
    msgs = message_struct(spread_input(_readings(spark, sf_dir))).withColumn(
        "sensor_type", F.regexp_replace("source_topic", r"^sensors\.", ""))
    write_topics(route_topics(msgs), fmt="parquet", path=path)
    back = spark.read.parquet(path)
    d = F.from_json("value", MESSAGE_SCHEMA)
    return back.select(F.col("topic"), "key", *[d[c].alias(c) for c in MESSAGE_SCHEMA.names],
                       F.array_join(F.json_object_keys("value"), ",").alias("json_fields"))


def q_payload_flatten(spark, sf_dir):
    docs = payloads_from_readings(spread_input(_readings(spark, sf_dir)))
    return flatten_payload(parse_payloads(docs, keep=["landed_at"]), ingested_at=iso_string("landed_at"))


def _landed(spark, sf_dir):
    return (_readings(spark, sf_dir)
            .withColumn("date", F.to_date("landed_at"))
            .withColumn("hour", F.hour("landed_at")))


def q_run_window_select(spark, sf_dir):
    sel = select_run(_landed(spark, sf_dir), RUN_START, RUN_END)
    return sel.select("event_id", "facility_id", "sensor_id", "value", "event_ts", "landed_at", "date", "hour")


def q_facility_union(spark, sf_dir):
    return facility_union(_readings(spark, sf_dir))


def _peer_input(spark, sf_dir):
    return _readings(spark, sf_dir).withColumn(
        "poll_ts", F.date_trunc(POLL_UNIT, "event_ts").cast("timestamp_ntz"))


PEER_KEYS = ("facility_id", "sensor_type", "poll_ts")


def q_peer_outliers(spark, sf_dir):
    return peer_outliers(_peer_input(spark, sf_dir), PEER_KEYS).select(
        "event_id", "is_peer_outlier", "peer_deviation")


def q_facility_aggregate(spark, sf_dir):
    flagged = peer_outliers(_peer_input(spark, sf_dir), PEER_KEYS)
    return facility_aggregate(flagged, PEER_KEYS)


def _live(spark, sf_dir):
    return live_latest(_readings(spark, sf_dir))


def q_live_latest(spark, sf_dir):
    return _live(spark, sf_dir)


def q_upsert_live(spark, sf_dir):
    r = _readings(spark, sf_dir)
    first = live_latest(r.where(F.col("event_ts") >= ntz_literal(FIRST_BATCH_FROM)))
    second = live_rows(r.where(F.col("event_ts") < ntz_literal(SECOND_BATCH_TO)))
    second = second.select(*LIVE_KEYS, "sensor_type", *LIVE_UPDATE_COLS, "arrival")
    return merge_upsert(first, second, LIVE_KEYS, LIVE_UPDATE_COLS, order_by="arrival")


GOLD_VALUE_COLS = [c for c in SERVING_COLUMNS if c not in ("facility_id", "window_start", "crop_type",
                                                           "growth_week")]


def _lake(spark, readings: DataFrame) -> tuple[str, object, object]:
    """Bronze and Silver of all readings as written tables: (folder, first landed hour, end)."""
    from datetime import timedelta

    lake = scratch_path(spark, "lake")
    good, _ = decode_messages(envelopes_from_readings(spread_input(readings)), landing_col="landed_at")
    write_partitions(good, f"{lake}/bronze", BRONZE_PARTITIONS)
    span = (spark.read.parquet(f"{lake}/bronze")
            .agg(F.min(F.date_trunc("hour", "bronze_landed_at")).alias("lo"), F.max("bronze_landed_at").alias("hi"))
            .first())
    start, end = span["lo"], span["hi"] + timedelta(hours=1)
    run_silver(spark, f"{lake}/bronze", f"{lake}/silver", start, end)
    return lake, start, end


def _gold(spark, lake: str, start, end) -> None:
    run_gold(spark, f"{lake}/silver", f"{lake}/gold", f"{lake}/vpd", f"{lake}/serving", start, end)


def q_serving_climate(spark, sf_dir):
    """The job chain end to end on written tables: Bronze -> Silver run ->
    Gold run (VPD, facts and serving replaced); returns the serving table.

    One Silver run and one Gold run cover every landed hour and every event
    window: the span is taken from the data (one tiny min/max job).
    """
    lake, start, end = _lake(spark, _readings(spark, sf_dir))
    _gold(spark, lake, start, end)
    return spark.read.parquet(f"{lake}/serving").select(*SERVING_COLUMNS)


def odd_readings(spark, sf_dir) -> DataFrame:
    """The readings with repeated messages, NULL growth weeks and readings that land 3 hours late."""
    r = _readings(spark, sf_dir)
    n = F.col("event_id")
    late = F.make_dt_interval(F.lit(0), F.when(n % 23 == 3, 3).otherwise(0), F.lit(0), F.lit(0))
    copies = F.when(n % 29 == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (r.withColumn("growth_week", F.when(n % 19 != 5, F.col("growth_week")))
             .withColumn("landed_at", F.col("landed_at") + late)
             .withColumn("copy", F.explode(copies)).drop("copy"))


def _odd_lake(spark, sf_dir) -> str:
    """Two Gold runs over odd readings: the first half, then all but the first quarter.

    Silver is built from the decoded messages; their Bronze table is
    ``bronze_landing``'s and ``serving_climate``'s part.
    """
    from datetime import timedelta

    readings = odd_readings(spark, sf_dir)
    span = readings.agg(F.min(F.date_trunc("hour", "landed_at")).alias("lo"), F.max("landed_at").alias("hi")).first()
    start, end = span["lo"], span["hi"] + timedelta(hours=1)
    lake = scratch_path(spark, "lake")
    good, _ = decode_messages(envelopes_from_readings(spread_input(readings)), landing_col="landed_at")
    write_silver(spark, silver_frame(good, start, end), f"{lake}/silver", start, end)
    step = (end - start) / 4
    for lo, hi in ((start, start + 2 * step), (start + step, end)):
        _gold(spark, lake, lo, hi)
    return lake


def q_vpd_table(spark, sf_dir):
    """The written VPD table after several runs over repeated, late and mistyped messages."""
    return read_table(spark, f"{_odd_lake(spark, sf_dir)}/vpd", VPD_SCHEMA).drop("date", "hour")


def q_gold_facts(spark, sf_dir):
    """The written fact table after several runs over repeated, late and mistyped messages."""
    return spark.read.parquet(f"{_odd_lake(spark, sf_dir)}/gold").select(*GOLD_COLUMNS)


def q_upsert_gold(spark, sf_dir):
    r = _readings(spark, sf_dir)
    run1 = build_gold(classify_anomalies(r.where(F.col("event_ts") < ntz_literal(GOLD_RUN1_TO))))
    run2 = build_gold(classify_anomalies(r.where(F.col("event_ts") >= ntz_literal(GOLD_RUN2_FROM))))
    return merge_upsert(run1.select(*SERVING_COLUMNS), run2.select(*SERVING_COLUMNS), GOLD_KEYS,
                        GOLD_VALUE_COLS)


def q_live_gauges(spark, sf_dir):
    return live_gauges(_live(spark, sf_dir))


def trend_readings(classified: DataFrame, as_of: str, hours: int = 24, minutes: int = 30,
                   band_seconds: int = 60) -> DataFrame:
    """Readings that can reach the trend windows (start in (as_of - hours, as_of]).

    Their events lie in (as_of - hours, as_of + minutes); humidity partners
    of the VPD band up to ``band_seconds`` beyond.  A plain event-time range
    reaches the scan as a pushed filter (row groups are skipped), while the
    exact window filter of ``climate_trends`` still decides the output.
    Statistics stay whole-input: they are computed before this filter.
    """
    from datetime import datetime, timedelta
    end = datetime.fromisoformat(as_of)
    lo = end - timedelta(hours=hours) - timedelta(seconds=band_seconds)
    hi = end + timedelta(minutes=minutes) + timedelta(seconds=band_seconds)
    return classified.where((F.col("event_ts") >= ntz_literal(lo)) & (F.col("event_ts") < ntz_literal(hi)))


def q_climate_trends(spark, sf_dir):
    return climate_trends(build_gold(trend_readings(_classified(spark, sf_dir), TREND_AS_OF)), TREND_AS_OF)


def q_current_anomalies(spark, sf_dir):
    return current_anomalies(_live(spark, sf_dir), TOP_N_ANOMALIES)


def q_threshold_band(spark, sf_dir):
    return threshold_band(live_gauges(_live(spark, sf_dir)))


def q_score_band(spark, sf_dir):
    """The score panel's band of each fact."""
    return climate_score(_wide(spark, sf_dir)).select("facility_id", "window_start", "climate_score",
                                                      band_label("climate_score", SCORE_BANDS).alias("band"))


def q_panel_gauges(spark, sf_dir):
    """The gauge panels' SQL over the live view, one statement a type; the facilities are those of the view."""
    register_serving_views(live=_live(spark, sf_dir))
    return union_facilities([panel(spark, "gauges", sensor_type=t, scale=s) for t, s in GAUGE_SCALES.items()])


def q_panel_trends(spark, sf_dir):
    """The four trend panels' SQL over the written serving table, one statement a panel.

    The panels' trailing hours name the table's date partitions, so their scan
    opens two of them however long the table's history is.
    """
    path = scratch_path(spark, "serving")
    facts = build_gold(_classified(spark, sf_dir)).select(*SERVING_COLUMNS).withColumn("date", F.to_date("window_start"))
    write_partitions(facts, path, ("facility_id", "date"))
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in facts.schema.fields]])
    register_serving_views(facts=read_table(spark, path, schema))
    return union_facilities([panel(spark, "trend", column=m, as_of=TREND_AS_OF, hours=TREND_HOURS)
                             .select(F.lit(m).alias("panel"), "time", "metric", "value") for m in TREND_METRICS])


def q_panel_anomalies(spark, sf_dir):
    """The current-anomalies panel's SQL over the live view."""
    register_serving_views(live=_live(spark, sf_dir))
    return panel(spark, "current_anomalies", n=TOP_N_ANOMALIES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sensor_stats": q_sensor_stats,
    "anomaly_classify": q_anomaly_classify,
    "anomaly_classify_loo": q_anomaly_classify_loo,
    "zone_spread": q_zone_spread,
    "climate_30min": q_climate_30min,
    "anomaly_rate": q_anomaly_rate,
    "climate_pivot": q_climate_pivot,
    "vpd_pairs": q_vpd_pairs,
    "vpd_30min": q_vpd_30min,
    "climate_score": q_climate_score,
    "crop_score": q_crop_score,
    "gold_climate": q_gold_climate,
    "json_decode": q_json_decode,
    "bronze_landing": q_bronze_landing,
    "live_stream": q_live_stream,
    "silver_typed": q_silver_typed,
    "silver_readings": q_silver_readings,
    "topic_route": q_topic_route,
    "payload_flatten": q_payload_flatten,
    "run_window_select": q_run_window_select,
    "facility_union": q_facility_union,
    "peer_outliers": q_peer_outliers,
    "facility_aggregate": q_facility_aggregate,
    "live_latest": q_live_latest,
    "upsert_live": q_upsert_live,
    "upsert_gold": q_upsert_gold,
    "serving_climate": q_serving_climate,
    "live_gauges": q_live_gauges,
    "climate_trends": q_climate_trends,
    "current_anomalies": q_current_anomalies,
    "threshold_band": q_threshold_band,
    "quarantine": q_quarantine,
    "topic_sink": q_topic_sink,
    "vpd_table": q_vpd_table,
    "gold_facts": q_gold_facts,
    "score_band": q_score_band,
    "panel_gauges": q_panel_gauges,
    "panel_anomalies": q_panel_anomalies,
    "panel_trends": q_panel_trends,
}

__all__ = ["QUERIES"]
