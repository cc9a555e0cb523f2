"""Per-panel Spark SQL equals the grouped DataFrame operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_MID, rows
from verdant.operators.climate import build_gold
from verdant.operators.quality import classify_anomalies
from verdant.operators.serving import climate_trends, current_anomalies, live_gauges, live_latest
from verdant.plans.panels import panel, register_serving_views
from verdant.sources.fixture import load_readings

AS_OF = "2024-01-21 00:00:00"


def test_panels_match_operators(spark):
    r = load_readings(spark, SF_MID)
    live = live_latest(r)
    gold = build_gold(classify_anomalies(r))
    register_serving_views(live, gold)
    gauges = {(x["facility_id"], x["sensor_type"]): x["gauge_value"] for x in live_gauges(live).collect()}
    for (fac, t), want in gauges.items():
        got = panel(spark, "gauge", facility=fac, sensor_type=t, scale=3 if t == "airflow" else 2).first()[0]
        assert got == want
    trends = climate_trends(gold, AS_OF)
    for metric in ("avg_vpd", "climate_score", "overall_anomaly_rate", "variance_temperature"):
        got = panel(spark, "trend", column=metric, as_of=AS_OF, hours=24)
        want = trends.where(F.col("panel") == metric).drop("panel")
        assert rows(got) == rows(want)
    assert rows(panel(spark, "current_anomalies", n=20)) == rows(current_anomalies(live, 20))
