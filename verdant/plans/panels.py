"""Dashboard panels as parameterised Spark SQL over the serving views.

``register_serving_views`` exposes the live table and the fact table under
the names the panels query; ``panel`` runs one panel with named parameter
markers (no string splicing of values).  The grouped DataFrame operators in
``verdant.operators.serving`` compute all gauges or all trend series in one
scan; these per-panel statements serve callers that want one number.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIVE_VIEW = "live_readings"
FACT_VIEW = "fct_30min_climate"

# Mean of the view's values, exact and rounded half up; NaN and NULL are no values.
_GAUGE_MEAN = """
               CASE WHEN COUNT(TRY_CAST(value AS DECIMAL(38, 18))) = COUNT(NULLIF(value, DOUBLE('NaN')))
                     AND TRY_SUM(TRY_CAST(value AS DECIMAL(38, 18))) IS NOT NULL
               THEN CAST(ROUND(TRY_SUM(TRY_CAST(value AS DECIMAL(38, 18))) / COUNT(TRY_CAST(value AS DECIMAL(38, 18))), :scale) AS DOUBLE)
               ELSE ROUND(AVG(NULLIF(value, DOUBLE('NaN'))), :scale) END AS gauge_value"""

PANEL_SQL = {
    # One gauge: mean of a facility's non-anomalous live values of one type.
    "gauge": f"""
        SELECT {_GAUGE_MEAN}
        FROM {LIVE_VIEW}
        WHERE facility_id = :facility AND sensor_type = :sensor_type AND is_anomaly = false""",
    # The gauges of one type, of every facility in the view.
    "gauges": f"""
        SELECT facility_id, sensor_type, {_GAUGE_MEAN}
        FROM {LIVE_VIEW}
        WHERE sensor_type = :sensor_type AND is_anomaly = false
        GROUP BY facility_id, sensor_type""",
    # One trend panel: a fact column over the trailing hours before :as_of.
    "trend": f"""
        SELECT window_start AS time, facility_id AS metric, CAST(IDENTIFIER(:column) AS DOUBLE) AS value
        FROM {FACT_VIEW}
        WHERE window_start > :as_of - make_dt_interval(0, :hours, 0, 0) AND window_start <= :as_of
          AND date >= CAST(:as_of - make_dt_interval(0, :hours, 0, 0) AS DATE) AND date <= CAST(:as_of AS DATE)
        ORDER BY window_start""",
    # The most recent anomalous live readings.
    "current_anomalies": f"""
        SELECT facility_id, sensor_id, sensor_type, value, recorded_at
        FROM {LIVE_VIEW}
        WHERE is_anomaly = true
        ORDER BY recorded_at DESC NULLS FIRST, facility_id, sensor_id
        LIMIT :n""",
}


def register_serving_views(live: DataFrame | None = None, facts: DataFrame | None = None) -> None:
    if live is not None:
        live.createOrReplaceTempView(LIVE_VIEW)
    if facts is not None:       # a written table has its windows' dates as partitions, which the trend panels prune
        dated = facts if "date" in facts.columns else facts.withColumn("date", F.to_date("window_start"))
        dated.createOrReplaceTempView(FACT_VIEW)


def panel(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one panel; ``as_of`` may be a datetime or ISO text."""
    args = dict(params)
    if isinstance(args.get("as_of"), str):
        args["as_of"] = datetime.fromisoformat(args["as_of"])
    if "as_of" in args:
        args["as_of"] = args["as_of"].isoformat(sep=" ")
        text = PANEL_SQL[name].replace(":as_of", "CAST(:as_of AS TIMESTAMP_NTZ)")
    else:
        text = PANEL_SQL[name]
    return spark.sql(text, args=args)
