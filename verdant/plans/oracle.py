"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written from the operator definitions, not generated from the
Spark plans, and states its own literals: nothing of the engine is imported.
Views ``events`` etc. are registered by the caller.
"""

from __future__ import annotations

# Fixed values.
SENSOR_TYPES = ("temperature", "humidity", "co2", "light", "airflow")
SENSOR_UNITS = {"temperature": "celsius", "humidity": "percent", "co2": "ppm", "light": "umol_m2_s", "airflow": "m_per_s"}
RANGE_LIMITS = {"temperature": (5, 50), "humidity": (0, 100), "co2": (200, 5000), "light": (0, 2000), "airflow": (0, 5)}
SCORE_RANGES = {"temperature": (20, 26), "humidity": (65, 75), "co2": (800, 1100), "light": (200, 600)}
CROP_PROFILES = {
    "tomato": {"temperature": (20, 26), "humidity": (65, 75), "co2": (800, 1100), "light": (200, 600)},
    "cucumber": {"temperature": (22, 28), "humidity": (70, 80), "co2": (700, 1000), "light": (150, 500)},
}
GAUGE_SCALES = {"temperature": 2, "humidity": 2, "co2": 2, "light": 2, "airflow": 3}
GAUGE_BANDS = {
    ("facility_A", "temperature"): [(None, "blue"), (20, "green"), (30, "red")],
    ("facility_B", "temperature"): [(None, "blue"), (22, "green"), (30, "red")],
    ("facility_A", "humidity"): [(None, "red"), (65, "green"), (80, "red")],
    ("facility_B", "humidity"): [(None, "red"), (65, "green"), (80, "red")],
    ("facility_A", "co2"): [(None, "red"), (800, "green"), (1200, "red")],
    ("facility_B", "co2"): [(None, "red"), (800, "green"), (1200, "red")],
    ("facility_A", "light"): [(None, "red"), (200, "green"), (600, "yellow")],
    ("facility_B", "light"): [(None, "red"), (150, "green"), (500, "yellow")],
    ("facility_A", "airflow"): [(None, "red"), (0.2, "green"), (0.9, "red")],
    ("facility_B", "airflow"): [(None, "red"), (0.2, "green"), (0.9, "red")],
}
EVENT_SENSOR_TYPES = {"view": "temperature", "click": "humidity", "purchase": "co2", "signup": "light", "error": "airflow"}


class Q:
    """The queries' parameters."""

    RUN_START, RUN_END = "2024-01-09 22:30:00", "2024-01-10 01:30:00"
    TREND_AS_OF = "2024-01-21 00:00:00"
    FIRST_BATCH_FROM, SECOND_BATCH_TO = "2024-01-15 00:00:00", "2024-01-21 00:00:00"
    GOLD_RUN1_TO, GOLD_RUN2_FROM = "2024-01-21 00:00:00", "2024-01-15 00:00:00"
    TOP_N_ANOMALIES = 20


SCORED = ("temperature", "humidity", "co2", "light")
RATED = ("temperature", "humidity", "co2")


def _dbl(x) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def rnd(x: str, d: int) -> str:
    """round(double, d): half-up on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,17)), {d}) AS DOUBLE)"


def mean_dec(terms: list[str]) -> str:
    """round(mean of 2-dp scores, 2) in exact decimal arithmetic."""
    total = " + ".join(f"CAST(({t}) AS DECIMAL(12,2))" for t in terms)
    return f"CAST(round(CAST({total} AS DECIMAL(18,2)) * CAST({1 / len(terms)!r} AS DECIMAL(10,6)), 2) AS DOUBLE)"


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def readings_sql(where: str = "") -> str:
    types = " ".join(f"WHEN '{e}' THEN '{s}'" for e, s in EVENT_SENSOR_TYPES.items())
    return f"""(
  SELECT event_id, 'facility_' || fac AS facility_id,
    CASE fac WHEN 'A' THEN 'tomato' ELSE 'cucumber' END AS crop_type,
    CASE fac WHEN 'A' THEN 6 ELSE 4 END AS growth_week,
    sensor_type, 'sensors.' || sensor_type AS source_topic,
    sensor_type || '_' || fac || '_zone' || CAST(user_id % 3 + 1 AS VARCHAR) AS sensor_id,
    sensor_type || '_u' || CAST(user_id AS VARCHAR) AS device_id,
    CASE WHEN event_id % 50 = 0 THEN NULL
         WHEN event_id % 97 = 0 THEN CAST(-1.0 AS DOUBLE)
         WHEN sensor_type = 'temperature' THEN 13 + value / 7
         WHEN sensor_type = 'humidity' THEN 58 + value / 7
         WHEN sensor_type = 'co2' THEN 500 + value * 71 / 7
         WHEN sensor_type = 'light' THEN 100 + value * 43 / 7
         ELSE value / 91 END AS value,
    ts AS event_ts,
    ts + to_seconds(event_id % 120) AS landed_at
  FROM (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS fac,
               CASE event_type {types} END AS sensor_type
        FROM events) b
  {where}
)"""


def _range_case(v: str = "value", t: str = "sensor_type") -> str:
    parts = [f"({t} = '{name}' AND ({v} < {_dbl(lo)} OR {v} > {_dbl(hi)}))" for name, (lo, hi) in RANGE_LIMITS.items()]
    return " OR ".join(parts)


def classified_sql(src: str, keys: str = "facility_id, sensor_id") -> str:
    """Anomaly classes with whole-input window statistics per sensor."""
    return f"""(
  SELECT * EXCLUDE (s_mean, s_sd),
    CASE WHEN value IS NULL OR isnan(value) THEN 'dropout'
         WHEN s_sd IS NOT NULL AND abs(value - s_mean) > 3 * s_sd THEN 'statistical'
         WHEN {_range_case()} THEN 'range' END AS anomaly_type,
    (CASE WHEN value IS NULL OR isnan(value) THEN 1
          WHEN s_sd IS NOT NULL AND abs(value - s_mean) > 3 * s_sd THEN 1
          WHEN {_range_case()} THEN 1 END) IS NOT NULL AS is_anomaly
  FROM (SELECT *,
          avg(CASE WHEN NOT isnan(value) THEN value END) OVER (PARTITION BY {keys}) AS s_mean,
          stddev_samp(CASE WHEN NOT isnan(value) THEN value END) OVER (PARTITION BY {keys}) AS s_sd
        FROM {src}) x
)"""


def classified_loo_sql(src: str, keys: str = "facility_id, sensor_id") -> str:
    """Classes with statistics of the other readings of the sensor (frame excludes the row)."""
    frame = (f"OVER (PARTITION BY {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING "
             f"EXCLUDE CURRENT ROW)")
    nn = "CASE WHEN NOT isnan(value) THEN value END"
    return f"""(
  SELECT event_id,
    CASE WHEN value IS NULL OR isnan(value) THEN 'dropout'
         WHEN s_sd IS NOT NULL AND abs(value - s_mean) > 3 * s_sd THEN 'statistical'
         WHEN {_range_case()} THEN 'range' END AS anomaly_type
  FROM (SELECT *, avg({nn}) {frame} AS s_mean, stddev_samp({nn}) {frame} AS s_sd FROM {src}) x
)"""


def long_sql(src: str, clean_only: bool = False) -> str:
    where = "WHERE event_ts IS NOT NULL" + (" AND NOT is_anomaly" if clean_only else "")
    cv = "CASE WHEN NOT is_anomaly THEN value END"
    return f"""(
  SELECT facility_id, crop_type, growth_week,
    time_bucket(INTERVAL '30 minutes', event_ts) AS window_start, sensor_type,
    {exact_mean(cv, 3)} AS avg_value,
    {rnd(f"stddev_samp({cv})", 3)} AS zone_variance,
    count({cv}) AS reading_count,
    count(*) AS n_all,
    count(*) FILTER (WHERE is_anomaly) AS n_anomalous,
    {rnd("CAST(count(*) FILTER (WHERE is_anomaly) AS DOUBLE) / count(*)", 4)} AS anomaly_rate
  FROM {src} {where}
  GROUP BY facility_id, crop_type, growth_week, window_start, sensor_type
)"""


def wide_sql(long_src: str) -> str:
    cols = []
    for stat in ("avg", "variance", "anomaly_rate", "reading_count"):
        src_col = {"avg": "avg_value", "variance": "zone_variance", "anomaly_rate": "anomaly_rate",
                   "reading_count": "reading_count"}[stat]
        for t in SENSOR_TYPES:
            cols.append(f"max(CASE WHEN sensor_type = '{t}' THEN {src_col} END) AS {stat}_{t}")
    return f"""(
  SELECT facility_id, crop_type, growth_week, window_start,
    {", ".join(cols)}
  FROM {long_src} l GROUP BY facility_id, crop_type, growth_week, window_start
)"""


def pairs_sql(classified: str) -> str:
    return f"""(
  SELECT t.facility_id, t.temperature_event_id, h.humidity_event_id, t.event_ts,
    t.temperature, h.humidity,
    {rnd("(1 - h.humidity / 100) * 0.6108 * exp(17.27 * t.temperature / (t.temperature + 237.3))", 4)} AS vpd_kpa
  FROM (SELECT facility_id, event_id AS temperature_event_id, event_ts, value AS temperature
        FROM {classified} c WHERE NOT is_anomaly AND sensor_type = 'temperature') t
  JOIN (SELECT facility_id, event_id AS humidity_event_id, event_ts AS humidity_ts, value AS humidity
        FROM {classified} c WHERE NOT is_anomaly AND sensor_type = 'humidity') h
    ON t.facility_id = h.facility_id
   AND abs(epoch(date_trunc('second', t.event_ts)) - epoch(date_trunc('second', h.humidity_ts))) <= 60
)"""


def vpd_window_sql(pairs: str) -> str:
    return f"""(
  SELECT facility_id, time_bucket(INTERVAL '30 minutes', event_ts) AS window_start, {exact_mean("vpd_kpa", 4)} AS avg_vpd
  FROM {pairs} p GROUP BY facility_id, window_start
)"""


def _score(v: str, lo, hi) -> str:
    lo, hi, w = _dbl(lo), _dbl(hi), _dbl(float(hi) - float(lo))
    below = rnd(f"CAST(100.0 AS DOUBLE) - ({lo} - {v}) / {w} * 100", 2)
    above = rnd(f"CAST(100.0 AS DOUBLE) - ({v} - {hi}) / {w} * 100", 2)
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} >= {lo} AND {v} <= {hi} THEN CAST(100.0 AS DOUBLE) "
            f"WHEN {v} < {lo} THEN {below} ELSE {above} END")


def scores_sql(src: str) -> str:
    scores = [f"{_score('avg_' + t, *SCORE_RANGES[t])} AS score_{t}" for t in SCORED]
    climate = mean_dec([_score('avg_' + t, *SCORE_RANGES[t]) for t in SCORED])
    rate = " + ".join(f"anomaly_rate_{t}" for t in RATED)
    return f"""(
  SELECT *, {", ".join(scores)},
    {climate} AS climate_score,
    {rnd(f"({rate}) / 3 * 100", 4)} AS overall_anomaly_rate
  FROM {src} s
)"""


def gold_sql(classified: str) -> str:
    wide = wide_sql(long_sql(classified))
    vw = vpd_window_sql(pairs_sql(classified))
    joined = f"(SELECT w.*, v.avg_vpd FROM {wide} w LEFT JOIN {vw} v USING (facility_id, window_start))"
    return scores_sql(joined)


GOLD_COLS = (["facility_id", "crop_type", "growth_week", "window_start"]
             + [f"avg_{t}" for t in SENSOR_TYPES] + [f"variance_{t}" for t in SENSOR_TYPES]
             + [f"anomaly_rate_{t}" for t in SENSOR_TYPES] + [f"reading_count_{t}" for t in SENSOR_TYPES]
             + ["avg_vpd"] + [f"score_{t}" for t in SCORED] + ["climate_score", "overall_anomaly_rate"])
SERVING = ["facility_id", "crop_type", "growth_week", "window_start", "avg_temperature", "avg_humidity",
           "avg_co2", "avg_light", "avg_airflow", "avg_vpd", "climate_score", "variance_temperature",
           "overall_anomaly_rate"]


def unit_case(t: str = "sensor_type") -> str:
    return "CASE " + t + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SENSOR_UNITS.items()) + " END"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"


def live_rows_sql(src: str) -> str:
    return f"""(
  SELECT facility_id, device_id AS sensor_id, sensor_type, value, {unit_case()} AS unit,
    value IS NULL AS is_anomaly, event_ts AS recorded_at, event_id AS arrival, landed_at
  FROM {src} r
)"""


def latest_sql(rows: str, order: str = "arrival DESC") -> str:
    return f"""(
  SELECT facility_id, sensor_id, sensor_type, value, unit, is_anomaly, recorded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY facility_id, sensor_id ORDER BY {order}) AS rn
        FROM {rows} x) y WHERE rn = 1
)"""


def merge_sql(old: str, new: str, keys: list[str], cols: list[str], update: list[str]) -> str:
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in keys:
            sel.append(f"coalesce(o.{c}, n.{c}) AS {c}")
        elif c in update:
            sel.append(f"CASE WHEN n.__hit THEN n.{c} ELSE o.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN o.__hit THEN o.{c} ELSE n.{c} END AS {c}")
    return f"""(
  SELECT {", ".join(sel)}
  FROM (SELECT *, true AS __hit FROM {old} a) o FULL JOIN (SELECT *, true AS __hit FROM {new} b) n ON {on}
)"""


def exact_mean(v: str, scale: int) -> str:
    """round(mean(v), scale) half away from zero: the values' decimal forms summed in units of 1e-18."""
    d = f"CAST(CAST({v} AS VARCHAR) AS DECIMAL(38,18))"
    unit = 10 ** 18
    k = (f"(sum(CAST(trunc({d}) AS HUGEINT)) * {unit} "
         f"+ sum(CAST(CAST({d} - trunc({d}) AS DECIMAL(18,18)) * CAST({unit} AS DECIMAL(19,0)) AS HUGEINT)))")
    n = f"CAST(count({v}) AS HUGEINT)"
    f = 10 ** scale
    return (f"CASE WHEN count({v}) > 0 THEN CAST(sign({k}) * ((2 * abs({k}) * {f} + {n} * {unit}) // (2 * {n} * {unit})) AS DOUBLE) "
            f"/ {float(f)!r} END")


def gauges_sql(live: str) -> str:
    case = "NULL"
    for t, scale in GAUGE_SCALES.items():
        case = f"CASE WHEN sensor_type = '{t}' THEN {exact_mean('value', scale)} ELSE {case} END"
    return f"""(
  SELECT facility_id, sensor_type, {case} AS gauge_value
  FROM {live} l WHERE is_anomaly = false GROUP BY facility_id, sensor_type
)"""


def band_case(v: str) -> str:
    out = "NULL"
    for (fac, t), steps in GAUGE_BANDS.items():
        label = f"'{steps[0][1]}'"
        for bound, name in steps[1:]:
            label = f"CASE WHEN {v} >= {_dbl(bound)} THEN '{name}' ELSE {label} END"
        label = f"CASE WHEN {v} IS NULL THEN NULL ELSE {label} END"
        out = f"CASE WHEN facility_id = '{fac}' AND sensor_type = '{t}' THEN {label} ELSE {out} END"
    return out


def crop_sql(wide: str) -> str:
    rows = ", ".join("('" + crop + "', " + ", ".join(f"{_dbl(p[t][i])}" for t in SCORED for i in (0, 1)) + ")"
                     for crop, p in CROP_PROFILES.items())
    names = ", ".join(f"low_{t}, high_{t}" for t in SCORED)
    scores = []
    for t in SCORED:
        v, lo, hi = f"avg_{t}", f"low_{t}", f"high_{t}"
        scores.append(
            f"CASE WHEN {v} IS NULL OR {lo} IS NULL THEN NULL WHEN {v} >= {lo} AND {v} <= {hi} THEN CAST(100.0 AS DOUBLE) "
            f"WHEN {v} < {lo} THEN {rnd(f'CAST(100.0 AS DOUBLE) - ({lo} - {v}) / ({hi} - {lo}) * 100', 2)} "
            f"ELSE {rnd(f'CAST(100.0 AS DOUBLE) - ({v} - {hi}) / ({hi} - {lo}) * 100', 2)} END")
    sel = ", ".join(f"{s} AS crop_score_{t}" for s, t in zip(scores, SCORED))
    return f"""(
  SELECT facility_id, window_start, w.crop_type, {sel}, {mean_dec(scores)} AS crop_climate_score
  FROM {wide} w LEFT JOIN (VALUES {rows}) AS p(crop_type, {names}) ON w.crop_type = p.crop_type
)"""


#: Sensor statistics of the jobs: per landing hour.
RUN_KEYS = "facility_id, sensor_id, date_trunc('hour', landed_at)"


def odd_readings_sql(src: str) -> str:
    """Repeated messages, NULL growth weeks, readings that land 3 hours late."""
    return f"""(
  SELECT * EXCLUDE (growth_week, landed_at), CASE WHEN event_id % 19 <> 5 THEN growth_week END AS growth_week,
    CASE WHEN event_id % 23 = 3 THEN landed_at + INTERVAL '3 hours' ELSE landed_at END AS landed_at
  FROM (SELECT * FROM {src} a UNION ALL SELECT * FROM {src} b WHERE event_id % 29 = 4) o
)"""


def table_pairs_sql(classified: str) -> str:
    """Rows of the VPD table: pairs named by their sensors."""
    side = lambda t: f"(SELECT facility_id, sensor_id, event_ts, value FROM {classified} c WHERE NOT is_anomaly AND sensor_type = '{t}')"
    return f"""(
  SELECT t.facility_id, t.sensor_id AS temperature_sensor_id, h.sensor_id AS humidity_sensor_id, t.event_ts,
    h.event_ts AS humidity_ts, t.value AS temperature, h.value AS humidity,
    {rnd("(1 - h.value / 100) * 0.6108 * exp(17.27 * t.value / (t.value + 237.3))", 4)} AS vpd_kpa
  FROM {side("temperature")} t JOIN {side("humidity")} h
    ON t.facility_id = h.facility_id
   AND abs(epoch(date_trunc('second', t.event_ts)) - epoch(date_trunc('second', h.event_ts))) <= 60
)"""


def payload_sql(src: str) -> str:
    """Readings of poll documents: one per facility and minute, flagged and aggregated by group."""
    poll = "facility_id, crop_type, growth_week, minute"
    flag = "coalesce(value IS NOT NULL AND pn >= 2 AND psd > 0 AND abs(value - pm) > 2 * psd, false)"
    over = f"OVER (PARTITION BY {poll}, sensor_type)"
    return f"""
  WITH m AS (SELECT *, date_trunc('minute', event_ts) AS minute FROM {src} r),
  p AS (SELECT *, count(value) {over} AS pn, avg(value) {over} AS pm, stddev_samp(value) {over} AS psd,
          max(landed_at) OVER (PARTITION BY {poll}) AS last_landed FROM m),
  f AS (SELECT *, {flag} AS out FROM p),
  g AS (SELECT {poll}, sensor_type, {exact_mean("CASE WHEN NOT out THEN value END", 2)} AS facility_aggregate,
          CAST(count(*) AS INTEGER) AS sensor_count,
          CAST(count(*) FILTER (WHERE value IS NOT NULL AND NOT out) AS INTEGER) AS healthy_sensor_count
        FROM f GROUP BY {poll}, sensor_type)
  SELECT f.sensor_id, f.value, {unit_case("f.sensor_type")} AS unit, {iso("f.event_ts")} AS timestamp, f.out AS is_peer_outlier,
    CASE WHEN f.out THEN {rnd("f.value - f.pm", 3)} END AS peer_deviation, f.facility_id, f.crop_type, f.growth_week,
    {iso("f.last_landed")} AS ingested_at, g.facility_aggregate, g.sensor_count, g.healthy_sensor_count, f.source_topic AS topic
  FROM f JOIN g USING ({poll}, sensor_type)"""


def json_fields_sql() -> str:
    """Fields of a message's JSON text: those that are not NULL, in order."""
    return "CASE WHEN value IS NULL THEN 'sensor_id,' ELSE 'sensor_id,value,' END || 'unit,timestamp,is_peer_outlier,facility_id,crop_type,growth_week,ingested_at'"


def quarantine_sql(src: str, msg_cols: str) -> str:
    """Messages that are cut short, empty or without facility; and the landed rest, counted by topic."""
    # The first 25 characters of a message's text: '{"sensor_id":"' and the start of the id.
    cut = "substr('{\"sensor_id\":\"' || sensor_id || '\",\"value\":', 1, 25)"
    return f"""
  WITH b AS (SELECT source_topic, event_id, sensor_id,
               CASE WHEN event_id % 31 = 3 THEN 'malformed' WHEN event_id % 37 = 4 THEN 'empty'
                    WHEN event_id % 41 = 5 THEN 'no_facility' END AS reason FROM {src} r)
  SELECT source_topic, reason, CASE reason WHEN 'malformed' THEN {cut} WHEN 'no_facility' THEN sensor_id END AS raw_value
  FROM b WHERE reason IS NOT NULL
  UNION ALL
  SELECT source_topic, 'none' AS reason, 'landed ' || CAST(count(*) AS VARCHAR) AS raw_value FROM b WHERE reason IS NULL GROUP BY source_topic"""


def _select(src: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(cols)} FROM {src} q"


def oracle_sql() -> dict[str, str]:
    R = readings_sql()
    C = classified_sql(R)
    odd = classified_sql(odd_readings_sql(R), RUN_KEYS)
    long_all = long_sql(C)
    wide = wide_sql(long_all)
    pairs = pairs_sql(C)
    gold = gold_sql(C)
    live = latest_sql(live_rows_sql(R))
    msg_cols = (f"sensor_id, value, {unit_case()} AS unit, {iso('event_ts')} AS timestamp, "
                "false AS is_peer_outlier, CAST(NULL AS DOUBLE) AS peer_deviation, facility_id, crop_type, "
                f"growth_week, {iso('landed_at')} AS ingested_at, CAST(NULL AS DOUBLE) AS facility_aggregate, "
                "CAST(NULL AS INTEGER) AS sensor_count, CAST(NULL AS INTEGER) AS healthy_sensor_count")
    landing = ("source_topic, landed_at AS bronze_landed_at, CAST(landed_at AS DATE) AS date, "
               "CAST(hour(landed_at) AS INTEGER) AS hour")
    typed_cols = (f"sensor_id, value, {unit_case()} AS unit, false AS is_peer_outlier, "
                  "CAST(NULL AS DOUBLE) AS peer_deviation, facility_id, crop_type, growth_week, "
                  "landed_at AS ingested_at, CAST(NULL AS DOUBLE) AS facility_aggregate, "
                  "CAST(NULL AS INTEGER) AS sensor_count, CAST(NULL AS INTEGER) AS healthy_sensor_count, "
                  f"{landing}, event_ts, sensor_type")
    typed = f"(SELECT {typed_cols} FROM {R} r)"
    peer_in = f"(SELECT *, date_trunc('day', event_ts) AS poll_ts FROM {R} r)"
    peer_stats = (f"(SELECT facility_id, sensor_type, poll_ts, count(value) AS pn, avg(value) AS pm, "
                  f"stddev_samp(value) AS psd FROM {peer_in} p GROUP BY facility_id, sensor_type, poll_ts)")
    flag = "coalesce(value IS NOT NULL AND pn >= 2 AND psd > 0 AND abs(value - pm) > 2 * psd, false)"
    peer = (f"(SELECT p.*, {flag} AS is_peer_outlier, CASE WHEN {flag} THEN {rnd("value - pm", 3)} END "
            f"AS peer_deviation FROM {peer_in} p LEFT JOIN {peer_stats} s "
            f"USING (facility_id, sensor_type, poll_ts))")
    gold_run = lambda where: gold_sql(classified_sql(readings_sql(where)))
    gold1 = f"(SELECT {', '.join(SERVING)} FROM {gold_run('WHERE ts < ' + _ts(Q.GOLD_RUN1_TO))} g)"
    gold2 = f"(SELECT {', '.join(SERVING)} FROM {gold_run('WHERE ts >= ' + _ts(Q.GOLD_RUN2_FROM))} g)"
    live1 = latest_sql(live_rows_sql(readings_sql("WHERE ts >= " + _ts(Q.FIRST_BATCH_FROM))))
    live2 = latest_sql(live_rows_sql(readings_sql("WHERE ts < " + _ts(Q.SECOND_BATCH_TO))))
    live_cols = ["facility_id", "sensor_id", "sensor_type", "value", "unit", "is_anomaly", "recorded_at"]
    trend_lo = f"{_ts(Q.TREND_AS_OF)} - INTERVAL '24 hours'"
    trends = " UNION ALL ".join(
        f"SELECT '{m}' AS panel, window_start AS time, facility_id AS metric, CAST({m} AS DOUBLE) AS value "
        f"FROM {gold} g WHERE window_start > {trend_lo} AND window_start <= {_ts(Q.TREND_AS_OF)}"
        for m in ("avg_vpd", "climate_score", "overall_anomaly_rate", "variance_temperature"))
    run_lo, run_hi = _ts(Q.RUN_START), _ts(Q.RUN_END)
    return {
        "sensor_stats": (f"SELECT facility_id, sensor_id, count(value) AS n, {rnd("avg(value)", 6)} AS mean, "
                         f"{rnd("stddev_samp(value)", 6)} AS stddev FROM {R} r GROUP BY facility_id, sensor_id"),
        "anomaly_classify": f"SELECT event_id, anomaly_type, is_anomaly FROM {C} c",
        "anomaly_classify_loo": (f"SELECT event_id, anomaly_type, anomaly_type IS NOT NULL AS is_anomaly "
                                 f"FROM {classified_loo_sql(R)} c"),
        "zone_spread": (
            f"SELECT facility_id, crop_type, growth_week, window_start, sensor_type, "
            f"{rnd('stddev_samp(zm)', 3)} AS zone_spread, count(*) AS zone_count FROM ("
            f"SELECT facility_id, crop_type, growth_week, time_bucket(INTERVAL '30 minutes', event_ts) "
            f"AS window_start, sensor_type, sensor_id, avg(value) AS zm FROM {C} c "
            f"WHERE NOT is_anomaly AND value IS NOT NULL AND event_ts IS NOT NULL "
            f"GROUP BY facility_id, crop_type, growth_week, window_start, sensor_type, sensor_id) z "
            f"GROUP BY facility_id, crop_type, growth_week, window_start, sensor_type"),
        "climate_30min": _select(long_sql(C, clean_only=True),
                                 ["facility_id", "crop_type", "growth_week", "window_start", "sensor_type",
                                  "avg_value", "zone_variance", "reading_count"]),
        "anomaly_rate": _select(long_all, ["facility_id", "window_start", "sensor_type", "n_all",
                                           "n_anomalous", "anomaly_rate"]),
        "climate_pivot": f"SELECT * FROM {wide} w",
        "vpd_pairs": f"SELECT * FROM {pairs} p",
        "vpd_30min": f"SELECT * FROM {vpd_window_sql(pairs)} v",
        "climate_score": _select(scores_sql(wide), ["facility_id", "window_start"]
                                 + [f"score_{t}" for t in SCORED] + ["climate_score"]),
        "crop_score": f"SELECT * FROM {crop_sql(wide)} c",
        "gold_climate": _select(gold, GOLD_COLS),
        "json_decode": f"SELECT {msg_cols}, {landing} FROM {R} r",
        "bronze_landing": f"SELECT {msg_cols}, {landing} FROM {R} r",
        "live_stream": f"SELECT * FROM {latest_sql(live_rows_sql(R).replace('device_id AS sensor_id', 'sensor_id'), 'landed_at DESC, arrival DESC')} l",
        "silver_typed": f"SELECT * FROM {typed} t",
        "silver_readings": f"SELECT * FROM {classified_sql(typed)} s",
        "topic_route": (f"SELECT source_topic AS topic, count(*) AS n_messages, "
                        f"count(DISTINCT sensor_id) AS n_sensors FROM {R} r GROUP BY source_topic"),
        "payload_flatten": payload_sql(R),
        "run_window_select": (f"SELECT event_id, facility_id, sensor_id, value, event_ts, landed_at, "
                              f"CAST(landed_at AS DATE) AS date, CAST(hour(landed_at) AS INTEGER) AS hour "
                              f"FROM {R} r WHERE landed_at >= {run_lo} AND landed_at < {run_hi}"),
        "facility_union": (f"SELECT * FROM {R} r WHERE facility_id = 'facility_A' UNION ALL "
                           f"SELECT * FROM {R} r WHERE facility_id = 'facility_B'"),
        "peer_outliers": f"SELECT event_id, is_peer_outlier, peer_deviation FROM {peer} p",
        "facility_aggregate": (
            f"SELECT facility_id, sensor_type, poll_ts, "
            f"{exact_mean('CASE WHEN value IS NOT NULL AND NOT is_peer_outlier THEN value END', 2)} AS facility_aggregate, "
            f"count(*) AS sensor_count, "
            f"count(*) FILTER (WHERE value IS NOT NULL AND NOT is_peer_outlier) AS healthy_sensor_count "
            f"FROM {peer} p GROUP BY facility_id, sensor_type, poll_ts"),
        "live_latest": f"SELECT * FROM {live} l",
        "upsert_live": f"SELECT * FROM {merge_sql(live1, live2, ['facility_id', 'sensor_id'], live_cols, ['value', 'unit', 'is_anomaly', 'recorded_at'])} m",
        "serving_climate": _select(gold_sql(classified_sql(R, RUN_KEYS)), SERVING),
        "gold_facts": _select(gold_sql(odd), GOLD_COLS),
        "vpd_table": (f"SELECT facility_id, temperature_sensor_id, humidity_sensor_id, event_ts, humidity_ts, temperature, humidity, "
                      f"vpd_kpa, time_bucket(INTERVAL '30 minutes', event_ts) AS window_start FROM {table_pairs_sql(odd)} p"),
        "quarantine": quarantine_sql(R, msg_cols),
        "topic_sink": (f"SELECT {msg_cols}, source_topic AS topic, '[\"' || facility_id || '\",\"' || sensor_id || '\"]' AS key, "
                       f"{json_fields_sql()} AS json_fields FROM {R} r"),
        "score_band": (f"SELECT facility_id, window_start, climate_score, CASE WHEN climate_score IS NULL THEN NULL "
                       f"WHEN climate_score >= 80 THEN 'green' WHEN climate_score >= 60 THEN 'yellow' ELSE 'red' END AS band "
                       f"FROM {scores_sql(wide)} s"),
        "panel_gauges": (f"SELECT f.facility_id, t.sensor_type, g.gauge_value FROM (VALUES ('facility_A'), ('facility_B')) f(facility_id) "
                         f"CROSS JOIN (VALUES {', '.join(f"('{t}')" for t in SENSOR_TYPES)}) t(sensor_type) "
                         f"LEFT JOIN {gauges_sql(live)} g USING (facility_id, sensor_type)"),
        "panel_trends": trends,
        "panel_anomalies": (f"SELECT facility_id, sensor_id, sensor_type, value, recorded_at FROM {live} l "
                            f"WHERE is_anomaly = true ORDER BY recorded_at DESC NULLS FIRST, facility_id, "
                            f"sensor_id LIMIT {Q.TOP_N_ANOMALIES}"),
        "upsert_gold": f"SELECT * FROM {merge_sql(gold1, gold2, ['facility_id', 'window_start'], SERVING, SERVING[4:])} m",
        "live_gauges": f"SELECT * FROM {gauges_sql(live)} g",
        "climate_trends": trends,
        "current_anomalies": (f"SELECT facility_id, sensor_id, sensor_type, value, recorded_at FROM {live} l "
                              f"WHERE is_anomaly = true ORDER BY recorded_at DESC NULLS FIRST, facility_id, "
                              f"sensor_id LIMIT {Q.TOP_N_ANOMALIES}"),
        "threshold_band": f"SELECT *, {band_case('gauge_value')} AS band FROM {gauges_sql(live)} g",
    }
