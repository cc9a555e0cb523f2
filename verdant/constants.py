"""Fixed domain values.

Everything in this module is a fixed value that results depend on; the values
are stated as plain data so operators can take them as parameters.
"""

from __future__ import annotations

# --- Fixed values: sensor types, their message topics and units -------------
SENSOR_TYPES = ("temperature", "humidity", "co2", "light", "airflow")

TOPIC_MAP = {
    "temperature": "sensors.temperature",
    "humidity": "sensors.humidity",
    "co2": "sensors.co2",
    "light": "sensors.light",
    "airflow": "sensors.airflow",
}

SENSOR_UNITS = {
    "temperature": "celsius",
    "humidity": "percent",
    "co2": "ppm",
    "light": "umol_m2_s",
    "airflow": "m_per_s",
}

# --- Fixed values: physiological limits for the range check (inclusive) -----
RANGE_LIMITS = {
    "temperature": (5.0, 50.0),
    "humidity": (0.0, 100.0),
    "co2": (200.0, 5000.0),
    "light": (0.0, 2000.0),
    "airflow": (0.0, 5.0),
}

# --- Fixed values: score ranges used by the facility-wide climate score -----
SCORE_RANGES = {
    "temperature": (20.0, 26.0),
    "humidity": (65.0, 75.0),
    "co2": (800.0, 1100.0),
    "light": (200.0, 600.0),
}

# --- Fixed values: crop profiles (optimal ranges per crop) -------------------
CROP_PROFILES = {
    "tomato": {
        "temperature": (20.0, 26.0),
        "humidity": (65.0, 75.0),
        "co2": (800.0, 1100.0),
        "light": (200.0, 600.0),
        "airflow": (0.2, 0.8),
    },
    "cucumber": {
        "temperature": (22.0, 28.0),
        "humidity": (70.0, 80.0),
        "co2": (700.0, 1000.0),
        "light": (150.0, 500.0),
        "airflow": (0.2, 0.7),
    },
}

# --- Fixed values: facilities -------------------------------------------------
FACILITIES = {
    "facility_A": {"crop_type": "tomato", "location": "Amsterdam, NL", "growth_week": 6},
    "facility_B": {"crop_type": "cucumber", "location": "Rotterdam, NL", "growth_week": 4},
}

# --- Fixed values: dashboard gauge threshold steps ----------------------------
# (facility_id, sensor_type) -> ascending steps (lower bound, band); the first
# step has no lower bound.  A value falls in the last step whose bound it
# reaches (value >= bound).
GAUGE_BANDS = {
    ("facility_A", "temperature"): [(None, "blue"), (20.0, "green"), (30.0, "red")],
    ("facility_B", "temperature"): [(None, "blue"), (22.0, "green"), (30.0, "red")],
    ("facility_A", "humidity"): [(None, "red"), (65.0, "green"), (80.0, "red")],
    ("facility_B", "humidity"): [(None, "red"), (65.0, "green"), (80.0, "red")],
    ("facility_A", "co2"): [(None, "red"), (800.0, "green"), (1200.0, "red")],
    ("facility_B", "co2"): [(None, "red"), (800.0, "green"), (1200.0, "red")],
    ("facility_A", "light"): [(None, "red"), (200.0, "green"), (600.0, "yellow")],
    ("facility_B", "light"): [(None, "red"), (150.0, "green"), (500.0, "yellow")],
    ("facility_A", "airflow"): [(None, "red"), (0.2, "green"), (0.9, "red")],
    ("facility_B", "airflow"): [(None, "red"), (0.2, "green"), (0.9, "red")],
}

# Climate-score threshold steps of the trend panel.
SCORE_BANDS = [(None, "red"), (60.0, "yellow"), (80.0, "green")]

# --- Fixed values: gauge display rounding (decimals per sensor type) ---------
GAUGE_SCALES = {"temperature": 2, "humidity": 2, "co2": 2, "light": 2, "airflow": 3}

# --- Fixed values: algorithm constants ----------------------------------------
WINDOW_MINUTES = 30
STAT_SIGMA = 3.0          # per-sensor statistical outlier threshold
PEER_SIGMA = 2.0          # peer (same poll, same type) outlier threshold
BAND_SECONDS = 60         # temperature/humidity pairing band
VPD_SCALE = 4             # decimals of vpd_kpa
TREND_HOURS = 24          # trailing interval of the trend panels
TOP_ANOMALIES = 20        # rows of the current-anomalies table
