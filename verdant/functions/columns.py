"""Scalar column expressions.

Each function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.constants import RANGE_LIMITS, SENSOR_UNITS, TOPIC_MAP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(value) -> Column:
    """NaN -> NULL, so one NaN cannot poison a mean or a stddev."""
    v = _col(value)
    return F.when(~F.isnan(v), v)


def parse_timestamp(text) -> Column:
    """ISO-8601 text (with or without fraction) -> TIMESTAMP_NTZ; garbage -> NULL.

    Strings carry UTC wall-clock time; parsing runs under the UTC session zone,
    so the cast to NTZ keeps the wall clock unchanged.
    """
    return F.try_to_timestamp(_col(text)).cast("timestamp_ntz")


def message_key(columns: Sequence[str] = ("facility_id", "sensor_id")) -> Column:
    """Key of a reading's message: facility and sensor id as JSON text; NULL where ``columns`` lacks one."""
    names = ("facility_id", "sensor_id")
    return F.to_json(F.array(*names)) if set(names) <= set(columns) else F.lit(None).cast("string")


def iso_string(ts) -> Column:
    """Timestamp -> ISO-8601 text with microseconds."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def ntz_literal(value) -> Column:
    """A datetime (or ISO text) as a TIMESTAMP_NTZ literal, free of any zone."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds (truncated), for NTZ or LTZ timestamps (UTC session)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def _literal_map(mapping: Mapping[str, str]) -> Column:
    items = []
    for key, value in mapping.items():
        items += [F.lit(key), F.lit(value)]
    return F.create_map(*items)


def topic_of_sensor_type(sensor_type, topic_map: Mapping[str, str] = TOPIC_MAP) -> Column:
    """Sensor type -> topic; unknown types -> NULL."""
    return F.try_element_at(_literal_map(topic_map), _col(sensor_type))


def sensor_type_of_topic(topic, topic_map: Mapping[str, str] = TOPIC_MAP) -> Column:
    """Topic -> sensor type; unknown topics -> NULL."""
    inverse = {t: s for s, t in topic_map.items()}
    return F.try_element_at(_literal_map(inverse), _col(topic))


def unit_of_sensor_type(sensor_type, units: Mapping[str, str] = SENSOR_UNITS) -> Column:
    return F.try_element_at(_literal_map(units), _col(sensor_type))


def range_violation(value, sensor_type, limits: Mapping[str, tuple] = RANGE_LIMITS) -> Column:
    """True when the value lies strictly outside its type's limits."""
    v, t = _col(value), _col(sensor_type)
    cond = F.lit(False)
    for name, (low, high) in limits.items():
        cond = cond | ((t == name) & ((v < low) | (v > high)))
    return cond


def anomaly_type(value, sensor_type, mean, stddev, n_sigma: float = 3.0,
                 limits: Mapping[str, tuple] = RANGE_LIMITS) -> Column:
    """First match wins: dropout > statistical > range > NULL."""
    v = _col(value)
    m, s = _col(mean), _col(stddev)
    return (F.when(v.isNull() | F.isnan(v), F.lit("dropout"))
            .when(s.isNotNull() & (F.abs(v - m) > F.lit(n_sigma) * s), F.lit("statistical"))
            .when(range_violation(v, sensor_type, limits), F.lit("range"))
            .otherwise(F.lit(None).cast("string")))


def vpd_kpa(temperature, humidity, scale: int = 4) -> Column:
    """Vapour pressure deficit in kPa from air temperature (C) and RH (%)."""
    t, h = _col(temperature), _col(humidity)
    saturation = F.lit(0.6108) * F.exp(F.try_divide(F.lit(17.27) * t, t + F.lit(237.3)))
    return F.round((F.lit(1) - h / F.lit(100)) * saturation, scale)


def range_score(value, low, high, clamp: bool = False, scale: int = 2) -> Column:
    """100 inside [low, high]; falls linearly by 100 per range width outside.

    ``low`` and ``high`` are numbers or columns.  Not clamped by default (can
    go negative); ``clamp=True`` bounds it to 0..100.
    """
    v = _col(value)
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    width = high - low
    below = F.round(F.lit(100.0) - (low - v) / width * F.lit(100), scale)
    above = F.round(F.lit(100.0) - (v - high) / width * F.lit(100), scale)
    score = (F.when(v.isNull(), F.lit(None).cast("double"))
             .when((v >= low) & (v <= high), F.lit(100.0))
             .when(v < low, below)
             .otherwise(above))
    if clamp:
        score = F.when(score.isNull(), score).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))
    return score


MEAN_DECIMAL = "decimal(38,18)"


def mean_parts(value, prefix: str = "__m") -> list[Column]:
    """Aggregates that ``rounded_mean`` finishes: a decimal sum, its count, the
    count of values and their double mean.  NaN counts as NULL."""
    v = nan_to_null(value)
    d = v.try_cast(MEAN_DECIMAL)
    return [F.try_sum(d).alias(f"{prefix}_sum"), F.count(d).alias(f"{prefix}_fits"),
            F.count(v).alias(f"{prefix}_n"), F.avg(v).alias(f"{prefix}_avg")]


def rounded_mean(scale: int, prefix: str = "__m") -> Column:
    """round(mean, scale) half away from zero; NULL without values.

    The mean of the values' decimal forms: exact, so ties round the same way
    in whatever order partial sums are merged.  Where a value or the sum does
    not fit the decimal (beyond 1e20), the mean of the doubles stands in; no
    value raises.
    """
    total, fits, n, mean = (F.col(f"{prefix}_{x}") for x in ("sum", "fits", "n", "avg"))
    exact = F.round(F.try_divide(total, n.cast("decimal(20,0)")), scale).cast("double")
    return F.when(n == 0, F.lit(None).cast("double")).when((fits == n) & total.isNotNull(), exact).otherwise(F.round(mean, scale))


def band_label(value, steps: Sequence[tuple]) -> Column:
    """Ascending threshold steps -> band label (value >= bound picks the step)."""
    v = _col(value)
    label = F.lit(steps[0][1])
    for bound, name in steps[1:]:
        label = F.when(v >= F.lit(bound), F.lit(name)).otherwise(label)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(label)
