"""Serving-table operators: latest value per key, keyed merge, dashboard views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.constants import GAUGE_BANDS, GAUGE_SCALES, TOP_ANOMALIES, TREND_HOURS
from verdant.functions.columns import band_label, mean_parts, ntz_literal, rounded_mean, unit_of_sensor_type

LIVE_KEYS = ("facility_id", "sensor_id")
LIVE_UPDATE_COLS = ("value", "unit", "is_anomaly", "recorded_at")
GOLD_KEYS = ("facility_id", "window_start")
GOLD_UPDATE_COLS = ("avg_temperature", "avg_humidity", "avg_co2", "avg_light", "avg_airflow",
                    "avg_vpd", "climate_score", "variance_temperature", "overall_anomaly_rate",
                    "gold_processed_at")


def _as_list(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _flat(df: DataFrame, cols: Sequence[str]) -> list:
    """Columns in order, a struct replaced by its fields: numbers and times that a hash aggregate can hold."""
    out = []
    for c in cols:
        kind = df.schema[c].dataType
        out += [F.col(c)[f.name] for f in kind.fields] if isinstance(kind, T.StructType) else [F.col(c)]
    return out


def _ends_by_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str], cols: Sequence[str],
                 first: bool) -> DataFrame:
    """``keys``, ``cols`` of each key's last rows (``__last``) and, if asked, first rows (``__first``) in ``order_by``.

    One round per order column: a hash aggregate takes the column's greatest
    (and least) value among the rows still in the running, and a join back
    keeps the rows that reach it.  The input is never sorted, and a key with a
    third of it is reduced inside each input split.  Full ties go to the
    greatest (and least) hash of the row, so the choice does not depend on the
    order of arrival; what then remains are equal rows.  NULL orders lose to
    any other.
    """
    order = _flat(df, _as_list(order_by))
    names = [f"__o{i}" for i in range(len(order))] + ["__tie"]
    tie = F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])
    cur = df.select(*keys, *cols, *[o.alias(n) for o, n in zip([*order, tie], names)],
                    F.lit(True).alias("__last"), F.lit(first).alias("__first"))
    for n in names:
        ends = [F.max(F.when(F.col("__last"), F.col(n))).alias("__hi")]
        if first:
            ends.append(F.min(F.when(F.col("__first"), F.col(n))).alias("__lo"))
        tops = cur.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(*ends)
        last = F.col("__last") & F.col(n).eqNullSafe(F.col("__hi"))
        begin = F.col("__first") & F.col(n).eqNullSafe(F.col("__lo")) if first else F.lit(False)
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        kept = [c for c in cur.columns if c not in ("__last", "__first", n)]
        cur = cur.join(tops, on & (last | begin)).select(*kept, last.alias("__last"), begin.alias("__first"))
    return cur


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str],
                  cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (arrival order).

    Hash aggregates and joins back (``_ends_by_key``), no sort.  NULL orders
    lose to any other; a key with NULL orders alone keeps one of its rows, and
    so does a full tie: the row with the greatest hash.
    """
    cols = [c for c in (cols or df.columns) if c not in keys]
    return _ends_by_key(df, keys, order_by, cols, first=False).select(*keys, *cols).distinct()


def _reduce_batch(upd: DataFrame, keys: Sequence[str], update_cols: Sequence[str], cols: Sequence[str],
                  order_by: str | Sequence[str]) -> DataFrame:
    """Several updates of one key in a batch, as if applied one by one.

    Updated columns come from the last update; the other columns from the
    first, which is what a new key keeps when it is inserted and then updated
    within the same batch.  Keys are not NULL.
    """
    last = [c for c in cols if c in update_cols]
    first = [c for c in cols if c not in update_cols]
    ends = _ends_by_key(upd, keys, order_by, cols, first=bool(first))
    out = ends.where("__last").select(*keys, *last).distinct()
    if not first:
        return out
    begin = ends.where("__first").select(*[F.col(k).alias(f"__k_{k}") for k in keys], *first).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"__k_{k}"))
    return out.join(begin, on).select(*keys, *last, *first)


def reduce_updates(updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                   order_by: str | Sequence[str]) -> DataFrame:
    """One row per key of an update batch: last values of ``update_cols`` and of the order, first ones of the rest.

    Rows with a NULL key are rejected.
    """
    known = updates
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    order = _as_list(order_by)
    cols = [c for c in updates.columns if c not in keys]
    return _reduce_batch(known, keys, [*update_cols, *order], cols, order)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], order_by: str | Sequence[str] | None = None,
                 newer_than: str | None = None) -> DataFrame:
    """Insert-or-update by key, as ``INSERT .. ON CONFLICT (keys) DO UPDATE``.

    * new key: the update row is inserted as a whole;
    * existing key: ``update_cols`` take the update's values (a NULL in the
      update overwrites), every other column keeps the stored value;
    * update rows with a NULL key are rejected (the store's key is NOT NULL);
    * several updates of one key: the last by ``order_by`` wins (required then);
    * with ``newer_than`` (a column of both sides, e.g. an arrival offset) an
      existing row is only updated by a strictly greater value, so replaying
      an old batch, or batches out of order, never moves a row backwards.

    A full outer join on the key: one shuffle of both sides, no driver loop.
    """
    keys = list(keys)
    has_null_key = F.lit(False)
    for k in keys:
        has_null_key = has_null_key | F.col(k).isNull()
    upd = updates.where(~has_null_key)
    if newer_than is not None and newer_than not in update_cols:
        update_cols = [*update_cols, newer_than]
    if order_by is not None:
        upd = _reduce_batch(upd, keys, update_cols, [c for c in target.columns if c not in keys], order_by)
    cols = [c for c in target.columns]
    missing = [c for c in cols if c not in upd.columns]
    if missing:
        raise ValueError(f"updates lack target columns {missing}")
    o = target.select(*[F.col(c).alias(f"__o_{c}") for c in cols], F.lit(True).alias("__o_hit"))
    n = upd.select(*[F.col(c).alias(f"__n_{c}") for c in cols], F.lit(True).alias("__n_hit"))
    cond = None
    for k in keys:
        c = F.col(f"__o_{k}") == F.col(f"__n_{k}")
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    new_hit = F.col("__n_hit").isNotNull()
    old_hit = F.col("__o_hit").isNotNull()
    if newer_than is not None:
        o_v, n_v = F.col(f"__o_{newer_than}"), F.col(f"__n_{newer_than}")
        new_hit = new_hit & (~old_hit | o_v.isNull() | (n_v > o_v))
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"__o_{c}"), F.col(f"__n_{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(new_hit, F.col(f"__n_{c}")).otherwise(F.col(f"__o_{c}")).alias(c))
        else:
            out.append(F.when(old_hit, F.col(f"__o_{c}")).otherwise(F.col(f"__n_{c}")).alias(c))
    return j.select(*out)


def live_rows(readings: DataFrame, sensor_col: str = "device_id") -> DataFrame:
    """Readings -> rows of the live table (+ ``arrival`` order).

    ``is_anomaly`` is ``value IS NULL`` (a NaN is not flagged).
    """
    return readings.select(
        "facility_id",
        F.col(sensor_col).alias("sensor_id"),
        "sensor_type",
        "value",
        unit_of_sensor_type("sensor_type").alias("unit"),
        F.col("value").isNull().alias("is_anomaly"),
        F.col("event_ts").alias("recorded_at"),
        F.col("event_id").alias("arrival"),
    )


def live_latest(readings: DataFrame, sensor_col: str = "device_id", order_by: str = "arrival") -> DataFrame:
    """Latest live row per (facility, sensor); ``order_by="recorded_at"`` uses event time."""
    rows = live_rows(readings, sensor_col)
    return latest_by_key(rows, LIVE_KEYS, order_by,
                         ["sensor_type", "value", "unit", "is_anomaly", "recorded_at"])


def live_gauges(live: DataFrame, scales: Mapping[str, int] = GAUGE_SCALES) -> DataFrame:
    """Gauge value per (facility, type): rounded mean of non-anomalous live values.

    One grouped aggregate replaces one scan per gauge panel.  The mean is
    exact decimal mean, rounded half up; a NaN counts as no value.
    """
    rounded = F.lit(None).cast("double")
    for t, scale in scales.items():
        rounded = F.when(F.col("sensor_type") == t, rounded_mean(scale)).otherwise(rounded)
    return (live.where(F.col("is_anomaly") == F.lit(False))
                .groupBy("facility_id", "sensor_type")
                .agg(*mean_parts("value"))
                .select("facility_id", "sensor_type", rounded.alias("gauge_value")))


def threshold_band(df: DataFrame, bands: Mapping[tuple, Sequence[tuple]] = GAUGE_BANDS,
                   keys: Sequence[str] = ("facility_id", "sensor_type"), value: str = "gauge_value",
                   out: str = "band") -> DataFrame:
    """Band label per row from per-key ascending threshold steps.

    The steps are a fixed literal table, so the lookup is a CASE expression
    (no join at all); keys without steps get NULL.
    """
    label = F.lit(None).cast("string")
    for key, steps in bands.items():
        key = key if isinstance(key, tuple) else (key,)
        match = F.lit(True)
        for k, v in zip(keys, key):
            match = match & (F.col(k) == F.lit(v))
        label = F.when(match, band_label(value, steps)).otherwise(label)
    return df.withColumn(out, label)


TREND_METRICS = ("avg_vpd", "climate_score", "overall_anomaly_rate", "variance_temperature")


def climate_trends(gold: DataFrame, as_of: datetime | str, hours: int = TREND_HOURS,
                   metrics: Sequence[str] = TREND_METRICS) -> DataFrame:
    """Long-form trend series for the trailing ``hours`` before ``as_of``.

    ``window_start > as_of - hours`` (strict) and ``<= as_of``; one row per
    (panel, time, facility) ordered by time.  A single scan and an unpivot
    replace one query per panel.
    """
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    lower = as_of - timedelta(hours=hours)
    recent = gold.where((F.col("window_start") > ntz_literal(lower))
                        & (F.col("window_start") <= ntz_literal(as_of)))
    if "date" in gold.columns:      # a written fact table: prune its date partitions too
        recent = recent.where(F.col("date").between(F.lit(lower.date()), F.lit(as_of.date())))
    wide = recent.select("window_start", "facility_id", *[F.col(m).cast("double").alias(m) for m in metrics])
    long_df = wide.unpivot(["window_start", "facility_id"], list(metrics), "panel", "value")
    return (long_df.select("panel", F.col("window_start").alias("time"),
                           F.col("facility_id").alias("metric"), "value")
                   .orderBy("time", "panel", "metric"))


def current_anomalies(live: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    """The ``n`` most recent anomalous live rows (NULL times first, as in SQL DESC).

    ``orderBy + limit`` plans as a per-partition top-k and a final merge.
    """
    return (live.where(F.col("is_anomaly") == F.lit(True))
                .orderBy(F.col("recorded_at").desc_nulls_first(), "facility_id", "sensor_id")
                .limit(n)
                .select("facility_id", "sensor_id", "sensor_type", "value", "recorded_at"))
