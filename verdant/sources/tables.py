"""Partitioned table reads and run-window selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.columns import ntz_literal


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a table root with its declared schema, partition columns included.

    Declared types are not inferred from folder names, so a facility ``007``
    stays text.  A table that was never written is an empty frame, so that a
    run over nothing returns an empty, correctly typed result.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def utc_time(value: datetime | str) -> datetime:
    """A run bound as a UTC wall-clock time; ISO text or datetime, with any zone or none (UTC)."""
    ts = datetime.fromisoformat(value) if isinstance(value, str) else value
    return ts if ts.tzinfo is None else ts.astimezone(timezone.utc).replace(tzinfo=None)


def run_bounds(start: datetime | str, end: datetime | str) -> tuple[datetime, datetime]:
    """The half-open run window [start, end) in UTC; it must not be empty."""
    lo, hi = utc_time(start), utc_time(end)
    if lo >= hi:
        raise ValueError(f"a run window must start before it ends: {start} .. {end}")
    return lo, hi


def partition_predicate(start: datetime, end: datetime, date_col: str = "date",
                        hour_col: str = "hour") -> Column:
    """(date, hour) partitions overlapping [start, end): prunable predicate."""
    last = end - timedelta(microseconds=1)
    d0, d1 = start.date(), last.date()
    d, h = F.col(date_col), F.col(hour_col)
    if d0 == d1:
        return (d == F.lit(d0)) & h.between(start.hour, last.hour)
    first = (d == F.lit(d0)) & (h >= start.hour)
    final = (d == F.lit(d1)) & (h <= last.hour)
    middle = (d > F.lit(d0)) & (d < F.lit(d1))
    return first | middle | final


#: A filter lists at most this many runs of consecutive hours or days; beyond it the smallest gaps are read too.
MAX_RANGES = 200


def value_runs(values: Iterable[int], most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """Runs (first, last) of consecutive numbers, at most ``most``: the smallest gaps are bridged beyond it."""
    runs: list[list[int]] = []
    for v in sorted(set(values)):
        if runs and v == runs[-1][1] + 1:
            runs[-1][1] = v
        else:
            runs.append([v, v])
    if len(runs) > most:
        gaps = sorted(range(1, len(runs)), key=lambda i: runs[i - 1][1] - runs[i][0])[:most - 1]
        cuts = [0, *sorted(gaps), len(runs)]
        runs = [[runs[a][0], runs[b - 1][1]] for a, b in zip(cuts, cuts[1:])]
    return [(a, b) for a, b in runs]


def hours_predicate(hours: Iterable[datetime], date_col: str = "date", hour_col: str = "hour") -> Column:
    """The (date, hour) partitions of a list of hours, by runs and not by their span: a stray hour adds itself only."""
    epoch = datetime(1970, 1, 1)
    step = timedelta(hours=1)
    out = F.lit(False)
    for first, last in value_runs((h - epoch) // step for h in hours):
        out = out | partition_predicate(epoch + first * step, epoch + (last + 1) * step, date_col, hour_col)
    return out


def days_predicate(days: Iterable[date], date_col: str = "date") -> Column:
    """The date partitions of a list of days, by runs."""
    out = F.lit(False)
    for first, last in value_runs(d.toordinal() for d in days):
        out = out | F.col(date_col).between(F.lit(date.fromordinal(first)), F.lit(date.fromordinal(last)))
    return out


def partition_filter(touched: DataFrame, partition_cols: Sequence[str]) -> Column:
    """A prunable filter of the touched partitions' days or hours (their distinct times are collected).

    Whole-number partitions (hash buckets) are listed.  Other columns, such as
    a facility, are left to the caller's join.
    """
    kinds = dict(touched.dtypes)
    cols = list(partition_cols)
    if "date" in cols and "hour" in cols:
        rows = touched.select("date", "hour").distinct().collect()
        return hours_predicate(datetime.combine(r["date"], time(r["hour"])) for r in rows)
    out = F.lit(True)
    if "date" in cols:
        out = days_predicate(r["date"] for r in touched.select("date").distinct().collect())
    for c in cols:
        if kinds[c] == "int" and c != "hour":
            runs = value_runs(r[0] for r in touched.select(c).distinct().collect())
            some = F.lit(False)
            for first, last in runs:
                some = some | F.col(c).between(first, last)
            out = out & some
    return out


def select_run(df: DataFrame, start: datetime | str, end: datetime | str, landed_col: str = "landed_at",
               date_col: str = "date", hour_col: str = "hour", whole_partitions: bool = False) -> DataFrame:
    """Rows landed in the half-open window [start, end).

    The (date, hour) predicate prunes partitions at the scan; the exact
    landing-time predicate keeps the half-open bounds.  With
    ``whole_partitions`` every row of the overlapping partitions is kept, so
    a run owns (and may overwrite) whole partitions.
    """
    start, end = run_bounds(start, end)
    out = df.where(partition_predicate(start, end, date_col, hour_col))
    if whole_partitions:
        return out
    return out.where((F.col(landed_col) >= ntz_literal(start)) & (F.col(landed_col) < ntz_literal(end)))


def union_facilities(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name (missing columns filled with NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def facility_union(df: DataFrame, branches: Sequence[str | None] | None = None, col: str = "facility_id") -> DataFrame:
    """The bag union of one branch per facility, as a single scan.

    Each branch selects one facility (``None``: rows without one); their
    predicates are merged into one that reaches the scan, and a facility named
    n times gives its rows n times.  Without ``branches`` every facility of
    the data has one: that is each row once, and no list of facilities is needed.
    """
    if branches is None:
        return df
    times: dict[str | None, int] = {}
    for b in branches:
        times[b] = times.get(b, 0) + 1
    named = [b for b in times if b is not None]
    wanted = F.col(col).isin(named)
    if None in times:
        wanted = wanted | F.col(col).isNull()
    out = df.where(wanted)
    if max(times.values(), default=1) == 1:
        return out
    n = F.lit(times.get(None, 0))
    for b in named:
        n = F.when(F.col(col) == F.lit(b), F.lit(times[b])).otherwise(n)
    return out.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), n))).drop("__copy")


def spread_input(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a too-coarse input before CPU-heavy per-row work.

    Only when the scan yields fewer splits than the cluster's parallelism
    (e.g. one small file with a single row group) is the input round-robin
    repartitioned; a large input already has more splits than cores and is
    left untouched, so no shuffle is added at scale.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
