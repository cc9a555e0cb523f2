"""Join helpers: broadcast only behind a checked size, never blindly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest small side that is broadcast: a row bound and a byte bound (rows x
# the schema's default field sizes, the estimate Spark's planner uses).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def type_bytes(dt: T.DataType) -> int:
    """Estimated bytes of one value (the conventions of Spark's size estimate)."""
    if isinstance(dt, T.StructType):
        return sum(type_bytes(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return 20 * type_bytes(dt.elementType)
    if isinstance(dt, T.MapType):
        return 20 * (type_bytes(dt.keyType) + type_bytes(dt.valueType))
    if isinstance(dt, (T.StringType, T.DecimalType)):
        return 20 if isinstance(dt, T.StringType) else 16
    if isinstance(dt, T.BinaryType):
        return 100
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    return 8      # long, double, timestamps, intervals


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes per row: the fields' sizes plus row overhead."""
    return 8 + type_bytes(df.schema)


def materialize_small(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Cut the lineage of a (probably) small side and check its size.

    The side is written once to the shared checkpoint folder (reliable
    checkpoint, so a lost executor does not lose it) and its rows are counted
    from there, up to ``max_rows + 1``.  Returns the materialised frame and
    whether it is within both the row and the estimated byte bound.
    """
    done = small.checkpoint(eager=True)
    n = done.limit(max_rows + 1).count()
    return done, n <= max_rows and n * row_bytes(done) <= max_bytes


def join_small(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
               max_rows: int = DEFAULT_BROADCAST_ROWS, null_safe: bool = False,
               max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with a side that is usually small (statistics, lookups).

    Within ``max_rows`` the small side is broadcast, so ``big`` is never
    shuffled and a hot key costs nothing extra.  Beyond it the join falls back
    to a shuffle join, where AQE's skew-join split handles hot keys.
    """
    small, fits = materialize_small(small, max_rows, max_bytes)
    right = F.broadcast(small) if fits else small
    if not null_safe:
        return big.join(right, list(keys), how)
    return join_null_safe(big, right, keys, how)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal or both-NULL ``keys``, which are kept once."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])
