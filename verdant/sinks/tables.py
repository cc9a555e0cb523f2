"""Partitioned Parquet tables: idempotent partition writes, merges, window replacement.

Parquet with dynamic partition overwrite stands in for a transactional table
format: a run replaces exactly the partitions it owns, so a retry or rerun
never duplicates rows.  Replacement is per partition (Spark's commit protocol
moves each partition's files into place); it is not one atomic commit across
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.operators.serving import merge_upsert
from verdant.sources.messages import kafka_guard
from verdant.sources.tables import partition_filter, path_exists, read_table


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """Write ``df`` replacing only the partitions it contains (a table that does not exist yet is just written).

    ``rebalance`` on the partition columns lets AQE size the write tasks:
    small partitions are coalesced (few files) and a hot partition (one
    facility with a third of the rows) is split over several tasks instead
    of one writer.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    (df.hint("rebalance", *partition_cols)
       .write.mode("overwrite" if path_exists(spark, path) else "append").format(fmt).partitionBy(*partition_cols).save(path))


def write_topics(df: DataFrame, fmt: str = "kafka", path: str | None = None,
                 options: dict | None = None) -> None:
    """Rows of (topic, key, value) to a topic sink; the row's ``topic`` routes it.

    ``fmt="kafka"`` writes to the broker; a file format writes one folder per
    topic (tests, replay).
    """
    w = df.write.options(**(options or {}))
    if fmt == "kafka":
        kafka_guard(lambda: w.format("kafka").save())
    else:
        w.mode("append").format(fmt).partitionBy("topic").save(path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _in_partitions(current: DataFrame, touched: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """The rows of the touched partitions.

    Their days, hours or buckets (listed, not spanned) prune partitions at the
    scan; a semi join then keeps exactly the touched ones.
    """
    return current.where(partition_filter(touched, partition_cols)).join(touched, list(partition_cols), "left_semi")


def merge_into_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                     update_cols: Sequence[str], partition_cols: Sequence[str],
                     order_by: str | Sequence[str] | None = None,
                     newer_than: str | None = None, materialized: bool = False) -> DataFrame:
    """Keyed upsert into a partitioned Parquet table (``merge_upsert`` semantics).

    Only partitions that receive updates are read, merged and rewritten; the
    rest of the table is untouched.  The merged partitions are checkpointed
    to the shared checkpoint folder before the overwrite, which cuts their
    lineage from the files being replaced (and survives executor loss).
    Partition columns must be functions of the key and not NULL.  The updates
    are materialised once (they feed both the partition listing and the
    merge), unless the caller passes ``materialized=True`` for an already cut
    lineage.  Returns the merged rows.
    """
    if not materialized:
        updates = updates.checkpoint(eager=True)
    keep = [c for c in updates.columns if c not in _order_list(order_by) or c == newer_than]
    current = read_table(spark, path, _nullable(updates.select(*keep).schema))
    if path_exists(spark, path):
        current = _in_partitions(current, updates.select(*partition_cols).distinct(), partition_cols)
    merged = merge_upsert(current, updates, keys, update_cols, order_by, newer_than).checkpoint(eager=True)
    write_partitions(merged, path, partition_cols)
    return merged


def window_digests(rows: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Per window the number of its rows and the sum of their hashes, whatever their order.

    NULLs are part of a row's hash by their place: (NULL, 1) and (1, NULL) differ.
    """
    cols = sorted(c for c in rows.columns if c not in ignore and c not in keys)      # whatever the frame's column order
    one = F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.sum(one.cast("decimal(38,0)")).alias("__sum"))


def changed_windows(current: DataFrame, rows: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """The change set: keys of the windows whose rows differ between ``current`` and ``rows``.

    A window of one side alone was added or removed; a window with equal
    digests is unchanged and not returned.
    """
    old = window_digests(current, keys, ignore).withColumnsRenamed({"__n": "__old_n", "__sum": "__old_sum"})
    both = window_digests(rows, keys, ignore).join(old, list(keys), "full_outer")
    same = F.col("__n").eqNullSafe(F.col("__old_n")) & F.col("__sum").eqNullSafe(F.col("__old_sum"))
    return both.where(~same).select(*keys)


def replace_windows(spark: SparkSession, path: str, rows: DataFrame, windows: DataFrame, keys: Sequence[str],
                    partition_cols: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """Replace all rows of whole windows of a table by ``rows``; returns ``rows`` as cut from their lineage.

    ``windows`` holds the replaced windows (``keys`` and ``partition_cols``,
    which are functions of the keys); rows of other windows are kept.  Only
    partitions with a window that changed are written: a window whose rows are
    the same (columns in ``ignore``, such as a processing stamp, aside) keeps
    its files, so a rerun over the same input writes nothing.  A window that
    produces nothing any more loses its old rows, and a partition left without
    rows is deleted.
    """
    rows = rows.checkpoint(eager=True)
    if not path_exists(spark, path):
        write_partitions(rows, path, partition_cols)
        return rows
    current = _in_partitions(read_table(spark, path, _nullable(rows.schema)), windows.select(*partition_cols).distinct(), partition_cols)
    own = current.join(windows.select(*keys), list(keys), "left_semi")
    changed = windows.join(changed_windows(own, rows, keys, ignore), list(keys), "left_semi").checkpoint(eager=True)
    touched = changed.select(*partition_cols).distinct()
    if changed.isEmpty():
        return rows
    current = _in_partitions(read_table(spark, path, _nullable(rows.schema)), touched, partition_cols)
    replaced = changed.select(*keys)
    kept = current.join(replaced, list(keys), "left_anti").select(*rows.columns)
    merged = kept.union(rows.join(replaced, list(keys), "left_semi").select(*rows.columns)).checkpoint(eager=True)
    write_partitions(merged, path, partition_cols)
    gone = touched.join(merged.select(*partition_cols).distinct(), list(partition_cols), "left_anti")
    _delete_partitions(spark, path, gone, partition_cols)
    return rows


def _delete_partitions(spark: SparkSession, path: str, partitions: DataFrame, cols: Sequence[str]) -> None:
    """Remove the folders of partitions that lost all their rows (a run's partitions at most)."""
    jvm = spark.sparkContext._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in partitions.select(*[F.col(c).cast("string") for c in cols]).toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{c}={escape(r[c])}" for c in cols]]))
        folder.getFileSystem(conf).delete(folder, True)


def _order_list(order_by) -> list[str]:
    if order_by is None:
        return []
    return [order_by] if isinstance(order_by, str) else list(order_by)
