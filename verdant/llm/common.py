"""Helpers shared by the operators: workers' import path, scratch tables, task files."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import verdant
from verdant.session import checkpoint_root, scratch_path


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package and register the checkpoint folder.

    Workers get the package's folder on their PYTHONPATH, so a session that
    was started from another folder works too; a cluster that ships the
    package with ``--py-files`` is not affected.
    """
    root = str(Path(verdant.__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    checkpoint_root(spark)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Lineage ends at the written table, so a lost executor costs a re-read and
    not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as the text 'null')."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(mod)).cast("int")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, for files written by tasks."""
    return scratch_path(spark, name)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI or an absolute path."""
    from pyarrow import fs

    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def open_new(folder: str, stem: str, suffix: str):
    """(name, output stream) of a new task file.

    Every task attempt writes a file of its own; only names that reach a
    written manifest are ever read, so files of failed or repeated attempts
    are ignored.
    """
    files, path = filesystem(folder)
    files.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex[:12]}{suffix}"
    return name, files.open_output_stream(f"{path}/{name}", compression=None)


def read_range(folder: str, name: str, offset: int = 0, length: int | None = None) -> bytes:
    files, path = filesystem(folder)
    with files.open_input_file(f"{path}/{name}") as f:
        f.seek(offset)
        return f.read() if length is None else f.read(length)


def by_file(df: DataFrame, col: str) -> DataFrame:
    """``df`` dealt out by the file its rows point to.

    The rows are small but stand for large range reads, so the number of tasks
    is the session's and not derived from the rows' bytes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), col)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
