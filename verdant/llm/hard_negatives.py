"""Hard negatives by Four-Russians scoring: subset-sum tables indexed with packed bit planes.

Components become whole numbers ``floor(scale * x)``.  A candidate is stored as
bit planes (two's complement): one byte per plane and group of eight
dimensions.  An anchor's table holds, for each group, the sums of all 256
subsets of its eight components.  A plane's inner product with the anchor is
then one table look-up per group, and the planes add up by shifting: exact
integer scores of all candidates without a multiplication.

The index (ids, labels, planes) is written once, in blocks of at most
``BLOCK`` vectors.  Two passes read it, each block against all anchors, which a
task streams from their written table in batches: the first finds every anchor's
best rows of its own label (positives), the second the best rows of other
labels inside each positive's band of scores.  Per block and anchor only the
best few leave a task; ranks over blocks come from a window per anchor.
Nothing is broadcast or collected but the largest component and length.

Defined results:

* rows with a null id, label or vector, or a null or non-finite component take
  no part; neither do rows with a scaled component of 2**27 or more, whose
  scores need not fit a long;
* vectors shorter than the longest one are padded with zeros;
* ties in the score go to the smaller id, then to the smaller label;
* a row with the anchor's own id is the anchor: neither positive nor negative;
  an anchor id that repeats counts once, with its least label and vector; other
  repeated rows are candidates each;
* an anchor without positives, and a positive without negatives, has no rows;
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import cut, filesystem, prepare, scratch_uri

#: Vectors in a block of the index, and candidates and anchors scored at a time.
BLOCK = 1 << 16
STRIPE = 2048
ANCHORS = 128
#: Anchors in a file.
ANCHOR_FILE = 8192
#: Scaled components reach less than this.
REACH = 1 << 27
GROUP = 8

INDEX = "n long, ids binary, labels binary, planes binary"
PAIRS = "anchor_id long, place int, positive_id long, positive_score long, other_id long, label int, score long"
NAMES = [f.split()[0] for f in PAIRS.split(", ")]


def scaled_rows(vectors: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, components as whole numbers."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double") * F.lit(float(scale)))
    # A null component makes `forall` null or false, so such rows go as well.
    fit = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(REACH))))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), x.alias("x"))
                   .where("id is not null and label is not null and x is not null").where(fit)
                   .select("id", "label", F.transform("x", lambda c: F.floor(c)).alias("v")))


def matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows of whole numbers, padded with zeros to ``width`` columns."""
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def pack(v: np.ndarray, planes: int) -> np.ndarray:
    """(planes, groups, rows) bytes: bit d of a byte is dimension 8 * group + d of that plane."""
    bits = (v[None, :, :] >> np.arange(planes)[:, None, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """(groups, 256, anchors): for every group of eight dimensions the sums of all subsets."""
    n, width = anchors.shape
    parts = anchors.T.reshape(width // GROUP, GROUP, n)
    out = np.zeros((width // GROUP, 1 << GROUP, n), dtype)
    for d in range(GROUP):
        out[:, 1 << d:2 << d] = out[:, :1 << d] + parts[:, None, d].astype(dtype)
    return out


def scores(tables: np.ndarray, planes: np.ndarray, wide) -> np.ndarray:
    """(rows, anchors) inner products: look-ups per plane, added up by shifting; the top plane is the sign."""
    n_planes, groups, n = planes.shape
    total = np.zeros((n, tables.shape[2]), wide)
    part = np.empty((n, tables.shape[2]), tables.dtype)
    step = np.empty_like(part)
    for p in range(n_planes - 1, -1, -1):
        np.take(tables[0], planes[p, 0], axis=0, out=part, mode="clip")
        for g in range(1, groups):
            np.take(tables[g], planes[p, g], axis=0, out=step, mode="clip")
            part += step
        total <<= 1
        if p == n_planes - 1:
            total -= part
        else:
            total += part
    return total


def number_types(width: int, largest: int) -> tuple:
    """(type of a plane's sum, type of a score) that hold all sums of ``width`` components up to ``largest``."""
    plane = np.int16 if width * largest < 1 << 15 else np.int32 if width * largest < 1 << 31 else np.int64
    return plane, np.int32 if width * largest * largest < 1 << 30 else np.int64


class _Scorer:
    """What a task needs to score blocks of the index against the written anchors."""

    def __init__(self, folder: str, width: int, largest: int):
        self.folder, self.width = folder, width
        self.planes = max(1, int(largest).bit_length()) + 1
        self.types = number_types(width, largest)

    def index(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in the order of (label, id) -> blocks of the index."""
        held, count = [], 0
        for batch in batches:
            for lo in range(0, len(batch), BLOCK):
                part = batch.iloc[lo:lo + BLOCK]
                if count + len(part) > BLOCK:
                    yield self._block(held)
                    held, count = [], 0
                held.append((part["id"].to_numpy(np.int64), part["label"].to_numpy(np.int32),
                             pack(matrix(part["v"], self.width), self.planes)))
                count += len(part)
        if held:
            yield self._block(held)

    def _block(self, held: list) -> pd.DataFrame:
        ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        planes = np.ascontiguousarray(np.concatenate([h[2] for h in held], axis=2))
        return pd.DataFrame([(len(ids), ids.tobytes(), labels.tobytes(), planes.tobytes())],
                            columns=["n", "ids", "labels", "planes"])

    def blocks(self, batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                planes = np.frombuffer(b.planes, np.uint8).reshape(self.planes, -1, b.n)
                yield np.frombuffer(b.ids, np.int64), np.frombuffer(b.labels, np.int32), planes

    def anchors(self) -> Iterator[pd.DataFrame]:
        """The written anchors, a few at a time."""
        import pyarrow.dataset as ds

        files, path = filesystem(self.folder)
        for batch in ds.dataset(path, filesystem=files, format="parquet").to_batches(batch_size=ANCHORS, batch_readahead=1,
                                                                                     fragment_readahead=1):
            if batch.num_rows:
                yield batch.to_pandas()

    def stripes(self, tables, planes, rows: np.ndarray):
        """(stripe of row numbers, their scores) of the chosen rows."""
        for lo in range(0, len(rows), STRIPE):
            part = rows[lo:lo + STRIPE]
            yield part, scores(tables, np.ascontiguousarray(planes[:, :, part]), self.types[1])

    def positives(self, batches: Iterator[pd.DataFrame], keep: int) -> Iterator[pd.DataFrame]:
        """Per block and anchor the best rows of the anchor's label."""
        for ids, labels, planes in self.blocks(batches):
            for anchors in self.anchors():
                found = []
                for label, group in anchors.groupby("label"):
                    rows = np.flatnonzero(labels == label)
                    own = group["id"].to_numpy(np.int64)
                    tables = subset_sums(matrix(group["v"], self.width), self.types[0])
                    for part, s in self.stripes(tables, planes, rows):
                        nothing = np.zeros((3, len(own)), np.int64)
                        found.append(best(s, ids[part], labels[part], own, nothing, keep, ids[part][:, None] != own[None, :]))
                yield _rows(found)

    def negatives(self, batches: Iterator[pd.DataFrame], keep: int, low: int, high: int) -> Iterator[pd.DataFrame]:
        """Per block, anchor and positive the best rows of other labels with a score in the positive's band."""
        for ids, labels, planes in self.blocks(batches):
            everyone = np.arange(len(ids))
            for anchors in self.anchors():
                own, mine = anchors["id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int32)
                tables = subset_sums(matrix(anchors["v"], self.width), self.types[0])
                bands = [[(p["place"], p["id"], p["score"]) for p in ps] for ps in anchors["positives"]]
                found = []
                for part, s in self.stripes(tables, planes, everyone):
                    other = (labels[part][:, None] != mine[None, :]) & (ids[part][:, None] != own[None, :])
                    for k in range(max(map(len, bands))):
                        has = np.array([j for j, b in enumerate(bands) if len(b) > k])
                        named = np.array([bands[j][k] for j in has], np.int64).T
                        lo = np.array([-(-low * p // 100) for p in named[2].tolist()], np.int64)
                        hi = np.array([high * p // 100 for p in named[2].tolist()], np.int64)
                        sub = s[:, has]
                        ok = other[:, has] & (sub >= lo) & (sub <= hi)
                        found.append(best(sub, ids[part], labels[part], own[has], named, keep, ok))
                yield _rows(found)


def best(s: np.ndarray, ids: np.ndarray, labels: np.ndarray, own: np.ndarray, named: np.ndarray, keep: int,
         ok: np.ndarray) -> pd.DataFrame:
    """The ``keep`` best allowed rows of every column of ``s``; ties in order of (id, label).

    ``named`` holds each column's place, positive id and positive score.
    """
    n = len(ids)
    place = np.empty(n, np.int64)
    place[np.lexsort((labels, ids))] = np.arange(n)
    # Scores of 64 bits are numbered first, so that score and place fit one number.
    order = np.unique(s, return_inverse=True)[1].reshape(s.shape) if s.dtype == np.int64 else s.astype(np.int64)
    rank = np.where(ok, order * n - place[:, None], np.iinfo(np.int64).min)
    k = min(keep, n)
    top = np.argpartition(rank, n - k, axis=0)[n - k:]
    col = np.broadcast_to(np.arange(s.shape[1]), top.shape)
    good = ok[top, col]
    top, col = top[good], col[good]
    return pd.DataFrame({"anchor_id": own[col], "place": named[0][col].astype(np.int32), "positive_id": named[1][col],
                         "positive_score": named[2][col], "other_id": ids[top], "label": labels[top],
                         "score": s[top, col].astype(np.int64)})


def _rows(found: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(found, ignore_index=True)[NAMES] if found else pd.DataFrame([], columns=NAMES).astype("int64")


def _first(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id", "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _write_anchors(anchors: DataFrame, files: int, folder: str) -> None:
    """Anchors by label in ``files`` files: every block of the index opens each of them."""
    anchors.repartitionByRange("label", "id").sortWithinPartitions("label", "id").coalesce(max(1, files)).write.parquet(folder)


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
         label: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of every anchor (rows where ``is_anchor``, a condition on ``id``) and each of its positives.

    A negative's score lies between ``low`` and ``high`` percent of the
    positive's.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    spark = prepare(vectors.sparkSession)
    rows = scaled_rows(vectors, id_col, vec_col, F.col("label") if label is None else label, scale)
    size = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))).alias("largest"),
                    F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    # Enough rows in a block to be worth reading all anchors for, and enough anchors in a file.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["rows"] // STRIPE))
    files = -(-size["anchors"] // ANCHOR_FILE)
    width = max(GROUP, -(-(size["width"] or 0) // GROUP) * GROUP)
    largest = int(size["largest"] or 0) + 1
    if width * largest * largest >= 1 << 62:
        raise ValueError(f"scores of {width} components up to {largest} do not fit a long")

    first = F.min(F.struct("label", "v")).alias("r")
    chosen = rows.where(is_anchor).groupBy("id").agg(first).select("id", "r.label", "r.v")
    folder = scratch_uri(spark, "anchors")
    _write_anchors(chosen, files, folder)
    scorer = _Scorer(folder, width, largest)
    index = cut(rows.repartition(max(1, parts)).sortWithinPartitions("label", "id").mapInPandas(scorer.index, INDEX), "planes")

    def find_positives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return scorer.positives(batches, positives)

    near = _first(index.mapInPandas(find_positives, PAIRS), ["anchor_id"], positives)
    named = F.struct(F.col("rank").alias("place"), F.col("other_id").alias("id"), "score")
    bands = near.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(named)).alias("positives"))
    with_bands = scratch_uri(spark, "bands")
    _write_anchors(spark.read.parquet(folder).join(bands, "id"), files, with_bands)
    second = _Scorer(with_bands, width, largest)

    def find_negatives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return second.negatives(batches, negatives, low, high)

    out = _first(index.mapInPandas(find_negatives, PAIRS), ["anchor_id", "place"], negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))

