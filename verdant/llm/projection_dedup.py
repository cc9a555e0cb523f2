"""Embedding near-duplicates by sorted projection passes.

Equal vectors are one node.  In each pass every vector gets a key of
concatenated one-bit random hashes (signs of random projections); the vectors
are range-sorted by key, and each is compared, in double precision, with at
least its next ``window`` neighbours.  What links in a block of neighbours
leaves it as a forest of at most one edge a vector, and the forests of all
passes are united into components.

Each bit of a key is centred on the region that the bits before it name: the
first bits split a sample's vectors at their medians, the others lie around the
centre of the sample's leaf.  A region that holds many vectors is thus split as
well as the rest.  How far the vectors of each leaf are spread also tells how
often a pass brings a pair at the threshold together; passes are added until a
pair of the densest tenth is missed by at most ``MISS``.

The links of a component's members are counted exactly afterwards, as a window
does not hold all of them: small components by comparing all
members in one task; large ones by the angle to their centre, where members
within half the link angle surely link with each other and are only counted,
and the rest is compared with all members in blocks.  Counts, not pairs, leave
the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import cut, prepare
from verdant.llm.components import connected_components

THRESHOLD = 0.95
#: Passes at least, and at most where rows are many or dense.
PASSES = 12
MAX_PASSES = 64
#: Share of the pairs at the threshold that the passes may miss, by which their number is chosen.
MISS = 0.02
#: Passes whose sorted copies are shuffled at the same time.
PASSES_AT_ONCE = 4
KEY_BITS = 62
WINDOW = 256
#: Vectors that the keys' regions are learned from: bytes at most, and a leaf's vectors at least.
SAMPLE_BYTES = 32 << 20
LEAF_ROWS = 32
SEED = 20240
#: Members of a component that one task compares directly; the side of a block beyond.
GROUP_ROWS = 2048


def _unit(vectors: list[bytes]) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = np.frombuffer(b"".join(vectors), dtype="<f8").reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(column):
    """The vector as little-endian doubles; null where it is null, empty, zero or holds a null or non-finite number."""

    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for v in batch:
                x = None if v is None else np.asarray([np.nan if e is None else e for e in v] if getattr(v, "dtype", None) == object else v,
                                                      dtype="<f8") + 0.0
                out.append(x.tobytes() if x is not None and x.ndim == 1 and len(x) and np.isfinite(x).all() and x.any() else None)
            yield pd.Series(out, dtype=object)

    return pack(column)


def _planes(dim: int, pass_no: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, pass_no, dim])).standard_normal((dim, KEY_BITS))


def _keys(x: np.ndarray, pass_no: int, tree: tuple[list[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Concatenated signs of the pass's random projections, first hash in the highest bit, centred by the tree."""
    at = x @ _planes(x.shape[1], pass_no)
    bits = at > 0
    if tree:
        cuts, centres = tree
        leaf = np.zeros(len(x), dtype=np.int64)
        for j, c in enumerate(cuts):
            bits[:, j] = at[:, j] > c[leaf]
            leaf = 2 * leaf + bits[:, j]
        bits[:, len(cuts):] = (at > centres[leaf])[:, len(cuts):]
    return bits.astype(np.int64) @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))


def _grow(x: np.ndarray, pass_no: int, rows: int, window: int, threshold: float) -> tuple[tuple, np.ndarray]:
    """The pass's tree ((cuts of each level, projected centre of each leaf)) from a sample of ``rows`` vectors.

    Comes with each sampled vector's chance that a pass brings a partner at the
    threshold into its window: a bit parts them by their distance over the
    spread of their region.  Where vectors link on average it is 1.
    """
    planes = _planes(x.shape[1], pass_no)
    at, cuts, leaf = x @ planes, [], np.zeros(len(x), dtype=np.int64)
    distance, chance = math.sqrt(max(0.0, 2 - 2 * threshold)), np.ones(len(x))

    def spread(n: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(leaf, kind="stable")
        size = np.bincount(leaf, minlength=n)
        total = np.zeros((n, x.shape[1]))
        total[size > 0] = np.add.reduceat(x[order], (np.cumsum(size) - size)[size > 0], axis=0)
        mean = total / np.maximum(size, 1)[:, None]
        return mean, np.maximum(0.0, 1 - (mean * mean).sum(axis=1))

    for j in range(max(0, int(math.log2(max(1, len(x)) / LEAF_ROWS)))):
        _, var = spread(1 << j)
        if rows / (1 << j) > window:
            chance *= 1 - np.minimum(1.0, distance / (math.pi * np.sqrt(np.maximum(var, 1e-12))))[leaf]
        size = np.bincount(leaf, minlength=1 << j)
        middle = np.minimum(np.cumsum(size) - size + size // 2, len(x) - 1)
        cut_at = at[np.lexsort((at[:, j], leaf))[middle], j]
        cuts.append(cut_at)
        leaf = 2 * leaf + (at[:, j] > cut_at[leaf])
    mean, var = spread(1 << len(cuts))
    more = max(0.0, math.log2(max(1.0, rows / (1 << len(cuts)) / window)))
    chance *= (1 - np.minimum(1.0, distance / (math.pi * np.sqrt(np.maximum(var, 1e-12))))[leaf]) ** more
    chance[var[leaf] <= 1 - threshold] = 1.0
    return (cuts, mean @ planes), chance


def _sample(nodes: DataFrame, window: int) -> dict[int, tuple[np.ndarray, int]]:
    """By length, a sample of the vectors and how many there are; lengths that a window holds whole are left out."""
    size = F.octet_length("vec")
    found = nodes.groupBy(size.alias("s")).count().where(F.col("count") > window).orderBy(F.desc("count"), "s").limit(1000).collect()
    if not found:
        return {}
    total = sum(r["s"] * r["count"] for r in found)
    rate = {r["s"]: min(1.0, max(1 / 16, 4096 / r["count"]), SAMPLE_BYTES / total) for r in found}
    share = F.create_map(*[F.lit(v) for kv in rate.items() for v in kv])[size]
    rows = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < share * (1 << 20)).orderBy("node").select("vec").toPandas()["vec"]
    count = {r["s"]: r["count"] for r in found}
    return {size // 8: (_unit(part.tolist()), count[size]) for size, part in rows.groupby(rows.map(len))}


def _passes(sample: dict, least: int, most: int, window: int, threshold: float) -> int:
    """Passes after which a pair at the threshold, in the densest tenth of a length's vectors, is missed by ``MISS``."""
    need = least
    for x, rows in sample.values():
        p = min(1 - 1e-9, max(1e-9, float(np.quantile(_grow(x, 0, rows, window, threshold)[1], 0.1))))
        need = max(need, math.ceil(math.log(MISS) / math.log1p(-p)))
    return min(need, max(least, most))


def _by_dim(vectors: pd.Series) -> Iterator[np.ndarray]:
    """Positions of the vectors of each length."""
    size = vectors.map(len).to_numpy()
    for n in np.unique(size):
        yield np.flatnonzero(size == n)


def _window_pairs(nodes: DataFrame, sample: dict, rows: int, passes: range, window: int, threshold: float) -> DataFrame:
    """Pairs (a, b) that verified links of neighbours connect in the given passes."""
    spark = nodes.sparkSession
    trees = spark.sparkContext.broadcast(
        {(p, dim): _grow(x, p, n, window, threshold)[0] for p in passes for dim, (x, n) in sample.items()})
    # Parts of several windows at least, so that few windows reach beyond their neighbours.
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows * len(passes) // (8 * window)))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in _by_dim(batch["vec"]) if len(batch) else ():
                part = batch.iloc[at]
                x = _unit(part["vec"].tolist())
                for p in passes:
                    yield pd.DataFrame({"pass": p, "dim": x.shape[1], "key": _keys(x, p, trees.value.get((p, x.shape[1]))), "node": part["node"],
                                        "vec": part["vec"]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs within the partition; its first and last rows go on, for the windows over its ends."""
        from pyspark import TaskContext

        place, held, head = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not len(batch):
                continue
            first = batch.iloc[:max(0, window - head)]
            head += len(first)
            yield _ends(first, place - 1, True)
            both = batch if held is None else pd.concat([held, batch], ignore_index=True)
            yield _pairs(both, window, threshold, 0 if held is None else len(held))
            held = both.iloc[-window:]
        if held is not None:
            yield _ends(held, place, False)

    def across(group: pd.DataFrame) -> pd.DataFrame:
        order = group.sort_values(["head", "pass", "dim", "key", "node"], ignore_index=True)
        return _pairs(order, window, threshold, int((~order["head"]).sum()))[["a", "b"]]

    flat = "pass int, dim int, key long, node string, vec binary"
    sides = "a string, b string, gap int, head boolean, " + flat
    order = ["pass", "dim", "key", "node"]
    found = cut(nodes.select("node", "vec").mapInPandas(hashed, flat).repartitionByRange(parts, *order)
                     .sortWithinPartitions(*order).mapInPandas(compare, sides), "projection-pass")
    inner = found.where("gap is null").select("a", "b")
    ends = found.where("gap is not null").select("gap", "head", *order, "vec")
    return inner.union(ends.groupBy("gap").applyInPandas(across, "a string, b string"))


_SIDES = ["a", "b", "gap", "head", "pass", "dim", "key", "node", "vec"]


def _ends(rows: pd.DataFrame, gap: int, head: bool) -> pd.DataFrame:
    out = rows.assign(a=None, b=None, gap=pd.array([gap] * len(rows), dtype="Int32"), head=head)
    return out.astype({"node": object})[_SIDES]          # concatenated texts would be several Arrow chunks


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Least member of the component of each of ``n`` points that the pairs (i, j) connect."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pairs(rows: pd.DataFrame, window: int, threshold: float, known: int) -> pd.DataFrame:
    """A forest over what links within ``window`` rows, of one pass and length, the later one not among the first ``known``."""
    a, b = [], []
    node = rows["node"].to_numpy(dtype=object)
    group = rows["pass"].to_numpy(dtype=np.int64) * (1 << 32) + rows["dim"].to_numpy(dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(rows)]
    for low, high in pairwise(cuts):
        if high - low < 2 or high <= known:
            continue
        x = _unit(rows["vec"].iloc[low:high].tolist())
        for at in range(0, high - low, window):
            i, j = np.nonzero(x[at:at + window] @ x[at:at + 2 * window].T >= threshold)
            new = (j > i) & (low + at + j >= known)
            i, j = i[new], j[new]
            if len(i):
                root = _roots(i, j, min(2 * window, high - low - at))
                moved = np.flatnonzero(root != np.arange(len(root)))
                a.append(node[low + at + root[moved]])
                b.append(node[low + at + moved])
    n = sum(map(len, a))
    empty = {c: pd.Series([None] * n, dtype=object) for c in _SIDES[3:]}
    join = lambda x: pd.Series(np.concatenate(x) if x else [], dtype=object)
    return pd.DataFrame({"a": join(a), "b": join(b),
                         "gap": pd.array([None] * n, dtype="Int32")} | empty)


# -- links of each component's members -----------------------------------------------------------------

def _linked_weight(x: np.ndarray, y: np.ndarray, weight: np.ndarray, threshold: float) -> np.ndarray:
    """Per row of x the weight of the rows of y at or above the threshold."""
    out = np.zeros(len(x))
    for at in range(0, len(x), 512):
        out[at:at + 512] = (x[at:at + 512] @ y.T >= threshold) @ weight
    return out.astype(np.int64)


def _count_small(members: DataFrame, threshold: float) -> DataFrame:
    """(node, linked): copies of other nodes linked with each node, all members of a component in one task."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        x, weight = _unit(group["vec"].tolist()), group["copies"].to_numpy().astype(float)
        own = ((x * x).sum(axis=1) >= threshold) * weight
        return pd.DataFrame({"node": group["node"], "linked": _linked_weight(x, x, weight, threshold) - own.astype(np.int64)})

    return members.groupBy("component").applyInPandas(count, "node string, linked long")


def _count_large(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """As ``_count_small`` for components of any size (see the module's text)."""
    half = math.acos(min(1.0, threshold)) / 2 - 1e-6

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for component, group in batch.groupby("component"):
                rows.append((component, _unit(group["vec"].tolist()).sum(axis=0).tobytes()))
            yield pd.DataFrame(rows, columns=["component", "total"])

    def total(group: pd.DataFrame) -> pd.DataFrame:
        s = sum(np.frombuffer(b, dtype="<f8") for b in group["total"])
        return pd.DataFrame({"component": [group["component"].iloc[0]], "centre": [s.tobytes()]})

    def core(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, c = _unit(batch["vec"].tolist()), np.frombuffer(b"".join(batch["centre"]), "<f8").reshape(len(batch), -1)
                norm = np.sqrt((c * c).sum(axis=1))
                cos = (x * c).sum(axis=1) / np.where(norm > 0, norm, np.inf)
                yield batch.drop(columns="centre").assign(core=np.arccos(np.clip(cos, -1, 1)) <= half)

    def compare(group: pd.DataFrame, fringe: pd.DataFrame) -> pd.DataFrame:
        if not len(group) or not len(fringe):
            return pd.DataFrame({"node": pd.Series([], dtype=object), "linked": pd.Series([], dtype="int64")})
        x, y = _unit(group["vec"].tolist()), _unit(fringe["vec"].tolist())
        wx, wy = group["copies"].to_numpy().astype(float), fringe["copies"].to_numpy().astype(float)
        near = (y @ x.T) >= threshold
        same = fringe["node"].to_numpy()[:, None] == group["node"].to_numpy()[None, :]
        near &= ~same
        inner = group["core"].to_numpy()
        nodes = np.concatenate([fringe["node"].to_numpy(dtype=object), group["node"].to_numpy(dtype=object)[inner]])
        linked = np.concatenate([near @ wx, (wy @ near)[inner]]).astype(np.int64)
        return pd.DataFrame({"node": pd.Series(nodes, dtype=object), "linked": linked})

    centres = (members.select("component", "vec").mapInPandas(partial, "component string, total binary")
                      .groupBy("component").applyInPandas(total, "component string, centre binary"))
    schema = "component string, node string, vec binary, copies long, core boolean"
    marked = cut(members.join(centres, "component").select("component", "node", "vec", "copies", "centre")
                        .mapInPandas(core, schema), "projection-core")
    sizes = (marked.groupBy("component")
                   .agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_all"),
                        F.ceil(F.count(F.when(~F.col("core"), 1)) / block).cast("int").alias("n_fringe"),
                        F.sum(F.when(F.col("core"), F.col("copies"))).alias("core_copies")))
    sized = marked.join(sizes, "component")
    sure = sized.where("core").select("node", (F.col("core_copies") - F.col("copies")).alias("linked"))
    spot = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    left = (sized.where("n_fringe > 0").withColumn("i", spot("n_all"))
                 .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_fringe") - 1))))
    right = (sized.where(~F.col("core")).withColumn("j", spot("n_fringe"))
                  .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1))))
    keep, key = ["node", "vec", "copies", "core"], ["component", "i", "j"]
    right = right.select(*[F.col(c).alias(c) for c in (*key, *keep)])
    pairs = (left.select(*key, *keep).groupBy(*key).cogroup(right.groupBy(*key))
                 .applyInPandas(compare, "node string, linked long"))
    return sure.union(pairs).groupBy("node").agg(F.sum("linked").alias("linked"))


def find_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW,
                         group_rows: int = GROUP_ROWS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(id_col, n_links, component_id, kept) for each input row.

    ``n_links``: other rows linked directly (cosine of at least ``threshold``
    in double precision), copies included; ``component_id``: smallest id
    reachable, the row's own included; ``kept``: it is the row's own.  Rows
    whose vector is null, empty, zero or holds null or non-finite numbers,
    and rows with a null id, link with nothing (a null id has a null
    component and is kept).  Vectors of different length never link.
    Repeated rows are copies of each other.  Other columns are not read; an
    empty table gives an empty result.  What links is found with high
    probability, which grows with ``passes`` and ``window``; where rows are
    many or dense, up to ``max_passes`` passes are made.
    """
    prepare(vectors.sparkSession)
    rows = cut(vectors.select(F.col(id_col).alias("id"), _usable(F.col(vector_col)).alias("vec"))
                      .withColumn("node", F.when(F.col("id").isNotNull(), F.md5("vec"))), "projection-rows")
    nodes = cut(rows.where("node is not null").groupBy("node")
                    .agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")),
                "projection-nodes")
    pairs, n, sample = None, nodes.count(), _sample(nodes, window)
    passes = _passes(sample, passes, max_passes, window, threshold)
    for at in range(0, passes, PASSES_AT_ONCE):
        found = _window_pairs(nodes, sample, n, range(at, min(at + PASSES_AT_ONCE, passes)), window, threshold)
        pairs = found if pairs is None else pairs.union(found)
    groups = cut(connected_components(pairs, "a", "b"), "projection-groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = cut(nodes.join(groups.join(sizes, "component"), "node").select("component", "node", "vec", "copies", "size"),
                  "projection-members")
    small = _count_small(members.where(F.col("size") <= group_rows).drop("size"), threshold)
    linked = small
    if members.where(F.col("size") > group_rows).take(1):
        large = members.where(F.col("size") > group_rows).drop("size")
        linked = small.union(_count_large(large, threshold, group_rows))
    joined = (nodes.select("node", "copies", "least").join(groups, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = (joined.join(least, "component").join(linked, "node", "left")
                     .select("node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = rows.select("id", "node").join(by_node, "node", "left")
    own = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"))
