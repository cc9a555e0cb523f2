"""Benchmark decontamination with suffix arrays of the training text.

Every Arrow batch of documents is a shard (cut further by text volume): its
words become integers, its suffixes are sorted into a suffix array, and every
benchmark suffix is binary-searched in it.  The search gives the range of all
places where the suffix's first ``window`` words occur, and, next to the
insertion point, the longest verbatim match and its location.  Shards are
independent, so the corpus is never shuffled.

The suffix array is sparse: words that no benchmark item of the block holds are
one break symbol, and a suffix is kept only where at least as many words as
the shortest window stand before the next break.  Other suffixes cannot hold a
window, so nothing is lost.

The benchmark is cut into blocks of bounded bytes and distinct words; each
block is broadcast on its own, and every shard searches them one by one.  Items
are not cut, as the longest match may span all of one: an item beyond the
bounds is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.llm.common import free_name, prepare

WINDOW = 10
#: Bounds of one broadcast block of the benchmark.
BLOCK_BYTES = 8 << 20
BLOCK_WORDS = 65_000          # ids of a block fit in 16 bits, unless one item alone has more
#: Text bytes of one shard.
SHARD_BYTES = 6 << 20

MATCH_TYPE = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("longest", T.LongType()),
    T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.LongType()),
])

# A-Z to lower case, 0-9, a-z and bytes of non-ASCII characters as they are,
# everything else a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text in lower case (A-Z only)."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


class Block:
    """Items of the benchmark as word ids: a vocabulary, their text and the windows to search."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        ids, starts, owners, sizes, left = [], [], [], [], []
        for k, (_, words) in enumerate(items):
            w, at = min(window, len(words)), len(ids)
            for j in range(len(words) - w + 1):
                starts.append(at + j)
                owners.append(k)
                sizes.append(w)
                left.append(len(words) - j)
            ids += [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words] + [0]
        self.text = np.array(ids, dtype=np.int64)
        self.starts, self.owners, self.sizes, self.left = (np.array(x, dtype=np.int64)
                                                           for x in (starts, owners, sizes, left))
        self.least = int(self.sizes.min()) if sizes else 0


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> Iterator[Block]:
    """The benchmark in bounded blocks, read item by item."""
    items, size, seen = [], 0, set()
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for row in rows.toLocalIterator():
        words = words_of(row["t"])
        if not words:
            continue
        new = set(words)
        if items and (size + len(row["t"]) > BLOCK_BYTES or len(seen | new) > BLOCK_WORDS):
            yield Block(items, window)
            items, size, seen = [], 0, set()
        items.append((row["i"], words))
        size += len(row["t"])
        seen |= new
    if items:
        yield Block(items, window)


def _pack(text: np.ndarray, at: np.ndarray, run: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    """Sort keys of twelve words, ``bits`` each, from ``depth`` words behind ``at``; nothing behind a break."""
    keys, per = [], 64 // bits
    for k in range(depth, depth + 12, per):
        key = np.zeros(len(at), dtype=np.uint64)
        for j in range(k, k + per):
            inside = run > j
            key = (key << np.uint64(bits)) | np.where(inside, text[np.where(inside, at + j, 0)], 0).astype(np.uint64)
        keys.append(key)
    return keys


def suffix_array(text: np.ndarray, at: np.ndarray, run: np.ndarray) -> np.ndarray:
    """``at`` in the order of the suffixes that start there (each as long as its ``run``)."""
    if not len(at):
        return at
    bits = 16 if int(text.max()) < 1 << 16 else 32        # one very long item may have more words than a block's bound
    keys = _pack(text, at, run, 0, bits)
    order = np.lexsort(keys[::-1])
    group = np.zeros(len(at), dtype=np.int64)
    group[1:] = np.cumsum(np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))
    depth = 12
    while True:                       # ties go on with the next twelve words
        size = np.bincount(group)
        longest = np.zeros(len(size), dtype=np.int64)
        np.maximum.at(longest, group, run[order])
        tied = np.flatnonzero(((size > 1) & (longest > depth))[group])
        if not len(tied):
            return at[order]
        part = order[tied]
        keys = _pack(text, at[part], run[part], depth, bits)
        sub = np.lexsort([*keys[::-1], group[tied]])
        order[tied] = part[sub]
        keys = [k[sub] for k in keys]
        new = np.ones(len(group), dtype=bool)
        new[1:] = group[1:] != group[:-1]
        inner = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        new[tied[1:]] |= inner & (tied[1:] - tied[:-1] == 1)
        group = np.cumsum(new) - 1
        depth += 12


def _compare(text, sa_at, query, q_at, length):
    """-1, 0, 1: the suffix at ``sa_at`` against ``length`` query words at ``q_at``."""
    out = np.zeros(len(q_at), dtype=np.int8)
    live, d = np.arange(len(q_at)), 0
    while len(live):
        live = live[length[live] > d]
        x, y = text[sa_at[live] + d], query[q_at[live] + d]
        out[live] = np.sign(x - y)
        live = live[(x == y)]
        d += 1
    return out


def _bound(text, sa, query, q_at, length, lo, hi, after: bool):
    """Per query the first place in sa[lo:hi] whose suffix is not below (``after``: above) it."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        live = np.flatnonzero(lo < hi)
        if not len(live):
            return lo
        mid = (lo[live] + hi[live]) >> 1
        c = _compare(text, sa[mid], query, q_at[live], length[live])
        right = c <= 0 if after else c < 0
        lo[live[right]] = mid[right] + 1
        hi[live[~right]] = mid[~right]


def _common(text, at, query, q_at, most):
    """Words that the suffix at ``at`` and the query at ``q_at`` share from their start."""
    n = np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    while len(live):
        live = live[n[live] < most[live]]
        live = live[text[at[live] + n[live]] == query[q_at[live] + n[live]]]
        n[live] += 1
    return n


def search(text: np.ndarray, block: Block):
    """All windows of the block in the shard: (covered mask, place, item, longest match) arrays.

    ``text``: word ids of the shard, 0 for words outside the block and between
    documents, with at least one 0 at its end.
    """
    breaks = np.flatnonzero(text == 0)
    inside = np.flatnonzero(text)
    run = breaks[np.searchsorted(breaks, inside)] - inside
    keep = run >= max(block.least, 1)
    at, run = inside[keep], run[keep]
    covered = np.zeros(len(text) + 1, dtype=np.int64)
    none = np.zeros(0, dtype=np.int64)
    if not len(at) or not len(block.starts):
        return covered[:-1] > 0, none, none, none
    sa = suffix_array(text, at, run)
    q, size = block.starts, block.sizes
    low = _bound(text, sa, block.text, q, size, np.zeros(len(q), np.int64), np.full(len(q), len(sa)), False)
    high = _bound(text, sa, block.text, q, size, low, np.full(len(q), len(sa)), True)
    hit = np.flatnonzero(high > low)
    if not len(hit):
        return covered[:-1] > 0, none, none, none
    # Longest match of each suffix found: it stands next to its insertion point.
    low, high, q, left = low[hit], high[hit], q[hit], block.left[hit]
    ins = _bound(text, sa, block.text, q, left, low, high, False)
    before, here = sa[np.maximum(ins - 1, low)], sa[np.minimum(ins, high - 1)]
    n_before, n_here = _common(text, before, block.text, q, left), _common(text, here, block.text, q, left)
    longest = np.maximum(n_before, n_here)
    # Equal windows have one range: mark each range once, name each item of it once.
    ranges, first = np.unique(np.stack([low, high, size[hit]]), axis=1, return_index=True)
    count = ranges[1] - ranges[0]
    places = sa[np.repeat(ranges[0], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    np.add.at(covered, places, 1)
    np.add.at(covered, places + np.repeat(ranges[2], count), -1)
    named = np.unique(np.stack([low, high, block.owners[hit]]), axis=1, return_inverse=True)
    owner_best = np.zeros(named[0].shape[1], dtype=np.int64)
    np.maximum.at(owner_best, named[1].ravel(), longest)
    count = named[0][1] - named[0][0]
    where = sa[np.repeat(named[0][0], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    item = np.repeat(named[0][2], count)
    # The longest match at one place is its own common length with the item's suffix.
    own = np.minimum(np.repeat(owner_best, count), _longest_at(text, where, block, item, named, count, low, high, q, hit))
    return np.cumsum(covered)[:-1] > 0, where, item, own


def _longest_at(text, where, block, item, named, count, low, high, q, hit):
    """Common length at each place with the (first) item suffix of its range."""
    key = {tuple(k): int(p) for k, p in zip(np.stack([low, high, block.owners[hit]]).T.tolist()[::-1],
                                            q.tolist()[::-1], strict=True)}
    start = np.array([key[tuple(k)] for k in named[0].T.tolist()], dtype=np.int64)
    q_at = np.repeat(start, count)
    zeros = np.flatnonzero(block.text == 0)
    most = zeros[np.searchsorted(zeros, q_at)] - q_at
    return _common(text, where, block.text, q_at, most)


def match_shard(texts: list[str | None], found: list[Block]) -> list[tuple]:
    """Rows of MATCH_TYPE for the documents of one shard."""
    split = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    total = int((sizes + 1).sum())
    mask = np.zeros(total, dtype=bool)
    items: dict[int, set] = {}
    best: dict[int, tuple] = {}
    for block in found:
        get, ids = block.vocabulary.get, []
        for words in split:
            ids.extend(map(get, words, repeat(0)))
            ids.append(0)
        covered, where, item, longest = search(np.array(ids, dtype=np.int64), block)
        del ids
        mask |= covered
        if len(where):
            doc = np.searchsorted(first, where, "right") - 1
            pairs = np.unique(np.stack([doc, item]), axis=1)
            for d, i in pairs.T.tolist():
                items.setdefault(d, set())
                if block.names[i] is not None:
                    items[d].add(block.names[i])
            order = np.lexsort([where, -longest, doc])
            top = order[np.unique(doc[order], return_index=True)[1]]
            for d, i, n, p in zip(doc[top].tolist(), item[top].tolist(), longest[top].tolist(),
                                  (where[top] - first[doc[top]]).tolist(), strict=True):
                if d not in best or n > best[d][0]:
                    best[d] = (n, block.names[i], p)
    hits = np.add.reduceat(mask, first, dtype=np.int64) if len(texts) else []
    out = []
    for d, n in enumerate(sizes.tolist()):
        if not hits[d]:
            out.append((n, 0, [], [], 0, None, None))
            continue
        m = np.concatenate([[0], mask[first[d]:first[d] + n].astype(np.int8), [0]])
        edge = np.flatnonzero(np.diff(m)).reshape(-1, 2)
        out.append((n, int(hits[d]), sorted(items.get(d, ())), edge.tolist(), *best.get(d, (0, None, None))))
    return out


def _shards(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= SHARD_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def match_column(benchmark: DataFrame, text: Column, item_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> Column:
    """Column of MATCH_TYPE: where benchmark windows occur in ``text``.

    A window is ``window`` consecutive words of an item; an item of fewer words
    (but not none) is one window.  ``n_hit`` counts document words inside any
    occurrence, ``spans`` are the word ranges [start, end), ``items`` the item
    ids (as sorted text) with an occurrence, ``longest`` the longest verbatim
    match in words with its item and word position.  Null and empty texts have
    no words; items without words never match; items with a null id count in
    ``n_hit`` and are not named; repeated items are named once.
    """
    spark = prepare(benchmark.sparkSession)
    shared = [spark.sparkContext.broadcast(b) for b in blocks(benchmark, item_col, text_col, window)]

    @F.pandas_udf(MATCH_TYPE)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for part in _shards(batch.tolist()):
                out += match_shard([t if isinstance(t, str) else None for t in part], _Lazy(shared))
            yield pd.DataFrame(out, columns=MATCH_TYPE.names)

    return match(text)


class _Lazy:
    """The blocks, one by one as they are iterated; with several, each is let go before the next."""

    def __init__(self, shared):
        self.shared = shared

    def __iter__(self):
        for b in self.shared:
            yield b.value
            if len(self.shared) > 1:
                b.__dict__.pop("_value", None)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "match",
                       **kw) -> DataFrame:
    """``docs`` with a column ``out`` (lengthened if taken) of MATCH_TYPE; every row and column is kept."""
    return docs.withColumn(free_name(docs, out), match_column(benchmark, F.col(text_col), **kw))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The documents that hold no benchmark window, with their own columns."""
    name = free_name(docs, "__match")
    found = find_contamination(docs, benchmark, text_col, out=name, **kw)
    return found.where(F.col(f"`{name}`.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
