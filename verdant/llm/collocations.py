"""Phrase collocations by direct-address tiling.

Texts are cut into pieces and words once and written as chunks: runs of about
``CHUNK_WORDS`` words of one language as local codes, with the chunk's own
vocabulary and its counts.  Then, for phrases of two, three, ... words:

1. The frequent symbols (words first, later phrases) are ranked by frequency in
   their language; the rank is the symbol's id.
2. Each chunk learns the ids of its own symbols (a join on the chunk's
   vocabulary, not on the text) and counts its neighbouring pairs.
3. Ranks fall into blocks (the first 1,024, then blocks that double), pairs into
   tiles of two blocks.  Tiles are gathered from all chunks: those with few
   enough cells are counted in an array with one cell a pair (``numpy.bincount``),
   the others as sorted coordinates.
4. Frequent pairs are ranked again and become the symbols of the next round: two
   neighbouring phrases of k words overlap in k - 1 and are one of k + 1.

Only frequent symbols can be parts of frequent phrases, so nothing is lost by
leaving out the others; all counts are exact.  No vocabulary is broadcast or
held whole in one task.  A tile with many entries is split by its pairs into
parts of about ``TILE_ENTRIES`` entries, so however large a tile grows, a pair's
counts meet in one part and only the frequent pairs are handed on.  Sequences
stay in task files and are read by the chunk's task; only their names are dealt
with the ids.

Defined results:

* a null language counts as ``und``, a null text as empty; empty texts add nothing;
* very long texts are counted whole (a text is never split over chunks);
* repeated rows count as often as they occur;
* ties are ordered by frequency, then by phrase in the order of UTF-8 bytes;
* a language has fewer than 2**31 frequent phrases of a length (their ids are ints);
* an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import by_file, cut, open_new, prepare, read_range, scratch_uri

#: Words of a chunk, about (a chunk ends after the text that reaches it).
CHUNK_WORDS = 1 << 20
#: Ranks of the first block; later blocks double.
HEAD = 1024
#: A tile of at most this many cells is counted densely.
DENSE_CELLS = 1 << 22
#: Entries that are held before they are added up or handed on, and entries of one part of a tile, about.
HELD = 1 << 20
TILE_ENTRIES = 1 << 20

#: Lower-cases A-Z, makes tabs blanks, and piece ends line feeds.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
#: Stands for a piece end among the words; no word can hold a full stop.
_END = b"."

CHUNKS = "chunk long, lang string, n long, seq string, words array<string>, counts array<long>"
TILES = "chunk long, lang string, x int, y int, start long, a array<int>, b array<int>, c array<int>, seq string"
PARTS = "lang string, x int, y int, part int, a array<int>, b array<int>, c array<int>"


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with ``_END`` after every piece."""
    if not text:
        return []
    return text.encode().translate(_FOLD).replace(b"\n", b" . ").split() + [_END]


class _Codes(dict):
    """Numbers words in order of their first occurrence; piece ends are 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def write_sequence(folder: str, seq: np.ndarray) -> str:
    """Name of a new task file with ``seq`` (its length, then its numbers compressed)."""
    name, out = open_new(folder, "sequence", ".zst")
    with out:
        out.write(np.int64(seq.nbytes).tobytes())
        out.write(pa.compress(seq.tobytes(), codec="zstd", asbytes=True))
    return name


def read_sequence(folder: str, name: str) -> np.ndarray:
    raw = read_range(folder, name)
    return np.frombuffer(pa.decompress(raw[8:], int(np.frombuffer(raw, np.int64, 1)[0]), codec="zstd", asbytes=True), np.int32)


def chunk_words(batches: Iterator[pd.DataFrame], limit: int = CHUNK_WORDS, folder: str | None = None) -> Iterator[pd.DataFrame]:
    """(lang, text) rows -> chunks with their vocabulary; ``seq`` names the file of local codes (none without a folder)."""
    held: dict[str, tuple[_Codes, list[np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            words = tokens(text if isinstance(text, str) else None)
            if len(words) < 2:
                continue
            codes, parts = held.setdefault(lang, (_Codes({_END: 0}), []))
            parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
            size += len(words)
            if size >= limit:
                yield _closed(held, folder)
                held, size = {}, 0
    if held:
        yield _closed(held, folder)


def _closed(held: dict, folder: str | None) -> pd.DataFrame:
    rows = []
    for lang, (codes, parts) in held.items():
        seq = np.concatenate(parts)
        counts = np.bincount(seq, minlength=len(codes))[1:]
        rows.append((uuid.uuid4().int >> 65, lang, int(counts.sum()), write_sequence(folder, seq) if folder else None, [w.decode() for w in codes][1:], counts))
    return pd.DataFrame(rows, columns=["chunk", "lang", "n", "seq", "words", "counts"])


def block_of(rank: np.ndarray) -> np.ndarray:
    """Block numbers of ranks from 1: 0 for the first ``HEAD``, then one per doubling."""
    q = (rank - 1) // HEAD
    return np.where(q > 0, np.floor(np.log2(np.maximum(q, 1))).astype(np.int64) + 1, 0)


def block_start(block: int) -> int:
    """Ranks before a block."""
    return HEAD << (block - 1) if block else 0


def block_size(block: int) -> int:
    return HEAD << max(block - 1, 0)


def pair_tiles(chunk: int, lang: str, symbols: np.ndarray, folder: str | None) -> pd.DataFrame:
    """A chunk's neighbouring symbols, counted and dealt into tiles.

    ``symbols`` holds the id of the symbol that starts at each place, 0 where
    there is none.  Rows are tiles; codes of pairs run on from a tile's
    ``start``.  The first row also names the file of the places' pair codes, for the next round (none without a folder).
    """
    a, b = symbols[:-1], symbols[1:]
    at = np.flatnonzero((a > 0) & (b > 0))
    key, where, count = np.unique((a[at] << 32) | b[at], return_inverse=True, return_counts=True)
    if not len(key):
        return pd.DataFrame([], columns=[f.split()[0] for f in TILES.split(", ")])
    a, b = key >> 32, key & 0xFFFFFFFF
    tile = block_of(a) * 64 + block_of(b)
    order = np.argsort(tile, kind="stable")
    a, b, count, tile = (v[order] for v in (a.astype(np.int32), b.astype(np.int32), count.astype(np.int32), tile))
    seq = None
    if folder:
        code = np.empty(len(order), np.int32)
        code[order] = np.arange(1, len(order) + 1)
        places = np.zeros(len(symbols), np.int32)
        places[at] = code[where]
        seq = write_sequence(folder, places)
    ends = [*np.flatnonzero(np.diff(tile)) + 1, len(tile)]
    rows, lo = [], 0
    for hi in ends:
        rows.append((chunk, lang, int(tile[lo]) // 64, int(tile[lo]) % 64, lo, a[lo:hi], b[lo:hi], count[lo:hi],
                     None if lo else seq))
        lo = hi
    return pd.DataFrame(rows, columns=["chunk", "lang", "x", "y", "start", "a", "b", "c", "seq"])


def part_of(a: np.ndarray, b: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair in a tile of ``parts`` parts: a hash of the pair."""
    pair = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
    hashed = pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return (hashed % np.uint64(parts)).astype(np.min_scalar_type(parts))


def split_tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks' tiles with the number of ``parts`` of their tile -> a row per part; a pair is in the same part in every chunk."""
    columns = [f.split()[0] for f in PARTS.split(", ")]
    for batch in batches:
        rows, held = [], 0
        for r in batch.itertuples(index=False):
            if r.parts == 1:
                rows.append((r.lang, r.x, r.y, 0, r.a, r.b, r.c))
            else:
                part = part_of(r.a, r.b, r.parts)
                order = np.argsort(part, kind="stable")
                part, a, b, c = (v[order] for v in (part, r.a, r.b, r.c))
                lo = 0
                for hi in [*np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]:
                    rows.append((r.lang, r.x, r.y, int(part[lo]), a[lo:hi], b[lo:hi], c[lo:hi]))
                    lo = hi
            held += len(r.a)
            if held >= HELD:
                yield pd.DataFrame(rows, columns=columns)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)


class _Tile:
    """Counts of one tile: dense cells where they are few, else sorted coordinates."""

    def __init__(self, x: int, y: int):
        self.x0, self.y0, self.width = block_start(x) + 1, block_start(y) + 1, block_size(y)
        self.cells = block_size(x) * self.width
        self.keys, self.counts, self.held = [], [], 0
        self.dense = None

    def add(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        self.keys.append((a.astype(np.int64) - self.x0) * self.width + (b.astype(np.int64) - self.y0))
        self.counts.append(c.astype(np.int64))
        self.held += len(a)

    def settle(self) -> None:
        """Add up what is held."""
        if not self.held:
            return
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        if self.cells <= DENSE_CELLS and (self.dense is not None or 8 * self.held >= self.cells):
            part = np.bincount(key, count, minlength=self.cells).astype(np.int64)
            self.dense = part if self.dense is None else self.dense + part
            self.keys, self.counts, self.held = [], [], 0
        else:
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            self.keys, self.counts, self.held = [key[first]], [np.add.reduceat(count, first)], len(first)

    def take(self, lang: str, least: int = 1) -> pd.DataFrame:
        """The counts so far that are ``least`` or more; all are then forgotten."""
        self.settle()
        if self.dense is not None:
            key = np.flatnonzero(self.dense)
            count = self.dense[key]
        else:
            key, count = (v[0] if v else np.zeros(0, np.int64) for v in (self.keys, self.counts))
        self.keys, self.counts, self.held, self.dense = [], [], 0, None
        if least > 1:
            key, count = key[count >= least], count[count >= least]
        return pd.DataFrame({"lang": lang, "a": key // self.width + self.x0, "b": key % self.width + self.y0, "f": count})


def tile_counts(batches: Iterator[pd.DataFrame], min_count: int = 1) -> Iterator[pd.DataFrame]:
    """Tiles of many chunks, sorted by (lang, x, y, part) -> (lang, a, b, f) of the pairs with ``min_count`` or more.

    Without a column ``part`` a tile is one part.  Rows may say among how many
    tasks their pairs are dealt (column ``parts``): beyond one the counts are
    partial, and all are handed on.
    """
    name, tile, least, limit = None, None, 1, HELD
    for batch in batches:
        for r in batch.itertuples(index=False):
            this = (r.lang, r.x, r.y, getattr(r, "part", 0))
            if this != name:
                if tile is not None:
                    yield tile.take(name[0], least)
                name, tile, limit = this, _Tile(r.x, r.y), HELD
                least = min_count if getattr(r, "parts", 1) == 1 else 1
            tile.add(r.a, r.b, r.c)
            if tile.held >= limit:
                tile.settle()
                limit = max(HELD, 2 * tile.held)
    if tile is not None:
        yield tile.take(name[0], least)


def ranked(counts: DataFrame, ties: list[str], name: str) -> DataFrame:
    """``counts`` (lang, f, ...) as a written table with ``id``: the rank by frequency within the language, from 1.

    A range partitioning in rank order numbers the rows in parallel: a row's
    rank is its place in its partition plus the rows of the partitions before
    (one number per language and partition).
    """
    order = ["lang", F.desc("f"), *ties]
    table = cut(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), name)
    table = table.withColumn("__part", F.shiftright("__at", 33))
    sizes = table.groupBy("lang", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("lang").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return (table.join(sizes, ["lang", "__part"]).withColumn("id", F.col("__at") - F.col("__first") + F.col("__before") + 1)
                 .drop("__at", "__part", "__n", "__first", "__before"))


def _next_tiles(sequences: DataFrame, codes: DataFrame, folder: str, last: bool) -> DataFrame:
    """Chunks whose symbols get their ids -> tiles of their pairs."""

    def tiles(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        seq = read_sequence(folder, left["seq"].iloc[0])
        lookup = np.zeros(int(seq.max()) + 1, np.int64)
        lookup[right["code"].to_numpy(np.int64)] = right["id"].to_numpy(np.int64)
        return pair_tiles(int(left["chunk"].iloc[0]), left["lang"].iloc[0], lookup[seq], None if last else folder)

    def cogrouped(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:                # no frequent symbol in this chunk
            return pd.DataFrame([], columns=[f.split()[0] for f in TILES.split(", ")])
        return tiles(left, right)

    codes = by_file(codes.withColumnRenamed("chunk", "owner"), "owner")
    return by_file(sequences, "chunk").groupBy("chunk").cogroup(codes.groupBy("owner")).applyInPandas(cogrouped, TILES)


def _pair_counts(tiles: DataFrame, min_count: int) -> DataFrame:
    """(lang, a, b, f) of the pairs that occur ``min_count`` times or more."""
    partitions = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = tiles.groupBy("lang", "x", "y").agg(F.ceil(F.sum(F.size("a")) / F.lit(TILE_ENTRIES)).cast("int").alias("parts"))
    # A row per tile (pairs of blocks, whose number grows with the logarithm of the ranks): broadcast.
    dealt = tiles.select("lang", "x", "y", "a", "b", "c").join(F.broadcast(parts), ["lang", "x", "y"]).mapInPandas(split_tiles, PARTS)
    name = ["lang", "x", "y", "part"]
    dealt = dealt.repartition(partitions, *name).sortWithinPartitions(*name)
    found = dealt.mapInPandas(lambda batches: tile_counts(batches, min_count), "lang string, a long, b long, f long")
    return cut(found, "counts")                      # written: the ranking's range partitioning reads it twice


def count_phrases(docs: DataFrame, max_words: int = 3, min_count: int = 10, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Tables of the frequent phrases of 1, 2, ... ``max_words`` words, and all words' number per language.

    A table holds lang, id, f, phrase, last (word), heads and tails (the
    frequencies of its first and of its last 1, 2, ... words), and from two
    words on a and b, the ids of its parts without the last and the first word.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    limit, folder = CHUNK_WORDS, scratch_uri(docs.sparkSession, "sequences")
    chunks = cut(texts.mapInPandas(lambda batches: chunk_words(batches, limit, folder), CHUNKS), "chunks", codec="zstd")
    total = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("phrase"))
    words = ranked(counted.agg(F.sum("w.counts").alias("f")).where(F.col("f") >= min_count), ["phrase"], "words")
    none = F.array().cast("array<long>")
    levels = [cut(words.select("lang", "id", "f", "phrase", F.col("phrase").alias("last"), none.alias("heads"), none.alias("tails")), "phrases")]

    sequences = chunks.select("chunk", "lang", "seq")
    codes = (chunks.select("chunk", "lang", F.posexplode("words").alias("pos", "phrase"))
                   .join(levels[0].select("lang", "phrase", "id"), ["lang", "phrase"])
                   .select("chunk", (F.col("pos") + 1).alias("code"), F.col("id").cast("int").alias("id")))
    for size in range(2, max_words + 1):
        tiles = cut(_next_tiles(sequences, codes, folder, last=size == max_words), "tiles", codec="zstd")
        pairs = ranked(_pair_counts(tiles, min_count), ["a", "b"], "pairs")
        levels.append(cut(_with_parts(pairs, levels[-1]), "phrases"))
        sequences = tiles.where("seq is not null").select("chunk", "lang", "seq")
        entries = tiles.select("chunk", "lang", "start", F.posexplode(F.arrays_zip("a", "b")).alias("pos", "p"))
        codes = (entries.select("chunk", "lang", (F.col("start") + F.col("pos") + 1).cast("int").alias("code"), _pair("p.a", "p.b"))
                        .join(levels[-1].select("lang", _pair("a", "b"), F.col("id").cast("int").alias("id")), ["lang", "pair"])
                        .select("chunk", "code", "id"))
    return levels, total


def _pair(a: str, b: str):
    """Two ids (below 2**31) as one number."""
    return F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b).cast("long")).alias("pair")


def _with_parts(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases with their text and the frequencies of their heads and tails, from their two parts."""
    first = shorter.select("lang", F.col("id").alias("a"), F.col("f").alias("fa"), F.col("phrase").alias("begin"), "heads")
    rest = shorter.select("lang", F.col("id").alias("b"), F.col("f").alias("fb"), "last", "tails")
    return (pairs.join(first, ["lang", "a"]).join(rest, ["lang", "b"])
                 .select("lang", "id", "f", F.concat_ws(" ", "begin", "last").alias("phrase"), "last",
                         F.concat("heads", F.array("fa")).alias("heads"), F.concat("tails", F.array("fb")).alias("tails"), "a", "b"))


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, cover: int = 50,
         text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of two to ``max_words`` words of each language, by their weakest cut.

    A cut after the first words scores floor(10**6 * a * a / (l * r)) with the
    frequencies of the phrase and of both parts (decimals: no overflow, no
    rounding).  A phrase inside a longer one that holds ``cover`` percent of
    its occurrences is dropped; frequencies fall with length, so phrases one
    word longer decide.  Returns lang, rank, phrase, words, a, l, r, n, score.
    """
    levels, total = count_phrases(docs, max_words, min_count, text_col, lang_col)
    kept = []
    for size in range(2, max_words + 1):
        table = levels[size - 1].withColumn("words", F.lit(size))
        if size < max_words:
            longer = levels[size]
            over = (longer.select("lang", F.explode(F.array("a", "b")).alias("id"), F.col("f").alias("over"))
                          .groupBy("lang", "id").agg(F.max("over").alias("over")))
            table = table.join(over, ["lang", "id"], "left").where("over is null or over * 100 < f * %d" % cover)
        cuts = F.expr(f"""array_min(transform(sequence(1, {size - 1}), j -> struct(
            (1000000BD * (cast(f as decimal(19, 0)) * cast(f as decimal(19, 0))))
              div (cast(heads[j - 1] as decimal(19, 0)) * cast(tails[{size - 1} - j] as decimal(19, 0))) as score,
            j as j, heads[j - 1] as l, tails[{size - 1} - j] as r)))""")
        kept.append(table.select("lang", "phrase", "words", F.col("f").alias("a"), cuts.alias("c"))
                         .select("lang", "phrase", "words", "a", "c.l", "c.r", "c.score"))
    every = kept[0]
    for k in kept[1:]:
        every = every.unionByName(k)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = every.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "words", "a", "l", "r", "n", "score")
