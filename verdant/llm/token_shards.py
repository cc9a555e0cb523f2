"""Token ids as raw binary shards with a minimal-perfect-hash index.

Layout of a store (a folder on storage that all executors share):

* ``ids-*.bin``: a shard's token ids, raw little-endian, 16 or 32 bits each
  (16 where the vocabulary allows), document after document in key order;
* ``ids-*.off``: little-endian unsigned 64-bit positions (in ids) at which the
  shard's documents start, and the end of the last one;
* ``keys-*.mph``: one bucket of the key index (see ``build_index``);
* Parquet manifests of shards and buckets, written by Spark.  Only files that
  a manifest names belong to the store, so a lost or repeated task leaves at
  most an unused file.

Documents are range-partitioned by key, so a shard is one task's work and the
shards follow each other in key order.  Index buckets are cut by key hash and
have a bounded number of keys each.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.common import by_file, open_new, prepare, read_range, scratch_uri

END_ID = 1
#: Keys of one index bucket, on average.
BUCKET_KEYS = 100_000
#: Pre-tokens whose ids an executor's worker remembers: so many new ones, and as many of before.
CACHE_WORDS = 400_000
#: Characters of a text that are encoded at once.
PART = 4_000_000
#: Bits of a level's table per key that is still unplaced.
GAMMA = 2.0

_MAGIC = b"MPHI0001"
_SPLIT = re.compile(r"[ \t\r\n\f\v]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
# Words whose pre-tokens are plain to find: letters of ASCII and Latin-1 in
# runs, single ASCII digits, ASCII punctuation without the apostrophe in runs.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCTUATION = r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(rf"[{_LETTER}0-9{_PUNCTUATION}]+")
_NOT_PLAIN = re.compile(rf"[^{_LETTER}0-9{_PUNCTUATION} \t\r\n\f\v]|<\|")
_PRE_TOKENS = re.compile(rf"[{_LETTER}]+|[0-9]|[{_PUNCTUATION}]+")
#: Marks a remembered word that is no plain pre-token.
_WORD = "\0"


class Encoder:
    """``encode(text)`` = the library's ids of the whole text, piece by piece.

    Only for tokenizers that drop white space, lower-case, and end every
    pre-token with an end-of-word piece; then a text's ids are those of its
    pre-tokens one after the other.  Unknown pre-tokens are encoded by the
    library, many at a time, and told apart by their end-of-word pieces.  Words
    whose pre-tokens are not plain to find are encoded whole and on their own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(size, dtype=bool)
        if self.suffix:
            for piece, i in vocab.items():
                self.ends[i] = piece.endswith(self.suffix)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _learn(self, keys: list[str]) -> None:
        plain = [k for k in keys if k[0] != _WORD]
        for at in range(0, len(plain), 2000):
            part = plain[at:at + 2000]
            ids = np.array(self._ids([" ".join(part)])[0], dtype=self.dtype)
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(part):                          # another pre-tokenizer: one by one
                self.known |= {k: self._bytes(x) for k, x in zip(part, self._ids(part), strict=True)}
                continue
            for k, a, b in zip(part, [0, *ends], ends, strict=False):
                self.known[k] = ids[a:b].tobytes()
        words = [k for k in keys if k[0] == _WORD]
        for k, ids in zip(words, self._ids([k[1:] for k in words]), strict=True):
            self.known[k] = self._bytes(ids)

    @staticmethod
    def _keys(text: str) -> list[str]:
        if not _NOT_PLAIN.search(text):
            return _PRE_TOKENS.findall(text.lower())
        out = []
        for w in _SPLIT.split(text) if _ODD_SPACE.search(text) else text.split():
            if _PLAIN.fullmatch(w) and "<|" not in w:
                out += _PRE_TOKENS.findall(w.lower())
            elif w:
                out.append(_WORD + w)
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian integers of ``dtype``."""
        if not self.suffix:
            return self._bytes(self._ids([text])[0])
        if len(text) > PART:                                    # cut at a space
            m = _SPLIT.search(text, PART)
            if m:
                return self.encode(text[:m.start()]) + self.encode(text[m.end():])
        keys, known, before = self._keys(text), self.known, self.before
        new = []
        for k in set(keys):
            if k not in known:
                if k in before:
                    known[k] = before[k]
                else:
                    new.append(k)
        if new:
            self._learn(new)
        out = b"".join([known[k] for k in keys])
        if len(known) > CACHE_WORDS:
            self.known, self.before = {}, known
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# -- minimal perfect hash -------------------------------------------------------------------------

def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; another function for each seed."""
    with np.errstate(over="ignore"):
        x = h ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class PerfectHash:
    """Levels of bit tables: a key has its slot in the first level where it is alone (Limasset et al., 2017).

    Slots are ranks of set bits over all levels, so n distinct hashes get the
    numbers 0 to n - 1.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels                       # bool arrays
        sums = [np.cumsum(x) for x in levels]
        base = np.cumsum([0, *[int(s[-1]) for s in sums]])
        self.ranks = [s + b for s, b in zip(sums, base[:-1], strict=True)]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, levels, seed = np.unique(hashes), [], 0
        while len(left):
            size = max(64, int(GAMMA * len(left)))
            at = (_mix(left, seed) % np.uint64(size)).astype(np.int64)
            count = np.bincount(at, minlength=size)
            levels.append(count == 1)
            left, seed = left[count[at] > 1], seed + 1
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 where no level has a bit (surely an unknown key)."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        live = np.arange(len(hashes))
        for seed, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (_mix(hashes[live], seed) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[live[hit]] = ranks[at[hit]] - 1
            live = live[~hit]
        return out


def key_hash(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode(), 42)


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (_mix(h, 1 << 20) >> np.uint64(32)).astype("<u4")


_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u4"), ("docs", "<u4")])


class Bucket:
    """One bucket of the index: keys -> (shard, place of the first document, number of documents)."""

    def __init__(self, mph: PerfectHash, table: np.ndarray, extra: dict[str, tuple[int, int, int]]):
        self.mph, self.table, self.extra = mph, table, extra

    @classmethod
    def build(cls, keys: list[str], shard, first, docs) -> Bucket:
        h = np.array([key_hash(k) for k in keys], dtype=np.uint64)
        own, at, n = np.unique(h, return_index=True, return_counts=True)
        # Keys that share all 64 bits of their hash can't be told apart by it: they are listed in full.
        clash = set(own[n > 1].tolist())
        extra = {k: (int(shard[i]), int(first[i]), int(docs[i])) for i, k in enumerate(keys) if int(h[i]) in clash}
        own, at = own[n == 1], at[n == 1]
        mph = PerfectHash.build(own)
        table = np.zeros(len(own), dtype=_SLOT)
        slot = mph.slots(own)
        for name, values in (("print", _fingerprint(own)), ("shard", np.asarray(shard)[at]),
                             ("first", np.asarray(first)[at]), ("docs", np.asarray(docs)[at])):
            table[name][slot] = values
        return cls(mph, table, extra)

    def find(self, keys: list[str]) -> list[tuple[int, int, int] | None]:
        h = np.array([key_hash(k) for k in keys], dtype=np.uint64)
        slot = self.mph.slots(h)
        ok = slot >= 0
        ok[ok] = self.table["print"][slot[ok]] == _fingerprint(h[ok])
        out = [tuple(int(self.table[c][s]) for c in ("shard", "first", "docs")) if good else None
               for s, good in zip(slot.tolist(), ok.tolist(), strict=True)]
        return [self.extra.get(k, x) for k, x in zip(keys, out, strict=True)] if self.extra else out

    def dump(self) -> bytes:
        import json

        parts = [_MAGIC, struct.pack("<I", len(self.mph.levels))]
        for bits in self.mph.levels:
            parts += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        extra = json.dumps(self.extra).encode()
        return b"".join([*parts, struct.pack("<QQ", len(self.table), len(extra)), self.table.tobytes(), extra])

    @classmethod
    def load(cls, data: bytes) -> Bucket:
        import json

        if data[:8] != _MAGIC:
            raise ValueError("not an index bucket")
        (n,), at, levels = struct.unpack_from("<I", data, 8), 12, []
        for _ in range(n):
            (size,) = struct.unpack_from("<Q", data, at)
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at + 8), count=size).astype(bool))
            at += 8 + width
        rows, extra = struct.unpack_from("<QQ", data, at)
        table = np.frombuffer(data, _SLOT, rows, at + 16)
        at += 16 + rows * _SLOT.itemsize
        return cls(PerfectHash(levels), table, {k: tuple(v) for k, v in json.loads(data[at:at + extra]).items()})


# -- the store ------------------------------------------------------------------------------------

_DOCS = "shard int, file string, key string, place int, n_tokens long"


def write_store(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", end_id: int = END_ID) -> TokenStore:
    """Encode every text, append ``end_id``, write shards in ascending key order and index the keys.

    Null texts are empty (their end id alone); a null key sorts first, is
    written and counted, and can't be looked up.  Repeated keys stay, one
    after the other, and are found together.  Other columns are not read.  An
    empty table gives an empty store.
    """
    spark = prepare(docs.sparkSession)
    folder = folder or scratch_uri(spark, "token-store")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), _encoder(tokenizer_path)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        name = out = None
        offsets, place = [0], 0
        for batch in batches:
            if out is None and len(batch):
                name, out = open_new(folder, f"ids-{shard:06d}", ".bin")
            sizes = []
            for text in batch["text"].tolist():
                data = (encoder.encode(text) if isinstance(text, str) else b"") + end
                out.write(data)
                sizes.append(len(data) // encoder.dtype.itemsize)
                offsets.append(offsets[-1] + sizes[-1])
            yield pd.DataFrame({"shard": shard, "file": name, "key": batch["key"], "place": range(place, place + len(batch)),
                                "n_tokens": sizes})
            place += len(batch)
        if out is not None:
            out.close()
            from verdant.llm.common import filesystem

            files, path = filesystem(folder)
            with files.open_output_stream(f"{path}/{name[:-4]}.off") as f:
                f.write(np.array(offsets, dtype="<u8").tobytes())

    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                .repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
                .select(F.col("id").cast("string").alias("key"), "text").mapInPandas(write, _DOCS))
    rows.write.parquet(f"{folder}/documents")
    manifest = spark.read.schema(_DOCS).parquet(f"{folder}/documents")
    _write_shards(manifest, folder)
    _write_index(manifest, folder)
    return TokenStore(spark, folder, _encoder(tokenizer_path).dtype.str)


def _write_shards(manifest: DataFrame, folder: str) -> None:
    """(shard, file, docs, tokens) of every shard; shards are numbered in key order."""
    (manifest.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
             .write.parquet(f"{folder}/shards"))


def _bucket(n: int):
    return F.pmod(F.shiftrightunsigned(F.xxhash64("key"), 8), F.lit(n)).cast("int")


def _write_index(manifest: DataFrame, folder: str) -> None:
    """Key buckets: a hash table file each, and the manifest ``buckets`` (bucket, of, file)."""
    keys = (manifest.where(F.col("key").isNotNull()).groupBy("key")
                    .agg(F.min("shard").alias("shard"), F.min("place").alias("first"), F.count(F.lit(1)).alias("docs")))
    n = max(1, -(-manifest.count() // BUCKET_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        b = int(group["bucket"].iloc[0])
        data = Bucket.build(group["key"].tolist(), group["shard"].to_numpy(), group["first"].to_numpy(),
                            group["docs"].to_numpy()).dump()
        name, out = open_new(folder, f"keys-{b:06d}", ".mph")
        out.write(data)
        out.close()
        return pd.DataFrame({"bucket": [b], "of": [n], "file": [name]})

    (by_file(keys.withColumn("bucket", _bucket(n)), "bucket").groupBy("bucket").applyInPandas(build, "bucket int, of int, file string")
         .write.parquet(f"{folder}/buckets"))


class TokenStore:
    """Reads a written store: single keys on the caller's side, many keys as Spark jobs."""

    def __init__(self, spark: SparkSession, folder: str, dtype: str = "<u2"):
        self.spark, self.folder, self.dtype = spark, folder, np.dtype(dtype)

    def shards(self) -> DataFrame:
        """(shard, file, docs, tokens, start): start counts the ids of all shards before it."""
        from pyspark.sql import Window

        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
        return (self.spark.read.schema("shard int, file string, docs long, tokens long").parquet(f"{self.folder}/shards")
                    .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))))

    def buckets(self) -> DataFrame:
        return self.spark.read.schema("bucket int, of int, file string").parquet(f"{self.folder}/buckets")

    def find(self, keys: DataFrame, key_col: str) -> DataFrame:
        """(key, shard, first, docs) of the distinct keys that the index knows; a shuffle of the keys alone."""
        one = self.buckets().first()
        if one is None:
            return self.spark.createDataFrame([], "key string, shard int, first int, docs int")
        folder = self.folder
        wanted = (keys.select(F.col(key_col).cast("string").alias("key")).where("key is not null").distinct()
                      .withColumn("bucket", _bucket(one["of"])))

        def look(group: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(group) and len(index):
                names = group["key"].tolist()
                bucket = Bucket.load(read_range(folder, index["file"].iloc[0]))
                found = [(k, *x) for k, x in zip(names, bucket.find(names), strict=True) if x]
            return pd.DataFrame(found, columns=["key", "shard", "first", "docs"])

        return (by_file(wanted, "bucket").groupBy("bucket").cogroup(self.buckets().groupBy("bucket"))
                      .applyInPandas(look, "key string, shard int, first int, docs int"))

    def read(self, keys: DataFrame, key_col: str, digest: bool = False) -> DataFrame:
        """(key, nth, start, n_tokens, ids or ids_crc32) of the documents under the keys, read from the shards.

        ``nth`` numbers documents that share a key.  With ``digest`` the ids'
        unsigned crc32 (as 32-bit little-endian integers) stands for them.
        """
        return self.load(self.find(keys, key_col), digest)

    def load(self, places: DataFrame, digest: bool) -> DataFrame:
        """Documents at (key, shard, first, docs), a shard's together: one pass of range reads."""
        folder, dtype = self.folder, self.dtype
        out = "key string, nth int, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>")

        def fetch(group: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
            rows = []
            if len(group) and len(shard):
                name, base = shard["file"].iloc[0], int(shard["start"].iloc[0])
                offsets = np.frombuffer(read_range(folder, f"{name[:-4]}.off"), dtype="<u8").astype(np.int64)
                order = group.sort_values("first")
                for at in range(0, len(order), 4096):              # neighbours in one range read
                    part = order.iloc[at:at + 4096]
                    low = int(offsets[part["first"].iloc[0]])
                    high = int(offsets[(part["first"] + part["docs"]).max()])
                    ids = np.frombuffer(read_range(folder, name, low * dtype.itemsize, (high - low) * dtype.itemsize), dtype)
                    for key, first, docs in zip(part["key"], part["first"], part["docs"], strict=True):
                        for nth in range(docs):
                            a, b = int(offsets[first + nth]), int(offsets[first + nth + 1])
                            own = ids[a - low:b - low]
                            rows.append((key, nth, base + a, b - a, zlib.crc32(own.astype("<u4").tobytes())
                                         if digest else own.astype(np.int32)))
            return pd.DataFrame(rows, columns=["key", "nth", "start", "n_tokens", "ids_crc32" if digest else "ids"])

        return by_file(places, "shard").groupBy("shard").cogroup(self.shards().groupBy("shard")).applyInPandas(fetch, out)

    def unkeyed(self) -> DataFrame:
        """Places of documents with a null key, for ``load``."""
        return (self.spark.read.schema(_DOCS).parquet(f"{self.folder}/documents").where("key is null")
                    .select("key", "shard", F.col("place").alias("first"), F.lit(1).alias("docs")))

    def get(self, key) -> list[np.ndarray]:
        """The ids of one key's documents: one bucket, one slot, one range read; [] if unknown."""
        text = str(key)
        one = self.buckets().first()
        if one is None:
            return []
        b = self.spark.range(1).select(F.lit(text).alias("key")).select(_bucket(one["of"]).alias("b")).first()["b"]
        row = self.buckets().where(F.col("bucket") == b).first()
        found = Bucket.load(read_range(self.folder, row["file"])).find([text])[0] if row else None
        if not found:
            return []
        shard, first, docs = found
        name = self.shards().where(F.col("shard") == shard).first()["file"]
        offsets = np.frombuffer(read_range(self.folder, f"{name[:-4]}.off", 8 * first, 8 * (docs + 1)), dtype="<u8").astype(int)
        size = self.dtype.itemsize
        return [np.frombuffer(read_range(self.folder, name, a * size, (b - a) * size), self.dtype)
                for a, b in zip(offsets, offsets[1:], strict=False)]
