import os
import random
import zlib

import numpy as np
import pytest

from verdant.llm import token_shards as t

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_encoder_equals_library(library):
    rng = random.Random(2)
    own = t.Encoder(PATH)
    cases = ["", " ", "don't we'll 'sx x's", "İstanbul ΣΑΣ Σ", "a\x1cb \x85c d e", "é é ①½ 12ab", "<|endoftext|> x<|startoftext|>", "👍🏽 日本",
             *["".join(rng.choices("abcXé'.,!-<|1 9\n\tßĳ", k=k)) for k in range(120)]]
    for c in cases:
        got = np.frombuffer(own.encode(c), own.dtype).tolist()
        assert got == library.encode(c, add_special_tokens=False).ids, repr(c)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    mph = t.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    bucket = t.Bucket.build([str(k) for k in range(3000)], np.arange(3000) % 7, np.arange(3000), np.ones(3000, int))
    bucket = t.Bucket.load(bucket.dump())
    assert bucket.find([str(k) for k in range(3000)]) == [(k % 7, k, 1) for k in range(3000)]
    assert sum(x is not None for x in bucket.find([f"no{k}" for k in range(2000)])) <= 1
    empty = t.Bucket.load(t.Bucket.build([], np.array([]), np.array([]), np.array([])).dump())
    assert empty.find(["1"]) == [None]


def test_keys_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(t, "key_hash", lambda k: int(k) // 2)
    bucket = t.Bucket.load(t.Bucket.build([str(k) for k in range(10)], np.arange(10), np.arange(10), np.ones(10, int)).dump())
    assert bucket.find([str(k) for k in range(10)]) == [(k, k, 1) for k in range(10)]


def test_store(spark, library):
    rows = [(5, "Hello world", 1), (3, None, 1), (4, "", 1), (None, "nobody's", 1), (9, "word " * 3000, 1), (9, "again", 1), (-2, "tie", 1), (-2, "tie", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, file int")
    store = t.write_store(df.repartition(3), PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = {}, 0
    for i, text, _ in order:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.setdefault(i, []).append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    got = store.load(store.find(df, "doc_id").unionByName(store.unkeyed()), digest=True).collect()
    assert sorted((str(r.key), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), *x[:3]) for k, v in want.items() for x in v)
    assert [x.tolist() for x in store.get(9)] == [x[3] for x in want[9]]
    assert store.get(12345) == []
    ids = {(r.key, r.nth): list(r.ids) for r in store.read(df.where("doc_id = 5"), "doc_id").collect()}
    assert ids == {("5", 0): want[5][0][3]}


def test_empty_store(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    store = t.write_store(df, PATH)
    assert store.read(df, "doc_id", digest=True).count() == 0 and store.get(1) == []
