import re
from collections import Counter

import numpy as np
import pytest

from verdant.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top, max_words=3):
    freq, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    freq.setdefault(lang, Counter())[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in freq.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in cand.items():
            cuts = [(10**6 * a * a // (f[p[:j]] * f[p[j:]]), j) for j in range(1, len(p))]
            s, j = min(cuts)
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            rows.append((-s, -a, " ".join(p).encode(), f[p[:j]], f[p[j:]]))
        rows.sort()
        out += [(lang, n + 1, p.decode(), -a, le, r, total[lang], -s) for n, (s, a, p, le, r) in enumerate(rows[:top])]
    return sorted(out)


def texts(seed=0, n=120):
    rng = np.random.default_rng(seed)
    words = ["Ab", "cd", "ef", "GH", "é", "ÀB", "x y", "\x01", "\x85z"]
    seps = [" ", " ", " ", "\t", "  ", ". ", ", ", "\n", "\x0b", "\r\n"]
    rows = [(["en", "de", None][i % 3], "".join(words[a] + seps[b] for a, b in zip(rng.zipf(1.6, 30) % 9, rng.integers(0, 10, 30))))
            for i in range(n)]
    return rows + [("en", None), ("de", ""), (None, " . "), ("fr", "lone"), *rows[:20], ("en", "Ab cd ef " * 3000)]


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_equals_brute_force(spark, max_words):
    rows = texts()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "lang string, text string, chunk string, f int").repartition(3)
    got = c.mine(df, max_words=max_words, min_count=4, top=50)
    want = brute(rows, 4, 50, max_words)
    assert len(want) > 50
    assert sorted(tuple(r) for r in got.drop("words").collect()) == want


def test_small_chunks_and_split_tiles(spark, monkeypatch):
    """Many chunks, several ranks blocks, tiles dealt to several tasks and handed on early: the same counts."""
    rng = np.random.default_rng(3)
    rows = [("en", " ".join(f"w{i}" for i in rng.zipf(1.2, 80) % 500)) for _ in range(300)]
    monkeypatch.setattr(c, "TILE_ENTRIES", 500)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    got = sorted(tuple(r) for r in c.mine(df, min_count=5, top=100).drop("words").collect())
    assert got == brute(rows, 5, 100)


def test_tile_counts_dense_and_sparse(monkeypatch):
    rng = np.random.default_rng(5)
    for x, y, size in ((0, 0, 400_000), (3, 9, 50_000)):
        lo, hi = (c.block_start(x) + 1, c.block_start(y) + 1)
        a = rng.integers(lo, lo + c.block_size(x), size).astype(np.int32)
        b = rng.integers(hi, hi + c.block_size(y), size).astype(np.int32)
        n = rng.integers(1, 5, size).astype(np.int32)
        assert set(c.block_of(a)) == {x} and set(c.block_of(b)) == {y}
        for held in (1 << 20, 30_000):
            monkeypatch.setattr(c, "HELD", held)
            import pandas as pd
            rows = pd.DataFrame([("en", x, y, a[i::7], b[i::7], n[i::7]) for i in range(7)], columns=["lang", "x", "y", "a", "b", "c"])
            got = Counter()
            for part in c.tile_counts(iter([rows])):
                for p, q, f in zip(part["a"], part["b"], part["f"]):
                    got[p, q] += f
            want = Counter()
            for p, q, f in zip(a.tolist(), b.tolist(), n.tolist()):
                want[p, q] += f
            assert got == want


def test_chunks_end_after_the_text_that_fills_them():
    import pandas as pd
    batch = pd.DataFrame({"lang": ["a", "b", "a", "a"], "text": ["x y", "y", "x " * 10, None]})
    rows = pd.concat(list(c.chunk_words(iter([batch]), limit=6)))
    assert sorted((r.lang, r.n) for r in rows.itertuples()) == [("a", 12), ("b", 1)]


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: the score of a frequent pair of very frequent words."""
    big = 3_000_000_019
    row = spark.sql(f"select (1000000BD * (cast({big - 7} as decimal(19, 0)) * cast({big - 7} as decimal(19, 0)))) "
                    f"div (cast({big} as decimal(19, 0)) * cast({big} as decimal(19, 0))) as s").first()
    assert row.s == 10**6 * (big - 7)**2 // (big * big)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert c.mine(df).collect() == []
    assert c.mine(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_whole_tiles_keep_frequent_pairs_only():
    """A tile in one part hands on its frequent pairs alone, one of several parts all its partial counts."""
    import pandas as pd
    a, b, n = (np.array(v, np.int32) for v in ([1, 2, 3], [4, 5, 6], [9, 10, 11]))
    for parts, want in ((1, [(2, 5, 10), (3, 6, 11)]), (2, [(1, 4, 9), (2, 5, 10), (3, 6, 11)])):
        rows = pd.DataFrame([("en", 0, 0, a, b, n, parts)], columns=["lang", "x", "y", "a", "b", "c", "parts"])
        got = [t for f in c.tile_counts(iter([rows]), 10) for t in f[["a", "b", "f"]].itertuples(index=False, name=None)]
        assert got == want


def test_sequences_are_read_back(tmp_path):
    for seq in (np.arange(100_000, dtype=np.int32) % 777, np.zeros(0, np.int32)):
        assert (c.read_sequence(str(tmp_path), c.write_sequence(str(tmp_path), seq)) == seq).all()


def test_large_tiles_hand_on_frequent_pairs_only(monkeypatch):
    """Beyond ``HELD`` different pairs, and split into parts: every pair's count is whole, rare pairs stay behind."""
    import pandas as pd
    monkeypatch.setattr(c, "HELD", 300)
    rng = np.random.default_rng(7)
    lo, hi = c.block_start(3) + 1, c.block_start(9) + 1
    rows, want = [], Counter()
    for _ in range(12):
        key = rng.permutation(np.r_[np.arange(40), rng.choice(np.arange(40, 20_000), 500, replace=False)])
        a, b, n = ((v).astype(np.int32) for v in (lo + key // 100, hi + key % 100, np.ones(len(key))))
        want.update(zip(a.tolist(), b.tolist()))
        rows.append(("en", 3, 9, a, b, n))
    want = {(p, q, f) for (p, q), f in want.items() if f >= 10}
    assert len(want) == 40
    tile = pd.DataFrame(rows, columns=["lang", "x", "y", "a", "b", "c"])

    def counted(frame):
        found = pd.concat(list(c.tile_counts(iter([frame]), 10)))
        return [t for t in found[["a", "b", "f"]].itertuples(index=False, name=None)]

    one = counted(tile.assign(parts=1))
    assert len(one) == 40 and set(one) == want
    for parts in (1, 7):
        split = pd.concat(list(c.split_tiles(iter([tile.assign(parts=parts)]))))
        sizes = split.assign(size=split["a"].map(len)).groupby("part")["size"].sum()
        assert len(sizes) == parts and sizes.sum() == 12 * 540 and sizes.max() < 1.5 * sizes.min()
        got = counted(split.sort_values(["lang", "x", "y", "part"], kind="stable"))
        assert len(got) == 40 and set(got) == want
