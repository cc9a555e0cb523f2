import random
import re

import pytest

from verdant.llm import decontaminate as d

DOCS = "doc_id long, text string, match string, N_HIT int"


def brute(text, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w, hit, names = words(text), set(), set()
    for name, item in items:
        iw = words(item)
        k = min(window, len(iw))
        for j in range(len(iw) - k + 1 if k else 0):
            for p in range(len(w) - k + 1):
                if w[p:p + k] == iw[j:j + k]:
                    hit |= set(range(p, p + k))
                    names |= {str(name)} if name is not None else set()
    return len(w), len(hit), sorted(names)


def longest(text, items):
    w, best = d.words_of(text), 0
    for _, item in items:
        iw = d.words_of(item)
        for p in range(len(w)):
            for j in range(len(iw)):
                n = 0
                while p + n < len(w) and j + n < len(iw) and w[p + n] == iw[j + n]:
                    n += 1
                best = max(best, n)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_brute_force(seed):
    rng = random.Random(seed)
    vocab = "a b c d é".split()
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 30)))) for i in range(6)] + [(9, "x"), (None, "a b c d")]
    items.append((7, items[0][1]))                       # repeated item
    texts = [" ".join(rng.choices(vocab + ["zz"], k=rng.randrange(0, 80))) for _ in range(20)] + ["", None, "X!", "a" * 500]
    texts += [items[1][1] + " zz " + items[1][1]]
    block = d.Block([(None if n is None else str(n), d.words_of(t)) for n, t in items if d.words_of(t)], 4)
    found = d.match_shard(texts, [block])
    for t, row in zip(texts, found, strict=True):
        assert (row[0], row[1], row[2]) == brute(t, items, 4)
        assert sum(b - a for a, b in row[3]) == row[1]
        if row[1]:
            assert row[4] == longest(t, items)


def test_suffix_array_orders_long_ties():
    import numpy as np
    rng = random.Random(1)
    text = np.array([rng.choice([1, 1, 1, 2]) for _ in range(400)] + [0], dtype=np.int64)
    at = np.arange(400)
    sa = d.suffix_array(text, at, 400 - at)
    assert sa.tolist() == sorted(range(400), key=lambda p: text[p:400].tolist())


def test_frame_nulls_blocks_clashes(spark, monkeypatch):
    items = [(1, "one two three four"), (2, "four five six seven"), (3, None), (None, "eight nine ten eleven"), (2, "four five six seven")]
    docs = [(1, "x one two three four five six seven y", "m", 1), (2, None, None, 2), (2, "", "", 2), (3, "eight nine ten eleven", "q", 3),
            (None, "One TWO, three-four", "n", 4), (5, "one two three", "n", 5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, DOCS)
    want = sorted((str(r[0]), *brute(r[1], items, 3)) for r in docs)
    for words in (d.BLOCK_WORDS, 4):                       # one block, and a block for each item
        monkeypatch.setattr(d, "BLOCK_WORDS", words)
        out = d.find_contamination(df, bench, window=3)
        assert out.columns == [*df.columns, "match_"]
        assert sorted((str(r["doc_id"]), r["match_"]["n_words"], r["match_"]["n_hit"], r["match_"]["items"]) for r in out.collect()) == want
        kept = d.decontaminate(df, bench, window=4)
        assert kept.columns == df.columns and sorted(r["text"] or "" for r in kept.collect()) == ["", "", "one two three"]
    assert d.find_contamination(df.limit(0), bench).count() == 0
    assert d.decontaminate(df, bench.limit(0)).count() == len(docs)


def test_item_of_70000_distinct_words():
    """One item alone has more words than 16 bits number."""
    rng = random.Random(4)
    item = [f"w{k}" for k in range(70_000)]
    texts = []
    for _ in range(300):                                   # a passage between words of the item in another order
        at, n = rng.randrange(len(item) - 40), rng.randrange(9, 40)
        texts.append((at, n, " ".join([*rng.choices(item, k=30), "zz", *item[at:at + n], "zz", *rng.choices(item, k=30)])))
    found = d.match_shard([t for *_, t in texts], [d.Block([("long", [w.encode() for w in item])], 10)])
    for (_, n, _), row in zip(texts, found, strict=True):
        assert row[1:3] == ((n, ["long"]) if n >= 10 else (0, []))
        assert row[3] == ([[31, 31 + n]] if n >= 10 else []) and row[4] == (n if n >= 10 else 0)
