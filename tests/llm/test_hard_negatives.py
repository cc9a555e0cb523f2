import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdant.llm import hard_negatives as h


def brute(rows, every, scale=256, positives=5, negatives=3, low=50, high=95):
    use = []
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) or abs(x * scale) >= h.REACH for x in v):
            continue
        use.append((i, [math.floor(scale * x) for x in v], lab))
    out = []
    anchors = {}
    for i, v, lab in use:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    for i, (lab, v) in anchors.items():
        s = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in use if j != i)
        pos = [(j, -x) for x, j, m in s if m == lab][:positives]
        for j, ps in pos:
            neg = [(k, -x) for x, k, m in s if m != lab and low * ps <= -100 * x <= high * ps][:negatives]
            out += [(i, j, n + 1, k, ps, x) for n, (k, x) in enumerate(neg)]
    return sorted(out)


def run(spark, rows, every, **kw):
    df = spark.createDataFrame([(i, v, lab, 1) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, score int")
    return sorted(tuple(r) for r in h.mine(df, F.col("id") % every == 0, **kw).collect())


def vectors(n=400, width=20, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, width))
    return [(i, (centres[i % 4] * 0.3 + spread * rng.standard_normal(width) * 0.2).tolist(), int(rng.integers(0, 5))) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors()
    want = brute(rows, 20)
    assert len(want) > 100 and run(spark, rows, 20) == want


def test_ties_and_repeated_vectors(spark):
    rows = [(i, [0.5, 0.25, -0.125][: 1 + i % 3], i % 3) for i in range(120)] + [(200 + i, [0.4, 0.2, 0.1], i % 2) for i in range(40)]
    want = brute(rows, 10)
    assert want and run(spark, rows, 10) == want


def test_rows_that_take_no_part(spark):
    rows = vectors(150, 9) + [(None, [0.1] * 9, 1), (1000, None, 1), (1050, [0.1] * 9, None), (1100, [0.1, None] + [0.2] * 7, 2),
                              (1150, [float("nan")] * 9, 2), (1200, [float("inf")] * 9, 2), (1250, [1e30] * 9, 2), (1300, [], 2)]
    want = brute(rows, 10)
    assert want and run(spark, rows, 10) == want


def test_large_components_need_wide_sums(spark):
    rows = [(i, [x * 3000 for x in v], lab) for i, v, lab in vectors(150, 12, 2)]
    assert h.number_types(16, 3000 * 256) == (np.int32, np.int64)
    want = brute(rows, 10)
    assert want and run(spark, rows, 10) == want


def test_small_blocks_and_stripes(spark, monkeypatch):
    rows = vectors(300, 8, 4)
    monkeypatch.setattr(h, "BLOCK", 50)
    want = brute(rows, 15)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in h.mine(df, F.col("id") % 15 == 0).collect()) == want


def test_repeated_anchor_rows(spark):
    rows = vectors(100, 8, 5)
    rows += [rows[0], (0, rows[1][1], 9), rows[20]]
    got = run(spark, rows, 20)
    assert got == brute(rows, 20)


@pytest.mark.parametrize("seed", range(3))
def test_scores_equal_the_inner_products(seed):
    rng = np.random.default_rng(seed)
    largest = [3, 700, 200_000][seed]
    a, v = rng.integers(-largest, largest, (7, 24)), rng.integers(-largest, largest, (90, 24))
    planes = h.pack(v, int(largest).bit_length() + 1)
    plane, wide = h.number_types(24, largest)
    assert (h.scores(h.subset_sums(a, plane), planes, wide) == v @ a.T).all()


def test_empty_and_no_partners(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(0, [1.0], 1)], 5) == []
    assert run(spark, [(0, [1.0], 1), (1, [1.0], 1)], 5) == []
