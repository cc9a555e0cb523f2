import numpy as np
import pytest

from verdant.llm import projection_dedup as p


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    c, out = rng.standard_normal(16), []
    out += [(i, (c + 0.22 * rng.standard_normal(16)).tolist()) for i in range(300)]
    out += [(1000 + i, rng.standard_normal(16).tolist()) for i in range(200)]
    out += [(2000 + i, out[3][1]) for i in range(5)]
    return out


def truth(rows):
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    label = np.arange(len(rows))
    ids = np.array([i for i, _ in rows])
    comp = ids.copy()
    while True:
        new = np.array([comp[near[k]].min() for k in range(len(rows))])
        if (new == comp).all():
            break
        comp = new
    del label
    return {i: (int(n) - 1, int(c)) for i, n, c in zip(ids.tolist(), near.sum(1), comp, strict=True)}


@pytest.mark.parametrize("group_rows", [2048, 40])
def test_links_and_components(spark, rows, group_rows):
    want = truth(rows)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in p.find_near_duplicates(df, group_rows=group_rows).collect()}
    assert len(got) == len(rows)
    found, true = sum(r.n_links for r in got.values()), sum(n for n, _ in want.values())
    assert 0.9 * true <= found <= true and all(got[i].n_links <= want[i][0] for i in want)
    assert sum(got[i].component_id == want[i][1] for i in want) >= 0.95 * len(want)
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_unusable_vectors(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (6, [float("inf"), 1.0]), (7, [1.0, 2.0]),
            (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (7, [1.0, 2.0]), (10, [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in p.find_near_duplicates(df).collect()), key=str)
    want = [(0, 0, None, True), *[(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10)], (7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False)]
    assert got == sorted(want, key=str)
    assert p.find_near_duplicates(df.limit(0)).count() == 0


def test_pairs_within_a_dense_region(spark):
    """Recall against a comparison of all, where two thirds of the rows are one region in which few link."""
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    region = unit(2 * unit(rng.standard_normal(64)) + unit(rng.standard_normal((12000, 64))))          # cosine about 0.8
    beside = unit(rng.standard_normal((400, 64)))
    a = region[:400]
    side = unit(beside - (beside * a).sum(1, keepdims=True) * a)
    x = np.concatenate([region, unit(rng.standard_normal((6000, 64))), 0.955 * a + np.sqrt(1 - 0.955 ** 2) * side])
    x = unit(x)
    true = np.concatenate([(x[at:at + 2000] @ x.T >= 0.95).sum(1) - 1 for at in range(0, len(x), 2000)])
    assert 800 <= true.sum() < 2000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in p.find_near_duplicates(df).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= true).all()
    assert found.sum() >= 0.98 * true.sum(), found.sum() / true.sum()
