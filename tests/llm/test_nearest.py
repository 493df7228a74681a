"""Operator 7 against brute force."""

import numpy as np
import pytest

from cohortlens.llm import cross_polytope as X

IS_QUERY = "vec_id % 20 = 0"


def frame(spark, ids, rows, kind="float"):
    return spark.createDataFrame([(None if i is None else int(i), r) for i, r in zip(ids, rows, strict=True)],
                                 f"vec_id long, embedding array<{kind}>")


def brute(ids, m, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (m * m[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), s[i]) for i in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, m = t["vec_id"].to_numpy(), np.array(t["embedding"].tolist(), dtype=float)
    got, want = results(X.op7_nearest(spark, sf)), brute(ids, m, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) > 0.95
    place = {i: r for i, r in zip(ids, m, strict=True)}
    for q, v in got.items():
        assert v == sorted(v, key=lambda x: (-x[1], x[0])) and q not in [i for i, _ in v]
        assert all(s == (place[q] * place[i]).sum() for i, s in v)


def test_unequal_lengths_and_blocks(spark):
    rng = np.random.default_rng(4)
    m = (rng.normal(size=(600, 10)) * rng.uniform(0.2, 3, size=(600, 1)))
    ids = np.arange(600)
    got = results(X.nearest(frame(spark, ids, m.tolist(), "double"), IS_QUERY, block_rows=20))
    assert recall(got, brute(ids, m, 20)) > 0.9


def test_few_vectors_give_all(spark):
    rng = np.random.default_rng(5)
    m, ids = rng.normal(size=(15, 64)), np.arange(15)
    got = results(X.nearest(frame(spark, ids, m.tolist(), "double"), IS_QUERY))
    assert [i for i, _ in got[0]] == [i for i, _ in brute(ids, m, 20)[0]]


def test_equal_vectors_and_ties(spark):
    m = np.array([[1.0, 0.0]] * 200 + [[0.0, 1.0]] * 5)
    ids = np.arange(205)
    got = results(X.nearest(frame(spark, ids, m.tolist()), IS_QUERY))
    want = brute(ids, m, 20)
    assert set(got) == set(want)
    assert got[0] == [(i, 1.0) for i in range(1, 21)] and got[100] == [(i, 1.0) for i in range(20)]
    assert [i for i, _ in got[200]][:4] == [201, 202, 203, 204]


def test_unusable_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [[1.0, 2.0], None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [2.0, 1.0], [1.0, 2.0, 3.0], [1.0, 1.0],
            [1.0, 2.0], [3.0, 3.0]]
    ids = [0, 20, 40, 60, 80, 100, 120, 1, 140, 2, 0, None]
    got = results(X.nearest(frame(spark, ids, rows, "double"), IS_QUERY))
    assert got == {0: [(1, 4.0), (2, 3.0)]}
    assert X.nearest(frame(spark, [], []), IS_QUERY).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(X.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    h = X.hadamard(np.eye(4)) * 2
    assert np.allclose(h @ h.T, 4 * np.eye(4)) and set(h.ravel()) == {1.0, -1.0}


def met(spark, sf):
    """Share of (query, candidate) pairs that are ranked, from the buckets and limits of the operator itself."""
    t = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = X.clean(t.select("vec_id", "embedding"))
    m = np.array([r["embedding"] for r in t.select("embedding").collect()], dtype=float)
    index = X.indexed(rows, X.TABLES, {64: float(np.linalg.norm(m, axis=1).max())}, "<f4").cache()
    n = index.count()
    shares = {64: X.ranked_share(n, X.K, X.SHARE)}
    asked = X._asked(rows.where(IS_QUERY), X.TABLES, shares, {64: 3}, X.fitted_sample(index, {64: n}), "<f4").collect()
    bucket = np.array([r["axes"] for r in index.select("axes").collect()])
    pairs, ids = 0, sorted({r["id"] for r in asked})
    for i in ids:
        hit = np.zeros(n, dtype=bool)
        for r in (r for r in asked if r["id"] == i):
            own = bucket[:, r["table"] * X.ROTATIONS:(r["table"] + 1) * X.ROTATIONS]
            near = X.near_axes(X._unit_queries(np.array([r["v"]], dtype=float)), r["table"])
            hit |= (X._sums(near, np.array([0]), own)[0] >= r["least"]) & np.isin(own[:, 0], r["first"])
        pairs += hit.sum()
    return pairs / (n * len(ids))


def test_share_of_candidates_falls(spark):
    small, large = met(spark, "/root/testdata/sf0.01"), met(spark, "/root/testdata/sf0.1")
    print("share of candidates ranked", small, large)
    assert large < 0.2 and large < small


def test_hot_vectors_split_on_both_sides(spark):
    """A third of the rows in one narrow cone: its block is split by candidates and by queries."""
    rng = np.random.default_rng(7)
    m = rng.normal(size=(3000, 16))
    m[:1000] = m[0] + rng.normal(size=(1000, 16)) * 0.01
    ids = np.arange(3000)
    got = results(X.nearest(frame(spark, ids, m.tolist(), "double"), "vec_id % 2 = 0", block_rows=100))
    want = {q: w for q, w in brute(ids, m, 20).items()}
    assert len(got) == 1500
    assert recall(got, want) > 0.9
