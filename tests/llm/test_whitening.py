"""Whitening against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thumbwheel.llm import whitening
from thumbwheel.llm.whitening import WhitenConfig, whiten

SCHEMA = "vec_id long, embedding array<float>, n int, deviation string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, 1, "x") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(vectors, k=32, weights=None):
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors], object)
    fit = x if weights is None else np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, sums = len(fit), fit.sum(axis=0)
    z = lambda a: (a - np.array([s // n for s in sums], object)).astype(float) - np.array([(s % n) / n for s in sums])
    cov = z(fit).T @ z(fit) / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:k], vecs[:, ::-1][:, :k]
    with np.errstate(all="ignore"):
        return n, ((n * x - sums) ** 2).sum(axis=1), z(x) @ vecs / np.sqrt(values), values / np.trace(cov)


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


@pytest.mark.parametrize("weights", ["count", "one"])
@pytest.mark.parametrize("weak_keys", [False, True])
def test_like_numpy_with_a_hot_vector(spark, weights, weak_keys):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 6)) * [3, 2, 1.5, 1, 0.7, 0.4]).tolist()
    vectors += [vectors[7]] * 40
    keys = (lambda x: [F.lit(1).cast("long").alias("key_a"), F.size(x).cast("long").alias("key_b")]) if weak_keys else whitening.vector_keys
    got = collected(whiten(spark, table(spark, vectors), cfg=WhitenConfig(components=4, weights=weights), keys=keys))
    n, deviation, white, explained = plain(vectors, 4, None if weights == "count" else "one")
    assert sorted(got) == list(range(100))
    for i, row in got.items():
        assert sorted(row) == [1, 2, 3, 4]
        for c, r in row.items():
            assert (r.n, int(r.deviation)) == (n, deviation[i])
            assert abs(r.whitened) == pytest.approx(abs(white[i][c - 1]), abs=1e-9)
            assert r.explained == pytest.approx(explained[c - 1]) and r.identity_error < 1e-9
    # One sign per component for all rows.
    for c in (1, 2, 3, 4):
        assert len({round(got[i][c].whitened / white[i][c - 1]) for i in range(100)}) == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.0, 1.0], [1.0, 0.5], [-1.0, 2.0]]
    odd = [None, [], [nan, 1.0], [inf, 1.0], [-inf, 0.0], [None, 1.0], [1.0], [1.0, 2.0, 3.0]]
    df = table(spark, good + good[:1] + odd, [0, 1, None, 0, *range(10, 10 + len(odd))])
    rows = whiten(spark, df).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.component) for r in rows) == [
        (-1, 1), (-1, 2), (0, 1), (0, 1), (0, 2), (0, 2), (1, 1), (1, 2)
    ]
    assert {r.n for r in rows} == {4}
    assert whiten(spark, df.where("vec_id > 9 and vec_id < 16")).count() == 0
    assert whiten(spark, df.limit(0)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_components_without_variance(spark):
    rows = whiten(spark, table(spark, [[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]])).collect()
    assert {(r.component, r.whitened is None) for r in rows} == {(1, False), (2, True)}
    assert {r.explained for r in rows} == {1.0, 0.0} and rows[0].identity_error < 1e-12
    (a, b) = whiten(spark, table(spark, [[1.0, 5.0]])).collect()
    assert a.whitened is None and b.explained is None and a.identity_error is None and int(a.deviation) == 0


def test_large_entries_stay_exact(spark):
    vectors = [[3e12, 0.25], [-3e12, 0.5], [1e30, 0.125]]
    got = collected(whiten(spark, table(spark, vectors[:2])))
    n, deviation, _, _ = plain(vectors[:2])
    assert [int(got[i][1].deviation) for i in (0, 1)] == deviation.tolist()
    # No long holds 64e30: the entry stays at the edge, and its deviation has more than 38 digits or fits.
    assert len(whiten(spark, table(spark, vectors)).collect()) == 6


def test_only_matrices_reach_the_driver(spark):
    assert whitening.exact(np.array([3]), 1 << 62).dtype == object
    with pytest.raises(ValueError):
        WhitenConfig(weights="half")
