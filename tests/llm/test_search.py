"""Vantage-point trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.vptree import SearchSettings, nearest, search_tree


def brute(rows, k):
    out = []
    for q, x in rows:
        if q % 20 == 0:
            scores = sorted((-float(np.dot(np.float64(x), np.float64(y))), v) for v, y in rows if v != q)[:k]
            out += [(q, i + 1, v) for i, (_, v) in enumerate(scores)]
    return sorted(out)


def test_factor_one_is_exact_over_shards_and_blocks(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 8)) * r.uniform(0.2, 3, size=(600, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = SearchSettings(k=5, factor=1.0, shard_rows=150, block_queries=7, leaf_rows=16)
    found = nearest(df, F.col("vec_id") % 20 == 0, s).select("query_id", "rank", "vec_id").collect()
    assert sorted(map(tuple, found)) == brute(rows, 5)


@pytest.mark.parametrize("values", ["small integers", "many equal products", "few signs"])
def test_ties_between_different_vectors_go_to_the_smaller_id(spark, values):
    """More equal products at the border than are asked for, over several shards, blocks and leaves."""
    r = np.random.default_rng(4)
    if values == "many equal products":
        x = np.array([[1.0, i] for i in range(400)])
        x[0] = x[20] = [1.0, 0.0]
    else:
        x = r.integers(-1, 2, (900, 8)).astype(float) * (1 if values == "few signs" else r.integers(1, 3, (900, 1)))
    ids = r.permutation(len(x)) if values != "many equal products" else np.arange(len(x))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True) if v.any()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = SearchSettings(k=20, shard_rows=200, block_queries=9, leaf_rows=16)
    found = nearest(df, F.col("vec_id") % 20 == 0, s).select("query_id", "rank", "vec_id").collect()
    assert sorted(map(tuple, found)) == brute(rows, 20)


def test_ties_in_one_tree():
    r = np.random.default_rng(5)
    x = np.unique(r.integers(-1, 2, (2000, 8)).astype(float), axis=0)
    x = r.permutation(x[x.any(axis=1)])
    scores = x[:100] @ x.T
    true = np.lexsort((np.broadcast_to(np.arange(len(x)), scores.shape), -scores), axis=1)[:, :21]
    assert search_tree(x, x[:100], SearchSettings(), 8 * (1 + 1e-9), 21).tolist() == true.tolist()


def test_recall_of_the_default_factor():
    r = np.random.default_rng(2)
    x = r.normal(size=(4000, 32)) + 3 * r.normal(size=(12, 32))[r.integers(0, 12, 4000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    got = search_tree(x, x[:200], SearchSettings(), 1.0 + 1e-9, 20)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(true, got, strict=True)]) >= 0.9


@pytest.mark.parametrize("shape", ["varying norms", "low rank", "few dimensions"])
def test_default_settings_lose_no_neighbour(shape):
    r = np.random.default_rng(3)
    x = r.normal(size=(4096, 4 if shape == "few dimensions" else 64))
    if shape == "varying norms":
        x *= r.lognormal(sigma=0.7, size=(4096, 1))
    elif shape == "low rank":
        x = r.normal(size=(4096, 6)) @ r.normal(size=(6, 64)) + 0.01 * x
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    got = search_tree(x, x[:200], SearchSettings(), float((x * x).sum(axis=1).max()) * (1 + 1e-9), 20)
    assert [set(g) for g in got.tolist()] == [set(t) for t in true.tolist()]


def test_ties_repeats_and_unusable_vectors(frame):
    rows = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]),
            (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (20, [0.0, 0.0])]
    got = nearest(frame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 2, 2.0), (0, 2, 3, 2.0)]


def test_empty(frame):
    assert nearest(frame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect() == []
