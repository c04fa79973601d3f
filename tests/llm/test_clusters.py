"""Clustering against plain rounds over all distances."""

import hashlib
import random
from dataclasses import replace

import numpy as np
import pytest

from ledgerloom.llm import vafile as V

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, s):
    fine = [(i, v) for i, v in rows if v is not None and len(v) == s.dim and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [int(np.floor(x * s.scale)) for x in v]) for i, v in fine]
    mark = lambda i: (i is None, "" if i is None else hashlib.sha256(f"{s.salt}:{i}".encode()).hexdigest())
    first = sorted(ints, key=lambda r: (mark(r[0]), np.array(r[1], "<i4").tobytes()))
    cents = [v for _, v in first[: s.k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(cents))
    for _ in range(s.rounds):
        held = {}
        for _, v in ints:
            held.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(x) // len(held[j]) for x in zip(*held[j], strict=True)] if j in held else c for j, c in enumerate(cents)]
    found = [(i, *nearest(v)) for i, v in ints]
    out = []
    for i, d, j in found:
        own = sum(e for _, e, k in found if k == j)
        out.append((i, j, d, own, sum(e for _, e, _ in found), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, s):
    return sorted(map(tuple, V.centroid_clusters(df, s).drop("centroid").collect()), key=str)


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_equals_plain_rounds(spark, frame, bits):
    """Few distinct values give ties, equal vectors and empty clusters; the last component is constant."""
    r = random.Random(bits)
    s = replace(V.ClusterSettings(), k=9, rounds=3, dim=8, bits=bits, rows=50)
    rows = [(i, [*(r.choice([-0.5, -0.3, 0.0, 0.25, r.gauss(0, 1)]) for _ in range(7)), 1.0]) for i in range(200)]
    rows += [(300 + i, [0.25] * 8) for i in range(60)] + [(None, [0.1] * 8), (5, [0.2] * 8), (5, [0.2] * 8)]
    rows += [(400, None), (401, []), (402, [1.0] * 7), (403, [None] + [1.0] * 7), (404, [float("nan")] + [1.0] * 7), (405, [float("inf")] + [1.0] * 7)]
    assert run(frame(rows, SCHEMA).repartition(4), s) == brute(rows, s)


def test_cells_decide_where_clusters_are_apart():
    s = replace(V.ClusterSettings(), dim=8, bits=4)
    r = np.random.default_rng(1)
    centres = r.integers(-2000, 2000, (5, 8))
    v = np.concatenate([c + r.integers(-20, 20, (200, 8)) for c in centres])
    inner = np.linspace(0, 1, s.cells + 1)[1:-1]
    cuts = np.ceil(np.quantile(v, inner, axis=0).T).astype(np.int64)
    low, high = np.concatenate((v.min(0)[:, None], cuts), 1), np.concatenate((cuts - 1, v.max(0)[:, None]), 1)
    codes = np.stack([np.searchsorted(low[d, 1:], v[:, d], side="right") for d in range(8)], 1).astype(np.uint8)
    nearest, looked = V.assign(codes[:, 0::2] | codes[:, 1::2] << np.uint8(4), v, centres, V._tables(centres, low, high, s))
    assert (nearest == ((v[:, None] - centres[None]) ** 2).sum(2).argmin(1)).all()
    assert (looked > 0).mean() < 0.2


def test_fewer_vectors_than_centroids_and_large_components(spark, frame):
    s = replace(V.ClusterSettings(), dim=4)
    rows = [(1, [1e300, 0.0, 0.0, 0.0]), (2, [-1e300, 0.0, 0.0, 0.0]), (3, [0.5, 0.0, 0.0, -0.001])]
    got = run(frame(rows, SCHEMA), s)
    assert [g[2] for g in got] == [0, 0, 0] and len({g[1] for g in got}) == 3


def test_empty_table(spark, frame):
    for rows in ([], [(1, None)]):
        empty = V.centroid_clusters(frame(rows, SCHEMA))
        assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "cluster", "distance"]
