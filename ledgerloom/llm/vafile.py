"""Clustering around centroids with a vector-approximation file.

Vectors become integers and are written once, each beside its approximation: a cell of a few bits per dimension. The
cell borders follow the values, so that the cells of a dimension hold about as many vectors each. In every round, look-up
tables give for each cell and centroid the least and the greatest squared difference; their sums over the dimensions
enclose the distance. A vector whose nearest centroid follows from these intervals is assigned by its cells alone. Only
where intervals overlap is the vector itself compared: first with the centroid whose interval starts lowest, then with
those whose interval starts no higher than that distance.

Per round, tasks return sums per centroid, so the driver holds as many numbers as there are centroids and dimensions.
All distances and sums are exact integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged

# Larger components count as this: squared distances of 64 of them still fit 64 bits.
LARGEST = 1 << 27

_OUT = "vec_id long, cluster int, distance long"


@dataclass(frozen=True)
class ClusterSettings:
    """`bits` per cell, 1 to 8; a byte holds as many cells as fit. `salt` goes into the hash that picks the first centroids. `rows`: vectors held
    against the tables at a time."""

    k: int = 40
    rounds: int = 5
    dim: int = 64
    scale: int = 256
    salt: str = "2"
    bits: int = 6
    rows: int = 2048

    @property
    def cells(self) -> int:
        return 1 << self.bits


def _vectors(batch: pa.RecordBatch, s: ClusterSettings) -> np.ndarray:
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, s.dim)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(flat * s.scale), -LARGEST, LARGEST).astype("<i4")


def _borders(kept: DataFrame, s: ClusterSettings) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each cell, per dimension: (dim, cells) each. The inner borders are the mean of the
    quantiles of all batches, weighted by their rows; the outer ones are the extremes of all values."""
    inner = np.linspace(0, 1, s.cells + 1)[1:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = 0, np.zeros((s.dim, len(inner))), np.full(s.dim, LARGEST), np.full(s.dim, -LARGEST)
        for batch in batches:
            if batch.num_rows:
                v = _vectors(batch, s)
                n, total = n + len(v), total + len(v) * np.quantile(v, inner, axis=0).T
                low, high = np.minimum(low, v.min(axis=0)), np.maximum(high, v.max(axis=0))
        if n:
            columns = [pa.array(np.arange(s.dim)), pa.array([n] * s.dim), pa.array(low.astype(np.int64)), pa.array(high.astype(np.int64)), pa.array(total.tolist())]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "n", "low", "high", "total"])

    parts = kept.mapInArrow(run, "d long, n long, low long, high long, total array<double>")
    sums = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(len(inner))]
    found = parts.groupBy("d").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *sums).orderBy("d").collect()
    cuts = np.array([[np.ceil(r[f"t{i}"] / r["n"]) for i in range(len(inner))] for r in found]).astype(np.int64).reshape(len(found), len(inner))
    low = np.array([r["low"] for r in found], np.int64).reshape(-1, 1)
    high = np.array([r["high"] for r in found], np.int64).reshape(-1, 1)
    return np.concatenate((low, cuts), axis=1), np.concatenate((cuts - 1, high), axis=1)


def _packed(kept: DataFrame, starts: np.ndarray, s: ClusterSettings) -> DataFrame:
    """(vec_id, cells, v): approximation and integers of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch, s)
            codes = np.empty(v.shape, np.uint8)
            for d in range(s.dim):
                codes[:, d] = np.searchsorted(starts[d, 1:], v[:, d], side="right")
            per_byte = 8 // s.bits
            cells = np.zeros((len(v), s.dim // per_byte), np.uint8)
            for i in range(per_byte):
                cells |= codes[:, i::per_byte] << np.uint8(i * s.bits)
            columns = [batch.column(0), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (cells, v))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cells", "v"])

    return kept.mapInArrow(run, "vec_id long, cells binary, v binary")


def _tables(centroids: np.ndarray, low: np.ndarray, high: np.ndarray, s: ClusterSettings) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared difference to each centroid, per byte of cells: (bytes, 256, centroids) each."""
    c = centroids.T[:, None, :]
    below, above = low[:, :, None] - c, c - high[:, :, None]
    least = np.maximum(np.maximum(below, above), 0) ** 2
    # A cell that holds no value may have its borders crossed; the larger difference is right for the others.
    most = np.maximum(below**2, above**2)
    per_byte, byte = 8 // s.bits, np.arange(256)
    out = []
    for per_cell in (least, most):
        codes = [(byte >> (i * s.bits)) & (s.cells - 1) for i in range(per_byte)]
        out.append(sum(per_cell[i::per_byte][:, code] for i, code in enumerate(codes)))
    return out[0], out[1]


def assign(cells: np.ndarray, v: np.ndarray, centroids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, number of exact distances computed) per vector; ties to the smaller number."""
    least = np.zeros((len(cells), len(centroids)), np.int64)
    most = np.zeros_like(least)
    for byte in range(cells.shape[1]):
        least += tables[0][byte][cells[:, byte]]
        most += tables[1][byte][cells[:, byte]]
    open_ = least <= most.min(axis=1, keepdims=True)
    nearest, looked = open_.argmax(axis=1), np.zeros(len(cells), np.int64)
    rows = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(rows):
        guess = least[rows].argmin(axis=1)
        best = ((v[rows] - centroids[guess]) ** 2).sum(axis=1)
        rest = open_[rows] & (least[rows] <= best[:, None])
        rest[np.arange(len(rows)), guess] = False
        exact = np.full(rest.shape, np.iinfo(np.int64).max)
        exact[np.arange(len(rows)), guess] = best
        at, number = np.nonzero(rest)
        for i in range(0, len(at), 8192):
            a, b = at[i : i + 8192], number[i : i + 8192]
            exact[a, b] = ((v[rows[a]] - centroids[b]) ** 2).sum(axis=1)
        nearest[rows] = exact.argmin(axis=1)
        looked[rows] = 1 + rest.sum(axis=1)
    return nearest, looked


def _batches(batches: Iterator[pa.RecordBatch], s: ClusterSettings) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, s.rows):
            batch = whole.slice(at, s.rows)
            cells = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            v = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4").reshape(batch.num_rows, -1)
            yield batch.column(0), cells, v.astype(np.int64)


def _sums(packed: DataFrame, centroids: np.ndarray, low: np.ndarray, high: np.ndarray, s: ClusterSettings) -> list:
    """(cluster, d, n, total) of one round: the vectors of each centroid and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(centroids, low, high, s)
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, cells, v in _batches(batches, s):
            nearest, _ = assign(cells, v, centroids, tables)
            order = np.argsort(nearest, kind="stable")
            some, at = np.unique(nearest[order], return_index=True)
            total[some] += np.add.reduceat(v[order], at, axis=0)
            n += np.bincount(nearest, minlength=len(centroids))
        used = np.flatnonzero(n)
        columns = [pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    parts = packed.mapInArrow(run, "cluster int, n long, total array<long>")
    tall = parts.select("cluster", "n", F.posexplode("total").alias("d", "total"))
    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    return tall.groupBy("cluster", "d").agg(F.sum("n").alias("n"), exact).collect()


def _assigned(packed: DataFrame, centroids: np.ndarray, low: np.ndarray, high: np.ndarray, s: ClusterSettings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(centroids, low, high, s)
        for ids, cells, v in _batches(batches, s):
            nearest, _ = assign(cells, v, centroids, tables)
            distance = ((v - centroids[nearest]) ** 2).sum(axis=1)
            columns = [ids, pa.array(nearest.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return packed.mapInArrow(run, _OUT)


def centroid_clusters(vectors: DataFrame, settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """One row per kept row of `vectors` (vec_id, embedding): vec_id, cluster, distance (squared), cluster_inertia,
    inertia, centroid_sha256, centroid (the components).

    Kept are vectors of exactly `dim` components, none null or non-finite; each becomes floor(scale * component), at
    most 2^27 in size. The first centroids are the k kept vectors with the smallest hash of salt and vec_id; ties of a
    repeated id go by the vector's bytes, and a null id comes last. Fewer than k vectors give fewer centroids. Every
    round assigns all vectors, ties to the smaller number, and moves each centroid that has vectors to the floor of
    their mean. Repeated rows each count. An inertia that doesn't fit 64 bits is null. Other columns are ignored. An empty
    table gives an empty result.
    """
    s = settings
    spark = vectors.sparkSession
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(e.isNotNull() & (F.size(e) == s.dim) & fine).select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding"))
    low, high = _borders(kept, s)
    packed = staged(_packed(kept, low, s), "approximations")
    mark = F.sha2(F.concat(F.lit(f"{s.salt}:"), F.col("vec_id").cast("string")), 256)
    first = packed.select(mark.alias("mark"), "v").orderBy(F.asc_nulls_last("mark"), "v").limit(s.k).collect()
    out = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    if not first:
        return spark.createDataFrame([], f"{_OUT}, {out.split(', ', 1)[1]}")
    centroids = np.array([np.frombuffer(r["v"], "<i4") for r in first], np.int64)
    for _ in range(s.rounds):
        moved = centroids.copy()
        for r in _sums(packed, centroids, low, high, s):
            moved[r["cluster"], r["d"]] = int(r["total"]) // r["n"]
        centroids = moved

    assigned = staged(_assigned(packed, centroids, low, high, s), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")).collect()
    whole = sum(int(r["total"]) for r in sums)
    fits = lambda n: n if n < 1 << 63 else None
    rows = []
    for r in sums:
        own = centroids[r["cluster"]].tolist()
        rows.append((r["cluster"], fits(int(r["total"])), fits(whole), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), own))
    # At most k rows.
    return assigned.join(F.broadcast(spark.createDataFrame(rows, out)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
