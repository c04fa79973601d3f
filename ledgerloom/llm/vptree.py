"""Nearest neighbours by largest inner product, with vantage-point trees per shard.

One more coordinate, sqrt(M^2 - |x|^2) with the largest norm M (0 for queries), turns the order by inner product into
the order by Euclidean distance, for which the triangle inequality holds. Rows are dealt into shards of bounded size
and queries into blocks of bounded size; each pair of shard and block is one task group. In a group a vantage-point
tree is built: every inner node splits its rows at the median distance from a vantage point. A leaf is skipped for a
query when the lower bound that the triangle inequality gives from the leaf's ancestors, times `factor`, exceeds the
distance of the k-th best so far. `factor` 1, the default, is exact; larger ones prune more and lose neighbours, how many
depends on the vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class SearchSettings:
    k: int = 20
    factor: float = 1.0
    shard_rows: int = 8192
    block_queries: int = 4096
    leaf_rows: int = 128


def build_leaves(x: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, list[tuple[np.ndarray, list[tuple[int, float, float]]]]]:
    """(rows used as vantage points, leaves): a leaf has its rows and, per ancestor, the index of the vantage point
    and the range of distances from it. Rows too alike to split stay one leaf."""
    points: list[int] = []
    leaves = []
    stack = [(np.arange(len(x)), [])]
    pick = np.random.Generator(np.random.PCG64(11))
    while stack:
        rows, above = stack.pop()
        if len(rows) > leaf_rows:
            point = int(rows[pick.integers(len(rows))])
            far = np.sqrt(((x[rows] - x[point]) ** 2).sum(axis=1))
            inner = far <= np.median(far)
            if inner.any() and not inner.all():
                points.append(point)
                for side in (inner, ~inner):
                    stack.append((rows[side], [*above, (len(points) - 1, float(far[side].min()), float(far[side].max()))]))
                continue
        leaves.append((rows, above))
    return np.array(points, np.int64), leaves


def _best(x: np.ndarray, queries: np.ndarray, who: np.ndarray, rows: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (query, row) pairs the k with the largest product per query, ties to the smaller name, in this order."""
    cuts = range(65_536, max(len(who), 1), 65_536)
    parts = [(x[r] * queries[w]).sum(axis=1) for w, r in zip(np.split(who, cuts), np.split(rows, cuts), strict=True)]
    order = np.lexsort((names[rows], -np.concatenate(parts), who))
    who, rows = who[order], rows[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    return who[place < k], rows[place < k]


def search_tree(x: np.ndarray, queries: np.ndarray, s: SearchSettings, largest: float, k: int, names: np.ndarray | None = None) -> np.ndarray:
    """Row numbers of the k best rows per query, -1 where there are fewer; `x` original vectors, `largest` M^2. Ties go
    to the smaller of `names`, by default the row number.

    Visiting the leaves gives the k-th best product of each query, up to rounding. All rows that reach it less a margin
    for rounding are then ordered by one and the same sum of products, so that no tie is decided by the way leaves are
    visited.
    """
    names = np.arange(len(x)) if names is None else names
    lift = np.sqrt(np.maximum(largest - (x * x).sum(axis=1), 0.0))
    lifted = np.column_stack((x, lift))
    points, leaves = build_leaves(lifted, s.leaf_rows)
    own = (queries * queries).sum(axis=1)
    best = np.full((len(queries), k), -np.inf)
    low = np.zeros((len(queries), len(leaves)))
    if len(points):
        to = np.sqrt(np.maximum(own[:, None] + largest - 2 * queries @ x[points].T, 0.0))
        for j, (_, above) in enumerate(leaves):
            for p, near, far in above:
                np.maximum(low[:, j], np.maximum(near - to[:, p], to[:, p] - far), out=low[:, j])
    visited = np.zeros((len(leaves), len(queries)), bool)

    def visit(j: int, who: np.ndarray) -> None:
        visited[j, who] = True
        scores = np.concatenate((best[who], queries[who] @ x[leaves[j][0]].T), axis=1)
        best[who] = -np.partition(-scores, k - 1, axis=1)[:, :k]

    def reach(least: np.ndarray) -> np.ndarray:
        """Distance within which a row reaches a product; unbounded where there are not yet k rows."""
        known = np.where(np.isfinite(least), least, 0.0)
        return np.where(np.isfinite(least), np.sqrt(np.maximum(own + largest - 2 * known, 0.0)), np.inf)

    slack = 1e-6 * np.sqrt(largest)  # distances are rounded, the more so the shorter they are
    first = low.argmin(axis=1)
    for j in range(len(leaves)):
        who = np.flatnonzero(first == j)
        if len(who):
            visit(j, who)
    for j in np.argsort(low.mean(axis=0), kind="stable").tolist():
        who = np.flatnonzero((first != j) & (low[:, j] * s.factor <= reach(best.min(axis=1)) + slack))
        if len(who):
            visit(j, who)

    margin = 4 * x.shape[1] * np.finfo(float).eps * np.sqrt(largest * own)
    least = best.min(axis=1) - margin
    near = low <= (reach(least) + slack)[:, None]
    found = (np.empty(0, np.int64), np.empty(0, np.int64))
    for j, (rows, _) in enumerate(leaves):
        who = np.flatnonzero(visited[j] & near[:, j])
        for at in range(0, len(who), 1024):
            some = who[at : at + 1024]
            q, r = np.nonzero(queries[some] @ x[rows].T >= least[some, None])
            found = tuple(np.concatenate((old, new)) for old, new in zip(found, (some[q], rows[r]), strict=True))
            if len(found[0]) > 4 * k * len(queries) + 100_000:
                found = _best(x, queries, *found, names, k)
    who, rows = _best(x, queries, *found, names, k)
    place = np.full((len(queries), k), -1, np.int64)
    place[who, np.arange(len(who)) - np.searchsorted(who, who)] = rows
    return place


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def nearest(vectors: DataFrame, is_query: Column, settings: SearchSettings = SearchSettings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for every row of `vectors`
    (vec_id, embedding) that satisfies `is_query`, nearest first, ties to the smaller vec_id, its own id left out.

    Rows with a null id and vectors that are null, empty, zero or hold null or non-finite components take no part.
    Vectors are compared with those of the same length only. Repeated rows count once; if an id has several vectors,
    its best one counts, and as a query its first in array order is taken. Other columns are ignored.
    """
    s = settings
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & fine & F.exists(e, lambda v: v != 0))
    rows = rows.withColumn("dim", F.size("embedding"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    facts = rows.agg(F.max(norm).alias("largest"), F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    largest = float(facts["largest"] or 0.0) * (1 + 1e-9)
    shards, blocks = max(1, -(-facts["n"] // s.shard_rows)), max(1, -(-facts["q"] // s.block_queries))

    deal = F.xxhash64("vec_id")
    data = rows.withColumn("shard", F.pmod(deal, F.lit(shards)).cast("int"))
    data = data.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("is_query")
    queries = rows.where("is_query").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = queries.withColumn("dim", F.size("embedding")).withColumn("block", F.pmod(deal, F.lit(blocks)).cast("int"))
    queries = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            x, q = _matrix(left.column("embedding"), dim), _matrix(right.column("embedding"), dim)
            ids, q_ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
            # Equal vectors are one row of the tree, with the ids that can be among the k best.
            distinct, which = np.unique(x, axis=0, return_inverse=True)
            order = np.lexsort((ids, which.ravel()))
            cut = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
            members = [np.unique(ids[order[a:b]])[: s.k + 1] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            k = min(s.k + 1, len(distinct))
            smallest = np.array([m[0] for m in members])
            for i, found in enumerate(search_tree(distinct, q, s, largest, k, smallest).tolist()):
                found = [f for f in found if f >= 0]
                scores = (distinct[found] * q[i]).sum(axis=1).tolist()
                near = [(-score, v) for f, score in zip(found, scores, strict=True) for v in members[f].tolist() if v != q_ids[i]]
                out += [(int(q_ids[i]), v, -score) for score, v in sorted(near)[: s.k]]
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)), schema=schema)

    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    keys = ("dim", "shard", "block")
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
