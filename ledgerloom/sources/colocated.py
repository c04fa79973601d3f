"""Tables stored by the same hash of their join keys, which join without moving either of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "__key"


@dataclass(frozen=True)
class Colocated:
    """A stored side: the bucketed table of rows whose keys are all known, and a path with the others."""

    table: str
    rest: str
    n_keys: int


def write_colocated(df: DataFrame, table: str, path: str, keys: Sequence[Column], buckets: int) -> Colocated:
    """Store `df` under `path` in buckets by `keys`, normalised once, here, instead of in every join, and register it as
    `table`. Both sides of a join need the same number of keys and of buckets.

    Rows with a NULL key can't match and would all fall into one bucket, so they are stored beside. A bucket is read by one
    task: where a single key holds a large share of the rows, join with `lookup`, which splits it.
    """
    named = df.withColumns({f"{KEY}{i}": k for i, k in enumerate(keys)})
    names = [f"{KEY}{i}" for i in range(len(keys))]
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull()
    # Rows go to their bucket's writer first, so that each bucket is one file, sorted by the keys.
    kept = named.where(known).repartition(buckets, *names)
    kept.write.mode("overwrite").bucketBy(buckets, *names).sortBy(*names).option("path", f"{path}/keyed").saveAsTable(table)
    named.where(~known).drop(*names).write.mode("overwrite").parquet(f"{path}/unkeyed")
    return Colocated(table, f"{path}/unkeyed", len(keys))


def join_colocated(
    spark: SparkSession, left: Colocated, right: Colocated, attributes: Mapping[str, str] | Sequence[str], how: str = "left"
) -> DataFrame:
    """`left` with attributes of `right` by an equi-join on the stored keys; no exchange stands under it."""
    if not isinstance(attributes, Mapping):
        attributes = {a: a for a in attributes}
    names = [f"{KEY}{i}" for i in range(left.n_keys)]
    dim = spark.table(right.table).select(*[F.col(n).alias(f"__r{n}") for n in names], *[F.col(a).alias(b) for a, b in attributes.items()])
    facts = spark.table(left.table)
    # Merging sorted buckets is the point, so neither side is broadcast.
    joined = facts.hint("merge").join(dim, [F.col(n) == F.col(f"__r{n}") for n in names], how).drop(*names, *[f"__r{n}" for n in names])
    if how != "left":
        return joined
    rest = spark.read.parquet(left.rest)
    types = {f.name: f.dataType for f in joined.schema}
    return joined.unionByName(rest.withColumns({b: F.lit(None).cast(types[b]) for b in attributes.values()}))
