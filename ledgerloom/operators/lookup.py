"""Joins: attribute lookups and grouped values joined back, safe for hot keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Key:
    """One pair of join columns, each optionally normalised, optionally matching NULL with NULL."""

    left: str | Column
    right: str
    left_by: Callable[[Column], Column] | None = None
    right_by: Callable[[Column], Column] | None = None
    null_safe: bool = False


def same(*names: str, null_safe: bool = False) -> list[Key]:
    """Keys with one name on both sides."""
    return [Key(n, n, null_safe=null_safe) for n in names]


def _zero(*names: str) -> Column:
    """0, in a way that the optimiser doesn't turn into a constant. As one more key of a join it puts an exchange
    right under each side, even under a side that is already grouped by the other keys: Spark splits a skewed
    partition only there."""
    return F.pmod(F.xxhash64(*names), F.lit(1).cast("long"))


_SPREAD_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
_SPREAD_TASKS = 1 << 20


def _spread(df: DataFrame, taken: Iterable[str | Column]) -> Column:
    """A positive number by which rows that match nothing are dealt: a hash of at most two columns that are no keys,
    amounts and dates first. It is deterministic, so that later filters get below the join, and names so few columns
    that the scan still reads only what is asked for."""
    keys = {c for c in taken if isinstance(c, str)}
    free = [f for f in df.schema if f.name not in keys and not isinstance(f.dataType, (T.VariantType, T.MapType))]
    varied = [f.name for f in free if isinstance(f.dataType, _SPREAD_TYPES)]
    names = (varied or [f.name for f in free] or df.columns)[:2]
    return F.lit(1).cast("long") + F.pmod(F.xxhash64(*[F.col(f"`{n}`") for n in names]), F.lit(_SPREAD_TASKS).cast("long"))


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[Key],
    attributes: Mapping[str, str] | Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Add attributes of `dim` to `facts` by an equi-join.

    Spark decides from measured sizes whether the dimension is broadcast, and splits the partition of a hot key. Facts
    of a left join whose key is NULL match nothing; they are dealt by their other values, so they don't meet in one
    task. Duplicate keys in `dim` fan rows out, as a join does.
    """
    if not isinstance(attributes, Mapping):
        attributes = {name: name for name in attributes}
    clash = set(attributes.values()) & set(facts.columns)
    if clash:
        raise ValueError(f"attribute names already present: {sorted(clash)}")

    dim_keys = []
    for i, key in enumerate(keys):
        value = F.col(key.right)
        dim_keys.append((key.right_by(value) if key.right_by else value).alias(f"__k{i}"))
    names = [f"__k{i}" for i in range(len(keys))]
    dim = dim.select(*dim_keys, *[F.col(a).alias(n) for a, n in attributes.items()])
    strict = [n for n, key in zip(names, keys, strict=True) if not key.null_safe]
    if strict:
        dim = dim.filter(" AND ".join(f"{n} IS NOT NULL" for n in strict))

    values = []
    for key in keys:
        value = F.col(key.left) if isinstance(key.left, str) else key.left
        values.append(key.left_by(value) if key.left_by else value)
    left = facts.withColumns({f"__f{i}": v for i, v in enumerate(values)})
    unmatched = F.lit(False)
    for i, key in enumerate(keys):
        if not key.null_safe:
            unmatched = unmatched | F.col(f"__f{i}").isNull()
    left = left.withColumn("__deal", F.when(unmatched, _spread(facts, [k.left for k in keys])).otherwise(F.lit(0).cast("long")))
    right = dim.withColumn("__zero", _zero(*names))
    conditions = [F.col("__deal") == F.col("__zero")]
    for i, key in enumerate(keys):
        mine, other = F.col(f"__f{i}"), F.col(f"__k{i}")
        conditions.append(mine.eqNullSafe(other) if key.null_safe else mine == other)
    helpers = [*names, *[f"__f{i}" for i in range(len(keys))], "__deal", "__zero"]
    return left.join(right, conditions, how).drop(*helpers)


def without_matches(facts: DataFrame, groups: DataFrame, keys: Sequence[str], only_where: Column) -> DataFrame:
    """Drop rows that satisfy `only_where` and whose keys (NULL matching NULL) occur in `groups`.

    Rows outside `only_where` match nothing and are dealt by their other values, so they spread evenly; a hot group
    of the others is split by Spark.
    """
    deal = F.when(only_where, F.lit(0).cast("long")).otherwise(_spread(facts, keys))
    left = facts.withColumn("__deal", deal)
    names = [f"__g{i}" for i in range(len(keys))]
    right = groups.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).withColumn("__zero", _zero(*names))
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
    kept = left.join(right, [*match, F.col("__deal") == F.col("__zero")], "left_anti")
    return kept.select(*facts.columns)


def group_value(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column]
) -> DataFrame:
    """Attach group aggregates to every row of the group (NULL keys form a group).

    Same result as an unordered window, but the aggregate is combined before the shuffle and no
    task has to hold a whole group.
    """
    grouped = df.groupBy(*keys).agg(*[v.alias(n) for n, v in values.items()])
    return lookup(df, grouped, same(*keys, null_safe=True), list(values))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report of keys that several rows share, with their number. A look-up on such a key multiplies its rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def latest_by(df: DataFrame, key: str, order: str, versions: DataFrame | None = None) -> DataFrame:
    """Rows holding the greatest `order` value of their key; ties are all kept.

    `versions` gives the rows the maximum is taken over when `df` is already filtered. The join is
    on key and value together, so the versions of a hot key spread over tasks.
    """
    source = df if versions is None else versions
    newest = source.groupBy(key).agg(F.max(order).alias("__newest"))
    keys = [Key(key, key), Key(order, "__newest")]
    return lookup(df, newest.withColumn("__found", F.lit(True)), keys, ["__found"], how="inner").drop("__found")


def first_row_flag(
    df: DataFrame, key: str, order: Sequence[str], name: str = "is_first"
) -> DataFrame:
    """Flag the first row of each key under a total order; rows with a NULL key are all first.

    `order` must tell rows of one key apart. The first row is found by a minimum, which combines
    before the shuffle, not by a window over the key.
    """
    position = F.struct(*order)
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(position).alias("__first_place"))
    out = lookup(df, first, [Key(key, key)], ["__first_place"])
    is_first = F.col(key).isNull() | position.eqNullSafe(F.col("__first_place"))
    return out.withColumn(name, is_first).drop("__first_place")


def running_flag(
    df: DataFrame, keys: Sequence[str], order: str, condition: Column, name: str
) -> DataFrame:
    """1 once any row of the group at or before this one (in `order`, NULL first, ties included)
    satisfies `condition`, else 0: a running maximum.

    A row is at or after the first hit exactly when its order value is not below the group's
    smallest hit, so one minimum per group replaces an ordered window over it.
    """
    place = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("value"))
    hits = df.filter(condition).groupBy(*keys).agg(F.min(place).alias("__hit"))
    out = lookup(df, hits, same(*keys, null_safe=True), ["__hit"])
    reached = F.col("__hit").isNotNull() & (place >= F.col("__hit"))
    return out.withColumn(name, F.when(reached, 1).otherwise(0)).drop("__hit")


def share_of_total(
    df: DataFrame, keys: Sequence[str], measure: str, name: str
) -> DataFrame:
    """Ratio of a measure to its total over the group, NULL for a zero total."""
    out = group_value(df, keys, {"__total": F.sum(measure)})
    share = F.try_divide(F.col(measure).cast("double"), F.col("__total").cast("double"))
    return out.withColumn(name, share).drop("__total")
