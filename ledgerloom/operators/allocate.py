"""Distributing cost by weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import ColumnLike, as_column
from ledgerloom.operators.lookup import Key, lookup


def allocate(
    df: DataFrame,
    weights: DataFrame,
    keys: Mapping[str, str],
    value: str,
    weight: str,
    out: str,
    reassign: Mapping[str, tuple[str, str]],
    where: Column | None = None,
    how: str = "left",
) -> DataFrame:
    """Spread cost by weights: one row per matching weight, with `out` = value × weight.

    `keys` maps columns of `df` to columns of `weights`. `reassign` maps an output name to the
    weight column giving its value and the column of `df` used for rows that are not spread. Rows
    outside `where` are not spread: they pass once, unchanged, in the same scan. With `left`, spread
    rows without a weight stay with a NULL amount; with `inner` they are dropped.
    """
    spread = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    df = df.withColumn("__spread", spread)
    pairs = [Key(F.when(F.col("__spread"), F.col(left)), right) for left, right in keys.items()]
    carried = {source: f"__c_{source}" for source, _ in reassign.values()}
    joined = lookup(
        df, weights.withColumn("__matched", F.lit(True)), pairs, {**carried, weight: "__w", "__matched": "__matched"}
    )
    if how == "inner":
        joined = joined.filter(~F.col("__spread") | F.col("__matched"))
    amount = F.col(value).cast("double")
    reassigned = {
        name: F.when(F.col("__spread"), F.col(f"__c_{source}")).otherwise(F.col(own))
        for name, (source, own) in reassign.items()
    }
    keep = [c for c in joined.columns if not c.startswith("__") and c not in (*reassigned, out)]
    return joined.select(
        *keep, *[c.alias(n) for n, c in reassigned.items()],
        F.when(F.col("__spread"), amount * F.col("__w")).otherwise(amount).alias(out),
    )


def check_weights(weights: DataFrame, keys: Sequence[str], weight: str, tolerance: float = 1e-9) -> DataFrame:
    """Report of weight groups that do not add up to one."""
    total = weights.groupBy(*keys).agg(F.sum(weight).alias("total_weight"))
    return total.filter(F.abs(F.col("total_weight") - 1) > tolerance)


def scale_for(key: ColumnLike, match: str, value: ColumnLike, factor: float) -> Column:
    """Partial charge: the value of one key is scaled, others stay."""
    amount = as_column(value)
    return F.when(as_column(key) == match, amount * F.lit(factor)).otherwise(amount)


def cross_templates(months: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Repeat a short list of literal rows for every month, by exploding an array literal. The
    list is part of the program, so no join is involved."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    exploded = months.withColumn("__row", F.explode(F.array(*structs)))
    return exploded.select(*months.columns, "__row.*")


def cutover_union(before: DataFrame, after: DataFrame) -> DataFrame:
    """Append a table that takes over from the first one; columns are matched by name."""
    return before.unionByName(after.select(*before.columns))
