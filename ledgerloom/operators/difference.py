"""Signed differences between two results that should agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.shared import Store, not_stored


def differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance: float = 0.0,
    store: Store = not_stored,
) -> DataFrame:
    """Keys whose summed measures or rows differ, with a reason and the difference left - right of each measure.

    Both sides are summed per key (NULL keys match each other) before they meet, so neither side's rows are multiplied.
    `reason` is 'only left', 'only right', 'value' or, where only the number of rows differs, 'rows'. A NULL sum differs
    from a number. `<measure>_left`, `_right` and `_difference` follow, and `rows_difference`.
    `store` takes the sums of either side, the left one first.
    """

    def summed(df: DataFrame, side: str) -> DataFrame:
        columns = [F.sum(m).alias(f"{m}_{side}") for m in measures]
        return df.groupBy(*keys).agg(*columns, F.count(F.lit(1)).alias(f"rows_{side}"))

    a = store("left", summed(left, "left"))
    b = store("right", summed(right, "right"))
    b = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = [a[k].eqNullSafe(b[f"__{k}"]) for k in keys]
    both = a.join(b, match, "full")

    def apart(m: str) -> Column:
        x, y = F.col(f"{m}_left"), F.col(f"{m}_right")
        return F.when(x.isNull() | y.isNull(), x.isNull() != y.isNull()).otherwise(F.abs(x - y) > F.lit(tolerance))

    values = F.lit(False)
    for m in measures:
        values = values | apart(m)
    rows = F.coalesce("rows_left", F.lit(0)) - F.coalesce("rows_right", F.lit(0))
    reason = (
        F.when(F.col("rows_right").isNull(), "only left").when(F.col("rows_left").isNull(), "only right")
        .when(values, "value").when(rows != 0, "rows")
    )
    zero = F.lit(0)
    shown = []
    for m in measures:
        difference = F.coalesce(f"{m}_left", zero) - F.coalesce(f"{m}_right", zero)
        shown += [F.col(f"{m}_left"), F.col(f"{m}_right"), difference.alias(f"{m}_difference")]
    # A key of the left side is absent, not NULL, where only the right side has the row.
    own = [F.when(F.col("rows_left").isNull(), F.col(f"__{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    out = both.select(*own, reason.alias("reason"), *shown, rows.alias("rows_difference"))
    return out.where(F.col("reason").isNotNull())
