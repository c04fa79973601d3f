"""Running totals kept per month, so that later months extend them instead of reading everything again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.sources.shared import path_exists


def monthly_sums(rows: DataFrame, month: str, measures: Sequence[str]) -> DataFrame:
    """(month, measures, n_rows): the part of the state that comes from a month's own rows."""
    return rows.groupBy(F.col(month).alias("month")).agg(*[F.sum(c).alias(c) for c in measures], F.count(F.lit(1)).alias("n_rows"))


class RunningTotals:
    """State in `path`, one row per month and measure: the month's own sum and row count, and both up to and with it.

    `extend` takes all rows of some months, new or corrected ones, and nothing of the others: totals start from the stored
    ones of the month before, and those of later months are moved on from their stored sums.
    """

    def __init__(self, spark: SparkSession, path: str, measures: Mapping[str, str]):
        self.spark, self.path, self.measures = spark, path, dict(measures)

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if path_exists(self.spark, self.path) else None

    def extend(self, rows: DataFrame, month: str) -> None:
        """Replace the months that occur in `rows`, which must hold all of their rows."""
        sums = monthly_sums(rows, month, list(self.measures))
        pairs = ", ".join(f"'{label}', CAST(`{c}` AS DECIMAL(38, 10))" for c, label in self.measures.items())
        tall = sums.selectExpr("month", "n_rows", f"stack({len(self.measures)}, {pairs}) AS (kpi, own)")
        stored = self.read()
        if stored is not None:
            first = sums.agg(F.min("month").alias("m")).first()["m"]
            if first is None:
                return
            # One row per month and measure: the state is as small as the calendar.
            opening = stored.where(F.col("month") < F.lit(first)).groupBy("kpi").agg(
                F.max_by("total", "month").alias("total"), F.max_by("seen", "month").alias("seen")
            )
            later = stored.where(F.col("month") >= F.lit(first)).select("month", "n_rows", "kpi", "own")
            replaced = tall.select("month").distinct()
            tall = tall.unionByName(later.join(replaced, "month", "left_anti"))
            start = opening.select("kpi", F.col("total").alias("__total"), F.col("seen").alias("__seen"))
            tall = tall.join(start, "kpi", "left")
        else:
            tall = tall.withColumns({"__total": F.lit(None).cast("decimal(38,10)"), "__seen": F.lit(0).cast("long")})
        w = Window.partitionBy("kpi").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
        grown, zero = F.sum("own").over(w), F.lit(0).cast("decimal(38,10)")
        known = F.col("__total").isNotNull() | grown.isNotNull()
        total = F.when(known, F.coalesce(grown, zero) + F.coalesce("__total", zero)).cast("decimal(38,10)")
        state = tall.select(
            "kpi", "own", "n_rows", total.alias("total"), (F.sum("n_rows").over(w) + F.coalesce("__seen", F.lit(0))).alias("seen"), "month"
        )
        # The months replaced are being read as well, so they are computed and written before they are overwritten.
        done = self.spark.createDataFrame(state.collect(), state.schema)
        done.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(self.path)

    def by_calendar(self, months: DataFrame) -> DataFrame:
        """(month, kpi, val_total) for the calendar's months from the first activity on; a month without any has the total
        of the one before."""
        state = self.read().select(F.col("month").cast("date").alias("month"), "kpi", "total", "seen")
        labels = F.explode(F.array(*[F.lit(label) for label in self.measures.values()])).alias("kpi")
        grid = months.select("month", labels).withColumn("__listed", F.lit(True)).join(state, ["month", "kpi"], "full")
        w = Window.partitionBy("kpi").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
        latest = grid.withColumns({
            "__last": F.last(F.when(F.col("seen").isNotNull(), F.struct("total", "seen")), ignorenulls=True).over(w),
        })
        return latest.where(F.col("__listed") & F.col("__last").isNotNull()).select("month", "kpi", F.col("__last.total").alias("val_total"))
