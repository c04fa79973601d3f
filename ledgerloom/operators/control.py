"""Control totals of look-ups and allocations, taken in the pass that computes the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.allocate import allocate
from ledgerloom.operators.lookup import Key, lookup

REPORT = "step string, rows_in long, rows_out long, rows_unmatched long, amount_in double, amount_out double, amount_unmatched double"


class ControlTotals:
    """Observes rows and amounts before and after steps. Totals are known once an action has run the watched result,
    and cost no further scan; each watched result should be run once.

    More rows out than in tells that a look-up multiplied them; an amount out that differs from the amount in tells that
    weights don't add up to one or that a join dropped rows.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._steps: list[tuple[str, Observation, Observation]] = []

    def _watch(self, df: DataFrame, name: str, amount: Column, unmatched: Column | None = None) -> tuple[DataFrame, Observation]:
        seen = Observation(name)
        lost = F.lit(False) if unmatched is None else unmatched
        exact = amount.cast("decimal(38,10)")
        metrics = [F.count(F.lit(1)).alias("n"), F.sum(exact).alias("amount"), F.count_if(lost).alias("lost"), F.sum(F.when(lost, exact)).alias("amount_lost")]
        return df.observe(seen, *metrics), seen

    def lookup(
        self, step: str, facts: DataFrame, dim: DataFrame, keys: Sequence[Key], attributes: Mapping[str, str] | Sequence[str], amount: str, how: str = "left"
    ) -> DataFrame:
        """`lookup` with totals of `amount`; a row is unmatched if no row of the dimension has its key."""
        before, first = self._watch(facts, f"{step} in", F.col(amount))
        if not isinstance(attributes, Mapping):
            attributes = {a: a for a in attributes}
        joined = lookup(before, dim.withColumn("__met", F.lit(True)), keys, {**attributes, "__met": "__met"}, how)
        after, last = self._watch(joined, f"{step} out", F.col(amount), F.col("__met").isNull())
        self._steps.append((step, first, last))
        return after.drop("__met")

    def allocate(
        self, step: str, df: DataFrame, weights: DataFrame, keys: Mapping[str, str], value: str, weight: str, out: str,
        reassign: Mapping[str, tuple[str, str]], where: Column | None = None, how: str = "left",
    ) -> DataFrame:
        """`allocate` with totals of the cost that goes in and of the cost that comes out; unmatched rows have none."""
        before, first = self._watch(df, f"{step} in", F.col(value))
        spread = allocate(before, weights, keys, value, weight, out, reassign, where, how)
        after, last = self._watch(spread, f"{step} out", F.col(out), F.col(out).isNull())
        self._steps.append((step, first, last))
        return after

    def report(self) -> DataFrame:
        """One row per step, after the result was run."""
        number = lambda x: None if x is None else float(x)
        rows = []
        for step, first, last in self._steps:
            a, b = first.get, last.get
            rows.append((step, a["n"], b["n"], b["lost"], number(a["amount"]), number(b["amount"]), number(b["amount_lost"])))
        return self.spark.createDataFrame(rows, REPORT)
