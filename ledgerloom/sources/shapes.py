"""Unions, padding, literal tables and month spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalars import ColumnLike, as_column, month_start, today


def pad(df: DataFrame, **constants: object) -> DataFrame:
    """Append constant columns so that a narrower relation fits a wider one."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in constants.items()])


def align(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename columns by position, for unions of differently named branches."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_sources(
    frames: Iterable[DataFrame], columns: Sequence[str], where: Column | None = None
) -> DataFrame:
    """One ledger out of several sources: same columns by name, same filter in front of the union
    so that it reaches every scan."""
    parts = []
    for df in frames:
        part = df if where is None else df.filter(where)
        parts.append(part.select(*columns))
    return union_all(parts)


def conform_union(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """Consolidate heterogeneous fact sets into one long table with a fixed schema."""
    parts = []
    for df in frames:
        parts.append(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]))
    return union_all(parts)


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A small table given inline; `columns` reads 'name type, name type'. The rows are an array
    literal of the plan, so Spark knows how small it is and joins broadcast it."""
    fields = [part.split() for part in columns.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def month_spine(spark: SparkSession, start: dt.date, as_of: dt.date | None = None) -> DataFrame:
    """One row per month from `start` up to the reporting date, column `month`."""
    series = F.sequence(F.lit(start), today(as_of), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(series).alias("month"))


def calendar_months(
    calendar: DataFrame, start: dt.date, as_of: dt.date | None = None, date_column: str = "full_date"
) -> DataFrame:
    """Distinct months of a calendar table between a start date and the reporting date."""
    day = F.col(date_column)
    bounded = calendar.filter((day >= F.lit(start)) & (day <= today(as_of)))
    return bounded.select(month_start(day).alias("month")).distinct()


def within_spine(c: ColumnLike, start: dt.date, as_of: dt.date | None = None) -> Column:
    """Condition equal to an inner join with the month spine: the month of `c` is one of its months. No join is
    needed, and the bounds are on `c` itself, so that they reach the file scan."""
    value = as_column(c)
    return (value >= F.trunc(F.lit(start), "MONTH")) & (value < F.add_months(F.trunc(today(as_of), "MONTH"), 1))
