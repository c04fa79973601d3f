"""Loading tables by logical name against the declared schemas."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.schemas import SCHEMAS

Tables = Mapping[str, DataFrame]


class MissingColumns(ValueError):
    """A source lacks columns of its contract."""


def _as_declared(name: str, actual: T.DataType, declared: T.DataType) -> str | Column:
    """The column's name if its type may stay, else a cast."""
    both_instants = isinstance(actual, T.TimestampNTZType) and isinstance(declared, T.TimestampType)
    exact_amount = isinstance(actual, T.DecimalType) and isinstance(declared, T.DoubleType)
    if actual == declared or both_instants or exact_amount:
        return name
    return F.col(name).cast(declared).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns, by name, with its types. DATE/DATETIME become dates; decimal
    amounts and zone-less instants are kept as they are, and so are members shredded from a document of the contract."""
    actual = {f.name: f.dataType for f in df.schema}
    absent = [f.name for f in schema if f.name not in actual]
    if absent:
        raise MissingColumns(f"columns not found: {', '.join(absent)}")
    columns = [_as_declared(f.name, actual[f.name], f.dataType) for f in schema]
    columns += [c for c in df.columns if "__" in c and c.split("__")[0] in schema.fieldNames()]
    unchanged = all(isinstance(c, str) for c in columns) and columns == df.columns
    return df if unchanged else df.select(*columns)


class Warehouse(Mapping):
    """Logical table names mapped to Parquet paths, catalog tables or DataFrames.

    Nothing is read until a table is asked for, and only contract columns are selected, so column
    pruning and filters reach the files.
    """

    def __init__(self, spark: SparkSession, locations: Mapping[str, str | DataFrame]):
        self._spark = spark
        self._locations = dict(locations)

    def __getitem__(self, name: str) -> DataFrame:
        location = self._locations[name]
        if isinstance(location, DataFrame):
            df = location
        elif "/" in location:
            df = self._spark.read.parquet(location)
        else:
            df = self._spark.table(location)
        schema = SCHEMAS.get(name)
        return conform(df, schema) if schema is not None else df

    def __iter__(self) -> Iterator[str]:
        return iter(self._locations)

    def __len__(self) -> int:
        return len(self._locations)
