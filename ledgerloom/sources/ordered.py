"""Results written in a global order: range-partitioned files, a range index beside them, global places."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACE = "__place"
_TIE = "__tie"
INDEX = "_ranges"


def _sort_keys(order: Mapping[str, str]) -> list:
    unknown = [d for d in order.values() if d not in ("asc", "desc")]
    if unknown or not order:
        raise ValueError(f"order must map columns to 'asc' or 'desc', got {dict(order)}")
    return [F.col(c).asc() if d == "asc" else F.col(c).desc() for c, d in order.items()]


def write_ordered(df: DataFrame, path: str, order: Mapping[str, str]) -> None:
    """Write `df` in the order of the given columns ('asc', NULL first, or 'desc', NULL last).

    Spark samples the order's values, deals rows into ranges and sorts each range, so no task holds the whole result and
    every file covers one range. Rows with equal values are told apart by a hash of the row, so that a value held by very
    many rows still spreads over ranges. Beside the files, in `_ranges`, stand the first place, the number of rows and the
    extremes of the leading column of each range. The table is new or replaced as a whole.
    """
    keys = [*_sort_keys(order), F.col(_TIE)]
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (T.VariantType, T.MapType))]
    ranged = df.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in hashed])).repartitionByRange(*keys)
    # The number is that of the range and of the row within it, in file order.
    placed = ranged.sortWithinPartitions(*keys).drop(_TIE).withColumn(PLACE, F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(path)

    spark, lead = df.sparkSession, next(iter(order))
    written = spark.read.schema(placed.schema).parquet(path)
    named = written.select(
        PLACE, F.col(f"`{lead}`").alias("lead"), F.substring_index(F.input_file_name(), "/", -1).alias("file")
    )
    ranges = named.groupBy(F.shiftright(PLACE, 33).alias("range")).agg(
        F.min(PLACE).alias("first"), F.count("*").alias("n_rows"), F.min("lead").alias("low"), F.max("lead").alias("high"),
        F.count_if(F.col("lead").isNull()).alias("n_null"), F.collect_set("file").alias("files"),
    )
    before, rows = 0, []
    # One row a range, as many as there are write tasks.
    for r in sorted(ranges.collect(), key=lambda r: r["range"]):
        rows.append((*r, before))
        before += r["n_rows"]
    schema = T.StructType([*ranges.schema.fields, T.StructField("before", T.LongType())])
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def read_ordered(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """Read the table back; `place` names a column for the row's place in the whole order, from 1. The places come from
    the range index, so nothing is sorted again."""
    df = spark.read.parquet(path)
    if place is None:
        return df.drop(PLACE)
    index = spark.read.parquet(f"{path}/{INDEX}").select(F.col("range").alias("__range"), "before", "first")
    joined = df.join(index, F.shiftright(PLACE, 33) == F.col("__range"))
    return joined.withColumn(place, F.col(PLACE) - F.col("first") + F.col("before") + 1).drop(PLACE, "__range", "before", "first")


def read_between(spark: SparkSession, path: str, lead: str, low: object = None, high: object = None) -> DataFrame:
    """Rows whose leading column lies between two values, both included; None leaves a side open. Only files whose range
    meets them are listed and read; NULL never matches."""
    index = spark.read.parquet(f"{path}/{INDEX}").where("n_rows > n_null")
    wanted = F.lit(True)
    inside = F.col(f"`{lead}`").isNotNull()
    if low is not None:
        wanted, inside = wanted & (F.col("high") >= F.lit(low)), inside & (F.col(f"`{lead}`") >= F.lit(low))
    if high is not None:
        wanted, inside = wanted & (F.col("low") <= F.lit(high)), inside & (F.col(f"`{lead}`") <= F.lit(high))
    files = [f"{path}/{name}" for r in index.where(wanted).select("files").collect() for name in r["files"]]
    if not files:
        return spark.read.parquet(path).where("false").drop(PLACE)
    return spark.read.parquet(*files).where(inside).drop(PLACE)
