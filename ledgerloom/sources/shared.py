"""The folder that driver and executors share, for tables a plan writes and reads again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Puts a named step of a plan somewhere and gives it back, to be read from there.
Store = Callable[[str, DataFrame], DataFrame]
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def not_stored(name: str, df: DataFrame) -> DataFrame:
    """The step as part of the plan that uses it."""
    return df


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """DataFrames made and written here remove their shuffle files when they have run, so that steps that are stored one
    after the other take the disk of the largest, not of all. Elsewhere Spark keeps them until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back."""
    path = new_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`. A local session without it gets a temporary folder, set as the
    checkpoint folder; a cluster session is refused, since executors could not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before, so that a rerun never meets the files of an earlier one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever store Spark reads it from."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
