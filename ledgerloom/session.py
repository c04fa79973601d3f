"""Spark session settings used by the package."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that can be changed on a running session. They let Spark re-plan joins from the sizes it
# measures, split skewed partitions even when that costs one more exchange, and merge small ones. Rows in memory take about
# ten times the bytes of their Parquet files; planned by the files' size, tables of a million rows would be broadcast.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "10.0",
    "spark.sql.session.timeZone": "UTC",
}


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on an existing session and return it."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session. `master` and `shuffle_partitions` are for local runs;
    on a cluster leave both unset so that the submit command decides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return apply_scale_settings(builder.getOrCreate())

