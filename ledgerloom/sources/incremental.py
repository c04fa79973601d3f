"""Stored cubes that are brought up to date partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.shared import path_exists, shuffles_removed

UNDATED = -1
_CONTEXT = -2
_LOG = "version long, source string, partition long, n_rows long, mark_xor long, mark_sum decimal(38,0)"
_MARKS = ("n_rows", "mark_xor", "mark_sum")

Sources = Mapping[str, DataFrame]


def fingerprints(df: DataFrame, partition: Column) -> DataFrame:
    """(partition, n_rows, mark_xor, mark_sum): what tells the rows of a partition from other rows, in one pass and
    whatever their order. The exclusive or alone would not see a row that comes twice; the sum does. A NULL partition is
    `UNDATED`."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.select(F.coalesce(partition.cast("long"), F.lit(UNDATED).cast("long")).alias("partition"), row.alias("row"))
    return marked.groupBy("partition").agg(
        F.count("*").alias("n_rows"), F.bit_xor("row").alias("mark_xor"),
        F.sum(F.xxhash64("row", F.lit("sum")).cast("decimal(20,0)")).cast("decimal(38,0)").alias("mark_sum"),
    )


class StoredCube:
    """A cube in `path`/data, partitioned by a long column such as the month, and its log in `path`/log.

    The log holds, per version, the fingerprints of the partitions of each source that have changed. A refresh compares
    them with the sources, recomputes only changed partitions and replaces their files; other files stay as they are. Files
    are replaced before the log is written, so a refresh that fails half-way is repaired by the next one.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str = "period"):
        self.spark, self.path, self.partition = spark, path, partition

    def _log(self) -> DataFrame:
        if path_exists(self.spark, f"{self.path}/log"):
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        return self.spark.createDataFrame([], _LOG)

    def _state(self) -> DataFrame:
        """Latest fingerprint of each source and partition; no rows stand for a partition that has gone."""
        marks = F.max_by(F.struct(*_MARKS), "version").alias("m")
        return self._log().groupBy("source", "partition").agg(marks).select("source", "partition", "m.*").where("n_rows > 0")

    def _changes(self, sources: Mapping[str, tuple[DataFrame, Column]], context: Sources) -> tuple[DataFrame, int]:
        now = [fingerprints(df, part).withColumn("source", F.lit(name)) for name, (df, part) in sources.items()]
        now += [fingerprints(df, F.lit(_CONTEXT)).withColumn("source", F.lit(name)) for name, df in context.items()]
        both = now[0]
        for df in now[1:]:
            both = both.unionByName(df)
        old = self._state().where("source <> ''").select("source", "partition", *[F.col(m).alias(f"old_{m}") for m in _MARKS])
        joined = both.join(old, ["source", "partition"], "full")
        differs = F.lit(False)
        for m in _MARKS:
            differs = differs | ~F.col(m).eqNullSafe(F.col(f"old_{m}"))
        version = self._log().agg(F.max("version").alias("v")).first()["v"]
        found = joined.where(differs).select("source", "partition", *_MARKS)
        return found, (version or 0) + 1

    def refresh(
        self, sources: Mapping[str, tuple[DataFrame, Column]], build: Callable[[Sources], DataFrame], context: Sources | None = None
    ) -> dict[int, str]:
        """Bring the cube up to date and report the partitions recomputed: 'added', 'changed' or 'removed'.

        `sources` maps names to rows and the expression of their partition; `build` makes the cube's rows, with the partition
        column, from the sources cut to some partitions, each from its own rows alone. `context` are tables that any
        partition may depend on, such as rates: when one changes, everything is recomputed. Partition numbers are collected;
        they are as many as there are months, not rows.
        """
        with shuffles_removed(self.spark):
            return self._refreshed(sources, build, context or {})

    def _refreshed(
        self, sources: Mapping[str, tuple[DataFrame, Column]], build: Callable[[Sources], DataFrame], context: Sources
    ) -> dict[int, str]:
        found, version = self._changes(sources, context)
        rows = [(version, r["source"], r["partition"], r["n_rows"] or 0, r["mark_xor"], r["mark_sum"]) for r in found.collect()]
        if not rows:
            return {}
        changed = {r[2] for r in rows}
        known = {r["partition"] for r in self._state().where("source = ''").select("partition").collect()}
        if _CONTEXT in changed:
            changed = known | changed | {r["partition"] for r in self._state().select("partition").distinct().collect()}
        changed = sorted(changed - {_CONTEXT})

        def cut(df: DataFrame, part: Column) -> DataFrame:
            return df.where(F.coalesce(part.cast("long"), F.lit(UNDATED)).isin(changed))

        out = build({name: cut(df, part) for name, (df, part) in sources.items()})
        column = F.coalesce(F.col(self.partition).cast("long"), F.lit(UNDATED).cast("long"))
        out = out.withColumn(self.partition, column).where(F.col(self.partition).isin(changed))
        # Which partitions have rows is learned in the pass that writes them.
        seen = Observation("partitions")
        watched = out.observe(seen, F.collect_set(self.partition).alias("filled"), F.count(F.lit(1)).alias("n_rows"))
        watched.hint("rebalance", self.partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            self.partition
        ).parquet(f"{self.path}/data")
        filled = set(seen.get["filled"])
        rows += [(version, "", p, int(p in filled), None, None) for p in changed if p in filled or p in known]
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        kinds = {p: "changed" if p in known else "added" for p in filled}
        return {p: kinds.get(p, "removed") for p in changed if p in filled or p in known}

    def partitions(self) -> Sequence[int]:
        return sorted(r["partition"] for r in self._state().where("source = ''").select("partition").collect())

    def read(self) -> DataFrame:
        """The cube as of its last refresh. Files of partitions that have gone are left out by their number."""
        df = self.spark.read.parquet(f"{self.path}/data")
        typed = T.StructType([f if f.name != self.partition else T.StructField(f.name, T.LongType()) for f in df.schema])
        return self.spark.read.schema(typed).parquet(f"{self.path}/data").where(F.col(self.partition).isin(list(self.partitions())))
