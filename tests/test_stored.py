"""Ordered, incremental and running results: equal to the whole plan, touching only what has changed."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from checks.queries import RULES, ViewTables, queries
from helpers import rows
from ledgerloom.operators.reconcile import apply_delta, reconcile, reconcile_delta
from ledgerloom.operators.running import RunningTotals
from ledgerloom.operators.series import cumulative_by_calendar
from ledgerloom.plans import revenue
from ledgerloom.sources import ordered
from ledgerloom.sources.cubes import write_cube
from ledgerloom.sources.incremental import StoredCube, fingerprints


def files(path):
    return {os.path.basename(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# ---- ordered output ------------------------------------------------------------------------------------


def lines(spark, n=4000):
    return spark.range(n).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE 2000 + id * 7919 % 20 END AS year", "id * 31 % 12 + 1 AS month",
        "CASE WHEN id % 9 > 0 THEN CAST(id * 104729 % 1000 AS DOUBLE) / 7 END AS v", "id",
    )


ORDER = {"year": "desc", "month": "asc", "v": "desc"}


def expected(df):
    def key(r):
        return (r["year"] is None, -(r["year"] or 0), r["month"], r["v"] is None, -(r["v"] or 0.0))

    return [tuple(r)[:3] for r in sorted(df.collect(), key=key)]


def test_places_are_global_and_files_cover_ranges(spark, tmp_path):
    path = str(tmp_path / "cube")
    df = lines(spark)
    ordered.write_ordered(df.repartition(5), path, ORDER)
    got = ordered.read_ordered(spark, path, "place").orderBy("place").select("year", "month", "v", "place").collect()
    assert [tuple(r)[:3] for r in got] == expected(df)
    assert [r["place"] for r in got] == list(range(1, 4001))
    assert ordered.read_ordered(spark, path).columns == df.columns
    plan = ordered.read_ordered(spark, path, "place")._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "SinglePartition" not in plan


def test_a_range_of_the_leading_column_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "cube")
    off = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        ordered.write_ordered(lines(spark), path, ORDER)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    part = ordered.read_between(spark, path, "year", 2004, 2005)
    assert rows(part) == rows(lines(spark).where("year BETWEEN 2004 AND 2005"))
    assert len(glob.glob(f"{path}/*.parquet")) == 8 and len(part.inputFiles()) <= 2
    assert rows(ordered.read_between(spark, path, "year", low=2019)) == rows(lines(spark).where("year >= 2019"))
    assert ordered.read_between(spark, path, "year", 1900, 1901).count() == 0
    # The files' own statistics prune as well: every file but those of the range lies outside.
    import pyarrow.parquet as pq

    spans = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in glob.glob(f"{path}/*.parquet")]
    assert sum(s.min is not None and s.min <= 2005 and s.max >= 2004 for s in spans) <= 2


def test_a_value_held_by_most_rows_spreads_over_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered.write_ordered(spark.range(8000).selectExpr("CASE WHEN id % 3 > 0 THEN 1 ELSE id END AS k", "id"), path, {"k": "asc"})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n_rows"] for r in spark.read.parquet(f"{path}/_ranges").collect()]
    assert len(sizes) == 8 and max(sizes) < 2500 and sum(sizes) == 8000


def test_empty_table_and_wrong_order(spark, tmp_path):
    path = str(tmp_path / "none")
    ordered.write_ordered(lines(spark).where("false"), path, ORDER)
    assert ordered.read_ordered(spark, path, "place").collect() == []
    assert ordered.read_between(spark, path, "year", 2000).collect() == []
    with pytest.raises(ValueError):
        ordered.write_ordered(lines(spark), path, {"year": "up"})


# ---- incremental cube ----------------------------------------------------------------------------------


def ledger(spark, changes=None):
    data = [(p, i, float(i)) for p in (202401, 202402, 202403, None) for i in range(5)]
    data = [r if changes is None else changes(r) for r in data]
    return spark.createDataFrame([r for r in data if r], "period long, id long, v double")


def build(parts):
    return parts["ledger"].groupBy("period").agg(F.sum("v").alias("total"), F.count("*").alias("n"))


def source(df):
    return {"ledger": (df, F.col("period"))}


def test_only_changed_partitions_are_rewritten(spark, tmp_path):
    cube = StoredCube(spark, str(tmp_path / "cube"))
    assert cube.refresh(source(ledger(spark)), build) == {-1: "added", 202401: "added", 202402: "added", 202403: "added"}
    before = {p: files(f"{cube.path}/data/period={p}") for p in cube.partitions()}

    def late(r):
        return None if r[0] == 202403 else (r[0], r[1], r[2] + 1) if r[0] == 202402 and r[1] == 0 else r

    seen = []

    def counted(parts):
        seen.append(parts["ledger"].count())
        return build(parts)

    extra = ledger(spark, late).union(spark.createDataFrame([(202404, 1, 9.0)], "period long, id long, v double"))
    assert cube.refresh(source(extra), counted) == {202402: "changed", 202403: "removed", 202404: "added"}
    assert seen == [5 + 1]  # the rows of 202402 and 202404
    after = {p: files(f"{cube.path}/data/period={p}") for p in cube.partitions()}
    assert after[202401] == before[202401] and after[-1] == before[-1] and after[202402] != before[202402]
    whole = build({"ledger": extra}).withColumn("period", F.coalesce("period", F.lit(-1)))
    assert rows(cube.read(), "period", "total", "n") == rows(whole, "period", "total", "n")
    assert cube.refresh(source(extra), build) == {}


def test_partition_that_comes_out_empty_and_comes_back(spark, tmp_path):
    cube = StoredCube(spark, str(tmp_path / "cube"))
    positive = lambda parts: build({"ledger": parts["ledger"].where("v > 0")})
    cube.refresh(source(ledger(spark)), positive)
    none = ledger(spark, lambda r: (r[0], r[1], -1.0) if r[0] == 202401 else r)
    assert cube.refresh(source(none), positive) == {202401: "removed"}
    assert 202401 not in cube.partitions() and cube.read().where("period = 202401").count() == 0
    assert cube.refresh(source(ledger(spark)), positive) == {202401: "added"}
    assert cube.read().where("period = 202401").first()["total"] == 10.0


def test_context_change_recomputes_everything_and_copies_are_seen(spark, tmp_path):
    cube = StoredCube(spark, str(tmp_path / "cube"))
    rate = lambda v: {"rates": spark.createDataFrame([("x", v)], "c string, v double")}
    cube.refresh(source(ledger(spark)), build, rate(1.0))
    assert cube.refresh(source(ledger(spark)), build, rate(1.0)) == {}
    assert set(cube.refresh(source(ledger(spark)), build, rate(2.0))) == {-1, 202401, 202402, 202403}
    # A row that comes twice more leaves the exclusive or as it was.
    double = ledger(spark).union(spark.createDataFrame([(202401, 0, 0.0)] * 2, "period long, id long, v double"))
    marks = [fingerprints(df, F.col("period")).where("partition = 202401").first() for df in (ledger(spark), double)]
    assert marks[0]["mark_xor"] == marks[1]["mark_xor"] and marks[0]["mark_sum"] != marks[1]["mark_sum"]
    assert cube.refresh(source(double), build, rate(2.0)) == {202401: "changed"}


def test_failed_refresh_is_repaired_by_the_next(spark, tmp_path):
    cube = StoredCube(spark, str(tmp_path / "cube"))
    cube.refresh(source(ledger(spark)), build)
    changed = ledger(spark, lambda r: (r[0], r[1], 7.0) if r[0] == 202401 else r)

    def broken(parts):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        cube.refresh(source(changed), broken)
    assert cube.refresh(source(changed), build) == {202401: "changed"}
    assert cube.read().where("period = 202401").first()["total"] == 35.0


# ---- incremental reconciliation ------------------------------------------------------------------------

KEYS = ["holding", "month"]
DOC = "id int, holding string, month int, document_type string"


def check_delta(spark, base, changes):
    """The delta applied to the stored result equals the plan over the documents as they then are."""
    lines_ = spark.createDataFrame(base, DOC)
    moves = spark.createDataFrame(changes, DOC + ", change int")
    delta = reconcile_delta(lines_, moves, KEYS)
    now = list(base)
    for *row, sign in changes:
        if sign > 0:
            now.append(tuple(row))
        elif tuple(row) in now:
            now.remove(tuple(row))
    want = rows(reconcile(spark.createDataFrame(now, DOC), KEYS))
    assert rows(apply_delta(reconcile(lines_, KEYS), delta, KEYS)) == want
    return [tuple(r) for r in delta.select("id", "change").orderBy("id", "change").collect()]


BASE = [
    (1, "A", 1, "Provision"), (2, "A", 1, "Provision"), (3, "A", 2, "Provision"), (4, "B", 1, "Invoice"), (5, "B", 1, "Provision"),
    (6, None, 1, "Provision"), (7, "C", 1, "Provision"), (7, "C", 1, "Provision"), (8, "C", 1, "Memo"),
]


def test_late_invoice_retracts_the_provisions_of_its_group(spark):
    assert check_delta(spark, BASE, [(9, "A", 1, "Invoice", 1)]) == [(1, -1), (2, -1), (9, 1)]
    assert check_delta(spark, BASE, [(9, None, 1, "Bill", 1)]) == [(6, -1), (9, 1)]


def test_invoice_that_goes_brings_provisions_back(spark):
    assert check_delta(spark, BASE, [(4, "B", 1, "Invoice", -1)]) == [(4, -1), (5, 1)]


def test_corrected_repeated_and_unknown_documents(spark):
    assert check_delta(spark, BASE, [(5, "B", 1, "Provision", -1), (5, "B", 2, "Provision", 1)]) == [(5, 1)]
    assert check_delta(spark, BASE, [(7, "C", 1, "Provision", -1)]) == [(7, -1)]  # one of two equal documents
    assert check_delta(spark, BASE, [(99, "A", 1, "Invoice", -1)]) == []
    assert check_delta(spark, BASE, [(8, "C", 1, "Memo", -1), (10, "D", 1, None, 1)]) == []
    # A type corrected to and fro, and a document that comes and goes at once.
    assert check_delta(spark, BASE, [(1, "A", 1, "Provision", -1), (1, "A", 1, "Invoice", 1), (11, "Z", 1, "Bill", 1), (11, "Z", 1, "Bill", -1)]) == [
        (1, -1), (1, 1), (2, -1)]


def test_only_touched_groups_are_read_again(spark, tmp_path):
    """Stored by month, the delta of one month's changes reads that month's files only."""
    path = str(tmp_path / "docs")
    spark.createDataFrame(BASE, DOC).write.partitionBy("month").parquet(path)
    stored = spark.read.schema(DOC).parquet(path).select("id", "holding", "month", "document_type")
    moves = spark.createDataFrame([(9, "A", 2, "Invoice", 1)], DOC + ", change int")
    delta = reconcile_delta(stored.where("month IN (2)"), moves, KEYS)
    assert rows(delta, "id", "change") == [(3, -1), (9, 1)]
    assert "PartitionFilters: [isnotnull(month" in delta._jdf.queryExecution().executedPlan().toString()


# ---- running totals ------------------------------------------------------------------------------------


def day(m, y=2024):
    return dt.date(y, m, 1)


KPIS = {"minutes": "total_minutes", "calories": "total_calories"}
ACTIVITY = [(day(1), 5, 10), (day(1), 7, None), (day(2), 1, 1), (day(5), 2, 3), (day(6), None, 4), (day(12, 2023), 4, 4)]
TYPES = "month_act date, minutes decimal(10,2), calories decimal(10,2)"


def dec(rows_):
    from decimal import Decimal

    return [(m, *[None if v is None else Decimal(v) for v in vs]) for m, *vs in rows_]


def calendar(spark):
    return spark.sql("SELECT explode(sequence(DATE '2023-11-01', DATE '2024-08-01', INTERVAL 1 MONTH)) AS month")


def test_extended_totals_equal_the_full_run(spark, tmp_path):
    act = lambda data: spark.createDataFrame(dec(data), TYPES)
    totals = RunningTotals(spark, str(tmp_path / "state"), KPIS)
    totals.extend(act([r for r in ACTIVITY if r[0] < day(2)][:1]), "month_act")  # January in part
    first = files(str(tmp_path / "state"))
    totals.extend(act([r for r in ACTIVITY if r[0] >= day(5)]), "month_act")
    assert first < files(str(tmp_path / "state"))  # later months leave January's file alone
    totals.extend(act([r for r in ACTIVITY if r[0] in (day(1), day(2))]), "month_act")  # a gap filled, January whole
    totals.extend(act([r for r in ACTIVITY if r[0] < day(1)]), "month_act")  # before everything
    totals.extend(act([]), "month_act")
    want = cumulative_by_calendar(act(ACTIVITY), calendar(spark), "month_act", KPIS)
    got = totals.by_calendar(calendar(spark))
    plain = lambda df: sorted((str(r["month"]), r["kpi"], None if r["val_total"] is None else float(r["val_total"])) for r in df.collect())
    assert plain(got) == plain(want) and len(plain(got)) == 18


def test_extension_reads_only_the_months_it_is_given(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame(dec(ACTIVITY), TYPES).write.partitionBy("month_act").parquet(path)
    stored = spark.read.schema(TYPES).parquet(path)
    totals = RunningTotals(spark, str(tmp_path / "state"), KPIS)
    totals.extend(stored.where(F.col("month_act") < F.lit(day(5))), "month_act")
    new = stored.where(F.col("month_act") >= F.lit(day(5)))
    assert "PartitionFilters: [isnotnull(month_act" in new._jdf.queryExecution().executedPlan().toString()
    assert new.select(F.input_file_name()).distinct().count() == 2 < len(stored.inputFiles())
    totals.extend(new, "month_act")
    last = totals.read().where("kpi = 'total_minutes'").orderBy(F.desc("month")).first()
    assert last["total"] == 19 and last["seen"] == 6


# ---- disk ----------------------------------------------------------------------------------------------


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files that are still there some seconds later."""
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_parts_of_the_pnl_are_stored(spark, sf_dir):
    before = shuffle_files(spark)
    plan = queries()["consolidated_pnl"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan parquet") == 5
    assert not left_behind(spark, before)


def test_buildup_sums_per_holding_without_a_shuffle_of_its_own(spark, sf_dir):
    months = revenue.reconciled_months(ViewTables(spark, sf_dir), RULES, revenue.BUILDUPS["with_product"])
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(holding_name" in plan and "hashpartitioning(service_date" not in plan


def test_sides_of_a_comparison_are_stored(spark, sf_dir):
    before = shuffle_files(spark)
    plan = queries()["cube_against_buildup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("FileScan parquet") == 2
    assert not left_behind(spark, before)


def test_a_refresh_leaves_no_shuffle_files(spark, tmp_path):
    rows_ = spark.range(500).select("id", (F.col("id") % 3).alias("period"))
    before = shuffle_files(spark)
    cube = StoredCube(spark, str(tmp_path / "cube"))
    assert len(cube.refresh({"rows": (rows_, F.col("period"))}, lambda parts: parts["rows"].groupBy("period").count())) == 3
    assert not left_behind(spark, before)
    assert {tuple(r) for r in cube.read().select("period", "count").collect()} == {(0, 167), (1, 167), (2, 166)}


def test_a_written_cube_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    write_cube(spark.range(500).groupBy((F.col("id") % 3).alias("year")).count(), str(tmp_path / "cube"))
    assert not left_behind(spark, before)
    assert spark.read.parquet(str(tmp_path / "cube")).count() == 3
