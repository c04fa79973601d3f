import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom import Warehouse
from ledgerloom.sources import shapes
from ledgerloom.sources.cubes import read_cube, write_cube
from ledgerloom.sources.schemas import PNL_SCHEMA, SCHEMAS
from ledgerloom.sources.warehouse import MissingColumns, conform


def test_conform_selects_casts_and_reports_missing_columns(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2024-05-06 10:00:00' AS full_date, 1 AS extra UNION ALL SELECT NULL, 2"
    )
    got = conform(df, SCHEMAS["calendar"])
    assert got.dtypes == [("full_date", "date")]
    assert rows(got) == [(None,), (dt.date(2024, 5, 6),)]
    with pytest.raises(MissingColumns, match="tax_id_client"):
        conform(df, SCHEMAS["holdings"])


def test_exact_amounts_and_local_instants_keep_their_type(spark):
    df = spark.sql("SELECT 'd' AS depositorderid, 'x' AS withdraworders_member")
    assert conform(df, SCHEMAS["balance_tx"]).columns == ["depositorderid", "withdraworders_member"]
    fx = spark.sql("SELECT 2024 AS Year, 'BRL' AS Currency, CAST(5.4 AS DECIMAL(10, 2)) AS Value")
    assert conform(fx, SCHEMAS["fx_budget"]).dtypes == [
        ("Year", "string"), ("Currency", "string"), ("Value", "decimal(10,2)")]


def test_warehouse_reads_paths_and_frames_and_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "clients")
    spark.sql("SELECT 1 AS client_id, 'a' AS client_tax_id, 'wide' AS other").write.parquet(path)
    house = Warehouse(spark, {"clients": path, "free": spark.range(3)})
    assert set(house) == {"clients", "free"} and len(house) == 2
    plan = house["clients"]._jdf.queryExecution().executedPlan().toString()
    assert "client_tax_id" in plan and "other" not in plan
    assert rows(house["clients"]) == [("1", "a")]
    assert house["free"].count() == 3


def test_write_cube_replaces_only_the_years_present(spark, tmp_path):
    path = str(tmp_path / "cube")
    first = spark.createDataFrame([(2023, 1.0), (2024, 2.0)], "year long, v double")
    write_cube(first, path)
    write_cube(spark.createDataFrame([(2024, 9.0)], "year long, v double"), path)
    assert rows(read_cube(spark, path), "year", "v") == [(2023, 1.0), (2024, 9.0)]
    write_cube(spark.createDataFrame([(2024, 1.0)], "year long, v double"), path, mode="append")
    assert rows(read_cube(spark, path), "year", "v") == [(2023, 1.0), (2024, 1.0), (2024, 9.0)]
    pruned = read_cube(spark, path).filter("year = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned


def test_union_sources_pushes_the_filter_into_every_scan(spark, tmp_path):
    paths = []
    for i in range(2):
        paths.append(str(tmp_path / f"t{i}"))
        spark.createDataFrame([(i, "EB"), (i, "CB")], "id int, stream string").write.parquet(paths[-1])
    merged = shapes.union_sources([spark.read.parquet(p) for p in paths], ["id", "stream"], F.col("stream") == "EB")
    assert rows(merged) == [(0, "EB"), (1, "EB")]
    assert merged._jdf.queryExecution().executedPlan().toString().count("EqualTo(stream,EB)") == 2


def test_pad_align_and_conform_union(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert rows(shapes.pad(df, z="k")) == [(1, "a", "k")]
    assert shapes.align(df, ["p", "q"]).columns == ["p", "q"]
    with pytest.raises(ValueError):
        shapes.align(df, ["p"])
    line = spark.sql("SELECT DATE '2024-01-01' AS period, 'CL' AS country, NULL AS segment, 'EB' AS revenue_stream, "
                     "'COGS' AS pnl_line, NULL AS department, 1 AS amount_local, CAST(2 AS DECIMAL(9, 2)) AS amount_usd")
    assert shapes.conform_union([line, line], PNL_SCHEMA).schema.simpleString() == PNL_SCHEMA.simpleString()


def test_month_spine_and_calendar(spark):
    spine = shapes.month_spine(spark, dt.date(2023, 11, 1), dt.date(2024, 1, 31))
    assert rows(spine) == [(dt.date(2023, 11, 1),), (dt.date(2023, 12, 1),), (dt.date(2024, 1, 1),)]
    days = spark.sql("SELECT explode(sequence(DATE '2023-01-15', DATE '2023-04-15')) AS full_date")
    got = shapes.calendar_months(days, dt.date(2023, 2, 20), dt.date(2023, 4, 1))
    assert rows(got) == [(dt.date(2023, 2, 1),), (dt.date(2023, 3, 1),), (dt.date(2023, 4, 1),)]


def test_within_spine_equals_join_with_the_spine(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2022-12-15', DATE '2023-04-15')) AS d UNION ALL SELECT NULL")
    start, as_of = dt.date(2023, 1, 1), dt.date(2023, 3, 10)
    spine = shapes.month_spine(spark, start, as_of)
    joined = days.join(spine, F.trunc("d", "MONTH") == F.col("month"))
    assert rows(days.filter(shapes.within_spine("d", start, as_of))) == rows(joined.select("d"))


def test_default_reporting_date_is_today(spark):
    spine = shapes.month_spine(spark, dt.date(2024, 1, 1))
    assert rows(spine)[-1][0] <= dt.date.today()
