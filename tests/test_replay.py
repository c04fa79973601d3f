"""Past reports run again, and tables joined where they are stored."""

import datetime as dt

from pyspark.sql import functions as F

from checks.queries import RULES, ViewTables
from helpers import rows
from ledgerloom.functions.scalars import normalize_id
from ledgerloom.operators.lookup import Key, latest_by, lookup
from ledgerloom.plans import revenue
from ledgerloom.sources.asof import AsOf
from ledgerloom.sources.colocated import join_colocated, write_colocated


def test_rows_count_from_their_date_on(spark, tmp_path):
    day = lambda d: dt.date(2024, 1, d)
    docs = spark.createDataFrame([(1, day(1)), (2, day(10)), (3, day(11)), (4, None)], "id int, document_date date")
    versions = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), "open"), ("a", dt.datetime(2024, 1, 10, 23, 59), "won"), ("a", dt.datetime(2024, 1, 11), "lost")],
        "deal_id string, last_modified_date timestamp, stage string",
    )
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    t = AsOf({"ledger_current": spark.read.parquet(path), "deal_versions": versions, "holdings": docs}, day(10))
    assert rows(t["ledger_current"], "id") == [(1,), (2,), (4,)] and t["holdings"].count() == 4 and len(t) == 3
    assert "LessThan(document_date,2024-01-11)" in t["ledger_current"]._jdf.queryExecution().executedPlan().toString()
    assert rows(latest_by(t["deal_versions"], "deal_id", "last_modified_date"), "stage") == [("won",)]


def test_no_churn_in_the_censored_month_and_none_moved_elsewhere(spark, sf_dir):
    t = ViewTables(spark, sf_dir)
    day = dt.date(1998, 6, 20)
    plain = revenue.buildup(AsOf(t, day), RULES, "with_product").where("full_date < DATE '1998-06-01'")
    built = revenue.buildup(AsOf(t, day), RULES, "with_product", censor=day)
    late = built.where("full_date >= DATE '1998-06-01'")
    assert late.where("members_churn <> 0 OR value_lc_churn <> 0 OR value_usd_churn <> 0 OR logo_churn <> 0").count() == 0 < late.count()
    early = built.where("full_date < DATE '1998-06-01'")
    total = lambda df: tuple(df.agg(F.count("*"), F.sum("logo_churn"), F.sum(F.col("members_churn").cast("decimal(20,4)"))).first())
    assert total(early) == total(plain) and total(early)[1] > 0


def test_stored_tables_join_without_an_exchange(spark, tmp_path):
    facts = spark.createDataFrame([(1, "7.1-k", "EB"), (2, "9", "EB"), (3, None, "EB"), (4, "8", "CB"), (5, "8", None)], "id int, client string, stream string")
    dim = spark.createDataFrame([("71K", "EB", "A"), ("8", "CB", "B"), ("8", "CB", "C"), (None, "EB", "N"), ("9", "CB", "D")], "tax string, stream string, name string")
    clean = normalize_id
    left = write_colocated(facts, "colocated_facts", str(tmp_path / "f"), [clean("client"), F.col("stream")], 4)
    right = write_colocated(dim, "colocated_dim", str(tmp_path / "d"), [clean("tax"), F.col("stream")], 4)
    joined = join_colocated(spark, left, right, {"name": "label"})
    want = lookup(facts, dim, [Key("client", "tax", left_by=clean, right_by=clean), Key("stream", "stream")], {"name": "label"})
    assert rows(joined, "id", "label") == rows(want, "id", "label") and joined.columns == want.columns
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    inner = join_colocated(spark, left, right, ["name"], how="inner")
    assert rows(inner, "id", "name") == [(1, "A"), (4, "B"), (4, "C")]
    for name in ("colocated_facts", "colocated_dim"):
        spark.sql(f"DROP TABLE {name}")
