"""Every registered query: whole result equal to its SQL, and no forbidden physical operator."""

import pytest

from checks.compare import compare, oracle_connection
from checks.oracle import oracle_sql
from checks.queries import queries


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "SinglePartition", "MapInPandas")


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_sql(spark, connection, sf_dir, name):
    r = compare(spark, connection, name, sf_dir)
    assert r["columns"] and r["types"], r["type_difference"]
    assert r["values"], (r["only_ours"], r["only_oracle"])
    assert r["rows"] == r["oracle_rows"]
    assert [f for f in FORBIDDEN if f in r["plan"]] == []


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries()) <= set(entry.queries())
    assert set(queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


SHUFFLED = (
    "latest_version", "first_time_company", "rewards_loaded", "rewards_orders", "rewards_redeemed", "rewards_voided", "client_revenue_share",
    "qa_running_flag", "allocate_reassign", "revenue_lines", "buildup_main_family", "engagement_by_segment", "cutover_union",
)


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_equals_sql_without_broadcast(spark, connection, sf_dir, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        r = compare(spark, connection, name, sf_dir)
    finally:
        spark.conf.set(key, before)
    assert r["columns"] and r["types"] and r["values"], (r["only_ours"], r["only_oracle"])
    assert [f for f in (*FORBIDDEN, "BroadcastHashJoin") if f in r["plan"]] == []
