"""Shredded documents, pattern index, differences and control totals."""

import datetime as dt
import re
import time

import pytest
from pyspark.sql import functions as F

from checks.queries import RULES, Replaced, ViewTables
from helpers import rows
from ledgerloom import Warehouse
from ledgerloom.operators.control import ControlTotals
from ledgerloom.operators.difference import differences
from ledgerloom.operators.lookup import Key
from ledgerloom.operators.patterns import label_by_patterns, match_patterns, without_patterns
from ledgerloom.plans import rewards
from ledgerloom.sources.shredded import member_column, shred, with_members

# ---- shredded documents --------------------------------------------------------------------------------

TEXTS = [
    ('{"amount": 5, "id": "a", "tags": [1], "deep": {"x": 1.5}}',), ('{"amount": null, "id": {"x": 1}}',), ('{"amount": "7"',), (None,), ("",),
    ('{"id": true}',), ('[1, 2]',),
]
PATHS = {"amount": "$.amount", "id": "$.id", "tags": "$.tags", "deep": "$.deep.x"}


def test_stored_members_equal_parsed_ones(spark):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(TEXTS)], "n int, doc string")
    stored = shred(df, "doc", PATHS.values())
    assert stored.columns == ["n", "doc", "doc__amount", "doc__id", "doc__tags", "doc__deep_x"]
    assert rows(with_members(stored, "doc", PATHS)) == rows(with_members(df, "doc", PATHS))
    assert rows(with_members(df, "doc", PATHS))[0] == (0, "5", "a", None, "1.5")
    # A member that isn't stored is parsed.
    assert rows(with_members(shred(df, "doc", ["$.id"]), "doc", PATHS)) == rows(with_members(df, "doc", PATHS))
    with pytest.raises(ValueError):
        shred(df, "doc", ["$.a.b", "$.a_b"])


def test_scan_reads_only_the_members_asked_for(spark, tmp_path):
    path = str(tmp_path / "docs")
    shred(spark.createDataFrame(TEXTS, "doc string"), "doc", PATHS.values()).write.parquet(path)
    plan = with_members(spark.read.parquet(path), "doc", {"amount": "$.amount"})._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: (\S+)", plan)[1] == f"struct<{member_column('doc', '$.amount')}:string>"


def test_rewards_ledger_over_stored_members_reads_no_document(spark, sf_dir, tmp_path):
    t = ViewTables(spark, sf_dir)
    path = str(tmp_path / "loads")
    document, members = rewards.DOCUMENTS["loads"]
    shred(t["loads"], document, members.values()).write.parquet(path)
    house = Warehouse(spark, {"loads": path})
    dates = (dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    got = rewards.loaded(Replaced(t, loads=house["loads"]), RULES, *dates)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = got._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = next(re.search(r"ReadSchema: (.+)", line)[1] for line in plan.splitlines() if str(tmp_path) in line)
    assert "giftCards_member__amount:string" in schema and "giftCards_member:string" not in schema
    assert rows(got) == rows(rewards.loaded(t, RULES, *dates))


def estimated_bytes(df):
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def test_members_are_not_planned_as_small(spark, tmp_path):
    path = str(tmp_path / "documents")
    spark.range(20_000).selectExpr("id", """concat('{"amount": ', id, ', "id": "N', id, '"}') AS member""").write.parquet(path)
    documents = spark.read.parquet(path)
    files = sum(f.stat().st_size for f in (tmp_path / "documents").glob("*.parquet"))
    taken = with_members(documents, "member", {"amount text": "$.amount", "bonus": "$.id"})
    assert estimated_bytes(documents) >= 5 * files  # rows in memory against Parquet
    assert estimated_bytes(taken) >= estimated_bytes(documents)
    assert rows(taken.where("id IN (7, 11)")) == [(7, "7", "N7"), (11, "11", "N11")]


# ---- patterns ------------------------------------------------------------------------------------------

NAMES = ["ACME Corp", "acme", "Big Acme Ltd", "x%y", "a_b", "ab", "", None, "Ünïcode Shop", "Shop", "sho", "ACME Corp", "a\\b"]
RULES_ = [
    (1, "%Corp%", "corp"), (2, "%cm%", "short gram"), (3, "ACME%", "prefix"), (4, "%Shop", "suffix"), (5, "_b", "two"), (6, "%nïco%Shop%", "two parts"),
    (7, "x\\%y", "escaped"), (8, "", "empty"), (9, "%zzzz%", "never"), (10, None, "no pattern"), (11, "__", "any two"), (12, "Shop", "equal"),
]


def expected(spark, names, rules):
    """A branch per pattern."""
    df = spark.createDataFrame([(n,) for n in names if n is not None], "name string").distinct()
    hit = F.coalesce(*[F.when(F.col("name").like(p), F.lit(label)) for _, p, label in rules if p is not None])
    return rows(df.select("name", hit.alias("label")).where("label IS NOT NULL"))


def test_index_equals_one_branch_per_pattern(spark):
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    rules = spark.createDataFrame(RULES_, "rank long, pattern string, label string")
    matched = match_patterns(names, rules)
    assert rows(matched, "name", "label") == expected(spark, NAMES, RULES_)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    labelled = label_by_patterns(names, "name", rules, "kind")
    assert labelled.count() == len(NAMES) and labelled.where("name = 'ACME Corp' AND kind = 'corp'").count() == 2
    kept = {r["name"] for r in without_patterns(names, "name", rules).collect()}
    assert kept == {None, "sho", "a_b", "a\\b"}
    folded = match_patterns(names, spark.createDataFrame([(1, "%ACME%", "a")], "rank long, pattern string, label string"), fold_case=True)
    assert {r["name"] for r in folded.collect()} == {"ACME Corp", "acme", "Big Acme Ltd"}


def most_joined(plan):
    """Rows of the join that made the most, in a plan that has run."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return most_joined(plan.executedPlan())
    if "QueryStage" in name:
        return most_joined(plan.plan())
    children = plan.children()
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    return max([own, *[most_joined(children.apply(i)) for i in range(children.size())]])


def test_rules_that_share_a_pattern_are_met_once(spark):
    names = spark.range(30).select(F.concat(F.lit("Vendor "), F.col("id")).alias("name"))
    ranked = "100 - id AS rank", "IF(id % 2 = 0, '%endor%', '%ENDOR%') AS pattern", "CAST(id AS string) AS label"
    matched = match_patterns(names, spark.range(100).selectExpr(*ranked), fold_case=True)
    assert {(r["label"], r["rank"]) for r in matched.collect()} == {("99", 1)}
    assert most_joined(matched._jdf.queryExecution().executedPlan()) <= 60


def test_no_rules_and_no_names(spark):
    schema = "rank long, pattern string, label string"
    names = spark.createDataFrame([("a",)], "name string")
    assert match_patterns(names, spark.createDataFrame([], schema)).collect() == []
    assert match_patterns(names.where("false"), spark.createDataFrame(RULES_, schema)).collect() == []
    assert rows(label_by_patterns(names, "name", spark.createDataFrame([], schema), "k")) == [("a", None)]


def test_ten_thousand_patterns_plan_like_ten(spark, tmp_path):
    names = spark.range(3000).select(F.concat(F.lit("Vendor "), F.col("id")).alias("name"))

    def run(n):
        path = str(tmp_path / f"rules{n}")
        spark.range(n).selectExpr("id AS rank", "concat('%or ', id * 7, '%') AS pattern", "id AS label").write.parquet(path)
        rules = spark.read.parquet(path)
        best = 9e9
        for _ in range(3):
            start = time.time()
            matched = match_patterns(names, rules)
            plan = matched._jdf.queryExecution().executedPlan().toString()
            best = min(best, time.time() - start)
        return matched, best, plan.count("\n")

    few, short, small = run(10)
    many, long, large = run(10_000)
    assert abs(large - small) <= 3 and long < 3 * short + 1
    assert few.count() > 0 and many.where("name = 'Vendor 77'").first()["label"] == 1  # '%or 7%'


# ---- differences ---------------------------------------------------------------------------------------


def test_differences_have_a_reason_each(spark):
    schema = "k string, m int, v double"
    left = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("b", 1, 5.0), (None, 1, 1.0), ("c", 1, 4.0), ("d", 1, None), ("e", 1, 1.0)], schema)
    right = spark.createDataFrame([("a", 1, 3.0), ("b", 1, 5.0), (None, 1, 2.0), ("c", 2, 4.0), ("d", 1, 0.0), ("e", 1, 1.001)], schema)
    got = rows(differences(left, right, ["k", "m"], ["v"], 0.01), "k", "m", "reason", "v_difference", "rows_difference")
    assert got == [(None, 1, "value", -1.0, 0), ("a", 1, "rows", 0.0, 1), ("c", 1, "only left", 4.0, 1), ("c", 2, "only right", -4.0, -1), ("d", 1, "value", 0.0, 0)]
    assert differences(left, left, ["k", "m"], ["v"]).collect() == []


# ---- control totals ------------------------------------------------------------------------------------


def test_totals_of_a_lookup_that_loses_and_multiplies(spark):
    facts = spark.createDataFrame([("a", 10.0), ("b", 5.0), ("c", 1.0), (None, 2.0)], "k string, v double")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, x int")
    totals = ControlTotals(spark)
    left = totals.lookup("left", facts, dim, [Key("k", "k")], ["x"], "v")
    inner = totals.lookup("inner", facts, dim, [Key("k", "k")], ["x"], "v", "inner")
    assert left.columns == ["k", "v", "x"] and left.count() == 5 and len(inner.collect()) == 3
    assert rows(totals.report()) == [("inner", 4, 3, 0, 18.0, 25.0, None), ("left", 4, 5, 2, 18.0, 28.0, 3.0)]


def test_totals_of_weights_in_one_pass(spark, tmp_path):
    """The source is scanned once: the totals come with the rows."""
    path = str(tmp_path / "cost")
    spark.createDataFrame([("x", 100.0), ("y", 50.0)], "k string, v double").write.parquet(path)
    weights = spark.createDataFrame([("x", "CL", 0.3333), ("x", "MX", 0.3333), ("x", "ES", 0.3333)], "k string, country string, w double")
    totals = ControlTotals(spark)
    spread = totals.allocate("weights", spark.read.parquet(path), weights, {"k": "k"}, "v", "w", "share", {"country": ("country", "k")})
    assert spread._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    out = spread.collect()
    assert len(out) == 4
    (report,) = totals.report().collect()
    assert (report["rows_in"], report["rows_out"], report["rows_unmatched"]) == (2, 4, 1)
    assert report["amount_in"] == 150.0 and report["amount_out"] == pytest.approx(99.99)
