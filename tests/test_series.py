import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom.operators import series as TS


def month(n):
    return dt.date(2024 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def test_gap_fill(spark):
    data = [("A", None, month(1), 10), ("A", None, month(4), 5), ("A", "x", month(2), 7), (None, None, month(11), 1),
            (None, None, month(14), None)]
    df = spark.createDataFrame(data, "h string, s string, full_date date, v int")
    got = rows(TS.gap_fill(df, "full_date", ["h", "s"], ["v"]), "h", "s", "full_date", "v")
    assert got == sorted([
        ("A", None, month(1), 10), ("A", None, month(2), None), ("A", None, month(3), None), ("A", None, month(4), 5),
        ("A", "x", month(2), 7),
        (None, None, month(11), 1), (None, None, month(12), None), (None, None, month(13), None),
        (None, None, month(14), None),
    ], key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_gap_fill_by_day_is_contiguous(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 30), 1), ("a", dt.date(2024, 2, 2), 2)], "k string, d date, v int")
    got = rows(TS.gap_fill(df, "d", ["k"], ["v"], step="1 day"), "d", "v")
    assert got == [(dt.date(2024, 1, 30), 1), (dt.date(2024, 1, 31), None), (dt.date(2024, 2, 1), None), (dt.date(2024, 2, 2), 2)]


def test_period_context(spark):
    df = spark.createDataFrame([("a", month(i), float(v)) for i, v in ((1, 3), (2, 0), (3, 8))], "k string, d date, m double")
    got = rows(TS.period_context(df, ["k"], "d", ["m"]), "d", "m_bop", "m_bop2", "m_next")
    assert got == [(month(1), 0.0, 0.0, 0.0), (month(2), 3.0, 0.0, 8.0), (month(3), 0.0, 3.0, None)]


CASES = [
    # invoice number, now, bop, bop2, next -> new, new after gap, retention, churn, churn ignoring negatives
    ((0, 5.0, 2.0, 0.0, 1.0), (5.0, 5.0, 0.0, 0.0, 0.0)),
    ((0, -5.0, 0.0, 0.0, None), (-5.0, -5.0, 0.0, -5.0, 0.0)),
    ((1, 7.0, 5.0, 0.0, 1.0), (2.0, 2.0, 0.0, 0.0, 0.0)),
    ((1, 3.0, 5.0, 0.0, 1.0), (0.0, 0.0, -2.0, 0.0, 0.0)),
    ((2, 7.0, 5.0, 0.0, 1.0), (2.0, 2.0, 0.0, 0.0, 0.0)),
    ((2, 3.0, 5.0, 0.0, 1.0), (0.0, 0.0, -2.0, 0.0, 0.0)),
    ((2, 7.0, 0.0, 4.0, 1.0), (3.0, 3.0, 0.0, 0.0, 0.0)),
    ((2, 3.0, 0.0, 4.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0)),
    ((2, 7.0, 0.0, 0.0, 1.0), (0.0, 7.0, 0.0, 0.0, 0.0)),
    ((2, 7.0, 0.0, -4.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0)),
    ((2, 7.0, -1.0, 4.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0)),
    ((3, 7.0, 5.0, 0.0, None), (0.0, 0.0, 2.0, 7.0, 7.0)),
    ((3, 4.0, 5.0, 0.0, 1.0), (0.0, 0.0, -1.0, 0.0, 0.0)),
    ((-1, 7.0, 5.0, 0.0, 1.0), (0.0, 0.0, 0.0, 0.0, 0.0)),
    ((None, 7.0, 5.0, 0.0, None), (0.0, 0.0, 0.0, 7.0, 7.0)),
]


@pytest.mark.parametrize("given, expected", CASES)
def test_movement(spark, given, expected):
    df = spark.createDataFrame([given], "invoice_number int, m double, m_bop double, m_bop2 double, m_next double")
    plain, gap, floor = TS.movement("m"), TS.movement("m", new_after_gap=True), TS.movement("m", ignore_negative=True)
    got = df.select(plain["new"], gap["new"], plain["retention"], plain["churn"], floor["churn"]).first()
    assert tuple(got) == expected


def test_linked_products(spark):
    # product, own next, main product's next -> churns
    data = [("main", None, None, True), ("main", 1.0, 1.0, False), ("addon", None, 1.0, False), ("addon", 1.0, None, True),
            ("other", None, None, False), (None, None, None, False)]
    df = spark.createDataFrame(data, "product string, m_next double, sib double, want boolean")
    end = TS.linked_end("m", "main", "addon", "sib")
    assert df.filter(end != F.col("want")).count() == 0
    months = spark.createDataFrame(
        [("h", 1, "main", 5.0), ("h", 1, "addon", 2.0), ("h", 2, "addon", 3.0)], "h string, d int, product string, n double")
    sib = TS.sibling_value(["h", "d"], F.col("product") == "main", F.col("n")).alias("sib")
    assert rows(months.select("d", "product", sib)) == [(1, "addon", 5.0), (1, "main", 5.0), (2, "addon", None)]


def test_logo_counts(spark):
    cols = "full_date date, holding_cohort date, invoice_number int, value_lc_next double, product string"
    data = [(month(1), month(1), 0, 1.0, "P"), (month(1), month(3), -2, None, "P"), (month(4), month(3), 1, None, "ADD"),
            (month(3), month(3), 0, None, None), (month(3), None, None, None, "P")]
    df = spark.createDataFrame(data, cols)
    names = ["logo_bop", "logo_new", "logo_churn", "logo_eop"]

    def counted(**options):
        logos = TS.logo_counts(**options)
        return [tuple(r) for r in df.coalesce(1).select(*[logos[n].alias(n) for n in names]).collect()]

    assert counted() == [(1, 1, 0, 1), (0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 1, 1), (1, 0, 1, 1)]
    assert counted(exclude="ADD") == [(1, 1, 0, 1), (0, 0, 1, 0), (0, 0, 0, 0), (1, 0, 0, 1), (1, 0, 1, 1)]
    assert counted(exclude="ADD", only_churn="Q") == [(1, 1, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 1), (1, 0, 0, 1)]


def test_cumulative_equals_range_join(spark):
    facts = spark.createDataFrame(
        [(month(1), 1.0, 10.0), (month(1), 2.0, None), (month(3), 4.0, 5.0), (month(6), 8.0, 1.0)], "m date, a double, b double")
    months = spark.createDataFrame([(month(i),) for i in (2, 3, 4, 5)], "month date")
    got = rows(TS.cumulative_by_calendar(facts, months, "m", {"a": "A", "b": "B"}))
    joined = facts.join(months, facts.m <= months.month).groupBy("month")
    want = rows(joined.agg(F.sum("a").alias("v")).select("month", F.lit("A"), "v").union(
        joined.agg(F.sum("b").alias("v")).select("month", F.lit("B"), "v")))
    assert got == want


def test_cumulative_skips_months_before_any_activity(spark):
    facts = spark.createDataFrame([(month(3), 4.0)], "m date, a double")
    months = spark.createDataFrame([(month(i),) for i in (1, 3, 4)], "month date")
    got = rows(TS.cumulative_by_calendar(facts, months, "m", {"a": "A"}))
    assert got == [(month(3), "A", 4.0), (month(4), "A", 4.0)]


def test_stack_metrics(spark):
    df = spark.createDataFrame([("p", 1.0, 2.0, 3)], "period string, lc double, usd double, logos int")
    got = rows(TS.stack_metrics(df, ["period"], [("Rev", "lc", "usd"), ("Logos", "logos", None)]))
    assert got == [("p", "Logos", 3.0, None), ("p", "Rev", 1.0, 2.0)]
