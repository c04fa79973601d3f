import pytest
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom import rules as R
from ledgerloom.operators import allocate as A
from ledgerloom.operators import classify as C
from ledgerloom.plans import expenses

COST = "id int, segment string, year int, value double"
WEIGHTS = [("Sin holding", "SMB", 2024, 0.6), ("Sin holding", "Enterprise", 2024, 0.4)]


def _spread(spark, how):
    cost = spark.createDataFrame(
        [(1, "Sin holding", 2024, 10.0), (2, "SME", 2024, 5.0), (3, "Sin holding", 2023, 7.0), (4, None, 2024, 1.0)], COST)
    weights = spark.createDataFrame(WEIGHTS, "o_segment string, to_segment string, year int, w double")
    return A.allocate(cost, weights, {"segment": "o_segment", "year": "year"}, "value", "w", "out",
                      {"final": ("to_segment", "segment")}, where=F.col("segment") == "Sin holding", how=how)


def test_allocate_keeps_or_drops_rows_without_a_weight(spark, join_path):
    direct = [(2, "SME", 5.0), (4, None, 1.0)]
    spread = [(1, "Enterprise", 4.0), (1, "SMB", 6.0)]
    assert rows(_spread(spark, "left"), "id", "final", "out") == sorted(spread + [(3, None, None)] + direct, key=lambda r: r[0])
    assert rows(_spread(spark, "inner"), "id", "final", "out") == sorted(spread + direct, key=lambda r: r[0])


def test_head_office_weights_lose_a_ten_thousandth(spark):
    df = spark.createDataFrame([("HQ", 300.0), ("CL", 10.0), ("US", 4.0), (None, 5.0)], "o_service_country string, original_value double")
    got = rows(expenses.split_head_office(df), "o_service_country", "f_service_country", "value_usd_distr")
    assert [(o, f) for o, f, _ in got] == [(None, None), ("CL", "CL"), ("HQ", "CL"), ("HQ", "ES"), ("HQ", "MX"), ("US", None)]
    assert sum(v for o, _, v in got if o == "HQ") == pytest.approx(300 * 0.9999)
    assert [v for o, _, v in got if o in (None, "US")] == [None, None]


def test_weight_report(spark):
    weights = spark.createDataFrame(R.HEAD_OFFICE_WEIGHTS, "o string, f string, w double")
    assert [r["o"] for r in A.check_weights(weights, ["o"], "w").collect()] == ["HQ"]


def test_vendor_scale_and_template(spark):
    df = spark.createDataFrame([("V", 10.0), ("W", 10.0), (None, 10.0)], "vendor string, total double")
    scaled = df.select("vendor", A.scale_for("vendor", "V", "total", 0.7))
    assert rows(scaled) == [(None, 10.0), ("V", 7.0), ("W", 10.0)]
    months = spark.createDataFrame([(2024, 1), (2024, 2)], "year int, month int")
    repeated = A.cross_templates(months, [{"c": "CL", "v": 350.0}, {"c": "MX", "v": 350.0}])
    assert rows(repeated) == [(2024, 1, "CL", 350.0), (2024, 1, "MX", 350.0), (2024, 2, "CL", 350.0), (2024, 2, "MX", 350.0)]
    assert "Join" not in repeated._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("account, department, expected", [
    ("Others", "Finance", "demand"),  # the first rule wins over later ones naming the same account
    ("Memberships", "Sales", "demand"), ("Merchandising", "Sales", "demand"),
    ("Events", "Marketing", "demand"), ("Event", "Sales", "conversion"), ("Events", "RevOps", "non_payroll"),
    ("Travels", "Sales", "conversion"), ("Travels", "Marketing", "non_payroll"), ("Travels", "Finance", None),
    ("Payroll", "Sales", "payroll"), ("Payroll", "RevOps", None), ("Benefits", None, "payroll"), (None, "Sales", None),
])
def test_cost_sub_types(spark, account, department, expected):
    df = spark.createDataFrame([(account, department)], "management_account_name string, management_department string")
    got = df.withColumn("sub_type", C.classify(R.COST_SUBTYPE_RULES)).withColumn("type", C.cost_type()).first()
    assert got["sub_type"] == expected
    assert got["type"] == ("initiatives" if expected in ("demand", "conversion") else "other")


@pytest.mark.parametrize("segment, expected", [
    ("Sin holding", "distribuible"), ("SME", "no_distribuible"), ("Enterprise", "no_distribuible"), ("SMB", None), (None, None),
])
def test_allocation_tag(spark, segment, expected):
    df = spark.createDataFrame([(segment,)], "holding_segment string")
    assert df.select(C.allocation_tag().alias("t")).first()["t"] == expected


@pytest.mark.parametrize("stream, segment, country, expected", [
    ("Employee Benefit", "Sin holding", "CL", "no_atribuible"),
    ("Employee Benefit", "Sin holding", "HQ", "no_atribuible_pais_corp"),
    ("Employee Benefit", "SMB", "HQ", "no_atribuible_pais_corp"),
    ("Employee Benefit", "Affinity", "HQ", "atribuible"),
    ("Employee Benefit", "SMB", "CL", "atribuible"),
    ("Employee Benefit", "Sin holding", None, "atribuible"),
    ("Affinity", "Sin holding", "CL", "atribuible"), ("Affinity", "SMB", "HQ", "no_atribuible_pais_corp"),
    ("N/R", "Sin holding", "CL", "no_atribuible"), ("N/R", "Affinity", "HQ", "no_atribuible_pais_corp"),
    ("N/R", "SMB", "CL", "atribuible"), ("Rewards", "SMB", "CL", None),
])
def test_attribution_rules(spark, stream, segment, country, expected):
    df = spark.createDataFrame([(stream, segment, country)], "revenue_stream string, holding_segment string, service_country string")
    assert df.select(C.attribution_category().alias("c")).first()["c"] == expected


@pytest.mark.parametrize("name, expected", [
    ("Gasto SME x", "SMB"), ("gasto smb", "SMB"), ("SMEs", "dim"), ("affinity fee", "Affinity"), ("Enterprise", "Enterprise"),
    ("big corps", "Enterprise"), ("General", "dim"), (None, "dim"),
])
def test_segment_from_account_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(expenses.segment_from_name("n", F.lit("dim")).alias("s")).first()["s"] == expected


def test_expense_cube_needs_a_known_chart(spark):
    import datetime as dt

    with pytest.raises(ValueError):
        expenses.expense_cube({}, "c", (dt.date(2024, 1, 1), dt.date(2024, 2, 1)))
