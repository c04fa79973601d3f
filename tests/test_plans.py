"""Invariants of the plans on generated data, and results independent of partitioning."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import RULES, ViewTables, queries
from helpers import rows
from ledgerloom import rules as R
from ledgerloom.plans import acquisition, revenue, rewards


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return ViewTables(spark, sf_dir)


def test_reconciliation_never_mixes_kinds(tables):
    lines = revenue.revenue_lines(tables, RULES)
    kinds = lines.groupBy("holding_name", "full_date", "revenue_stream").agg(
        F.countDistinct("document_status").alias("n"),
        F.max(F.col("document_type").isin(*R.ACTUAL_TYPES).cast("int")).alias("actual"),
        F.max(F.col("document_type").isin(*R.PROVISIONAL_TYPES).cast("int")).alias("provisional"),
    )
    assert kinds.filter("n > 1 OR (actual = 1 AND provisional = 1)").count() == 0


@pytest.mark.parametrize("variant", ["with_product", "main_family"])
def test_movement_identity_and_gap_filled_months(tables, variant):
    v = revenue.BUILDUPS[variant]
    months = revenue.reconciled_months(tables, RULES, v)
    grain = [c for c in months.columns if c not in ("full_date", *revenue.MONTH_MEASURES)]
    span = (F.year(F.max("full_date")) - F.year(F.min("full_date"))) * 12 + F.month(F.max("full_date")) - F.month(F.min("full_date")) + 1
    expected = months.groupBy(*grain).agg(span.alias("n")).agg(F.sum("n")).first()[0]
    if v.cohort == "dimension":
        assert revenue.revenue_base(tables, months, v).count() == expected
    built = revenue.buildup(tables, RULES, variant)
    later = built.filter("invoice_number > 2")
    for m in revenue.MEASURES:
        assert later.filter(F.abs(F.col(f"{m}_bop") + F.col(f"{m}_retention") - F.col(f"{m}_eop")) > 1e-6).count() == 0
    if v.exclude_addon_logos:
        addon = built.filter(F.col("product") == R.ADDON_PRODUCT)
        assert addon.filter("logo_bop + logo_new + logo_churn + logo_eop > 0").count() == 0


def test_unpivot_keeps_totals(spark, sf_dir):
    stacked = queries()["pnl_stack"](spark, sf_dir)
    built = queries()["buildup_with_product"](spark, sf_dir).filter("year >= 1997")
    got = {r["pnl_line"]: r["v"] for r in stacked.groupBy("pnl_line").agg(F.sum("amount_local").alias("v")).collect()}
    want = built.agg(F.sum("value_lc_new"), F.sum("logo_eop"), F.sum("members_churn")).first()
    assert got["Revenue_New"] == pytest.approx(want[0])
    assert got["Logos_EoP"] == want[1]
    assert got["Members_Churn"] == pytest.approx(want[2])
    assert len(got) == 11


def test_shares_add_up_to_one(spark, sf_dir):
    shares = queries()["client_revenue_share"](spark, sf_dir).groupBy("service_date", "country").agg(
        F.sum("revenue_weight").alias("s"), F.sum("revenue").alias("r"))
    assert shares.filter((F.abs(F.col("s") - 1) > 1e-9) & (F.abs("r") > 0.01)).count() == 0


@pytest.mark.parametrize("name", ["period_context", "first_time_company"])
def test_result_does_not_depend_on_partitioning(spark, sf_dir, name):
    def result(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            df = queries()[name](spark, sf_dir)
            hashes = df.select(F.xxhash64(*df.columns).alias("h"))
            return hashes.agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    assert result(1) == result(13)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = queries()["expense_cube_b"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    fact = next(line for line in plan.splitlines() if "lineitem.parquet" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate,1996-02-01T00:00)" in fact and "LessThan(l_shipdate" in fact
    lean = queries()["meetings_by_month"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    schema = next(re.search(r"ReadSchema: (\S+)", line)[1] for line in lean.splitlines() if "lineitem.parquet" in line)
    assert "l_extendedprice" not in schema and "l_orderkey" in schema


def test_unmatched_clients_are_dropped_by_the_holding_join(tables):
    months = revenue.reconciled_months(tables, RULES, revenue.BUILDUPS["with_product"])
    assert months.filter("holding_name IS NULL OR holding_name = ''").count() == 0
    plan = months._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "tax_id_client" in line or "__k0" in line and "Join" in line]
    assert joins and all("Inner" in line for line in joins)


# ---- hand-worked plans -------------------------------------------------------------------------------


def test_buildup_by_hand(spark):
    d = lambda m: dt.date(2024, m, 1)
    ledger = ("legal_client_id string, document_type string, revenue_stream string, quantity_charged double, "
              "value_lc double, local_currency string, service_date date, legal_entity_country string, "
              "sponsor string, product string")
    base = [
        ("7.1-k", "Invoice", "EB", 10.0, 100.0, "BRL", d(1), "BR", None, ""),
        ("7.1-k", "Provision", "EB", 99.0, 999.0, "BRL", d(1), "BR", None, ""),       # settled by the invoice
        ("71K", "Provision", "EB", 5.0, 50.0, "BRL", d(3), "BR", None, None),          # no invoice: kept
        ("71K", "Invoice", "EB", 3.0, 30.0, "BRL", d(1), "BR", None, "S.C cargas"),    # add-on: value, no members
        ("8", "Invoice", "EB", 1.0, 10.0, "BRL", d(1), "BR", None, ""),                # no holding
        ("71K", "Invoice", "Staff", 1.0, 10.0, "BRL", d(1), "BR", None, ""),           # excluded stream
        ("71K", "Free", "EB", 1.0, 10.0, "BRL", d(2), "BR", None, ""),                 # free document
        ("71K", "Invoice", "EB", 1.0, 20.0, "BRL", d(2), "BR", None, ""),
        ("71K", "Credit Note", "EB", 1.0, -20.0, "BRL", d(2), "BR", None, ""),         # adds up to zero: a gap
    ]
    empty = spark.createDataFrame([], ledger)
    tables = {
        "ledger_current": spark.createDataFrame(base, ledger), "ledger_history": empty, "ledger_history_old": empty,
        "ledger_corrections": empty,
        "holdings": spark.createDataFrame(
            [("71-K", "H", "EB", "BR", "SME", "x", d(1))],
            "tax_id_client string, holding_name string, revenue_stream string, service_country string, "
            "client_segment string, business_unit string, holding_cohort date"),
        "fx_budget": spark.createDataFrame([("2024", "BRL", 5.0)], "Year string, Currency string, Value double"),
        "cube_other_country": spark.createDataFrame(
            [], "full_date date, service_country string, holding_name string, holding_cohort date, "
            "client_segment string, local_currency string, sponsor string, revenue_stream string, product string, "
            "value_lc double, value_usd_bdg double, quantity_charged double"),
    }
    got = revenue.buildup(tables, RULES, "with_product")
    wanted = ["month", "product", "value_lc", "members", "value_usd_eop", "invoice_number", "members_new",
              "members_retention", "members_churn", "value_lc_new", "logo_new", "logo_churn", "logo_bop"]
    by_key = {(r["month"], r["product"]): tuple(r)[2:] for r in got.select(*wanted).collect()}
    assert set(by_key) == {(1, "EB-XX-1"), (2, "EB-XX-1"), (3, "EB-XX-1"), (1, "S.C")}
    approx = lambda *v: pytest.approx(v)
    # One period series over both products; in January the default product comes first.
    assert by_key[(1, "EB-XX-1")] == approx(88.0, 10.0, 17.6, 0, 10.0, 0.0, 0.0, 88.0, 1, 0, 1)
    assert by_key[(1, "S.C")] == approx(26.4, 0.0, 5.28, 0, 0.0, 0.0, 0.0, 26.4, 1, 0, 1)
    assert by_key[(2, "EB-XX-1")] == approx(0.0, 0.0, 0.0, 1, 0.0, 0.0, 0.0, 0.0, 0, 0, 1)
    # March is month 2 after a zero month; two back is the add-on row of January, without members.
    assert by_key[(3, "EB-XX-1")] == approx(44.0, 5.0, 8.8, 2, 5.0, 0.0, 5.0, 17.6, 0, 1, 1)


DEAL = ("deal_id string, company_id string, deal_name string, deal_stage string, deal_pipeline string, "
        "deal_country string, company_size string, product_modules string, development_type string, "
        "value_proposition string, partnership_demand_name string, number_of_employees long, closed_amount double, "
        "closed_date date, created_date date, last_modified_date timestamp")


def test_deals_by_hand(spark):
    def deal(i, company, **changes):
        row = dict(
            deal_id=i, company_id=company, deal_name="Deal", deal_stage="Cierres ganados",
            deal_pipeline="Pipeline de Ventas", deal_country="Chile", company_size="SME", product_modules=None,
            development_type=None, value_proposition="x", partnership_demand_name=None, number_of_employees=5,
            closed_amount=1.0, closed_date=dt.date(2024, 5, 1), created_date=dt.date(2024, 5, 1),
            last_modified_date=dt.datetime(2024, 6, 1))
        return tuple({**row, **changes}.values())

    spain = dict(deal_stage="x Closed Won y", deal_pipeline="Iberia", deal_country="Spain", value_proposition=None)
    data = [
        deal("a", "K"), deal("a", "K"),  # two equal versions are one deal
        deal("b", "K"),  # same month: the smaller id is first
        deal("c", None), deal("d", None),
        deal("e", "L", value_proposition=None),  # outside Spain a missing proposition is dropped
        deal("f", "M", deal_name=None), deal("g", "M", deal_name="TEST one"),
        deal("h", "M", development_type="Piloto A"), deal("i", "M", product_modules="Gift Cards"),
        deal("j", "J", **spain), deal("k", "J", **spain),
        deal("k", "J", **{**spain, "deal_stage": "Lost", "last_modified_date": dt.datetime(2024, 7, 1)}),  # latest: lost
        deal("l", "J", **{**spain, "company_size": "other"}),  # no business unit
        deal("m", "J", **{**spain, "created_date": dt.date(2024, 5, 31)}),  # created on the reporting date
    ]
    tables = {"deal_versions": spark.createDataFrame(data, DEAL)}
    got = acquisition.booked_logos(tables, RULES, dt.date(2023, 11, 1), dt.date(2024, 5, 31))
    assert rows(got, "deal_id", "company_repeat_check", "company_count", "company_count_post_check") == [
        ("a", "no repetido", 1, 1), ("b", "repetido", 1, 0), ("c", "no repetido", 0, None), ("d", "no repetido", 0, None),
        ("j", "no repetido", 1, 1)]
    members = acquisition.booked_members(tables, RULES, dt.date(2023, 11, 1), dt.date(2024, 5, 31))
    # Equal deals outside Spain stay apart (a, b, c, d), those in Spain collapse.
    assert members.count() == 5


def test_expense_allocation_totals(tables):
    from ledgerloom.plans import expenses

    spread = expenses.acquisition_cost(tables, 1997).filter("distribuir_check_tag = 'distribuible'")
    keys = ["year", "month", "revenue_stream", "management_department", "service_country", "management_account_name", "source"]
    per_group = spread.filter("value_expense IS NOT NULL").groupBy(*keys).agg(
        F.sum("value_expense").alias("out"), (F.sum("o_value_expense") / 2).alias("cost"))
    assert per_group.count() > 0
    assert per_group.filter(F.abs(F.col("out") - F.col("cost")) > 0.01).count() == 0


def test_rewards_loaded_pattern_and_months(tables):
    got = rewards.loaded(tables, RULES, dt.date(2024, 1, 1), dt.date(2024, 1, 20))
    assert got.filter(~F.col("transactionId").rlike(r"OP\d+|[MX|CO|CL|COP|PE]-\d+")).count() == 0
    assert [tuple(r) for r in got.select("AnoMes Loaded").distinct().collect()] == [(202401,)]
    assert rewards.loaded(tables, RULES, dt.date(2024, 1, 1), dt.date(2023, 12, 31)).count() == 0


def test_product_cohort_unifies_spellings_of_an_id(spark):
    import datetime as dt

    from ledgerloom.plans.revenue import product_cohort

    day = dt.date(2024, 5, 1)
    ledger = spark.createDataFrame(
        [("7.1-k", "CL", "S.C", day), ("71K", "CL", "S.C", dt.date(2024, 3, 1)), ("71K", "MX", "S.C", day), ("71K", "CL", "other", day)],
        "legal_client_id string, legal_entity_country string, product string, service_date date",
    )
    holdings = spark.createDataFrame([("71K", "H")], "tax_id_client string, holding_name string")
    got = product_cohort({"ledger_current": ledger, "holdings": holdings})
    assert sorted((r["product_cohort"], r["service_country"], r["legal_client_id"], r["holding_name"]) for r in got.collect()) == [
        (dt.date(2024, 3, 1), "CL", "71K", "H"), (day, "MX", "71K", "H")]
