"""Expense cube, expense control and cost allocation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.scalars import (
    converted,
    first_match,
    first_of,
    in_list,
    is_blank,
    like_first_match,
    month_of,
    not_in_list,
    year_of,
)
from ledgerloom.operators.allocate import allocate, cross_templates, cutover_union, scale_for
from ledgerloom.operators.classify import (
    allocation_tag,
    attribution_category,
    attribution_label,
    classify,
    cost_type,
)
from ledgerloom.operators.fx import fx_convert
from ledgerloom.operators.lookup import Key, lookup, same
from ledgerloom.sources.schemas import EXPENSE_CUBE_COLUMNS
from ledgerloom.sources.shapes import literal_table
from ledgerloom.sources.warehouse import Tables

# --- fixed values: filters of the allocation plans ---------------------------------------------------
SALES_CLASS = "S&M"
SGA = "SG&A"
COGS = "COGS"
PROFIT_AND_LOSS = "P&L"
REAL = "REAL"
V3_EXCLUDED_STREAMS = ("Vouchers", "Rewards", "Affinity")
V3_EXCLUDED_DEPARTMENTS = ("Success", "Product Marketing")
V3_EXCLUDED_OPERATIONS_ACCOUNTS = ("Payroll", "Benefits", "Severance")
V3_EXCLUDED_ACCOUNTS = ("ENGAGEMENT", "ONBOARDING", "RETENTION", "UNCOLLECTIBLE ACCOUNTS")
OLD_EXCLUDED_STREAMS = ("Vouchers", "Rewards")
OLD_EXCLUDED_UNIT = "Financial Services"
EXCLUDED_DEPARTMENTS = ("Success", "Insurance")
MANAGEMENT_EXCLUDED_ACCOUNTS = (
    "Non-Operational", "Uncollectible Accounts", "Payroll", "Severance", "Intercompany", "Benefits", "Travels",
)
FINANCIAL_EXCLUDED_ACCOUNTS = (
    "Non-Operational", "Uncollectible Accounts", "Severance", "Intercompany", "Benefits", "Travels", "Onboarding",
    "Engagement", "Office Supplies", "Retention", "Revenue", "Uncollectible accounts", "Payroll",
)
VENDOR_CHECKED_ACCOUNTS = ("Professional Services", "Digital Tools")
PAYROLL_CUTOVER = dt.date(2025, 8, 1)


def in_dates(df: DataFrame, start: dt.date, end: dt.date, column: str = "full_date") -> DataFrame:
    """Rows from `start` up to, not including, `end`."""
    day = F.col(column)
    return df.filter((day >= F.lit(start)) & (day < F.lit(end)))


# ---- expense cube ----------------------------------------------------------------------------------


def expense_cube(t: Tables, chart: str, dates: tuple[dt.date, dt.date]) -> DataFrame:
    """Expense lines with management accounts, departments, segments and USD values.

    `chart` names the chart of accounts, `a` or `b`. The date range is required, so that the lines
    are never read in full by accident; it reaches the file scan.
    """
    if chart not in ("a", "b"):
        raise ValueError(f"unknown chart of accounts {chart!r}")
    base = in_dates(t[f"expenses_base_{chart}"], *dates)
    return _cube_a(t, base) if chart == "a" else _cube_b(t, base)


def _any_case(left: str, right: str) -> Key:
    return Key(left, right, left_by=F.upper, right_by=F.upper)


ACCOUNT_ATTRIBUTES = {
    "management_account_name": "management_account_name",
    "management_account_classification": "mgmt_account_classification",
    "management_account_subclassification": "mgmt_account_subclasification",
}


def _finish(t: Tables, df: DataFrame) -> DataFrame:
    named = lookup(
        df, t["departments"], [_any_case("management_department", "management_department")],
        ["department_classification"],
    )
    valued = fx_convert(
        named, t["fx_budget"], "value_lc", "full_date", "currency", "value_usd_bdg", "value_fx_bdg", any_case=True
    )
    dated = valued.withColumns({"month": month_of("full_date"), "year": year_of("full_date")})
    return dated.select(*EXPENSE_CUBE_COLUMNS)


def _cube_a(t: Tables, base: DataFrame) -> DataFrame:
    with_accounts = lookup(
        base, t["accounts_a"],
        [Key("accounting_account_id", "accounting_account_id"), _any_case("legal_entity_name", "legal_entity_name")],
        {"management_account_id": "management_account_id", **ACCOUNT_ATTRIBUTES},
    )
    with_centers = lookup(
        with_accounts, t["cost_centers"],
        [
            _any_case("accounting_cost_center_dim1_name", "accounting_cost_center_dim1_name"),
            _any_case("legal_entity_name", "legal_entity_name"),
        ],
        {
            "management_department": "management_department", "holding_segment": "center_segment",
            "sales_channel": "sales_channel", "revenue_stream": "revenue_stream",
        },
    )
    with_country = lookup(
        with_centers, t["cost_country"],
        [_any_case("accounting_cost_center_dim2_name", "accounting_cost_center_dim2_name")], ["service_country"],
    )
    unit_keys = [
        *same("sales_channel", "management_department", "revenue_stream", "service_country"),
        Key("center_segment", "holding_segment"),
    ]
    with_unit = lookup(with_country, t["business_units"], unit_keys, {"business_unit": "listed_unit"})
    partner = F.col("business_partner_name")
    return _finish(t, with_unit.withColumns({
        "holding_segment": segment_from_name("accounting_account_name", F.col("center_segment")),
        "business_unit": first_match(
            [(partner == "ENTERPRISE", F.lit("Enterprise")), (partner == "SMB", F.lit("SMB"))], F.col("listed_unit")
        ),
    }))


def segment_from_name(account_name: str, default: Column) -> Column:
    """Segment named in the account, else the given one."""
    return like_first_match(account_name, R.SEGMENT_PATTERNS, default)


def _cube_b(t: Tables, base: DataFrame) -> DataFrame:
    with_accounts = lookup(
        base, t["accounts_b"], [Key("accounting_account_id", "accounting_account_id")], ACCOUNT_ATTRIBUTES
    )
    with_areas = lookup(
        with_accounts, t["areas_b"], [_any_case("accounting_department_name", "accounting_department_name")],
        ["management_department", "sales_channel", "revenue_stream"],
    )
    with_country = lookup(
        with_areas, t["cost_country"], [_any_case("accounting_country_name", "accounting_cost_center_dim2_name")],
        ["service_country"],
    )
    segment = F.col("segment_name")
    return _finish(t, with_country.withColumns({
        "management_account_id": F.lit(None).cast("string"),
        "holding_segment": F.when(is_blank(segment), R.NO_SEGMENT).when(segment == "SME", "SMB").otherwise(segment),
        "business_unit": F.when(segment == "ENTERPRISE", "Enterprise").when(segment == "SME", "SMB"),
    }).withColumnsRenamed({
        "accounting_department_id": "accounting_cost_center_dim1_id",
        "accounting_department_name": "accounting_cost_center_dim1_name",
        "accounting_country_id": "accounting_cost_center_dim2_id",
        "accounting_country_name": "accounting_cost_center_dim2_name",
        "product_id": "project_id",
        "product_name": "project_name",
    }))


# ---- expense control -------------------------------------------------------------------------------


def expense_control(t: Tables, rules: R.Rules, min_year: int = 2025) -> DataFrame:
    """Cost by control group and sub-group. Accounts in no group are left out."""
    house = rules.expense
    cube = t["expense_cube"].filter(
        (F.col("year") >= min_year)
        & (F.col("mgmt_account_classification") == PROFIT_AND_LOSS)
        & (F.col("mgmt_account_subclasification") == SGA)
        & (F.col("version") == REAL)
        & (F.col("subversion") == REAL)
        & not_in_list("management_account_name", R.CONTROL_EXCLUDED_ACCOUNTS)
        & not_in_list("transaction_detail", house.excluded_details)
    )
    account, partner = F.col("management_account_name"), F.col("business_partner_name")
    group = F.when(account.isin(*R.PAYROLL_ACCOUNTS), "Payroll").when(
        account.isin(*R.NON_PAYROLL_ACCOUNTS), "Non-Payroll"
    )
    services = account == "Professional Services"
    all_hands = (partner.like(house.all_hands_pattern), F.lit("All Hands"))
    subgroup = first_match(
        [
            (services & in_list(partner, house.outsourcing_vendors), F.lit("Outsourcing")),
            (services & in_list(partner, house.external_payroll_vendors), F.lit("Payroll Externo")),
            all_hands,
        ],
        account,
    )
    department = F.when(F.upper("source").like(house.rewards_source_pattern), "Rewards").otherwise(
        F.col("management_department")
    )
    shaped = cube.filter(group.isNotNull()).select(
        "year", "month", "service_country", "department_classification",
        department.alias("management_department"), group.alias("control_group"),
        first_match([all_hands], account).alias("management_account_name"),
        subgroup.alias("control_subgroup"), "business_partner_name", "holding_segment", "transaction_detail",
        "source", "revenue_stream", converted("value_usd_bdg").alias("value_usd"),
    )
    keys = [c for c in shaped.columns if c != "value_usd"]
    return shaped.groupBy(*keys).agg(F.sum("value_usd").cast("double").alias("value_usd"))


# ---- acquisition cost ------------------------------------------------------------------------------


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(converted("value_usd_bdg")).cast("double").alias("value_expense"))


def acquisition_cost(t: Tables, min_year: int = 2024, min_month: int = 11) -> DataFrame:
    """Acquisition cost: cost without a segment is spread over segments by monthly weights, direct
    cost is kept, and every row gets a sub-type and type. Late months of every year pass, as well as
    all months from `min_year` on."""
    department, account = F.col("management_department"), F.col("management_account_name")
    cube = t["expense_cube"].filter(
        (F.col("department_classification") == SALES_CLASS)
        & (F.col("mgmt_account_subclasification") == SGA)
        & not_in_list("revenue_stream", V3_EXCLUDED_STREAMS)
        & (F.col("holding_segment") != "Affinity")
        & (F.col("subversion") == REAL)
        & not_in_list(department, V3_EXCLUDED_DEPARTMENTS)
        & ~((department == "RevOps") & account.isin(*V3_EXCLUDED_OPERATIONS_ACCOUNTS))
        & not_in_list(F.upper(account), V3_EXCLUDED_ACCOUNTS)
        & ((F.col("year") >= min_year) | (F.col("month") >= min_month))
    )
    summed = _summed(
        cube, "year", "month", "revenue_stream", "management_department", "service_country",
        "management_account_name", "holding_segment", "business_partner_name", "source",
    )
    tagged = summed.withColumn("distribuir_check_tag", allocation_tag()).filter(
        F.col("distribuir_check_tag").isNotNull() & (F.col("value_expense") != 0)
    ).withColumnsRenamed({"holding_segment": "o_holding_segment", "value_expense": "o_value_expense"})
    spread = allocate(
        tagged, t["weights_v3"],
        {"o_holding_segment": "o_holding_segment", "year": "year", "month": "month"},
        "o_value_expense", "parametro", "value_expense",
        {"holding_segment": ("holding_segment", "o_holding_segment")},
        where=F.col("distribuir_check_tag") == "distribuible",
    )
    typed = spread.withColumns({
        "full_date": first_of("year", "month"),
        "sub_type": classify(R.COST_SUBTYPE_RULES),
    }).withColumn("type", cost_type())
    return typed.select(
        "year", "month", "revenue_stream", "management_department", "service_country", "management_account_name",
        "o_holding_segment", "holding_segment", "source", "distribuir_check_tag", "o_value_expense",
        "value_expense", "full_date", "sub_type", "type",
    )


def acquisition_cost_by_attribution(t: Tables) -> DataFrame:
    """Older allocation: rules per stream decide what is spread; the weights also move cost to
    another stream, country and segment. Cost to be spread without a weight is dropped."""
    department, account = F.col("management_department"), F.col("management_account_name")
    cube = t["expense_cube"].filter(
        (F.col("department_classification") == SALES_CLASS)
        & (F.col("mgmt_account_subclasification") == SGA)
        & not_in_list("revenue_stream", OLD_EXCLUDED_STREAMS)
        & (F.col("business_unit") != OLD_EXCLUDED_UNIT)
        & (F.col("subversion") == REAL)
        & (department != "Success")
        & ~((department == "RevOps") & (account == "Payroll"))
    )
    summed = _summed(
        cube, "year", "month", "revenue_stream", "business_unit", "management_department", "service_country",
        "mgmt_account_classification", "management_account_name", "holding_segment", "business_partner_name",
        "source",
    )
    labelled = summed.withColumn("category", attribution_category()).filter(
        F.col("category").isNotNull() & (F.col("value_expense") != 0)
    ).withColumnsRenamed({
        "revenue_stream": "o_revenue_stream", "holding_segment": "o_holding_segment",
        "service_country": "o_service_country", "value_expense": "o_value_expense",
    })
    moved = allocate(
        labelled, t["weights_old"],
        {c: c for c in ("o_revenue_stream", "o_holding_segment", "o_service_country")},
        "o_value_expense", "parametro", "value_expense",
        {
            "revenue_stream": ("revenue_stream", "o_revenue_stream"),
            "holding_segment": ("holding_segment", "o_holding_segment"),
            "final_service_country": ("service_country", "o_service_country"),
        },
        where=F.col("category") != "atribuible", how="inner",
    )
    payroll = F.when(F.upper(account).isin("PAYROLL", "SEVERANCE"), "payroll").otherwise("non-payroll")
    label = attribution_label("category")
    keyed = moved.withColumns({
        "tag_categoria_cac": label,
        "full_date": F.date_format(first_of("year", "month"), "yyyy-MM-dd"),
        "aux": F.concat(department, F.lit("-"), payroll, F.lit("-"), label),
    })
    return tag_lookup(keyed, t["tags"]).select(
        "year", "month", "revenue_stream", "management_department", "o_service_country", "final_service_country",
        "management_account_name", "holding_segment", "source", "tag_categoria_cac", "value_expense", "full_date",
        "aux", "tag_cac",
    )


def tag_lookup(df: DataFrame, tags: DataFrame, key: str = "aux") -> DataFrame:
    """Add the initiative tag of a composite key."""
    return lookup(df, tags, [Key(key, "aux")], ["tag_cac"])


def _vendor_scope(cube: DataFrame, min_year: int) -> DataFrame:
    return cube.filter(
        (F.col("mgmt_account_subclasification") == SGA)
        & (F.col("year") >= min_year)
        & (F.col("department_classification") == SALES_CLASS)
    )


VENDOR_KEYS = (
    "year", "month", "o_service_country", "management_department", "management_account_name",
    "business_partner_name",
)


def split_head_office(df: DataFrame) -> DataFrame:
    """Spread each origin country's cost over destination countries by the fixed weights. Head
    office goes to three countries; origins not listed keep a NULL destination and amount."""
    weights = literal_table(
        df.sparkSession, R.HEAD_OFFICE_WEIGHTS, "o_country string, f_service_country string, percentage double"
    )
    return allocate(
        df, weights, {"o_service_country": "o_country"}, "original_value", "percentage", "value_usd_distr",
        {"f_service_country": ("f_service_country", "o_service_country")},
    )


DISTRIBUTED_COLUMNS = (
    "year", "month", "o_service_country", "f_service_country", "management_department",
    "management_account_name", "business_partner_name", "original_value", "value_usd_distr",
)


def management_cost(t: Tables, rules: R.Rules, min_year: int = 2024) -> DataFrame:
    """Management view: vendor cost per destination country plus a fixed monthly template."""
    house = rules.expense
    account, partner = F.col("management_account_name"), F.col("business_partner_name")
    cube = _vendor_scope(t["expense_cube"], min_year).filter(
        not_in_list("management_department", EXCLUDED_DEPARTMENTS)
        & not_in_list(account, MANAGEMENT_EXCLUDED_ACCOUNTS)
        & not_in_list(partner, house.service_vendors)
    ).withColumnRenamed("service_country", "o_service_country")
    checked = account.isin(*VENDOR_CHECKED_ACCOUNTS)
    kept = cube.filter((checked & in_list(partner, house.management_vendors)) | ~checked)
    summed = _summed(kept, *VENDOR_KEYS).withColumnRenamed("value_expense", "original_value")
    distributed = split_head_office(summed).select(*DISTRIBUTED_COLUMNS)

    months = cube.select("year", "month").distinct()
    template = [
        {
            "o_service_country": c, "f_service_country": c, "management_department": "Marketing",
            "management_account_name": "Professional Services", "business_partner_name": house.template_vendor,
            "original_value": R.MONTHLY_TEMPLATE_AMOUNT, "value_usd_distr": R.MONTHLY_TEMPLATE_AMOUNT,
        }
        for c in R.MONTHLY_TEMPLATE_COUNTRIES
    ]
    return distributed.unionByName(cross_templates(months, template).select(*DISTRIBUTED_COLUMNS))


def financial_cost(
    t: Tables, rules: R.Rules, min_year: int = 2024, cutover: dt.date = PAYROLL_CUTOVER
) -> DataFrame:
    """Financial view: vendor cost, ledger payroll before the cut-over and the external payroll
    table, per destination country, with a label telling which cost view a row belongs to."""
    house = rules.expense
    account, partner = F.col("management_account_name"), F.col("business_partner_name")
    department = F.col("management_department")
    cube = _vendor_scope(t["expense_cube"], min_year).filter(
        (F.col("accounting_account_name") != R.VACATION_ACCOUNT)
        & not_in_list(department, EXCLUDED_DEPARTMENTS)
        & (F.col("subversion") == REAL)
        & (F.col("version") == REAL)
        & ~F.upper("source").like(house.rewards_source_pattern)
        & ~F.upper(account).like("%COGS%")
    )
    vendor_cost = not_in_list(account, FINANCIAL_EXCLUDED_ACCOUNTS) & not_in_list(partner, house.service_vendors)
    payroll = (account == "Payroll") & (department != "RevOps") & (F.col("full_date") < F.lit(cutover))
    # The two kinds never share an account, so one scan and one grouping serve both.
    summed = _summed(
        cube.filter(vendor_cost | payroll).withColumnRenamed("service_country", "o_service_country"), *VENDOR_KEYS
    ).withColumn(
        "original_value",
        F.when(account == "Payroll", F.col("value_expense")).otherwise(
            scale_for(partner, house.scaled_vendor, "value_expense", house.scaled_factor)
        ),
    )
    distributed = split_head_office(summed).select(*DISTRIBUTED_COLUMNS)
    both = cutover_union(distributed, t["payroll_external"])
    tools = in_list(partner, house.tool_vendors) & (account == "Digital Tools")
    label = first_match(
        [
            (account.isin(*R.FINANCIAL_SPLIT_ACCOUNTS), F.lit("cac_financiero")),
            (
                tools | in_list(partner, house.always_management_vendors)
                | account.isin(*R.MANAGEMENT_SPLIT_ACCOUNTS),
                F.lit("gestion"),
            ),
        ],
        "cac_financiero",
    )
    return both.withColumn("separacion_cac", label)
