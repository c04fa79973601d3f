"""The input tables of the plans, derived from the given test tables.

Each view is one SELECT in SQL that both Spark and the checking engine accept. `{name}` stands for
another view or a given table. Spark composes the views into one lazy plan; the checking engine gets
them as common table expressions. All views cover the whole tables they read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _values(rows: list[tuple], names: str) -> str:
    def literal(v: object) -> str:
        if v is None:
            return "CAST(NULL AS STRING)"
        return f"'{v}'" if isinstance(v, str) else repr(v)

    body = ",\n  ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(VALUES\n  {body}) AS v({names})"


def _text(c: str) -> str:
    return f"CAST({c} AS STRING)"


# Budget rates per year 1995..2001. One rate is zero and one is missing, to exercise both paths.
_RATES = {
    "BRL": (5.41, 5.47, 5.57, 5.63, 5.69, 5.71, 5.77),
    "CLP": (883.7, 883.9, 884.9, 886.1, 886.3, 886.7, 888.7),
    "MXN": (18.11, 18.23, 18.31, 18.47, 18.61, 18.67, 18.71),
    "EUR": (0.907, 0.911, 0.919, 0.929, 0.937, 0.941, 0.947),
    "COP": (4111.0, 4127.0, 4129.0, 4133.0, 4139.0, 4153.0, 4157.0),
}
_FX_ROWS = [
    (str(1995 + i), currency, 0.0 if (currency, i) == ("COP", 2) else rate)
    for currency, rates in _RATES.items()
    for i, rate in enumerate(rates)
    if (currency, i) != ("MXN", 4)
]

_ACCOUNT_NAMES = (
    "Payroll", "Outsourcing", "Professional Services", "Severance", "Benefits", "Travels", "Digital Tools",
    "Events", "Paid Media", "Merchandising", "Rent", "Others", "Memberships", "Free Month", "Non-Operational",
    "Uncollectible Accounts", "COGS: Rebate", "COGS: Delivery", "Revenue", "Training", "Incentives", "Event",
    "Engagement", "Intercompany", "Depreciation",
)


def _account_row(size: int) -> tuple:
    name = _ACCOUNT_NAMES[size % len(_ACCOUNT_NAMES)]
    sub = "COGS" if name.startswith("COGS") else "Revenue" if name == "Revenue" else "SG&A"
    return (size, name, "BS" if name == "Non-Operational" else "P&L", sub)


_DEPARTMENTS = ("Marketing", "Sales", "RevOps", "Success", "Insurance", "Product Marketing", "Finance")
_SEGMENTS = ("Sin holding", "SMB", "Enterprise", "SME", "Affinity")
_STREAMS = ("Employee Benefit", "Affinity", "Rewards", "N/R", "Employee Benefits", "Vouchers")
_CENTER_ROWS = [
    (
        f"Brand#{b}", "Sales" if b % 2 else _DEPARTMENTS[(b // 2) % 7], _SEGMENTS[(b // 3) % 5],
        "Direct" if b % 3 else "Partner", _STREAMS[(b // 4) % 6] if b > 8 else "Employee Benefit",
    )
    for b in range(1, 26)
]
_COUNTRIES = ("BR", "CL", "MX", "ES", "CO", "HQ")
_UNIT_ROWS = sorted({
    (channel, department, stream, segment, country, "Financial Services" if stream == "Vouchers" else f"BU {segment}")
    for _, department, segment, channel, stream in _CENTER_ROWS
    for country in _COUNTRIES[:5]
})
_V3_WEIGHT_ROWS = [
    ("Sin holding", segment, year, month, weight)
    for year in range(1995, 2002)
    for month in range(1, 13)
    for segment, weight in (("SMB", 0.6), ("Enterprise", 0.4))
    if (year, month) != (1999, 3)
]
_OLD_WEIGHT_ROWS = [
    (stream, segment, origin, stream if stream != "N/R" else "Employee Benefit", to_segment, country, weight)
    for stream in ("Employee Benefit", "N/R")
    for segment in ("Sin holding", "SMB")
    for origin in ("HQ", "CL")
    for to_segment, country, weight in (("SMB", "CL", 0.5), ("Enterprise", "MX", 0.25), ("SMB", "ES", 0.25))
]
_TAG_ROWS = [
    (f"{d}-{p}-{c}", f"{d} {p}".lower())
    for d in ("Marketing", "Sales", "RevOps")
    for p in ("payroll", "non-payroll")
    for c in ("Local", "Distribuido local", "Corp")
    if (d, p, c) != ("Sales", "payroll", "Corp")
]

_LEDGER_COLUMNS = (
    "document_number, document_date, legal_client_id, legal_client_name, invoice_description, document_type, "
    "canceled_document, revenue_stream, quantity_charged, value_lc, local_currency, service_date, "
    "legal_entity_country, sponsor, product"
)

_CUBE_SHAPE = """
SELECT document_number, legal_client_id AS tax_id_client, legal_client_name AS client_legal_name,
  invoice_description, document_type, {stream} AS revenue_stream, document_type AS type, quantity_charged,
  value_lc, local_currency, service_date AS full_date, 'Real' AS version, CAST(0 AS DOUBLE) AS arpu,
  {segment} AS client_segment, '' AS holding_id, {holding} AS holding_name, sponsor,
  make_date(1996, 3, 1) AS holding_cohort, legal_entity_country AS service_country,
  legal_entity_country, 'Other house' AS legal_entity_name, 'Direct' AS sales_channel, {product} AS product,
  CAST(0.9 AS DOUBLE) AS fx_value_bdg, CAST(value_lc AS DOUBLE) / CAST(0.911 AS DOUBLE) AS value_usd_bdg,
  {source} AS source, CAST(month(service_date) AS BIGINT) AS month, CAST(year(service_date) AS BIGINT) AS year,
  'Facturado' AS document_status
FROM {{ledger_lines}}
WHERE {where}
"""

VIEWS: dict[str, str] = {
    # ---- shared -----------------------------------------------------------------------------------
    "places": """
SELECT n_nationkey, n_name,
  CASE WHEN n_nationkey = 0 THEN 'AR' WHEN n_nationkey = 1 THEN 'PE' WHEN n_nationkey = 2 THEN 'EC'
       WHEN n_nationkey = 3 THEN 'US' WHEN n_regionkey = 0 THEN 'BR' WHEN n_regionkey = 1 THEN 'CL'
       WHEN n_regionkey = 2 THEN 'MX' WHEN n_regionkey = 3 THEN 'ES' ELSE 'CO' END AS country,
  CASE WHEN n_regionkey = 0 THEN 'BRL' WHEN n_regionkey = 1 THEN 'CLP' WHEN n_regionkey = 2 THEN 'MXN'
       WHEN n_regionkey = 3 THEN 'EUR' ELSE 'COP' END AS currency,
  CASE WHEN n_regionkey = 0 THEN 'HQ' WHEN n_regionkey = 1 THEN 'CL' WHEN n_regionkey = 2 THEN 'MX'
       WHEN n_regionkey = 3 THEN 'ES' ELSE 'CO' END AS cost_country,
  CASE WHEN n_regionkey = 0 THEN 'Brazil' WHEN n_regionkey = 1 THEN 'Chile' WHEN n_regionkey = 2 THEN 'Mexico'
       WHEN n_regionkey = 3 THEN 'Spain' ELSE 'Colombia' END AS deal_country
FROM {nation}
""",
    "fx_budget": f"""
SELECT Year, Currency, CAST(Value AS DOUBLE) AS Value
FROM {_values(_FX_ROWS, "Year, Currency, Value")}
""",
    # ---- revenue ----------------------------------------------------------------------------------
    "ledger_lines": f"""
SELECT 'D' || {_text("l.l_orderkey")} || '-' || {_text("l.l_linenumber")} || '-' || {_text("l.l_partkey")}
    AS document_number,
  CAST(l.l_shipdate AS DATE) AS document_date,
  'C.' || {_text("c.c_custkey")} || '-x' AS legal_client_id,
  c.c_name AS legal_client_name,
  'Line ' || {_text("l.l_linenumber")} AS invoice_description,
  CASE WHEN l.l_returnflag = 'A' AND l.l_linenumber = 6 THEN 'Bill'
       WHEN l.l_returnflag = 'A' THEN 'Invoice'
       WHEN l.l_returnflag = 'R' AND l.l_linenumber = 7 THEN 'Free'
       WHEN l.l_returnflag = 'R' THEN 'Credit Note'
       WHEN l.l_linenumber = 6 THEN 'Provision write-off'
       WHEN l.l_linenumber = 7 THEN 'Memo'
       ELSE 'Provision' END AS document_type,
  CAST(NULL AS STRING) AS canceled_document,
  CASE WHEN o.o_orderstatus = 'P' AND l.l_linenumber >= 5 THEN 'Otro negocio'
       WHEN l.l_quantity >= 49 THEN 'Staff'
       WHEN l.l_linestatus = 'O' THEN 'EB' ELSE 'CB' END AS revenue_stream,
  l.l_quantity AS quantity_charged,
  CAST(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END * l.l_extendedprice * (1 - l.l_discount)
    AS DECIMAL(18, 4)) AS value_lc,
  p.currency AS local_currency,
  make_date(year(o.o_orderdate), month(o.o_orderdate), 1) AS service_date,
  p.country AS legal_entity_country,
  CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Partner'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN CAST(NULL AS STRING) ELSE 'Direct' END AS sponsor,
  CASE WHEN l.l_linenumber = 1 THEN 'S.C' WHEN l.l_linenumber = 2 THEN 'S.C cargas'
       WHEN l.l_linenumber = 3 THEN '' WHEN l.l_linenumber = 4 THEN CAST(NULL AS STRING)
       ELSE 'AF-XX-1' END AS product,
  'P' || {_text("l.l_suppkey")} AS contract_plan_id,
  l.l_tax AS l_tax
FROM {{lineitem}} l
JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{places}} p ON c.c_nationkey = p.n_nationkey
""",
    "ledger_current": f"""
SELECT {_LEDGER_COLUMNS}, contract_plan_id FROM {{ledger_lines}} WHERE service_date >= make_date(1998, 1, 1)
""",
    "ledger_history": f"""
SELECT {_LEDGER_COLUMNS} FROM {{ledger_lines}}
WHERE service_date >= make_date(1996, 1, 1) AND service_date < make_date(1998, 1, 1)
""",
    "ledger_history_old": f"""
SELECT {_LEDGER_COLUMNS} FROM {{ledger_lines}} WHERE service_date < make_date(1996, 1, 1)
""",
    "ledger_corrections": f"""
SELECT document_number, document_date, legal_client_id, legal_client_name,
  'Correction' AS invoice_description, document_type, document_number AS canceled_document, revenue_stream,
  CAST(0 AS DOUBLE) AS quantity_charged, CAST(-value_lc AS DECIMAL(18, 4)) AS value_lc, local_currency,
  service_date, legal_entity_country, sponsor, product, contract_plan_id
FROM {{ledger_lines}}
WHERE document_type = 'Invoice' AND l_tax >= 0.08
""",
    "first_orders": """
SELECT o_custkey, min(make_date(year(o_orderdate), month(o_orderdate), 1)) AS cohort FROM {orders} GROUP BY o_custkey
""",
    "holding_base": f"""
SELECT 'c' || {_text("c.c_custkey")} || 'X' AS tax_id_client,
  CASE WHEN c.c_custkey % 7 = 0 THEN CAST(NULL AS STRING)
       ELSE 'Group ' || {_text("CAST(floor(c.c_custkey / 2) AS BIGINT)")} END AS holding_name,
  p.country AS service_country,
  CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'SME'
       WHEN c.c_mktsegment = 'AUTOMOBILE' THEN CAST(NULL AS STRING) ELSE 'Enterprise' END AS client_segment,
  c.c_mktsegment AS business_unit, f.cohort AS holding_cohort
FROM {{customer}} c
JOIN {{places}} p ON c.c_nationkey = p.n_nationkey
LEFT JOIN {{first_orders}} f ON f.o_custkey = c.c_custkey
""",
    "holdings": """
SELECT tax_id_client, holding_name, 'EB' AS revenue_stream, service_country, client_segment, business_unit,
  holding_cohort FROM {holding_base}
UNION ALL
SELECT tax_id_client, holding_name, 'CB' AS revenue_stream, service_country, client_segment, business_unit,
  holding_cohort FROM {holding_base}
UNION ALL
SELECT tax_id_client, holding_name, 'Otro negocio' AS revenue_stream, service_country, client_segment,
  business_unit, holding_cohort FROM {holding_base}
""",
    "cube_other_country": _CUBE_SHAPE.format(
        stream="revenue_stream", segment="'SME'", holding="'Grupo ' || legal_client_id",
        product="CASE WHEN sponsor = 'Direct' THEN 'VO-XX-1' ELSE 'IN-XX-1' END", source="'Cubo ES'",
        where="legal_entity_country = 'ES' AND document_type IN ('Invoice', 'Bill')",
    ),
    "cube_non_subscription": _CUBE_SHAPE.format(
        stream="'Services'", segment="''", holding="legal_client_name", product="''",
        source="'Historicos'", where="revenue_stream = 'Staff' AND service_date < make_date(1997, 1, 1)",
    ),
    "history_non_subscription": """
SELECT document_number, legal_client_id, legal_client_name, invoice_description, document_type,
  'Otro negocio' AS revenue_stream, quantity_charged, value_lc, local_currency, service_date,
  legal_entity_country
FROM {ledger_lines} WHERE service_date < make_date(1996, 1, 1) AND document_type = 'Memo'
""",
    # ---- expenses ---------------------------------------------------------------------------------
    "account_list": f"""
SELECT CAST(size AS INT) AS size, name, class, sub
FROM {_values([_account_row(s) for s in range(1, 51)], "size, name, class, sub")}
""",
    "center_list": f"""
SELECT brand, department, segment, channel, stream
FROM {_values(_CENTER_ROWS, "brand, department, segment, channel, stream")}
""",
    "expense_facts": f"""
SELECT 'E' || {_text("l.l_orderkey")} || '-' || {_text("l.l_linenumber")} AS expense_id,
  'T' || {_text("l.l_orderkey")} AS transaction_id, 'D' || {_text("l.l_partkey")} AS document_id,
  CAST(l.l_shipdate AS DATE) AS full_date, 'A' || {_text("a.p_size")} AS accounting_account_id,
  CASE WHEN a.p_type = 'SMALL' THEN 'Gasto SME general' WHEN a.p_type = 'MEDIUM' THEN 'Gasto smb local'
       WHEN a.p_type = 'PROMO' THEN 'Affinity fees' WHEN a.p_type = 'LARGE' THEN 'Big Corps travel'
       WHEN a.p_type = 'ECONOMY' THEN 'Vacaciones al Personal' ELSE 'General' END AS accounting_account_name,
  a.p_brand AS brand, p.n_name AS place_name, a.p_type AS kind,
  CASE WHEN l.l_linenumber = 7 THEN CAST(NULL AS STRING) WHEN l.l_linenumber = 6 THEN 'Reversed entry'
       ELSE 'Detail ' || {_text("l.l_linenumber")} END AS transaction_detail,
  p.country AS legal_entity_country,
  CASE WHEN a.p_type = 'PROMO' THEN 'Financial House' ELSE 'Main House' END AS legal_entity_name,
  'S' || {_text("l.l_suppkey")} AS business_partner_id,
  CASE WHEN l.l_linenumber = 1 AND a.p_size <= 10 THEN 'ENTERPRISE'
       WHEN l.l_linenumber = 2 AND a.p_size <= 10 THEN 'SMB'
       WHEN l.l_linenumber = 3 AND a.p_size > 40 THEN 'PARTY ALLHANDS 1'
       WHEN l.l_linenumber = 5 AND a.p_size > 45 THEN CAST(NULL AS STRING)
       ELSE s.s_name END AS business_partner_name,
  lower(p.currency) AS currency, l.l_extendedprice AS value_lc, l.l_tax AS value_fx_accounting,
  l.l_quantity AS value_usd_accounting,
  CASE WHEN l.l_returnflag = 'N' THEN 'BUDGET' ELSE 'REAL' END AS version,
  CASE WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'FORECAST' ELSE 'REAL' END AS subversion,
  CAST(l.l_shipdate AS DATE) AS payment_date,
  CASE WHEN l.l_linenumber = 4 THEN 'Close Rewards' WHEN p.country = 'CO' THEN 'Close CO'
       WHEN p.country = 'MX' THEN 'Close MX' ELSE 'Close main' END AS source
FROM {{lineitem}} l
JOIN {{part}} a ON l.l_partkey = a.p_partkey
JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
JOIN {{places}} p ON s.s_nationkey = p.n_nationkey
""",
    "expenses_base_a": """
SELECT expense_id, transaction_id, document_id, full_date, accounting_account_id, accounting_account_name,
  brand AS accounting_cost_center_dim1_id, upper(brand) AS accounting_cost_center_dim1_name,
  place_name AS accounting_cost_center_dim2_id, lower(place_name) AS accounting_cost_center_dim2_name,
  'PR' AS project_id, kind AS project_name, transaction_detail, legal_entity_country, legal_entity_name,
  business_partner_id, business_partner_name, currency, value_lc, value_fx_accounting, value_usd_accounting,
  version, subversion, payment_date, source
FROM {expense_facts}
""",
    "expenses_base_b": """
SELECT expense_id, transaction_id, document_id, full_date, accounting_account_id, accounting_account_name,
  brand AS accounting_department_id, upper(brand) AS accounting_department_name,
  place_name AS accounting_country_id, lower(place_name) AS accounting_country_name,
  'PR' AS product_id, kind AS product_name,
  CASE WHEN kind = 'SMALL' THEN 'SME' WHEN kind = 'LARGE' THEN 'ENTERPRISE' WHEN kind = 'PROMO' THEN ''
       WHEN kind = 'ECONOMY' THEN CAST(NULL AS STRING) ELSE 'Affinity' END AS segment_name,
  transaction_detail, legal_entity_country, legal_entity_name, business_partner_id, business_partner_name,
  currency, value_lc, value_fx_accounting, value_usd_accounting, version, subversion, payment_date, source
FROM {expense_facts}
""",
    "accounts_a": f"""
SELECT 'A' || {_text("size")} AS accounting_account_id, 'MAIN HOUSE' AS legal_entity_name,
  'M' || {_text("size")} AS management_account_id, name AS management_account_name,
  class AS management_account_classification, sub AS management_account_subclassification
FROM {{account_list}}
UNION ALL
SELECT 'A' || {_text("size")} AS accounting_account_id, 'FINANCIAL HOUSE' AS legal_entity_name,
  'F' || {_text("size")} AS management_account_id, name AS management_account_name,
  class AS management_account_classification, sub AS management_account_subclassification
FROM {{account_list}}
""",
    "accounts_b": f"""
SELECT 'A' || {_text("size")} AS accounting_account_id, name AS management_account_name,
  class AS management_account_classification, sub AS management_account_subclassification
FROM {{account_list}}
""",
    "cost_centers": """
SELECT brand AS accounting_cost_center_dim1_name, 'main house' AS legal_entity_name,
  department AS management_department, segment AS holding_segment, channel AS sales_channel,
  stream AS revenue_stream FROM {center_list}
UNION ALL
SELECT brand AS accounting_cost_center_dim1_name, 'financial house' AS legal_entity_name,
  department AS management_department, segment AS holding_segment, channel AS sales_channel,
  stream AS revenue_stream FROM {center_list}
""",
    "areas_b": """
SELECT brand AS accounting_department_name, department AS management_department, channel AS sales_channel,
  stream AS revenue_stream FROM {center_list}
""",
    "cost_country": """
SELECT n_name AS accounting_cost_center_dim2_name, cost_country AS service_country FROM {places}
""",
    "departments": f"""
SELECT management_department, department_classification
FROM {_values([("marketing", "S&M"), ("sales", "S&M"), ("revops", "S&M"), ("success", "S&M"),
               ("insurance", "S&M"), ("product marketing", "S&M"), ("finance", "G&A")],
              "management_department, department_classification")}
""",
    "business_units": f"""
SELECT sales_channel, management_department, revenue_stream, holding_segment, service_country, business_unit
FROM {_values(_UNIT_ROWS, "sales_channel, management_department, revenue_stream, holding_segment, "
                          "service_country, business_unit")}
""",
    "weights_v3": f"""
SELECT o_holding_segment, holding_segment, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  CAST(parametro AS DOUBLE) AS parametro
FROM {_values(_V3_WEIGHT_ROWS, "o_holding_segment, holding_segment, year, month, parametro")}
""",
    "weights_old": f"""
SELECT o_revenue_stream, o_holding_segment, o_service_country, revenue_stream, holding_segment,
  service_country, CAST(parametro AS DOUBLE) AS parametro
FROM {_values(_OLD_WEIGHT_ROWS, "o_revenue_stream, o_holding_segment, o_service_country, revenue_stream, "
                                "holding_segment, service_country, parametro")}
""",
    "tags": f"""
SELECT aux, tag_cac FROM {_values(_TAG_ROWS, "aux, tag_cac")}
""",
    "payroll_external": """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
  'CL' AS o_service_country, 'CL' AS f_service_country, 'Sales' AS management_department,
  'Payroll' AS management_account_name, CAST(NULL AS STRING) AS business_partner_name,
  o_totalprice AS original_value, o_totalprice AS value_usd_distr
FROM {orders} WHERE o_orderpriority = '1-URGENT'
""",
    # ---- acquisition and engagement ----------------------------------------------------------------
    "deal_versions": f"""
SELECT 'D' || {_text("o.o_orderkey")} AS deal_id,
  CASE WHEN c.c_acctbal < 0 THEN CAST(NULL AS STRING) ELSE 'K' || {_text("c.c_custkey")} END AS company_id,
  CASE WHEN l.l_linenumber = 7 THEN 'Wallet pilot' WHEN l.l_quantity = 50 THEN 'Deal Test'
       ELSE 'Deal ' || c.c_name END AS deal_name,
  CASE WHEN l.l_linestatus = 'F' THEN 'Abierto' WHEN p.deal_country = 'Spain' THEN 'Closed Won - 100%'
       ELSE 'Cierres ganados' END AS deal_stage,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Partners' WHEN p.deal_country = 'Spain' THEN 'Iberia sales'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'Pipeline Enterprise' ELSE 'Pipeline de Ventas' END
    AS deal_pipeline,
  p.deal_country AS deal_country,
  CASE WHEN o.o_totalprice < 100000 THEN 'Micro' WHEN o.o_totalprice < 200000 THEN 'sme'
       WHEN o.o_totalprice < 300000 THEN 'Corporate' WHEN o.o_totalprice < 400000 THEN 'ENTERPRISE'
       WHEN o.o_totalprice < 450000 THEN 'Big Enterprise' ELSE 'unknown' END AS company_size,
  CASE WHEN l.l_linenumber = 1 THEN 'Gift Cards' WHEN l.l_linenumber = 2 THEN CAST(NULL AS STRING)
       ELSE 'Wellbeing' END AS product_modules,
  CASE WHEN l.l_returnflag = 'A' THEN 'New Logo' WHEN l.l_returnflag = 'R' AND l.l_linenumber = 3 THEN 'Retention X'
       WHEN l.l_returnflag = 'R' THEN CAST(NULL AS STRING) ELSE 'Upside' END AS development_type,
  CASE WHEN l.l_linenumber = 5 THEN CAST(NULL AS STRING) WHEN l.l_linenumber = 6 THEN 'Affinity'
       ELSE 'employee_engagement' END AS value_proposition,
  CASE WHEN l.l_discount >= 0.1 THEN 'Agency One' ELSE CAST(NULL AS STRING) END AS partnership_demand_name,
  CAST(l.l_quantity AS BIGINT) - 5 AS number_of_employees,
  o.o_totalprice - 60000 AS closed_amount,
  CAST(o.o_orderdate AS DATE) AS closed_date, CAST(o.o_orderdate AS DATE) AS created_date,
  l.l_shipdate AS last_modified_date
FROM {{lineitem}} l
JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{places}} p ON c.c_nationkey = p.n_nationkey
""",
    "deals": f"""
SELECT 'D' || {_text("o.o_orderkey")} AS deal_id, 'K' || {_text("c.c_custkey")} AS company_id,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN c.c_name || ' TEST SPA' ELSE c.c_name END AS company_name,
  p.deal_country AS deal_country,
  CASE WHEN o.o_totalprice < 100000 THEN 'micro' WHEN o.o_totalprice < 200000 THEN 'sme'
       WHEN o.o_totalprice < 300000 THEN 'corporate' WHEN o.o_totalprice < 400000 THEN 'enterprise'
       WHEN o.o_totalprice < 450000 THEN 'big enterprise' ELSE 'unknown' END AS deal_size,
  CASE WHEN o.o_orderstatus = 'P' THEN 'Abierto' WHEN p.deal_country = 'Spain' THEN 'Closed Won - 100%'
       ELSE 'Cierres ganados' END AS deal_stage,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Wellbeing' WHEN o.o_orderpriority = '2-HIGH' THEN 'Seguros de salud'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Trae tu seguro'
       WHEN o.o_orderpriority = '5-LOW' THEN 'Pack Gift Cards' ELSE 'Otros' END AS product_modules,
  CASE WHEN o.o_orderstatus = 'F' THEN 'New Logo' WHEN o.o_orderstatus = 'O' THEN 'Renewal'
       ELSE CAST(NULL AS STRING) END AS development_type_use,
  CAST(o.o_orderdate AS DATE) AS close_date, CAST(o.o_orderdate AS DATE) AS activation_date,
  o.o_totalprice AS amount_in_company_currency
FROM {{orders}} o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{places}} p ON c.c_nationkey = p.n_nationkey
""",
    "companies": f"""
SELECT 'K' || {_text("c_custkey")} AS company_id, {_text("c_custkey")} || '-k' AS company_legal_id,
  c_name AS company_name FROM {{customer}}
""",
    "meetings": f"""
SELECT 'D' || {_text("l_orderkey")} AS deal_id, CAST(l_shipdate AS DATE) AS meeting_date,
  CASE WHEN l_returnflag = 'N' THEN 'CANCELED' ELSE 'COMPLETED' END AS meeting_outcome,
  CASE WHEN l_linenumber >= 5 THEN 'Demo' ELSE 'First meeting (AE)' END AS activity_type
FROM {{lineitem}}
""",
    "client_metrics": """
SELECT CAST(o.o_orderdate AS DATE) AS date_start,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Demo ' || c.c_name
       WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN CAST(NULL AS STRING) ELSE c.c_name END AS client_name,
  p.country AS client_country_code,
  CASE WHEN o.o_orderstatus = 'F' THEN 'employee_engagement' WHEN o.o_orderstatus = 'O' THEN 'customer_engagement'
       ELSE 'internal' END AS business_type,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'micro' WHEN c.c_mktsegment = 'MACHINERY' THEN 'sme'
       WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'corporate' WHEN c.c_mktsegment = 'FURNITURE' THEN 'enterprise'
       ELSE CAST(NULL AS STRING) END AS client_size,
  CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS onboarding_users,
  CAST(floor(o.o_totalprice / 500) AS BIGINT) AS total_users,
  CAST(floor(o.o_totalprice / 3000) AS BIGINT) AS total_user_mau
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {places} p ON c.c_nationkey = p.n_nationkey
""",
    "mau_eb": """
SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS date_start_month, o_custkey AS company_id,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS members_onboard, CAST(floor(o_totalprice / 3000) AS BIGINT) AS mau
FROM {orders} WHERE o_orderstatus = 'F'
""",
    "mau_cb": """
SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS date_start_month, o_custkey AS company_id,
  CAST(floor(o_totalprice / 1000) AS BIGINT) AS members_onboard, CAST(floor(o_totalprice / 3000) AS BIGINT) AS mau
FROM {orders} WHERE o_orderstatus = 'O'
""",
    "mau_clients": """
SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS date_start_month, o_custkey AS client_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'customer_engagement' WHEN o_orderpriority = '2-HIGH' THEN 'other'
       ELSE 'employee_engagement' END AS business_type,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(NULL AS BIGINT)
       ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS members_onboard,
  CAST(floor(o_totalprice / 3000) AS BIGINT) AS mau
FROM {orders} WHERE o_orderstatus = 'P'
""",
    "client_companies": f"""
SELECT c_custkey AS company_id, 'c' || {_text("c_custkey")} || 'X' AS company_tax_id FROM {{customer}}
""",
    "clients": f"""
SELECT c_custkey AS client_id, 'c' || {_text("c_custkey")} || 'X' AS client_tax_id FROM {{customer}}
""",
    "activities": f"""
SELECT {_text("l_suppkey")} AS data_person_id, l_quantity AS val_minutes, l_extendedprice AS calories,
  CAST(l_shipdate AS DATE) AS date_start FROM {{lineitem}}
""",
    "calendar": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date FROM {orders}
""",
    # ---- rewards ----------------------------------------------------------------------------------
    "orders_bo": f"""
SELECT 'O' || {_text("o_orderkey")} AS document_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'CL-' || lpad({_text("o_orderkey")}, 13, '1')
       ELSE 'OP2' || lpad({_text("o_orderkey")}, 6, '0') END AS label,
  'B' || {_text("o_custkey")} AS companyId,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'MX' ELSE 'CL' END AS countryId,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'done' END AS status,
  CASE WHEN o_orderstatus = 'F' THEN 'transfer' ELSE 'balance' END AS paymentMethod,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'B2B-Wallet-Platform' ELSE 'backoffice' END AS channel,
  o_totalprice AS totalamount, o_orderdate AS createdAt,
  '{{{{"productId": "P' || {_text("o_custkey")} || '", "quantity": "' || {_text("o_orderkey")} || '.5"}}}}' AS products_member
FROM {{orders}}
""",
    "balance_tx": f"""
SELECT 'O' || {_text("l_suppkey")} AS depositorderid,
  '{{{{"orderId": "O' || {_text("l_orderkey")} || '", "amount": ' || {_text("l_quantity")} || '}}}}' AS withdraworders_member
FROM {{lineitem}} WHERE l_linenumber = 7
""",
    "companies_bo": f"""
SELECT 'B' || {_text("c_custkey")} AS document_id,
  CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(NULL AS STRING) ELSE {_text("c_custkey")} || '-9' END AS nationalId,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(NULL AS STRING) WHEN c_mktsegment = 'BUILDING' THEN ''
       WHEN c_mktsegment = 'FURNITURE' THEN 'MX' ELSE 'CL' END AS countryId,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN CAST(NULL AS STRING) ELSE c_name END AS legalName
FROM {{customer}}
""",
    "companies_app": f"""
SELECT 'A' || {_text("c_custkey")} AS document_id,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Acme ' || c_name WHEN c_mktsegment = 'FURNITURE' THEN 'Points House'
       ELSE c_name END AS name
FROM {{customer}}
""",
    "invoices": f"""
SELECT 'O' || {_text("l_orderkey")} AS orderId, 'I' || {_text("l_partkey")} AS invoiceNumber,
  l_extendedprice AS amount
FROM {{lineitem}} WHERE l_returnflag = 'A'
""",
    "client": f"""
SELECT 'B' || {_text("c_custkey")} AS id, {_text("c_custkey")} || '-c' AS document_value, c_name AS company_name
FROM {{customer}}
""",
    "loads": f"""
SELECT 'L' || {_text("event_id")} AS document_id,
  CASE WHEN event_type = 'view' THEN 'OP2' || lpad({_text("event_id")}, 6, '0')
       WHEN event_type = 'click' THEN 'OP2' || lpad({_text("event_id")}, 6, '0') || '.1'
       WHEN event_type = 'signup' THEN 'CL-' || lpad({_text("event_id")}, 13, '1')
       WHEN event_type = 'purchase' THEN 'X-' || {_text("event_id")}
       ELSE 'OP1' || lpad({_text("event_id")}, 6, '0') || ',bonus' END AS transactionId,
  'A' || {_text("user_id")} AS companyId, ts AS createdAt,
  CASE WHEN value > 120 THEN '{{{{"amount": "12.5", "allowedGiftCardIds": "g1"}}}}'
       WHEN value > 100 THEN '{{{{"amount": 7, "nationalId": "N7", "email": null, "id": "BN' || {_text("event_id")}
         || '", "allowedGiftCardIds": ["g1", "g2"]}}}}'
       WHEN value > 90 THEN 'not json'
       ELSE '{{{{"amount": ' || {_text("value")} || ', "nationalId": "N' || {_text("user_id")} || '", "email": "u'
         || {_text("user_id")} || '@example.com", "id": "BN' || {_text("event_id")} || '"}}}}' END AS giftCards_member
FROM {{events}}
""",
    "bonuses": f"""
SELECT 'BN' || {_text("event_id")} AS document_id,
  CASE WHEN value > 150 THEN CAST(NULL AS STRING) ELSE 'L' || {_text("event_id")} END AS giftCardsLoadId,
  'U' || {_text("user_id")} AS userId, 'CL' AS nationality, 'N' || {_text("user_id")} AS nationalId,
  'u' || {_text("user_id")} || '@example.com' AS email,
  CASE WHEN event_type IN ('view', 'signup') THEN 'voided' ELSE 'active' END AS status, value AS amount,
  CASE WHEN value > 80 THEN TRUE WHEN value > 70 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS allowedGiftCardIds,
  ts AS createdAt, ts AS voidedat
FROM {{events}}
""",
    "user_giftcards": f"""
SELECT 'R' || {_text("event_id")} AS document_id, 'U' || {_text("user_id")} AS userId,
  'G' || event_type AS giftCardId, 'code' || {_text("event_id")} AS code,
  CASE WHEN value > 110 THEN 'reversed' ELSE 'redeemed' END AS status,
  CASE WHEN value > 100 THEN CAST(NULL AS STRING) ELSE 'Q' || {_text("event_id")} END
    AS userGiftCardRedeemRequestId,
  value AS amount, ts AS createdAt,
  CASE WHEN value < 1 THEN ts ELSE CAST(NULL AS TIMESTAMP) END AS voidedAt,
  CASE WHEN value > 95 THEN CAST(NULL AS BIGINT) ELSE CAST(0 AS BIGINT) END AS contributions_index,
  '{{{{"totalTakenAmount": ' || {_text("value")} || ', "bonusId": "BN' || {_text("event_id")} || '"}}}}'
    AS contributions_member
FROM {{events}}
""",
    "users": f"""
SELECT DISTINCT 'U' || {_text("user_id")} AS document_id, 'N' || {_text("user_id")} AS nationalId,
  CASE WHEN user_id % 9 = 0 THEN 'MX' ELSE 'CL' END AS nationality
FROM {{events}}
""",
}

_NAME = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def _dependencies(sql: str) -> list[str]:
    return sorted(set(_NAME.findall(sql)))


def load_views(spark: SparkSession, sf_dir: str, extra: Mapping[str, DataFrame] | None = None):
    """Lookup of view name to lazy DataFrame; each view is built once."""
    built: dict[str, DataFrame] = dict(extra or {})

    def get(name: str) -> DataFrame:
        if name not in built:
            if name in BASE_TABLES:
                built[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            else:
                sql = VIEWS[name]
                built[name] = spark.sql(sql, **{d: get(d) for d in _dependencies(sql)})
        return built[name]

    return get


def with_clause(names: list[str], more: Mapping[str, str] | None = None) -> str:
    """Common table expressions for the given views and everything they need, in order.

    `more` adds further named queries, whose `{name}` references are resolved the same way."""
    sources = {**VIEWS, **(more or {})}
    done: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in done:
            return
        for d in _dependencies(sources[name]):
            visit(d)
        done.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS (\n{render(sources[name])}\n)" for name in done]
    return "WITH " + ",\n".join(parts) if parts else ""


def render(sql: str) -> str:
    """Replace `{name}` by the bare name."""
    return _NAME.sub(r"\1", sql).replace("{{", "{").replace("}}", "}").strip()
