"""The registered queries in SQL for the checking engine.

Written line by line over the views, without the pre-aggregation and look-up rewrites the Spark plans
use, so that those rewrites are what the comparison tests.
"""

from __future__ import annotations

from checks.queries import (
    AS_OF,
    CUTOVER,
    LATER_MIN_YEAR,
    MIN_YEAR,
    REPLAY,
    REWARDS_AS_OF,
    REWARDS_SINCE,
    RULES,
    SINCE,
)
from checks.views import with_clause
from ledgerloom import rules as R
from ledgerloom.plans import expenses as X
from ledgerloom.plans import pnl as P
from ledgerloom.sources.schemas import EXPENSE_CUBE_COLUMNS, REVENUE_CUBE_COLUMNS


# ---- building blocks ---------------------------------------------------------------------------------


def quoted(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def date(d) -> str:
    return f"DATE '{d.isoformat()}'"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def exact(x: str, scale: int = 4) -> str:
    return f"CAST({x} AS DECIMAL({14 + scale}, {scale}))"


def exact_sum(x: str, scale: int = 4) -> str:
    return f"CAST(SUM({exact(x, scale)}) AS DOUBLE)"


def converted(x: str) -> str:
    """Ten decimals of a double; by its text, as DuckDB scales a double before it rounds."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(24, 10))"


def as_double(x: str) -> str:
    """Nearest double of a decimal with many digits, which a plain cast may miss by one unit."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def converted_sum(x: str) -> str:
    return as_double(f"SUM({converted(x)})")


def whole(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def key(c: str) -> str:
    return f"translate(upper({c}), '.-', '')"


def net(value: str, currency: str) -> str:
    return f"({value} * CASE WHEN {currency} = 'BRL' THEN CAST(0.88 AS DECIMAL(3, 2)) ELSE CAST(1 AS DECIMAL(3, 2)) END)"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def pick(c: str, mapping: dict, default: str = "NULL") -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {c} {cases} ELSE {default} END"


def doc_class(c: str = "document_type") -> str:
    return f"CASE WHEN {c} IN {quoted(R.ACTUAL_TYPES)} THEN 1 WHEN {c} IN {quoted(R.PROVISIONAL_TYPES)} THEN 0 END"


def status(c: str) -> str:
    return f"CASE WHEN {c} = 0 THEN 'Provisionado' ELSE 'Facturado' END"


def bucket(variant: str, s: str = "revenue_stream", p: str = "product") -> str:
    family = f"{p} IN {quoted(R.MAIN_FAMILY)}"
    kept = "'S.C'" if variant == "merged" else p
    rest = f"COALESCE({p}, '') = ''" if variant == "explicit" else "TRUE"
    return (
        f"CASE WHEN {s} = 'CB' THEN {p} WHEN {s} <> 'EB' THEN NULL WHEN {family} THEN {kept} "
        f"WHEN {rest} THEN 'EB-XX-1' END"
    )


def day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


def digits(c: str) -> str:
    found = [f"NULLIF(regexp_extract({c}, '\\d{{{{{n}}}}}'), '')" for n in (13, 6)]
    return f"CAST(COALESCE({', '.join(found)}) AS BIGINT)"


def scalar(c: str, name: str) -> str:
    """Text of a scalar JSON member, NULL for objects, arrays and malformed text."""
    doc = f"(CASE WHEN json_valid({c}) THEN {c} END)"
    kind = f"json_type({doc}, '$.{name}')"
    return f"(CASE WHEN {kind} NOT IN ('ARRAY', 'OBJECT', 'NULL') THEN json_extract_string({doc}, '$.{name}') END)"


def rounded(x: str) -> str:
    return f"CAST(round(TRY_CAST({x} AS DOUBLE)) AS BIGINT)"


def yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'SI' ELSE 'NO' END"


def santiago(c: str) -> str:
    return f"(({c} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Santiago')"


HOLDING_JOIN = (
    f"{key('f.legal_client_id')} = {key('h.tax_id_client')} AND f.revenue_stream = h.revenue_stream "
    "AND f.legal_entity_country = h.service_country"
)
YM = "CAST(strftime({c}, '%Y%m') AS BIGINT)"
LEDGER = (
    "document_number, legal_client_id, legal_client_name, invoice_description, document_type, revenue_stream, "
    "quantity_charged, value_lc, local_currency, service_date, legal_entity_country, sponsor, product"
)


def ledger(names, where: str = "TRUE") -> str:
    parts = []
    for n in names:
        history = n.startswith("ledger_history")
        plan = "''" if history else "contract_plan_id"
        present = " AND legal_client_id IS NOT NULL" if history else ""
        parts.append(f"SELECT {LEDGER}, {plan} AS contract_plan_id FROM {{{n}}} WHERE ({where}){present}")
    return "\nUNION ALL\n".join(parts)


ALL = ("ledger_current", "ledger_history", "ledger_history_old", "ledger_corrections")
RECENT = ("ledger_current", "ledger_corrections")

BLOCKS: dict[str, str] = {
    "ledger_all": ledger(ALL),
    "ledger_recent": ledger(RECENT),
    "current_holding": f"""
SELECT f.document_number, f.legal_client_id, f.document_type, f.revenue_stream, f.legal_entity_country,
  f.service_date, h.holding_name, {whole(doc_class("f.document_type"))} AS document_binary
FROM {{ledger_current}} f LEFT JOIN {{holdings}} h ON {HOLDING_JOIN}
WHERE f.document_type <> 'Free'
""",
}


# ---- buildups ----------------------------------------------------------------------------------------

GRAIN = ["service_country", "holding_name", "holding_cohort", "client_segment", "local_currency", "sponsor",
         "revenue_stream"]


def _months_sql(variant: str) -> dict[str, str]:
    main, other = variant == "main_family", variant == "other_products"
    grain = GRAIN + ([] if variant == "no_product" else ["product"])
    where = {"main_family": f"product IN {quoted(R.MAIN_FAMILY)}",
             "other_products": f"(product NOT IN {quoted(R.MAIN_FAMILY)} OR product IS NULL)"}.get(variant, "TRUE")
    names = RECENT if main or other else ALL
    unit = "" if variant == "with_product" else "business_unit, "
    product = bucket("merged" if variant == "with_product" else "split", "f.revenue_stream", "f.product")
    members = "CASE WHEN f.product = 'S.C cargas' THEN 0 ELSE f.quantity_charged END" \
        if variant == "with_product" else "f.quantity_charged"
    docs = f"""
SELECT f.document_type, f.revenue_stream, f.service_date, f.legal_entity_country AS service_country,
  f.local_currency, f.sponsor, h.holding_name, h.holding_cohort, h.client_segment, {product} AS product,
  {net("f.value_lc", "f.local_currency")} AS net_lc, {exact(members)} AS quantity,
  {doc_class("f.document_type")} AS cls
FROM ({ledger(names, where)}) f
LEFT JOIN (SELECT DISTINCT tax_id_client, holding_name, revenue_stream, service_country, client_segment, {unit}
  holding_cohort FROM {{holdings}}) h ON {HOLDING_JOIN}
WHERE f.revenue_stream <> 'Staff' AND f.document_type <> 'Free'
"""
    kept = f"""
SELECT * FROM (
  SELECT *, MAX(cls) OVER (PARTITION BY holding_name, service_date, revenue_stream, service_country) AS best
  FROM ({docs})) WHERE cls = best
"""
    rows = f"""
SELECT service_date AS full_date, {", ".join(grain)}, net_lc AS value_lc, net_lc AS convertible,
  CAST(NULL AS DECIMAL(24, 10)) AS usd_given, quantity FROM ({kept})
"""
    if not main:
        rows += f"""
UNION ALL
SELECT full_date, {", ".join(grain)}, value_lc, NULL AS convertible, {converted("value_usd_bdg")} AS usd_given,
  {exact("quantity_charged")} AS quantity FROM {{cube_other_country}}
"""
    sums = ", ".join(f"SUM({m}) AS {m}" for m in ("value_lc", "convertible", "usd_given", "quantity"))
    months = f"""
SELECT {month("full_date")} AS full_date, {", ".join(grain)}, {sums}
FROM ({rows})
GROUP BY ALL
HAVING SUM(value_lc) <> 0
"""
    streams = f"revenue_stream IN {quoted(R.BUILDUP_STREAMS)} AND holding_name <> ''"
    pairs = " AND ".join(f"m.{c} IS NOT DISTINCT FROM s.{c}" for c in [*grain, "full_date"])
    filled = f"""
SELECT s.full_date, {", ".join("s." + c for c in grain)}, m.value_lc, m.convertible, m.usd_given, m.quantity
FROM (SELECT {", ".join(grain)},
        CAST(unnest(generate_series(MIN(full_date), MAX(full_date), INTERVAL 1 MONTH)) AS DATE) AS full_date
      FROM {{months_{variant}}} GROUP BY {", ".join(grain)}) s
LEFT JOIN {{months_{variant}}} m ON {pairs}
"""
    base_grain = [c for c in grain if c != "holding_cohort"] if main or other else grain
    cohort = "MIN(full_date) OVER (PARTITION BY holding_name) AS holding_cohort," if main or other else ""
    base = f"""
SELECT b.* EXCLUDE (value_lc, convertible, usd_given, quantity),
  COALESCE(CAST(value_lc AS DOUBLE), 0) AS value_lc,
  COALESCE({ratio("convertible", "x.Value")}, 0) + COALESCE({as_double("usd_given")}, 0) AS value_usd,
  COALESCE(CAST(quantity AS DOUBLE), 0) AS members,
  date_diff('month', holding_cohort, full_date) AS invoice_number
FROM (SELECT full_date, {", ".join(base_grain)}, {cohort} {sums} FROM {{filled_{variant}}}
      GROUP BY full_date, {", ".join(base_grain)}) b
LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(b.full_date) AS VARCHAR) AND x.Currency = b.local_currency
"""
    keys = ["holding_name", "revenue_stream", "service_country", "sponsor"] + (["product"] if main or other else [])
    order = base_grain + (["holding_cohort"] if main or other else [])
    rest = [c for c in order if c not in keys]
    window = f"(PARTITION BY {', '.join(keys)} ORDER BY full_date, {', '.join(c + ' NULLS FIRST' for c in rest)})"
    measures = ("members", "value_lc", "value_usd")
    context = ", ".join(
        f"COALESCE(LAG({m}) OVER {window}, 0) AS {m}_bop, COALESCE(LAG({m}, 2) OVER {window}, 0) AS {m}_bop2, "
        f"LEAD({m}) OVER {window} AS {m}_next" for m in measures
    )
    ctx = f"SELECT *, {context} FROM {{base_{variant}}}"
    columns = []
    siblings = ""
    if main:
        over = "(PARTITION BY holding_name, revenue_stream, service_country, sponsor, full_date)"
        siblings = ", " + ", ".join(
            f"MAX({m}_next) FILTER (product = 'S.C') OVER {over} AS {m}_main" for m in measures
        )
    for m in measures:
        b, b2 = f"{m}_bop", f"{m}_bop2"
        again = f"WHEN invoice_number = 2 AND {b} = 0 AND {b2} = 0 AND {m} > 0 THEN {m}" if m == "members" else ""
        columns.append(f"""CASE WHEN invoice_number = 0 THEN {m}
    WHEN invoice_number IN (1, 2) AND {m} > {b} AND (invoice_number = 1 OR {b} > 0) THEN {m} - {b}
    WHEN invoice_number = 2 AND {b} = 0 AND {b2} > 0 AND {m} > {b2} THEN {m} - {b2}
    {again} ELSE 0 END AS {m}_new""")
        columns.append(f"""CASE WHEN invoice_number > 2 OR (invoice_number IN (1, 2) AND {m} < {b}) THEN {m} - {b}
    ELSE 0 END AS {m}_retention""")
        gone = f"{m}_next IS NULL"
        if main:
            gone = f"((product = 'S.C' AND {m}_next IS NULL) OR (product = 'S.C cargas' AND {m}_main IS NULL))"
        floor = " AND value_usd >= 0" if m == "value_usd" else " AND value_lc >= 0" if m == "value_lc" and main else ""
        columns.append(f"CASE WHEN {gone}{floor} THEN {m} ELSE 0 END AS {m}_churn")
    addon = "product = 'S.C cargas'" if main or other else "FALSE"
    counted = "product <> 'S.C cargas'" if main or other else "TRUE"
    last = "product = 'S.C'" if main else counted
    columns += [
        f"CASE WHEN invoice_number < 0 OR {addon} THEN 0 ELSE 1 END AS logo_bop",
        f"CASE WHEN invoice_number = 0 AND {counted} THEN 1 ELSE 0 END AS logo_new",
        f"CASE WHEN value_lc_next IS NULL AND {last} THEN 1 ELSE 0 END AS logo_churn",
        f"CASE WHEN full_date < holding_cohort OR {addon} THEN 0 ELSE 1 END AS logo_eop",
    ]
    parts = f"SELECT *, {', '.join(columns)} FROM (SELECT *{siblings} FROM {{context_{variant}}})"
    out = [
        "full_date", "year(full_date) AS year", "month(full_date) AS month", *grain, "value_lc", "members",
        "invoice_number",
    ]
    for m in measures:
        out += [f"{m}_{k}" for k in ("bop", "new", "retention", "churn")] + [f"{m} AS {m}_eop"]
    out += [f"CAST({c} AS BIGINT) AS {c}" for c in ("logo_bop", "logo_new", "logo_churn", "logo_eop")]
    return {
        f"months_all_{variant}": months,
        f"months_{variant}": f"SELECT * FROM {{months_all_{variant}}} WHERE {streams}",
        f"filled_{variant}": filled,
        f"base_{variant}": base,
        f"context_{variant}": ctx,
        f"buildup_{variant}": f"SELECT {', '.join(out)} FROM ({parts})",
    }


for _variant in ("with_product", "no_product", "other_products", "main_family"):
    BLOCKS.update(_months_sql(_variant))


def iso(query: str, *dates: str) -> str:
    """Turn date columns into ISO text."""
    return f"SELECT * REPLACE ({', '.join(day(d) for d in dates)}) FROM ({query})"


def _part(variant: str, *columns: str) -> str:
    keys = ["full_date", "service_country", "revenue_stream", "holding_name", "sponsor", "holding_cohort",
            "client_segment", "local_currency", "invoice_number"] + ([] if variant == "no_product" else ["product"])
    return iso(f"SELECT {', '.join([*keys, *columns])} FROM {{buildup_{variant}}}", "full_date", "holding_cohort")


def _movement(m: str) -> list[str]:
    return [f"{m}_{k}" for k in ("bop", "new", "retention", "churn", "eop")]


# ---- revenue cube ------------------------------------------------------------------------------------

_HOUSE_NAMES = {k: f"House {v}" for k, v in R.COUNTRY_NAMES.items()}
BLOCKS["cube_lines"] = f"""
SELECT document_number, translate(legal_client_id, '.-', '') AS tax_id_client,
  legal_client_name AS client_legal_name, invoice_description, document_type, revenue_stream,
  document_type AS type, quantity_charged, CAST(net_lc AS DOUBLE) AS value_lc, local_currency,
  service_date AS full_date, 'Real' AS version, {ratio("value_lc", "quantity_charged")} AS arpu, client_segment,
  '' AS holding_id, holding_name, sponsor, holding_cohort, legal_entity_country AS service_country,
  {pick("legal_entity_country", R.COUNTRY_NAMES)} AS legal_entity_country,
  {pick("legal_entity_country", _HOUSE_NAMES)} AS legal_entity_name, 'Direct' AS sales_channel,
  {bucket("explicit")} AS product, rate AS fx_value_bdg, {ratio("net_lc", "rate")} AS value_usd_bdg,
  'Cubo' AS source, month(service_date) AS month, year(service_date) AS year, {status("best")} AS document_status,
  contract_plan_id
FROM (
  SELECT f.*, h.holding_name, h.client_segment, h.holding_cohort, x.Value AS rate,
    {net("f.value_lc", "f.local_currency")} AS net_lc, {doc_class("f.document_type")} AS cls,
    MAX({doc_class("f.document_type")}) OVER (PARTITION BY h.holding_name, f.service_date, f.revenue_stream) AS best
  FROM (SELECT {LEDGER}, contract_plan_id FROM {{ledger_current}} WHERE legal_entity_country <> 'ES'
        UNION ALL {ledger(ALL[1:])}) f
  LEFT JOIN (SELECT DISTINCT * FROM {{holdings}}) h ON {HOLDING_JOIN}
  LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(f.service_date) AS VARCHAR) AND x.Currency = f.local_currency
  WHERE f.revenue_stream NOT IN ('Staff', 'Covid') AND f.document_type <> 'Free')
WHERE cls = best
"""


def _expense_revenue(product: str) -> str:
    return f"""
SELECT '0' AS document_number, business_partner_id AS tax_id_client, business_partner_name AS client_legal_name,
  transaction_detail AS invoice_description, '-' AS document_type, 'FS' AS revenue_stream, 'Real' AS type,
  CAST(1 AS DOUBLE) AS quantity_charged, value_lc, currency AS local_currency, full_date, 'Real' AS version,
  CAST(0 AS DOUBLE) AS arpu, '-' AS client_segment, '-' AS holding_id, business_partner_name AS holding_name,
  '-' AS sponsor, DATE '2021-01-01' AS holding_cohort, service_country, legal_entity_country, legal_entity_name,
  '-' AS sales_channel, '{product}' AS product, value_fx_bdg AS fx_value_bdg, value_usd_bdg, source, month, year,
  'Facturado' AS document_status
FROM {{expense_cube}}
"""


BLOCKS["rewards_cube"] = _expense_revenue("GC-XX-01") + (
    " WHERE (source = 'Close CO' AND accounting_account_id = 'A18') "
    "OR (source = 'Close MX' AND accounting_account_id = 'A43')"
)
BLOCKS["entity_lines"] = _expense_revenue("GC-XX-XX") + """
WHERE legal_entity_name = 'Financial House' AND management_account_name = 'Revenue' AND subversion = 'REAL'
  AND NOT (COALESCE(business_partner_name, '') LIKE '%00000001%' OR COALESCE(business_partner_name, '') LIKE '%ALLHANDS%')
"""
BLOCKS["history_cube"] = f"""
SELECT document_number, legal_client_id AS tax_id_client, legal_client_name AS client_legal_name,
  invoice_description, document_type, revenue_stream, 'Real' AS type, quantity_charged,
  CAST(value_lc AS DOUBLE) AS value_lc, local_currency, service_date AS full_date, 'Real' AS version,
  CAST(0 AS DOUBLE) AS arpu, '' AS client_segment, '' AS holding_id, legal_client_name AS holding_name,
  '' AS sponsor, DATE '1899-12-01' AS holding_cohort, legal_entity_country AS service_country,
  legal_entity_country, {pick("legal_entity_country", {"CL": "House Chile", "BR": "House Brazil"})} AS legal_entity_name,
  'Direct' AS sales_channel, '' AS product, x.Value AS fx_value_bdg, {ratio("value_lc", "x.Value")} AS value_usd_bdg,
  'Historicos_non_subs' AS source, month(service_date) AS month, year(service_date) AS year,
  'Facturado' AS document_status
FROM {{history_non_subscription}} f
LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(f.service_date) AS VARCHAR) AND x.Currency = f.local_currency
"""
_SHARED = ", ".join(REVENUE_CUBE_COLUMNS[:-1])
BLOCKS["revenue_cube"] = f"SELECT {_SHARED}, contract_plan_id FROM {{cube_lines}}" + "".join(
    f"\nUNION ALL SELECT {_SHARED}, '' FROM {{{n}}}"
    for n in ("cube_other_country", "cube_non_subscription", "entity_lines", "history_cube", "rewards_cube")
)


# ---- expenses ----------------------------------------------------------------------------------------


def _expense_sql(chart: str) -> str:
    a = chart == "a"
    name = "b.accounting_account_name"
    patterns = " ".join(f"WHEN upper({name}) LIKE '{p}' THEN '{v}'" for p, v in R.SEGMENT_PATTERNS)
    special = {
        "management_account_id": "m.management_account_id" if a else "CAST(NULL AS VARCHAR)",
        "management_account_name": "m.management_account_name",
        "mgmt_account_classification": "m.management_account_classification",
        "mgmt_account_subclasification": "m.management_account_subclassification",
        "management_department": "c.management_department",
        "department_classification": "d.department_classification",
        "service_country": "k.service_country",
        "holding_segment": f"CASE {patterns} ELSE c.holding_segment END" if a else
        "CASE WHEN COALESCE(b.segment_name, '') = '' THEN 'Sin holding' WHEN b.segment_name = 'SME' THEN 'SMB' "
        "ELSE b.segment_name END",
        "sales_channel": "c.sales_channel",
        "revenue_stream": "c.revenue_stream",
        "value_fx_bdg": "x.Value",
        "value_usd_bdg": ratio("b.value_lc", "x.Value"),
        "business_unit": "CASE b.business_partner_name WHEN 'ENTERPRISE' THEN 'Enterprise' WHEN 'SMB' THEN 'SMB' "
        "ELSE u.business_unit END" if a else
        "CASE b.segment_name WHEN 'ENTERPRISE' THEN 'Enterprise' WHEN 'SME' THEN 'SMB' END",
        "month": "month(b.full_date)",
        "year": "year(b.full_date)",
    }
    if not a:
        special |= {
            "accounting_cost_center_dim1_id": "b.accounting_department_id",
            "accounting_cost_center_dim1_name": "b.accounting_department_name",
            "accounting_cost_center_dim2_id": "b.accounting_country_id",
            "accounting_cost_center_dim2_name": "b.accounting_country_name",
            "project_id": "b.product_id", "project_name": "b.product_name",
        }
    columns = ",\n  ".join(f"{special.get(c, 'b.' + c)} AS {c}" for c in EXPENSE_CUBE_COLUMNS)
    if a:
        joins = """
LEFT JOIN {accounts_a} m ON b.accounting_account_id = m.accounting_account_id
  AND upper(b.legal_entity_name) = upper(m.legal_entity_name)
LEFT JOIN {cost_centers} c ON upper(b.accounting_cost_center_dim1_name) = upper(c.accounting_cost_center_dim1_name)
  AND upper(b.legal_entity_name) = upper(c.legal_entity_name)
LEFT JOIN {cost_country} k ON upper(b.accounting_cost_center_dim2_name) = upper(k.accounting_cost_center_dim2_name)
LEFT JOIN {business_units} u ON (c.sales_channel, c.management_department, c.revenue_stream, c.holding_segment,
  k.service_country) = (u.sales_channel, u.management_department, u.revenue_stream, u.holding_segment, u.service_country)
"""
    else:
        joins = """
LEFT JOIN {accounts_b} m ON b.accounting_account_id = m.accounting_account_id
LEFT JOIN {areas_b} c ON upper(b.accounting_department_name) = upper(c.accounting_department_name)
LEFT JOIN {cost_country} k ON upper(b.accounting_country_name) = upper(k.accounting_cost_center_dim2_name)
"""
    return f"""
SELECT {columns}
FROM {{expenses_base_{chart}}} b {joins}
LEFT JOIN {{departments}} d ON upper(c.management_department) = upper(d.management_department)
LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(b.full_date) AS VARCHAR) AND upper(x.Currency) = upper(b.currency)
"""


BLOCKS["expense_cube"] = _expense_sql("a") + "WHERE b.full_date >= DATE '1995-01-01' AND b.full_date < DATE '2002-01-01'"
BLOCKS["expense_cube_b"] = _expense_sql("b") + "WHERE b.full_date >= DATE '1996-02-01' AND b.full_date < DATE '2000-02-01'"

_E = RULES.expense
BLOCKS["control"] = f"""
SELECT year, month, service_country, department_classification,
  CASE WHEN upper(source) LIKE '{_E.rewards_source_pattern}' THEN 'Rewards' ELSE management_department END
    AS management_department,
  CASE WHEN management_account_name IN {quoted(R.PAYROLL_ACCOUNTS)} THEN 'Payroll'
       WHEN management_account_name IN {quoted(R.NON_PAYROLL_ACCOUNTS)} THEN 'Non-Payroll' ELSE 'check' END
    AS control_group,
  CASE WHEN business_partner_name LIKE '%ALLHANDS%' THEN 'All Hands' ELSE management_account_name END
    AS management_account_name,
  CASE WHEN management_account_name = 'Professional Services'
         AND business_partner_name IN {quoted(_E.outsourcing_vendors)} THEN 'Outsourcing'
       WHEN management_account_name = 'Professional Services'
         AND business_partner_name IN {quoted(_E.external_payroll_vendors)} THEN 'Payroll Externo'
       WHEN business_partner_name LIKE '%ALLHANDS%' THEN 'All Hands' ELSE management_account_name END
    AS control_subgroup,
  business_partner_name, holding_segment, transaction_detail, source, revenue_stream, value_usd_bdg
FROM {{expense_cube}}
WHERE year >= {MIN_YEAR} AND mgmt_account_classification = 'P&L' AND mgmt_account_subclasification = 'SG&A'
  AND version = 'REAL' AND subversion = 'REAL'
  AND management_account_name NOT IN {quoted(R.CONTROL_EXCLUDED_ACCOUNTS)}
  AND transaction_detail NOT IN {quoted(_E.excluded_details)}
"""


def _subtype() -> str:
    out = []
    for label, accounts, departments in R.COST_SUBTYPE_RULES:
        also = f" AND management_department IN {quoted(departments)}" if departments else ""
        out.append(f"WHEN management_account_name IN {quoted(accounts)}{also} THEN '{label}'")
    return "CASE " + " ".join(out) + " END"


TYPE = "CASE WHEN sub_type IN ('demand', 'conversion') THEN 'initiatives' ELSE 'other' END AS type"

BLOCKS["v3_groups"] = f"""
SELECT year, month, revenue_stream, management_department, service_country, management_account_name, holding_segment,
  business_partner_name, source, {converted_sum("value_usd_bdg")} AS value
FROM {{expense_cube}}
WHERE department_classification = 'S&M' AND mgmt_account_subclasification = 'SG&A'
  AND revenue_stream NOT IN {quoted(X.V3_EXCLUDED_STREAMS)} AND holding_segment <> 'Affinity'
  AND subversion = 'REAL' AND management_department NOT IN {quoted(X.V3_EXCLUDED_DEPARTMENTS)}
  AND NOT (management_department = 'RevOps'
           AND management_account_name IN {quoted(X.V3_EXCLUDED_OPERATIONS_ACCOUNTS)})
  AND upper(management_account_name) NOT IN {quoted(X.V3_EXCLUDED_ACCOUNTS)}
  AND (year >= {MIN_YEAR} OR month >= 11)
GROUP BY ALL
"""
BLOCKS["v3_spread"] = """
SELECT g.* EXCLUDE (holding_segment, value), g.holding_segment AS o_holding_segment, w.holding_segment,
  'distribuible' AS distribuir_check_tag, value AS o_value_expense, value * w.parametro AS value_expense
FROM {v3_groups} g
LEFT JOIN {weights_v3} w ON g.holding_segment = w.o_holding_segment AND g.year = w.year AND g.month = w.month
WHERE upper(g.holding_segment) = 'SIN HOLDING' AND value <> 0
UNION ALL
SELECT g.* EXCLUDE (holding_segment, value), holding_segment, holding_segment, 'no_distribuible', value, value
FROM {v3_groups} g WHERE upper(holding_segment) IN ('ENTERPRISE', 'SME') AND value <> 0
"""

CATEGORY = """CASE
  WHEN revenue_stream NOT IN ('Employee Benefit', 'Affinity', 'N/R') THEN NULL
  WHEN revenue_stream = 'Affinity' THEN CASE WHEN service_country = 'HQ' THEN 'no_atribuible_pais_corp' ELSE 'atribuible' END
  WHEN holding_segment = 'Sin holding' AND service_country <> 'HQ' THEN 'no_atribuible'
  WHEN service_country = 'HQ' AND (revenue_stream = 'N/R' OR holding_segment IN ('SMB', 'Enterprise', 'Sin holding'))
    THEN 'no_atribuible_pais_corp'
  ELSE 'atribuible' END"""
LABEL = "CASE category WHEN 'atribuible' THEN 'Local' WHEN 'no_atribuible' THEN 'Distribuido local' " \
        "WHEN 'no_atribuible_pais_corp' THEN 'Corp' END"
BLOCKS["old_groups"] = f"""
SELECT *, CASE WHEN revenue_stream IS NULL THEN NULL ELSE {CATEGORY} END AS category FROM (
  SELECT year, month, revenue_stream, business_unit, management_department, service_country,
    mgmt_account_classification, management_account_name, holding_segment, business_partner_name, source,
    {converted_sum("value_usd_bdg")} AS value
  FROM {{expense_cube}}
  WHERE department_classification = 'S&M' AND mgmt_account_subclasification = 'SG&A'
    AND revenue_stream NOT IN ('Vouchers', 'Rewards') AND business_unit <> 'Financial Services'
    AND subversion = 'REAL' AND management_department <> 'Success'
    AND NOT (management_department = 'RevOps' AND management_account_name = 'Payroll')
  GROUP BY ALL) WHERE value <> 0
"""
BLOCKS["old_spread"] = """
SELECT year, month, w.revenue_stream, management_department, g.service_country AS o_service_country,
  w.service_country AS final_service_country, management_account_name, w.holding_segment, source, category,
  value * w.parametro AS value_expense
FROM {old_groups} g JOIN {weights_old} w ON g.revenue_stream = w.o_revenue_stream
  AND g.holding_segment = w.o_holding_segment AND g.service_country = w.o_service_country
WHERE category <> 'atribuible'
UNION ALL
SELECT year, month, revenue_stream, management_department, service_country, service_country,
  management_account_name, holding_segment, source, category, value
FROM {old_groups} WHERE category = 'atribuible'
"""
BLOCKS["head_office"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{o}', '{f}', CAST({w} AS DOUBLE))" for o, f, w in R.HEAD_OFFICE_WEIGHTS
) + ") v(o_country, f_service_country, percentage)"

_SCOPE = f"""mgmt_account_subclasification = 'SG&A' AND year >= {MIN_YEAR} AND department_classification = 'S&M'
  AND management_department NOT IN ('Success', 'Insurance')"""
_VENDOR = "year, month, service_country AS o_service_country, management_department, management_account_name, business_partner_name"
BLOCKS["management_lines"] = f"""
SELECT {_VENDOR}, value_usd_bdg FROM {{expense_cube}}
WHERE {_SCOPE} AND management_account_name NOT IN {quoted(X.MANAGEMENT_EXCLUDED_ACCOUNTS)}
  AND business_partner_name NOT IN {quoted(_E.service_vendors)}
"""


def _split(source: str) -> str:
    return f"""
SELECT year, month, o_service_country, f_service_country, management_department, management_account_name,
  business_partner_name, original_value, original_value * percentage AS value_usd_distr
FROM ({source}) g LEFT JOIN {{head_office}} w ON g.o_service_country = w.o_country
"""


BLOCKS["management_rows"] = _split(f"""
SELECT * EXCLUDE (value_usd_bdg), {converted_sum("value_usd_bdg")} AS original_value FROM {{management_lines}}
WHERE (management_account_name IN ('Professional Services', 'Digital Tools')
       AND business_partner_name IN {quoted(_E.management_vendors)})
  OR management_account_name NOT IN ('Professional Services', 'Digital Tools')
GROUP BY ALL""") + f"""
UNION ALL
SELECT m.year, m.month, c, c, 'Marketing', 'Professional Services', 'Studio', 350, 350
FROM (SELECT DISTINCT year, month FROM {{management_lines}}) m, (SELECT unnest(['CL', 'MX', 'ES']) AS c)
"""
_FINANCIAL = f"""{_SCOPE} AND accounting_account_name <> 'Vacaciones al Personal' AND subversion = 'REAL'
  AND version = 'REAL' AND upper(source) NOT LIKE '%REWARDS%' AND upper(management_account_name) NOT LIKE '%COGS%'"""
BLOCKS["financial_rows"] = _split(f"""
SELECT * EXCLUDE (total), CASE WHEN business_partner_name = '{_E.scaled_vendor}' THEN total * CAST(0.7 AS DOUBLE)
  ELSE total END AS original_value
FROM (SELECT {_VENDOR}, {converted_sum("value_usd_bdg")} AS total
  FROM {{expense_cube}}
  WHERE {_FINANCIAL} AND management_account_name NOT IN {quoted(X.FINANCIAL_EXCLUDED_ACCOUNTS)}
    AND business_partner_name NOT IN {quoted(_E.service_vendors)}
  GROUP BY ALL)
UNION ALL
SELECT {_VENDOR}, {converted_sum("value_usd_bdg")} AS original_value
FROM {{expense_cube}}
WHERE {_FINANCIAL} AND management_account_name = 'Payroll' AND management_department <> 'RevOps'
  AND full_date < {date(CUTOVER)}
GROUP BY ALL""") + """
UNION ALL
SELECT year, month, o_service_country, f_service_country, management_department, management_account_name,
  business_partner_name, original_value, value_usd_distr FROM {payroll_external}
"""

# ---- deals -------------------------------------------------------------------------------------------

BU = pick("lower(company_size)", R.DEAL_BUSINESS_UNITS)


def unlike(c: str, patterns, nulls: bool) -> str:
    tests = " AND ".join(f"lower({c}) NOT LIKE '{p}'" for p in patterns)
    return f"(({tests}) OR {c} IS NULL)" if nulls else f"({tests})"


def _won(development) -> str:
    return f"""closed_date >= {date(SINCE)} AND {unlike("deal_name", R.TEST_NAME_PATTERNS, False)}
  AND {unlike("development_type", development, True)}
  AND {unlike("value_proposition", ["%customer_engagement%"], True)}
  AND {unlike("partnership_demand_name", [RULES.deal.excluded_partner_pattern], True)}"""


BLOCKS["won"] = f"""
SELECT *, {BU} AS bu FROM {{deal_versions}}
WHERE {_won(R.EXCLUDED_DEVELOPMENT)} AND deal_stage = 'Cierres ganados'
  AND (lower(product_modules) NOT IN {quoted(RULES.deal.excluded_modules)} OR product_modules IS NULL)
  AND lower(deal_pipeline) IN {quoted(R.WON_PIPELINES)} AND lower(value_proposition) <> 'affinity'
  AND lower(deal_country) <> 'spain'
"""
BLOCKS["won_es"] = f"""
SELECT v.*, {BU} AS bu FROM {{deal_versions}} v
JOIN (SELECT deal_id, MAX(last_modified_date) AS newest FROM {{deal_versions}} GROUP BY deal_id) n
  ON v.deal_id = n.deal_id AND v.last_modified_date = n.newest
WHERE {_won(R.EXCLUDED_DEVELOPMENT_ES)} AND created_date <= {date(AS_OF)} - 1
  AND lower(deal_pipeline) LIKE '{RULES.deal.es_pipeline_pattern}'
  AND (lower(value_proposition) <> 'affinity' OR value_proposition IS NULL)
  AND lower(deal_country) = 'spain' AND upper(deal_stage) LIKE '%CLOSED WON%' AND {BU} IS NOT NULL
"""
_CLOSED = "month(closed_date) AS closed_date_month, year(closed_date) AS closed_date_year, deal_country, bu"
BLOCKS["logos"] = f"""
SELECT DISTINCT {_CLOSED}, company_id, deal_id FROM {{won}}
UNION ALL
SELECT DISTINCT {_CLOSED}, company_id, deal_id FROM {{won_es}}
"""

# ---- engagement --------------------------------------------------------------------------------------

REAL_CLIENT = "NOT regexp_matches(lower(COALESCE(client_name, '')), '(demo|prueba|trial|test)')"
USERS = "CAST(SUM(onboarding_users) AS BIGINT) AS onboarded_members, CAST(SUM(total_users) AS BIGINT) AS total_members, " \
        "CAST(SUM(total_user_mau) AS BIGINT) AS monthly_active_users"
BLOCKS["rates"] = f"""
SELECT *, {ratio("onboarded_members", "total_members")} AS onb_rate,
  {ratio("monthly_active_users", "onboarded_members")} AS mau_rate
FROM (SELECT {month("date_start")} AS period, client_country_code AS country,
    CASE WHEN client_size IN ('micro', 'sme') THEN 'SME' WHEN client_size IN ('corporate', 'enterprise')
      THEN 'Enterprise' END AS segment,
    {pick("business_type", R.ENGAGEMENT_STREAMS)} AS revenue_stream, {USERS}
  FROM {{client_metrics}}
  WHERE {REAL_CLIENT} AND client_country_code IN ('CL', 'MX', 'ES')
    AND business_type IN ('employee_engagement', 'customer_engagement') AND client_size IS NOT NULL
    AND date_trunc('month', date_start) >= {date(SINCE)}
  GROUP BY ALL)
"""
BLOCKS["cal_months"] = f"""
SELECT DISTINCT {month("full_date")} AS month FROM {{calendar}}
WHERE full_date >= {date(SINCE)} AND full_date <= {date(AS_OF)}
"""
BLOCKS["members_by_client"] = f"""
SELECT 'EB' AS stream, date_start_month, company_tax_id AS tax_id, members_onboard, mau
FROM {{mau_eb}} m LEFT JOIN {{client_companies}} c ON m.company_id = c.company_id
UNION ALL
SELECT 'CB', date_start_month, company_tax_id, members_onboard, mau
FROM {{mau_cb}} m LEFT JOIN {{client_companies}} c ON m.company_id = c.company_id
UNION ALL
SELECT {pick("business_type", R.ENGAGEMENT_STREAMS)}, date_start_month, client_tax_id, members_onboard, mau
FROM {{mau_clients}} m LEFT JOIN {{clients}} c ON m.client_id = c.client_id
"""
BLOCKS["sessions"] = f"""
SELECT DISTINCT data_person_id, val_minutes, calories, {month("date_start")} AS m FROM {{activities}}
WHERE date_start < {date(AS_OF)}
"""

# ---- rewards -----------------------------------------------------------------------------------------

INTERNAL = yes_no("starts_with(lower(companyNameApp), 'acme') OR lower(companyNameApp) = 'points house'")


def home(country: str, transaction: str) -> str:
    return (f"CASE WHEN {country} = 'CL' OR (COALESCE({country}, '') = '' AND (contains({transaction}, 'OP2') "
            f"OR contains({transaction}, 'CL-'))) THEN 'CL' ELSE 'OTRO' END")


def order_like(c: str, places: str) -> str:
    return f"(regexp_matches({c}, 'OP\\d+') OR regexp_matches({c}, '[{places}]-\\d+'))"


BONUS_ID = ("CASE WHEN regexp_matches(transactionId, 'OP\\d+') THEN "
            "split_part(split_part(transactionId, '.', 1), ',', 1) ELSE transactionId END")
_LOADED_FROM, _LOADED_TO = date(REWARDS_SINCE), date(REWARDS_AS_OF)

BLOCKS["loaded"] = f"""
SELECT g.createdAt, g.transactionId, {scalar("g.giftCards_member", "amount")} AS amount_text,
  {scalar("g.giftCards_member", "nationalId")} AS national, {scalar("g.giftCards_member", "email")} AS user_email,
  a.name AS companyNameApp, b.nationalId AS companyNationalIdBO,
  {home("b.countryId", "g.transactionId")} AS corrected, n.userId AS user_id, p.paymentMethod AS paymentmethod
FROM {{loads}} g
LEFT JOIN {{companies_app}} a ON a.document_id = g.companyId
LEFT JOIN (SELECT DISTINCT document_id, label, companyId FROM {{orders_bo}}) o ON o.label = g.transactionId
LEFT JOIN {{companies_bo}} b ON b.document_id = o.companyId
LEFT JOIN {{bonuses}} n ON n.document_id = {scalar("g.giftCards_member", "id")}
LEFT JOIN {{orders_bo}} p ON p.label = g.transactionId
WHERE CAST(g.createdAt AS DATE) >= {_LOADED_FROM} AND date_trunc('month', g.createdAt) <= {_LOADED_TO}
  AND {scalar("g.giftCards_member", "allowedGiftCardIds")} IS NULL
  AND {order_like("g.transactionId", "MX|CO|CL|COP|PE")}
"""
BLOCKS["funded"] = f"""
SELECT o.label AS funding_label, o1.label AS label, {rounded(scalar("t.withdraworders_member", "amount"))} AS withdrawn
FROM {{balance_tx}} t
JOIN {{orders_bo}} o ON t.depositorderid = o.document_id
JOIN {{orders_bo}} o1 ON {scalar("t.withdraworders_member", "orderId")} = o1.document_id
"""
BLOCKS["done_orders"] = f"""
SELECT o.*, f.withdrawn, COALESCE(f.funding_label, o.label) AS super_label,
  {digits("COALESCE(f.funding_label, o.label)")} AS super_id
FROM {{orders_bo}} o LEFT JOIN {{funded}} f ON f.label = o.label
WHERE CAST(o.createdAt AS DATE) >= {date(SINCE)} AND o.countryId = 'CL' AND o.status = 'done'
"""
BLOCKS["load_records"] = """
SELECT DISTINCT g.document_id, g.transactionId, g.createdAt AS load_created, g.companyId,
  o.paymentMethod AS paymentmethod, a.name AS companyNameApp, b.nationalId AS companyNationalIdBO, b.countryId
FROM {loads} g
LEFT JOIN {orders_bo} o ON o.label = split_part(g.transactionId, '.', 1)
LEFT JOIN {companies_app} a ON a.document_id = g.companyId
LEFT JOIN {companies_bo} b ON b.document_id = o.companyId
"""

# ---- profit and loss -----------------------------------------------------------------------------------

_STREAM = pick("revenue_stream", R.COST_STREAMS, "revenue_stream")
_SEGMENT = "CASE holding_segment WHEN 'SMB' THEN 'SME' ELSE holding_segment END"
_AMOUNTS = f"{exact_sum('value_lc')} AS amount_local, {converted_sum('value_usd_bdg')} AS amount_usd"
BLOCKS["costs"] = f"""
SELECT make_date(year, month, 1) AS period, service_country AS country, {_SEGMENT} AS segment,
  {_STREAM} AS revenue_stream, 'COGS' AS pnl_line, management_department AS department, {_AMOUNTS}
FROM {{expense_cube}}
WHERE mgmt_account_subclasification = 'COGS' AND management_department = 'Sales' AND subversion = 'REAL'
  AND ((revenue_stream = 'Employee Benefit' AND holding_segment IN ('SME', 'Enterprise')) OR revenue_stream = 'Affinity')
  AND year >= {MIN_YEAR} AND management_account_name <> 'COGS: Rebate' AND service_country <> 'HQ'
GROUP BY ALL
UNION ALL
SELECT make_date(year, month, 1), service_country, NULL, 'FS', 'COGS', NULL, {_AMOUNTS}
FROM {{expense_cube}}
WHERE mgmt_account_subclasification = 'COGS' AND revenue_stream = 'Rewards' AND subversion = 'REAL'
  AND version = 'REAL' AND year >= {LATER_MIN_YEAR}
GROUP BY ALL
UNION ALL
SELECT make_date(year, month, 1), service_country, {_SEGMENT}, {_STREAM}, 'SGA', management_department, {_AMOUNTS}
FROM {{expense_cube}}
WHERE mgmt_account_subclasification = 'SG&A' AND mgmt_account_classification = 'P&L'
  AND management_account_name NOT IN {quoted(R.SGA_EXCLUDED_ACCOUNTS)}
  AND accounting_account_id NOT IN ('Vacaciones al Personal') AND subversion = 'REAL' AND year >= {MIN_YEAR}
GROUP BY ALL
"""
_LINE_SUMS = []
for _label, _local, _usd in P.BUILDUP_LINES:
    _LINE_SUMS.append(f"{exact_sum(_local, 6)} AS {_local}")
    if _usd:
        _LINE_SUMS.append(f"{converted_sum(_usd)} AS {_usd}")
BLOCKS["line_sums"] = f"""
SELECT full_date AS period, service_country AS country, client_segment AS segment,
  CASE WHEN revenue_stream <> 'EB' THEN revenue_stream
    ELSE {pick("product", P.EMPLOYEE_PRODUCTS, "revenue_stream")} END AS revenue_stream,
  {", ".join(_LINE_SUMS)}
FROM {{buildup_with_product}} WHERE year >= {MIN_YEAR} GROUP BY 1, 2, 3, 4
"""
BLOCKS["lines"] = "\nUNION ALL\n".join(
    f"SELECT period, country, segment, revenue_stream, '{label}' AS pnl_line, {local} AS amount_local, "
    f"{usd if usd else 'CAST(NULL AS DOUBLE)'} AS amount_usd FROM {{line_sums}}"
    for label, local, usd in P.BUILDUP_LINES
)
BLOCKS["other_revenue"] = f"""
SELECT make_date(year, month, 1) AS period, service_country AS country, revenue_stream,
  {exact_sum("value_lc", 6)} AS amount_local, {converted_sum("value_usd_bdg")} AS amount_usd, 'Revenue_EoP' AS pnl_line
FROM {{revenue_cube}}
WHERE revenue_stream IN ('FS', 'Otro negocio') AND year >= {LATER_MIN_YEAR}
GROUP BY 1, 2, 3
"""
BLOCKS["bookings"] = f"""
SELECT {month("close_date")} AS period, {pick("deal_country", R.BOOKED_COUNTRIES)} AS country,
  {pick("deal_size", R.DEAL_SEGMENTS)} AS segment,
  {pick("product_modules", R.BOOKED_PRODUCTS, "product_modules")} AS revenue_stream,
  {exact_sum("amount_in_company_currency")} AS amount_usd
FROM {{deals}}
WHERE close_date >= {date(SINCE)} AND deal_stage = 'Cierres ganados' AND deal_country IN ('Chile', 'Mexico')
  AND development_type_use = 'New Logo' AND upper(company_name) NOT LIKE '%HOUSE%'
  AND upper(company_name) NOT LIKE '% TEST %'
GROUP BY ALL
UNION ALL
SELECT {month("close_date")}, 'ES', {pick("deal_size", R.DEAL_SEGMENTS)}, 'EB',
  {exact_sum("amount_in_company_currency")}
FROM {{deals}}
WHERE close_date >= {date(SINCE)} AND deal_stage = 'Closed Won - 100%' AND deal_country = 'Spain'
  AND product_modules NOT IN ('Platform build', 'Gift Cards') AND product_modules NOT LIKE '%Gift Cards%'
GROUP BY ALL
"""


# ---- the queries ---------------------------------------------------------------------------------------

_FX_LINE = "x.Year = CAST(year(f.service_date) AS VARCHAR) AND x.Currency = f.local_currency"
_GRAIN_ALL = ", ".join([*GRAIN, "product"])

SQL: dict[str, str] = {
    "reconciled_monthly_revenue": iso(f"""
SELECT full_date, {", ".join("m." + c for c in [*GRAIN, "product"])}, CAST(value_lc AS DOUBLE) AS value_lc,
  CASE WHEN {ratio("convertible", "x.Value")} IS NOT NULL OR usd_given IS NOT NULL THEN
    COALESCE({ratio("convertible", "x.Value")}, 0) + COALESCE({as_double("usd_given")}, 0) END AS value_usd_bdg,
  CAST(quantity AS DOUBLE) AS quantity_charged
FROM {{months_with_product}} m
LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(m.full_date) AS VARCHAR) AND x.Currency = m.local_currency
""", "full_date", "holding_cohort"),
    "union_sources": iso("""
SELECT document_number, legal_client_id, document_type, revenue_stream, CAST(value_lc AS DOUBLE) AS value_lc,
  service_date, product, contract_plan_id FROM {ledger_all}""", "service_date"),
    "union_sources_main_family": """
SELECT document_number, revenue_stream, CAST(value_lc AS DOUBLE) AS value_lc, product FROM {ledger_recent}
WHERE product IN ('S.C', 'S.C cargas')""",
    "dim_distinct": "SELECT DISTINCT holding_name, service_country, client_segment FROM {holdings}",
    "enrich_normalized_key": iso(f"""
SELECT f.document_number, f.legal_client_id, f.revenue_stream, f.legal_entity_country, h.holding_name,
  h.client_segment, h.holding_cohort
FROM {{ledger_current}} f LEFT JOIN {{holdings}} h ON {HOLDING_JOIN}""", "holding_cohort"),
    "tax_factor": f"""
SELECT document_number, local_currency, CAST(value_lc AS DOUBLE) AS value_lc,
  CAST({net("value_lc", "local_currency")} AS DOUBLE) AS net_lc FROM {{ledger_current}}""",
    "fx_rates": iso(f"""
SELECT f.document_number, f.service_date, f.local_currency, CAST(f.value_lc AS DOUBLE) AS value_lc,
  x.Value AS fx_value, {ratio("f.value_lc", "x.Value")} AS value_usd_bdg
FROM {{ledger_history}} f LEFT JOIN {{fx_budget}} x ON {_FX_LINE}""", "service_date"),
    "arpu_gross_and_net": f"""
SELECT document_number, {ratio("value_lc", "quantity_charged")} AS arpu_gross,
  {ratio(net("value_lc", "local_currency"), "quantity_charged")} AS arpu_net FROM {{ledger_recent}}""",
    "group_flag": """
SELECT document_number, MAX(document_binary) OVER (PARTITION BY holding_name, service_date, revenue_stream)
  AS document_binary FROM {current_holding}""",
    "code_map": f"""
SELECT document_number, legal_entity_country, {pick("legal_entity_country", R.COUNTRY_NAMES)} AS country_name,
  {pick("legal_entity_country", _HOUSE_NAMES)} AS entity_name FROM {{ledger_current}}""",
    "product_bucket": f"""
SELECT document_number, {", ".join(f"{bucket(v)} AS product_{v}" for v in ("merged", "split", "explicit"))}
FROM {{ledger_current}}""",
    "addon_zero_quantity": """
SELECT document_number, product, CASE WHEN product = 'S.C cargas' THEN 0 ELSE quantity_charged END AS quantity
FROM {ledger_current}""",
    "monthly_rollup": iso(f"""
SELECT full_date, {", ".join(GRAIN)}, CAST(value_lc AS DOUBLE) AS value_lc, CAST(quantity AS DOUBLE) AS quantity
FROM {{months_no_product}}""", "full_date", "holding_cohort"),
    "gap_fill": iso(f"""
SELECT full_date, {_GRAIN_ALL}, CAST(value_lc AS DOUBLE) AS value_lc, CAST(quantity AS DOUBLE) AS quantity
FROM {{filled_with_product}}""", "full_date", "holding_cohort"),
    "revenue_base": iso("SELECT * FROM {base_with_product}", "full_date", "holding_cohort"),
    "cohort_from_first": iso(
        "SELECT DISTINCT holding_name, full_date, holding_cohort, invoice_number FROM {base_main_family}",
        "full_date", "holding_cohort"),
    "months_since_cohort": f"""
SELECT f.document_number, date_diff('month', h.holding_cohort, f.document_date) AS invoice_number
FROM {{ledger_current}} f LEFT JOIN {{holdings}} h ON {HOLDING_JOIN}""",
    "period_context": iso("SELECT * FROM {context_no_product}", "full_date", "holding_cohort"),
    "movement_members": _part("no_product", "members", *_movement("members")),
    "movement_value": _part("no_product", "value_lc", *_movement("value_lc"), *_movement("value_usd")),
    "movement_logos": _part("other_products", "logo_bop", "logo_new", "logo_churn", "logo_eop"),
    "linked_churn": _part("main_family", "members_churn", "value_lc_churn", "value_usd_churn", "logo_churn"),
    "revenue_cube": iso("SELECT * FROM {revenue_cube}", "full_date", "holding_cohort"),
    "revenue_lines": iso("SELECT * FROM {cube_lines}", "full_date", "holding_cohort"),
    "revenue_schema": iso("SELECT * FROM {rewards_cube}", "full_date", "holding_cohort"),
    "related_party_exclusion": iso("SELECT * FROM {entity_lines}", "full_date", "holding_cohort"),
    "non_subscription_history": iso("SELECT * FROM {history_cube}", "full_date", "holding_cohort"),
    "client_revenue_share": iso(f"""
SELECT service_date, holding_name, client_segment AS holding_size, translate(legal_client_id, '.-', '') AS tax_id,
  legal_client_name AS company_name, legal_entity_country AS country, g.local_currency AS currency,
  CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue, {ratio("revenue", "quantity")} AS arpu,
  {ratio("revenue", "x.Value")} AS revenue_usd, {ratio(ratio("revenue", "x.Value"), "quantity")} AS arpu_usd,
  {ratio("revenue", "SUM(revenue) OVER (PARTITION BY service_date, legal_entity_country)")} AS revenue_weight
FROM (
  SELECT service_date, holding_name, client_segment, legal_client_id, legal_client_name, legal_entity_country,
    local_currency, SUM({exact("quantity_charged")}) AS quantity, SUM({net("value_lc", "local_currency")}) AS revenue
  FROM (
    SELECT f.*, h.holding_name, h.client_segment, {doc_class("f.document_type")} AS cls,
      MAX({doc_class("f.document_type")}) OVER (PARTITION BY h.holding_name, f.service_date, f.revenue_stream,
        f.legal_entity_country) AS best
    FROM {{ledger_recent}} f LEFT JOIN {{holdings}} h ON {HOLDING_JOIN}
    WHERE f.revenue_stream = 'EB' AND f.document_type <> 'Free' AND f.legal_entity_country IN ('CL', 'MX'))
  WHERE cls = best AND service_date >= {date(SINCE)}
  GROUP BY ALL) g
LEFT JOIN {{fx_budget}} x ON x.Year = CAST(year(g.service_date) AS VARCHAR) AND x.Currency = g.local_currency
""", "service_date"),
    "share_of_total": f"""
SELECT countryId, companyId, CAST(amount AS DOUBLE) AS amount,
  {ratio("amount", "SUM(amount) OVER (PARTITION BY countryId)")} AS share
FROM (SELECT countryId, companyId, SUM({exact("totalamount")}) AS amount FROM {{orders_bo}} GROUP BY ALL)""",
    "qa_running_flag": f"""
SELECT * FROM (
  SELECT DISTINCT h.service_country, f.legal_client_id, h.holding_name, f.product,
    CAST(MAX(CASE WHEN upper(f.product) IN ('S.C', 'S.C CARGAS') THEN 1 ELSE 0 END)
      OVER (PARTITION BY h.holding_name ORDER BY f.legal_client_id) AS BIGINT) AS check_product_por_holding
  FROM {{ledger_current}} f LEFT JOIN {{holdings}} h ON {HOLDING_JOIN}
  WHERE f.service_date >= {date(SINCE)} AND h.service_country IN ('CL', 'MX') AND f.document_type <> 'Free'
    AND f.revenue_stream = 'EB')
WHERE product IS NULL AND check_product_por_holding = 1 AND holding_name NOT IN ('Group 4', 'Group 10')""",
    "running_flag": """
SELECT DISTINCT holding_name, legal_client_id, document_type,
  CAST(MAX(CASE WHEN document_type = 'Bill' THEN 1 ELSE 0 END)
    OVER (PARTITION BY holding_name ORDER BY legal_client_id) AS BIGINT) AS seen
FROM {current_holding}""",
    "product_cohort": iso(f"""
SELECT DISTINCT product_cohort, c.service_country, c.legal_client_id, holding_name, 'health' AS product
FROM (SELECT MIN(service_date) AS product_cohort, legal_entity_country AS service_country,
        {key("legal_client_id")} AS legal_client_id
      FROM {{ledger_current}} WHERE product IN ('S.C', 'S.C cargas') AND legal_entity_country IN ('CL', 'MX')
      GROUP BY {key("legal_client_id")}, legal_entity_country) c
LEFT JOIN {{holdings}} h ON c.legal_client_id = h.tax_id_client""", "product_cohort"),
    "new_activations": iso(f"""
SELECT d.deal_country, c.company_legal_id, c.company_name, d.product_modules, d.development_type_use, d.activation_date
FROM (SELECT DISTINCT deal_country, company_id, company_name, product_modules, activation_date, development_type_use
      FROM {{deals}} WHERE activation_date >= {date(SINCE)} AND deal_country IN ('Chile', 'Mexico')
        AND development_type_use NOT IN ('Renewal', 'Upside')) d
LEFT JOIN {{companies}} c ON d.company_id = c.company_id""", "activation_date"),
    "expense_cube_a": iso("SELECT * FROM {expense_cube}", "full_date", "payment_date"),
    "expense_cube_b": iso("SELECT * FROM {expense_cube_b}", "full_date", "payment_date"),
    "segment_from_name": "SELECT expense_id, accounting_account_name, CASE "
    + " ".join(f"WHEN upper(accounting_account_name) LIKE '{p}' THEN '{v}'" for p, v in R.SEGMENT_PATTERNS)
    + " ELSE 'Sin holding' END AS segment FROM {expenses_base_a}",
    "expense_control": f"""
SELECT * EXCLUDE (value_usd_bdg), {converted_sum("value_usd_bdg")} AS value_usd FROM {{control}}
WHERE control_group <> 'check' GROUP BY ALL""",
    "allocate_weights": iso(f"""
SELECT *, {TYPE} FROM (
  SELECT * EXCLUDE (business_partner_name), make_date(year, month, 1) AS full_date, {_subtype()} AS sub_type
  FROM {{v3_spread}})""", "full_date"),
    "allocate_reassign": f"""
SELECT year, month, revenue_stream, management_department, o_service_country, final_service_country,
  management_account_name, holding_segment, source, label AS tag_categoria_cac, value_expense,
  year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || '-01' AS full_date, s.aux, g.tag_cac
FROM (SELECT *, {LABEL} AS label, management_department || '-' ||
        CASE WHEN upper(management_account_name) IN ('PAYROLL', 'SEVERANCE') THEN 'payroll' ELSE 'non-payroll' END
        || '-' || {LABEL} AS aux FROM {{old_spread}}) s
LEFT JOIN {{tags}} g ON s.aux = g.aux""",
    "attribution_category": f"""
SELECT *, {LABEL} AS label FROM (
  SELECT revenue_stream, holding_segment, service_country, COUNT(*) AS expense_lines,
    CASE WHEN revenue_stream IS NULL THEN NULL ELSE {CATEGORY} END AS category
  FROM {{expense_cube}} GROUP BY revenue_stream, holding_segment, service_country)""",
    "tag_lookup": """
SELECT s.*, g.tag_cac FROM (
  SELECT management_department, COUNT(*) AS expense_lines, management_department || '-payroll-Local' AS aux
  FROM {expense_cube} GROUP BY management_department) s LEFT JOIN {tags} g ON s.aux = g.aux""",
    "classify_cost": f"""
SELECT *, {TYPE} FROM (
  SELECT management_account_name, management_department, COUNT(*) AS expense_lines, {_subtype()} AS sub_type
  FROM {{expense_cube}} GROUP BY management_account_name, management_department)""",
    "split_head_office": f"""
SELECT g.*, w.f_service_country, original_value * percentage AS value_usd_distr
FROM (SELECT year, month, service_country AS o_service_country, {exact_sum("value_lc")} AS original_value
      FROM {{expense_cube}} GROUP BY ALL) g
LEFT JOIN {{head_office}} w ON g.o_service_country = w.o_country""",
    "monthly_template": """
SELECT m.year, m.month, c AS country, CAST(350 AS DOUBLE) AS amount
FROM (SELECT DISTINCT year, month FROM {payroll_external}) m, (SELECT unnest(['CL', 'MX', 'ES']) AS c)""",
    "vendor_scale": f"""
SELECT *, CASE WHEN business_partner_name = '{_E.scaled_vendor}' THEN total * CAST(0.7 AS DOUBLE) ELSE total END AS scaled
FROM (SELECT business_partner_name, {exact_sum("value_lc")} AS total FROM {{expenses_base_a}} GROUP BY ALL)""",
    "management_cost": "SELECT * FROM {management_rows}",
    "cutover_union": f"""
SELECT *, CASE WHEN management_account_name IN {quoted(R.FINANCIAL_SPLIT_ACCOUNTS)} THEN 'cac_financiero'
  WHEN business_partner_name IN {quoted(_E.tool_vendors)} AND management_account_name = 'Digital Tools' THEN 'gestion'
  WHEN business_partner_name IN {quoted(_E.always_management_vendors)} THEN 'gestion'
  WHEN management_account_name IN {quoted(R.MANAGEMENT_SPLIT_ACCOUNTS)} THEN 'gestion'
  ELSE 'cac_financiero' END AS separacion_cac
FROM {{financial_rows}}""",
    "won_deals": iso("""
SELECT deal_id, company_id, deal_name, closed_date, strftime(last_modified_date, '%Y-%m-%d %H:%M:%S')
  AS last_modified_date, bu FROM {won}""", "closed_date"),
    "latest_version": """
SELECT deal_id, strftime(last_modified_date, '%Y-%m-%d %H:%M:%S') AS last_modified_date, deal_stage,
  number_of_employees
FROM (SELECT *, MAX(last_modified_date) OVER (PARTITION BY deal_id) AS newest FROM {deal_versions})
WHERE last_modified_date = newest""",
    "won_deals_latest": iso("""
SELECT deal_id, company_id, closed_date, strftime(last_modified_date, '%Y-%m-%d %H:%M:%S') AS last_modified_date,
  number_of_employees FROM {won_es}""", "closed_date"),
    "first_time_company": """
SELECT * EXCLUDE (again), CAST(company_id IS NOT NULL AS BIGINT) AS company_count,
  CASE WHEN again THEN 'repetido' ELSE 'no repetido' END AS company_repeat_check,
  CAST(CASE WHEN company_id IS NOT NULL THEN NOT again END AS BIGINT) AS company_count_post_check
FROM (SELECT *, COALESCE(LAG(company_id) OVER (PARTITION BY company_id ORDER BY closed_date_year, closed_date_month,
        deal_id, deal_country, bu NULLS FIRST) = company_id, FALSE) AS again FROM {logos})""",
    "booked_members": f"""
SELECT * FROM (
  SELECT * EXCLUDE (deal_id) FROM (
    SELECT DISTINCT {_CLOSED}, number_of_employees, closed_amount, deal_id FROM {{won}})
  UNION ALL
  SELECT DISTINCT {_CLOSED}, number_of_employees, closed_amount FROM {{won_es}})
WHERE closed_amount > 0 AND number_of_employees > 0""",
    "meetings_by_month": iso(f"""
SELECT {month("meeting_date")} AS meeting_month, deal_country, COUNT(m.deal_id) AS meetings
FROM {{meetings}} m JOIN {{deals}} d ON m.deal_id = d.deal_id
WHERE meeting_outcome = 'COMPLETED' AND activity_type = 'First meeting (AE)'
  AND deal_country IN ('Chile', 'Mexico', 'Spain', 'China')
GROUP BY ALL""", "meeting_month"),
    "booked_mrr": iso("SELECT * FROM {bookings}", "period"),
    "calendar_months": iso("SELECT * FROM {cal_months}", "month"),
    "month_spine": iso(f"""
SELECT s.month, n_orders
FROM (SELECT CAST(unnest(generate_series(DATE '1996-05-01', {date(AS_OF)}, INTERVAL 1 MONTH)) AS DATE) AS month) s
LEFT JOIN (SELECT {month("createdAt")} AS month, COUNT(*) AS n_orders FROM {{orders_bo}} GROUP BY 1) o
  ON o.month = s.month""", "month"),
    "engagement_rates": iso("SELECT * FROM {rates}", "period"),
    "engagement_on_calendar": iso(f"""
SELECT date, client_country_code, business_type, client_size, {USERS}
FROM (SELECT {month("date_start")} AS date, client_country_code, business_type,
        CASE WHEN client_size IN ('corporate', 'enterprise') THEN 'enterprise'
             WHEN client_size IN ('micro', 'sme') THEN 'sme' ELSE 'check' END AS client_size,
        onboarding_users, total_users, total_user_mau
      FROM {{client_metrics}} WHERE {REAL_CLIENT} AND client_country_code IN ('CL', 'MX', 'ES')) m
JOIN {{cal_months}} c ON c.month = m.date
GROUP BY ALL""", "date"),
    "engagement_by_segment": iso("""
SELECT m.stream AS revenue_stream, m.date_start_month AS service_date, h.service_country, h.client_segment,
  CAST(SUM(COALESCE(members_onboard, 0)) AS BIGINT) AS onboarded_members, CAST(SUM(COALESCE(mau, 0)) AS BIGINT) AS mau
FROM {members_by_client} m
LEFT JOIN (SELECT DISTINCT revenue_stream, holding_name, service_country, client_segment,
             translate(tax_id_client, '/-.', '') AS tax_id FROM {holdings}) h
  ON m.tax_id = h.tax_id AND m.stream = h.revenue_stream
GROUP BY ALL""", "service_date"),
    "cumulative_by_calendar": iso(f"""
SELECT c.month, k.kpi, k.unit, CAST(SUM(CASE WHEN k.unit = 'calories' THEN {exact("calories")}
  ELSE {exact("val_minutes")} END) AS DOUBLE) AS val_total
FROM (SELECT DISTINCT {month("full_date")} AS month FROM {{calendar}}
      WHERE full_date >= DATE '1996-01-01' AND full_date <= {date(AS_OF)}) c
JOIN {{sessions}} s ON s.m <= c.month,
  (VALUES ('total_calories_burned', 'calories'), ('total_training_minutes', 'minutes')) k(kpi, unit)
GROUP BY ALL""", "month"),
    "rewards_loaded": f"""
SELECT strftime(createdAt, '%Y-%m-%d %H:%M:%S') AS createdAt, {YM.format(c="createdAt")} AS "AnoMes Loaded",
  {rounded("amount_text")} AS amount, companyNameApp, companyNationalIdBO,
  corrected AS companyNationalityBO_corregido, national AS "user nationalId", user_email, user_id, transactionId,
  {digits("transactionId")} AS "transactionId Limpio", 'points' AS type, paymentmethod, {INTERNAL} AS empresa_interna,
  transactionId || national AS llave_voided_loadedid_userid,
  {yes_no("contains(lower(transactionId), '.') OR contains(lower(transactionId), 'bonus')")} AS es_movimiento_reloaded
FROM {{loaded}} WHERE corrected = 'CL'""",
    "rewards_orders": f"""
SELECT DISTINCT strftime(o.createdAt, '%Y-%m-%d %H:%M:%S') AS "orderCreatedDate",
  {YM.format(c="o.createdAt")} AS "AnoMes Order", o.label AS "orderId", {digits("o.label")} AS "orderId Limpio",
  o.paymentMethod AS "orderPaymentMethod", o.status AS "orderStatus",
  COALESCE(b.nationalId, c.document_value) AS "companyNationalId",
  COALESCE(b.legalName, c.company_name) AS "companyLegalName", i.invoiceNumber AS "invoiceNumber",
  i.amount AS "invoiceAmount", o.super_label AS invoiced_orden_factura_suprema,
  o.super_id AS "invoiced_orden_factura_suprema Limpio", {YM.format(c="s.first_date")} AS "AnoMes Order Supremo",
  o.withdrawn AS withdrawn_amount_saldo, {rounded(scalar("o.products_member", "quantity"))} AS "productAmount",
  CASE WHEN lower(o.channel) = 'b2b-wallet-platform' THEN 'Portal' ELSE 'BO' END AS channel
FROM {{done_orders}} o
LEFT JOIN {{companies_bo}} b ON b.document_id = o.companyId
LEFT JOIN {{client}} c ON c.id = o.companyId
LEFT JOIN {{invoices}} i ON i.orderId = o.document_id
LEFT JOIN (SELECT super_id, MIN(createdAt) AS first_date FROM {{done_orders}} GROUP BY super_id) s
  ON s.super_id = o.super_id""",
    "rewards_redeemed": f"""
SELECT strftime({santiago("r.createdAt")}, '%Y-%m-%d %H:%M:%S') AS "Redeemed createdAt",
  {YM.format(c=santiago("r.createdAt"))} AS "AnoMes Redeemed", r.amount AS "userGiftCardAmount",
  {rounded(scalar("r.contributions_member", "totalTakenAmount"))} AS "bonusLoadRedeemedContributionAmount",
  r.giftCardId, r.code, u.document_id AS user_id, u.nationalId AS "user_nationalId",
  {BONUS_ID} AS "bonusLoadTransactionId", {digits("transactionId")} AS "bonusLoadTransactionId Limpio",
  {YM.format(c=santiago("load_created"))} AS "AnoMes Loaded", companyNameApp, companyNationalIdBO,
  {INTERNAL} AS empresa_interna, {BONUS_ID} || u.document_id AS llave_bonus_user
FROM {{user_giftcards}} r
JOIN (SELECT DISTINCT document_id, giftCardsLoadId, userId FROM {{bonuses}} WHERE giftCardsLoadId IS NOT NULL) n
  ON n.document_id = {scalar("r.contributions_member", "bonusId")} AND n.userId = r.userId
JOIN {{load_records}} l ON l.document_id = n.giftCardsLoadId
JOIN {{users}} u ON u.document_id = r.userId
WHERE r.voidedAt IS NULL AND r.status NOT IN ('voided', 'reversed') AND r.userGiftCardRedeemRequestId IS NOT NULL
  AND r.contributions_index IS NOT NULL AND date_trunc('month', r.createdAt) >= {_LOADED_FROM}
  AND date_trunc('month', r.createdAt) <= {_LOADED_TO} AND CAST({santiago("r.createdAt")} AS DATE) >= {_LOADED_FROM}
  AND {order_like("transactionId", "MX|COP|CL|PE")} AND u.nationality = 'CL'
  AND {home("l.countryId", "transactionId")} = 'CL'""",
    "rewards_voided": f"""
SELECT strftime(n.voidedat, '%Y-%m-%d %H:%M:%S') AS "voidedAt", {YM.format(c="n.voidedat")} AS "AnoMes Voided",
  strftime(n.createdAt, '%Y-%m-%d %H:%M:%S') AS "bonusLoadCreatedAt", {YM.format(c="n.createdAt")} AS "AnoMes Loaded",
  n.amount, n.email, n.nationalId AS "userNationalId", a.name AS "companyNameApp",
  b.nationalId AS "companyNationalIdBO", {home("b.countryId", "transactionId")} AS "companyNationalityBO_corregido",
  transactionId AS "bonusLoadTransactionId", {digits("transactionId")} AS "bonusLoadTransactionId Limpio",
  o.paymentMethod AS paymentmethod, {INTERNAL.replace("companyNameApp", "a.name")} AS empresa_interna
FROM {{bonuses}} n
JOIN (SELECT DISTINCT document_id, transactionId, companyId FROM {{loads}}) l ON l.document_id = n.giftCardsLoadId
LEFT JOIN {{companies_app}} a ON a.document_id = l.companyId
LEFT JOIN {{orders_bo}} o ON o.label = split_part(l.transactionId, '.', 1)
LEFT JOIN {{companies_bo}} b ON b.document_id = o.companyId
WHERE date_trunc('month', n.createdAt) >= {_LOADED_FROM} AND date_trunc('month', n.createdAt) <= {_LOADED_TO}
  AND n.allowedGiftCardIds = FALSE AND n.status = 'voided' AND {home("b.countryId", "transactionId")} = 'CL'""",
    "clean_order_id": f"""
SELECT document_id, transactionId AS "transactionId", {digits("transactionId")} AS order_id, {BONUS_ID} AS bonus_id,
  {yes_no("contains(lower(transactionId), '.') OR contains(lower(transactionId), 'bonus')")} AS reloaded,
  split_part(transactionId, '.', 1) AS head FROM {{loads}}""",
    "corrected_country": f"""
SELECT g.document_id, {home("o.countryId", "g.transactionId")} AS country
FROM {{loads}} g LEFT JOIN {{orders_bo}} o ON o.label = split_part(g.transactionId, '.', 1)""",
    "duplicate_keys": "SELECT tax_id_client, count(*) AS n_rows FROM {holdings} GROUP BY tax_id_client HAVING count(*) > 1",
    "json_members": "SELECT document_id, "
    + ", ".join(f"{scalar('giftCards_member', k)} AS \"{k}\""
                for k in ("nationalId", "email", "id", "allowedGiftCardIds"))
    + f", CAST({scalar('giftCards_member', 'amount')} AS DOUBLE) AS amount, {rounded(scalar('giftCards_member', 'amount'))} AS amount_long FROM {{loads}}",
    "zone_months": f"""
SELECT document_id, strftime({santiago("createdAt")}, '%Y-%m-%d %H:%M:%S') AS local_created,
  {YM.format(c=santiago("createdAt"))} AS year_month FROM {{loads}}""",
    "pnl_costs": iso("SELECT * FROM {costs}", "period"),
    "pnl_stack": iso("SELECT * FROM {lines}", "period"),
    "pnl_other_revenue": iso("SELECT * FROM {other_revenue}", "period"),
    "consolidated_pnl": iso("""
SELECT period, country, segment, revenue_stream, pnl_line, CAST(NULL AS VARCHAR) AS department, amount_local, amount_usd
FROM {lines}
UNION ALL SELECT period, country, segment, revenue_stream, pnl_line, department, amount_local, amount_usd FROM {costs}
UNION ALL SELECT period, country, segment, revenue_stream, 'Booked_MRR', NULL, NULL, amount_usd FROM {bookings}
UNION ALL SELECT period, country, NULL, revenue_stream, pnl_line, NULL, amount_local, amount_usd FROM {other_revenue}
UNION ALL SELECT period, country, segment, revenue_stream, 'ONB_Rate', NULL, onb_rate, NULL FROM {rates}
UNION ALL SELECT period, country, segment, revenue_stream, 'MAU_Rate', NULL, mau_rate, NULL FROM {rates}
""", "period"),
}
for _name, _country in (("reconcile_by_holding", ""), ("reconcile_by_holding_country", ", legal_entity_country")):
    SQL[_name] = iso(f"""
SELECT * EXCLUDE (best), {status("best")} AS document_status FROM (
  SELECT *, MAX(document_binary) OVER (PARTITION BY holding_name, service_date, revenue_stream{_country}) AS best
  FROM {{current_holding}}) WHERE document_binary = best""", "service_date")
for _variant in ("with_product", "no_product", "other_products", "main_family"):
    SQL[f"buildup_{_variant}"] = iso(f"SELECT * FROM {{buildup_{_variant}}}", "full_date", "holding_cohort")

# Stored, ordered and incremental results equal those of the whole plans.
for _name, _whole in {
    "revenue_cube_from_stored_rewards": "revenue_cube", "consolidated_pnl_from_stored_cubes": "consolidated_pnl",
    "incremental_revenue_lines": "revenue_lines", "reconcile_changed_documents": "reconcile_by_holding",
    "cumulative_extended": "cumulative_by_calendar", "rewards_loaded_from_members": "rewards_loaded",
    "enrich_colocated": "enrich_normalized_key", "rewards_orders_from_members": "rewards_orders", "rewards_redeemed_from_members": "rewards_redeemed",
}.items():
    SQL[_name] = SQL[_whole]

for _block, _text in _months_sql("with_product").items():
    _known = _text.replace(ledger(ALL), ledger(ALL, f"document_date IS NULL OR document_date <= {date(REPLAY)}"))
    BLOCKS[_block.replace("_with_product", "_as_of")] = _known.replace("_with_product}", "_as_of}")
_CENSORED = ", ".join(
    f"CASE WHEN full_date >= {date(REPLAY.replace(day=1))} THEN 0 ELSE {c} END AS {c}" for c in ("members_churn", "value_lc_churn", "value_usd_churn", "logo_churn")
)
SQL["buildup_as_of"] = iso(f"SELECT * REPLACE ({_CENSORED}) FROM {{buildup_as_of}}", "full_date", "holding_cohort")

BLOCKS["deal_versions_then"] = f"SELECT * FROM {{deal_versions}} WHERE last_modified_date IS NULL OR CAST(last_modified_date AS DATE) <= {date(REPLAY)}"
for _block in ("won", "won_es", "logos"):
    _then = BLOCKS[_block].replace("{deal_versions}", "{deal_versions_then}").replace(date(AS_OF), date(REPLAY))
    BLOCKS[f"{_block}_then"] = _then.replace("{won}", "{won_then}").replace("{won_es}", "{won_es_then}")
SQL["first_time_company_as_of"] = SQL["first_time_company"].replace("{logos}", "{logos_then}")

SQL["ordered_revenue_cube"] = """
SELECT year, month, revenue_stream, tax_id_client, row_number() OVER (
  ORDER BY year NULLS FIRST, month NULLS FIRST, revenue_stream NULLS FIRST, tax_id_client NULLS FIRST) AS place FROM {revenue_cube}"""
SQL["ordered_financial_cost"] = """
SELECT year, month, original_value, row_number() OVER (
  ORDER BY year DESC NULLS LAST, month DESC NULLS LAST, original_value ASC NULLS FIRST) AS place FROM {financial_rows}"""

_DOCUMENT = "document_number, legal_client_id, document_type, revenue_stream, legal_entity_country, service_date, holding_name, document_binary"
BLOCKS["documents_before"] = f"""
SELECT {_DOCUMENT} FROM {{current_holding}} WHERE right(document_number, 1) NOT IN ('0', '1')
UNION ALL SELECT document_number, legal_client_id, 'Provision', revenue_stream, legal_entity_country, service_date, holding_name, 0
FROM {{current_holding}} WHERE right(document_number, 1) = '1'
UNION ALL SELECT document_number || '-x', legal_client_id, 'Invoice', revenue_stream, legal_entity_country, service_date, holding_name, 1
FROM {{current_holding}} WHERE right(document_number, 1) = '2'
"""


def _kept_documents(source: str) -> str:
    return f"""
SELECT * EXCLUDE (best) FROM (
  SELECT {_DOCUMENT}, MAX(document_binary) OVER (PARTITION BY holding_name, service_date, revenue_stream) AS best
  FROM {{{source}}}) WHERE document_binary = best"""


SQL["reconcile_delta"] = iso(f"""
SELECT *, CAST(1 AS BIGINT) AS change FROM ({_kept_documents("current_holding")} EXCEPT ALL {_kept_documents("documents_before")})
UNION ALL SELECT *, CAST(-1 AS BIGINT) FROM ({_kept_documents("documents_before")} EXCEPT ALL {_kept_documents("current_holding")})""", "service_date")

SQL["large_rule_list"] = """
SELECT c.c_custkey, c.c_name, min_by(p.p_name, p.p_partkey) AS label
FROM {customer} c LEFT JOIN {part} p ON c.c_name LIKE '%' || right(lpad(CAST(p.p_partkey AS VARCHAR), 9, '0'), 4) || '%'
GROUP BY c.c_custkey, c.c_name"""


def _total(x: str) -> str:
    return as_double(f"SUM(CAST({x} AS DECIMAL(38, 10)))")


SQL["control_totals"] = f"""
SELECT 'rates' AS step, (SELECT count(*) FROM {{ledger_history}}) AS rows_in, count(*) AS rows_out, count(*) FILTER (x.Year IS NULL) AS rows_unmatched,
  (SELECT {_total(exact("value_lc"))} FROM {{ledger_history}}) AS amount_in, {_total(exact("f.value_lc"))} AS amount_out,
  {_total(f"CASE WHEN x.Year IS NULL THEN {exact('f.value_lc')} END")} AS amount_unmatched
FROM {{ledger_history}} f LEFT JOIN {{fx_budget}} x ON {_FX_LINE}
UNION ALL
SELECT 'holdings', (SELECT count(*) FROM {{ledger_current}}), count(*), 0,
  (SELECT {_total(exact("value_lc"))} FROM {{ledger_current}}), {_total(exact("f.value_lc"))}, NULL
FROM {{ledger_current}} f JOIN {{holdings}} h ON {key("f.legal_client_id")} = {key("h.tax_id_client")}
UNION ALL
SELECT 'weights', count(*), CAST(sum(CASE WHEN known THEN 3 ELSE 1 END) AS BIGINT), count(*) FILTER (NOT known), {_total("value")},
  {as_double(f"SUM(CASE WHEN known THEN 3 * {converted('share')} END)")}, NULL
FROM (
  SELECT value, coalesce(currency IN ('CLP', 'MXN', 'BRL', 'USD', 'EUR'), false) AS known, CAST(value AS DOUBLE) * CAST(0.3333 AS DOUBLE) AS share
  FROM (SELECT currency, SUM({exact("value_lc")}) AS value FROM {{expenses_base_a}} GROUP BY currency))
"""
SQL["weights_that_do_not_add_up"] = f"""
SELECT countryId, CAST(sum(weight) AS DOUBLE) AS total_weight FROM (
  SELECT countryId, CAST(floor({ratio("amount", "sum(amount) OVER (PARTITION BY countryId)")} * 10000) AS DECIMAL(10, 0)) * CAST(0.0001 AS DECIMAL(4, 4)) AS weight
  FROM (SELECT countryId, companyId, SUM({exact("totalamount")}) AS amount FROM {{orders_bo}} GROUP BY ALL))
GROUP BY countryId HAVING abs(sum(weight) - 1) > 1e-9"""


def _by_holding(source: str, period: str) -> str:
    return f"""SELECT {period} AS period, holding_name, revenue_stream, service_country, SUM({exact("value_lc")}) AS value, count(*) AS n
  FROM {{{source}}} GROUP BY ALL"""


SQL["cube_against_buildup"] = iso(f"""
SELECT CASE WHEN a.n IS NULL THEN b.period ELSE a.period END AS period, CASE WHEN a.n IS NULL THEN b.holding_name ELSE a.holding_name END AS holding_name,
  CASE WHEN a.n IS NULL THEN b.revenue_stream ELSE a.revenue_stream END AS revenue_stream,
  CASE WHEN a.n IS NULL THEN b.service_country ELSE a.service_country END AS service_country, reason,
  CAST(a.value AS DOUBLE) AS value_left, CAST(b.value AS DOUBLE) AS value_right, CAST(coalesce(a.value, 0) - coalesce(b.value, 0) AS DOUBLE) AS value_difference,
  coalesce(a.n, 0) - coalesce(b.n, 0) AS rows_difference
FROM (
  SELECT a, b, CASE WHEN b.n IS NULL THEN 'only left' WHEN a.n IS NULL THEN 'only right'
    WHEN (a.value IS NULL) <> (b.value IS NULL) OR abs(a.value - b.value) > 0.01 THEN 'value' WHEN a.n <> b.n THEN 'rows' END AS reason
  FROM ({_by_holding("revenue_cube", month("full_date"))}) a FULL JOIN ({_by_holding("buildup_with_product", "full_date")}) b
    ON a.period IS NOT DISTINCT FROM b.period AND a.holding_name IS NOT DISTINCT FROM b.holding_name
    AND a.revenue_stream IS NOT DISTINCT FROM b.revenue_stream AND a.service_country IS NOT DISTINCT FROM b.service_country)
WHERE reason IS NOT NULL""", "period")


def oracle_sql() -> dict[str, str]:
    """Query name to one self-contained statement over the given tables."""
    out = {}
    for name, sql in SQL.items():
        target = f"result_{name}"
        clause = with_clause([target], {**BLOCKS, target: sql})
        out[name] = f"{clause}\nSELECT * FROM {target}"
    return out
