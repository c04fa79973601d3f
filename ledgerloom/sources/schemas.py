"""Input contract: name, column and type of every table the plans read."""

from __future__ import annotations

from pyspark.sql import types as T

_LEDGER = (
    "document_number string, document_date date, legal_client_id string, legal_client_name string, "
    "invoice_description string, document_type string, canceled_document string, "
    "revenue_stream string, quantity_charged double, value_lc double, local_currency string, "
    "service_date date, legal_entity_country string, sponsor string, product string"
)

_REVENUE_CUBE = (
    "document_number string, tax_id_client string, client_legal_name string, "
    "invoice_description string, document_type string, revenue_stream string, type string, "
    "quantity_charged double, value_lc double, local_currency string, full_date date, "
    "version string, arpu double, client_segment string, holding_id string, holding_name string, "
    "sponsor string, holding_cohort date, service_country string, legal_entity_country string, "
    "legal_entity_name string, sales_channel string, product string, fx_value_bdg double, "
    "value_usd_bdg double, source string, month long, year long, document_status string"
)

_EXPENSE_COMMON = (
    "project_id string, project_name string, transaction_detail string, "
    "legal_entity_country string, legal_entity_name string, business_partner_id string, "
    "business_partner_name string, currency string, value_lc double, value_fx_accounting double, "
    "value_usd_accounting double, version string, subversion string, payment_date date, "
    "source string"
)

_TABLES = {
    # revenue
    "ledger_current": _LEDGER + ", contract_plan_id string",
    "ledger_history": _LEDGER,
    "ledger_history_old": _LEDGER,
    "ledger_corrections": _LEDGER + ", contract_plan_id string",
    "holdings": (
        "tax_id_client string, holding_name string, revenue_stream string, service_country string, "
        "client_segment string, business_unit string, holding_cohort date"
    ),
    "fx_budget": "Year string, Currency string, Value double",
    "cube_other_country": _REVENUE_CUBE,
    "cube_non_subscription": _REVENUE_CUBE,
    "cube_rewards": _REVENUE_CUBE,
    "revenue_cube": _REVENUE_CUBE + ", contract_plan_id string",
    "history_non_subscription": (
        "document_number string, legal_client_id string, legal_client_name string, "
        "invoice_description string, document_type string, revenue_stream string, "
        "quantity_charged double, value_lc double, local_currency string, service_date date, "
        "legal_entity_country string"
    ),
    # expenses and allocation
    "expenses_base_a": (
        "expense_id string, transaction_id string, document_id string, full_date date, "
        "accounting_account_id string, accounting_account_name string, "
        "accounting_cost_center_dim1_id string, accounting_cost_center_dim1_name string, "
        "accounting_cost_center_dim2_id string, accounting_cost_center_dim2_name string, "
        + _EXPENSE_COMMON
    ),
    "expenses_base_b": (
        "expense_id string, transaction_id string, document_id string, full_date date, "
        "accounting_account_id string, accounting_account_name string, "
        "accounting_department_id string, accounting_department_name string, "
        "accounting_country_id string, accounting_country_name string, product_id string, "
        "product_name string, segment_name string, "
        + _EXPENSE_COMMON.replace("project_id string, project_name string, ", "")
    ),
    "accounts_a": (
        "accounting_account_id string, legal_entity_name string, management_account_id string, "
        "management_account_name string, management_account_classification string, "
        "management_account_subclassification string"
    ),
    "accounts_b": (
        "accounting_account_id string, management_account_name string, "
        "management_account_classification string, management_account_subclassification string"
    ),
    "cost_centers": (
        "accounting_cost_center_dim1_name string, legal_entity_name string, "
        "management_department string, holding_segment string, sales_channel string, "
        "revenue_stream string"
    ),
    "areas_b": (
        "accounting_department_name string, management_department string, sales_channel string, "
        "revenue_stream string"
    ),
    "cost_country": "accounting_cost_center_dim2_name string, service_country string",
    "departments": "management_department string, department_classification string",
    "business_units": (
        "sales_channel string, management_department string, revenue_stream string, "
        "holding_segment string, service_country string, business_unit string"
    ),
    "expense_cube": (
        "expense_id string, transaction_id string, document_id string, full_date date, "
        "accounting_account_id string, accounting_account_name string, "
        "management_account_id string, management_account_name string, "
        "mgmt_account_classification string, mgmt_account_subclasification string, "
        "accounting_cost_center_dim1_id string, accounting_cost_center_dim1_name string, "
        "accounting_cost_center_dim2_id string, accounting_cost_center_dim2_name string, "
        "management_department string, department_classification string, project_id string, "
        "project_name string, transaction_detail string, service_country string, "
        "legal_entity_country string, legal_entity_name string, holding_segment string, "
        "sales_channel string, revenue_stream string, business_partner_id string, "
        "business_partner_name string, currency string, value_lc double, "
        "value_fx_accounting double, value_usd_accounting double, value_fx_bdg double, "
        "value_usd_bdg double, version string, subversion string, payment_date date, "
        "source string, business_unit string, month long, year long"
    ),
    "weights_v3": (
        "o_holding_segment string, holding_segment string, year long, month long, parametro double"
    ),
    "weights_old": (
        "o_revenue_stream string, o_holding_segment string, o_service_country string, "
        "revenue_stream string, holding_segment string, service_country string, parametro double"
    ),
    "tags": "aux string, tag_cac string",
    "payroll_external": (
        "year long, month long, o_service_country string, f_service_country string, "
        "management_department string, management_account_name string, "
        "business_partner_name string, original_value double, value_usd_distr double"
    ),
    # acquisition and engagement
    "deal_versions": (
        "deal_id string, company_id string, deal_name string, deal_stage string, "
        "deal_pipeline string, deal_country string, company_size string, product_modules string, "
        "development_type string, value_proposition string, partnership_demand_name string, "
        "number_of_employees long, closed_amount double, closed_date date, created_date date, "
        "last_modified_date timestamp"
    ),
    "deals": (
        "deal_id string, company_id string, company_name string, deal_country string, "
        "deal_size string, deal_stage string, product_modules string, development_type_use string, "
        "close_date date, activation_date date, amount_in_company_currency double"
    ),
    "companies": "company_id string, company_legal_id string, company_name string",
    "meetings": "deal_id string, meeting_date date, meeting_outcome string, activity_type string",
    "client_metrics": (
        "date_start date, client_name string, client_country_code string, business_type string, "
        "client_size string, onboarding_users long, total_users long, total_user_mau long"
    ),
    "mau_eb": "date_start_month date, company_id string, members_onboard long, mau long",
    "mau_cb": "date_start_month date, company_id string, members_onboard long, mau long",
    "mau_clients": (
        "date_start_month date, client_id string, business_type string, members_onboard long, mau long"
    ),
    "client_companies": "company_id string, company_tax_id string",
    "clients": "client_id string, client_tax_id string",
    "activities": "data_person_id string, val_minutes double, calories double, date_start date",
    "calendar": "full_date date",
    # rewards
    "loads": (
        "document_id string, transactionId string, companyId string, createdAt timestamp, "
        "giftCards_member string"
    ),
    "orders_bo": (
        "document_id string, label string, companyId string, countryId string, status string, "
        "paymentMethod string, channel string, totalamount double, createdAt timestamp, "
        "products_member string"
    ),
    "balance_tx": "depositorderid string, withdraworders_member string",
    "companies_bo": "document_id string, nationalId string, countryId string, legalName string",
    "companies_app": "document_id string, name string",
    "invoices": "orderId string, invoiceNumber string, amount double",
    "products": "document_id string",
    "client": "id string, document_value string, company_name string",
    "user_giftcards": (
        "document_id string, userId string, giftCardId string, code string, status string, "
        "userGiftCardRedeemRequestId string, amount double, createdAt timestamp, voidedAt timestamp, "
        "contributions_index long, contributions_member string"
    ),
    "bonuses": (
        "document_id string, giftCardsLoadId string, userId string, nationality string, "
        "nationalId string, email string, status string, amount double, allowedGiftCardIds boolean, "
        "createdAt timestamp, voidedat timestamp"
    ),
    "users": "document_id string, nationalId string, nationality string",
}

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from 'name type, name type'; needs no running session."""
    pairs = [part.split() for part in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {name: _struct(columns) for name, columns in _TABLES.items()}
REVENUE_CUBE_COLUMNS = SCHEMAS["revenue_cube"].fieldNames()
EXPENSE_CUBE_COLUMNS = SCHEMAS["expense_cube"].fieldNames()
PNL_SCHEMA = _struct(
    "period date, country string, segment string, revenue_stream string, pnl_line string, "
    "department string, amount_local double, amount_usd double"
)
