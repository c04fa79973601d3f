"""Business rules held as data.

Values under "fixed values" are codes and labels that results depend on. Names of companies,
vendors, people and house brands are never built in: they are fields of the rule classes below,
to be filled by the caller.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# --- fixed values: document types -----------------------------------------------------------------
ACTUAL_TYPES = ("Invoice", "Credit Note", "Bill")
PROVISIONAL_TYPES = ("Provision", "Provision write-off")
FREE_TYPE = "Free"
STATUS_PROVISIONAL = "Provisionado"
STATUS_ACTUAL = "Facturado"

# --- fixed values: revenue streams and product codes ----------------------------------------------
STREAM_EMPLOYEE = "EB"
STREAM_AFFINITY = "CB"
STREAM_FINANCIAL = "FS"
STREAM_OTHER = "Otro negocio"
BUILDUP_STREAMS = ("EB", "CB", "Otro negocio")
MAIN_PRODUCT = "S.C"
ADDON_PRODUCT = "S.C cargas"
MAIN_FAMILY = ("S.C", "S.C cargas")
DEFAULT_EMPLOYEE_PRODUCT = "EB-XX-1"

# --- fixed values: tax haircut and country names --------------------------------------------------
TAX_FACTORS = {"BRL": "0.88"}
COUNTRY_NAMES = {
    "CL": "Chile",
    "BR": "Brazil",
    "AR": "Argentina",
    "PE": "Peru",
    "CO": "Colombia",
    "MX": "Mexico",
    "ES": "España",
    "EC": "Ecuador",
}

# --- fixed values: segment patterns in account names, first match wins ------------------------------
SEGMENT_PATTERNS = (
    ("% SME%", "SMB"),
    ("% SMB%", "SMB"),
    ("%AFFINITY%", "Affinity"),
    ("%ENTERPRISE%", "Enterprise"),
    ("%BIG CORPS%", "Enterprise"),
)
NO_SEGMENT = "Sin holding"

# --- fixed values: expense control groups -----------------------------------------------------------
PAYROLL_ACCOUNTS = ("Payroll", "Outsourcing", "Professional Services", "Severance", "Benefits")
NON_PAYROLL_ACCOUNTS = (
    "Travels", "Digital Tools", "Events", "Paid Media", "Merchandising", "Rent", "Office Supplies",
    "Onboarding", "Retention", "Engagement", "Others", "Memberships", "Free Month",
)
CONTROL_EXCLUDED_ACCOUNTS = ("Non-Operational", "Uncollectible Accounts")

# --- fixed values: acquisition-cost sub-types, first match wins --------------------------------------
# Each rule: label, account names, departments (None = any department).
COST_SUBTYPE_RULES = (
    ("demand", ("Paid Media", "Merchandising", "Others", "Memberships", "Referral Incentives"), None),
    ("demand", ("Event", "Events", "Others"), ("Marketing",)),
    ("conversion",
     ("Incentives", "Free Month", "Free trial", "Free Trial", "Merchandising", "Others"), None),
    ("conversion", ("Event", "Events", "Others"), ("Sales",)),
    ("conversion", ("Travels",), ("Sales",)),
    ("payroll", ("Payroll",), ("Marketing", "Sales")),
    ("payroll", ("Severance", "Benefits"), None),
    ("non_payroll", ("Digital Tools", "Memberships", "Training", "Professional Services"), None),
    ("non_payroll", ("Travels",), ("RevOps", "Marketing")),
    ("non_payroll", ("Event", "Events"), ("RevOps",)),
)
INITIATIVE_SUBTYPES = ("demand", "conversion")
MANAGEMENT_SPLIT_ACCOUNTS = ("Events", "Merchandising", "Free Month", "Paid Media")
FINANCIAL_SPLIT_ACCOUNTS = ("Payroll", "Others", "Memberships")

# --- fixed values: head-office weights (origin, destination, weight) ---------------------------------
HEAD_OFFICE = "HQ"
HEAD_OFFICE_WEIGHTS = (
    ("HQ", "CL", 0.3333),
    ("HQ", "MX", 0.3333),
    ("HQ", "ES", 0.3333),
    ("CL", "CL", 1.0),
    ("MX", "MX", 1.0),
    ("ES", "ES", 1.0),
    ("AR", "AR", 1.0),
    ("BR", "BR", 1.0),
    ("EC", "EC", 1.0),
    ("CO", "CO", 1.0),
    ("PE", "PE", 1.0),
)
MONTHLY_TEMPLATE_COUNTRIES = ("CL", "MX", "ES")
MONTHLY_TEMPLATE_AMOUNT = 350.0

# --- fixed values: deal sizes and stages ------------------------------------------------------------
DEAL_BUSINESS_UNITS = {
    "micro": "SMB",
    "sme": "SMB",
    "corporate": "Enterprise",
    "enterprise": "Enterprise",
    "big enterprise": "Enterprise",
}
DEAL_SEGMENTS = {
    "micro": "Micro",
    "sme": "SME",
    "corporate": "Corporate",
    "enterprise": "Enterprise",
    "big enterprise": "Enterprise",
}
WON_STAGE = "Cierres ganados"
WON_STAGE_ES = "Closed Won - 100%"
WON_PIPELINES = ("pipeline de ventas", "pipeline enterprise")
TEST_NAME_PATTERNS = ("%test%", "%prueba%", "%wallet%")
EXCLUDED_DEVELOPMENT = ("%piloto%", "%reactivate%", "%retention%")
EXCLUDED_DEVELOPMENT_ES = ("%piloto%", "%ong%", "%reactivate%", "%retention%")
DEMO_CLIENT_REGEX = "(demo|prueba|trial|test)"

# --- fixed values: P&L line maps --------------------------------------------------------------------
COST_STREAMS = {"Employee Benefit": "EB", "Employee Benefits": "EB", "Affinity": "CB"}
COST_SEGMENTS = {"SMB": "SME"}
BOOKED_PRODUCTS = {
    "Wellbeing": "Wellbeing",
    "Seguros de salud": "Health",
    "Trae tu seguro": "Wellbeing",
}
BOOKED_COUNTRIES = {"Chile": "CL", "Mexico": "MX"}
ENGAGEMENT_STREAMS = {"employee_engagement": "EB", "customer_engagement": "CB"}
ENGAGEMENT_COUNTRIES = ("CL", "MX", "ES")
SGA_EXCLUDED_ACCOUNTS = ("Non-Operational", "Depreciation", "Severance", "Uncollectible Accounts")
COGS_EXCLUDED_ACCOUNT = "COGS: Rebate"
VACATION_ACCOUNT = "Vacaciones al Personal"

# --- fixed values: rewards transaction ids ------------------------------------------------------------
ORDER_ID_REGEX = r"OP\d+"
LOAD_COUNTRY_ID_REGEX = r"[MX|CO|CL|COP|PE]-\d+"
REDEEM_COUNTRY_ID_REGEX = r"[MX|COP|CL|PE]-\d+"
LOCAL_ORDER_MARKERS = ("OP2", "CL-")
HOME_COUNTRY = "CL"
OTHER_COUNTRY = "OTRO"
HOME_ZONE = "America/Santiago"


@dataclass(frozen=True)
class RevenueRules:
    """House-specific choices of the revenue plans."""

    excluded_streams: tuple[str, ...] = ()
    cube_excluded_streams: tuple[str, ...] = ()
    cube_excluded_country: str = "ES"
    entity_prefix: str = "Entity"
    history_entity_prefix: str = "Entity"
    related_patterns: tuple[str, ...] = ()
    financial_entity: str = ""
    qa_exceptions: tuple[str, ...] = ()
    rewards_lines: tuple[tuple[str, str], ...] = ()  # (source label, account id)


@dataclass(frozen=True)
class ExpenseRules:
    """House-specific choices of the expense and allocation plans."""

    outsourcing_vendors: tuple[str, ...] = ()
    external_payroll_vendors: tuple[str, ...] = ()
    all_hands_pattern: str = "%ALLHANDS%"
    rewards_source_pattern: str = "%REWARDS%"
    excluded_details: tuple[str, ...] = ()
    service_vendors: tuple[str, ...] = ()
    management_vendors: tuple[str, ...] = ()
    always_management_vendors: tuple[str, ...] = ()
    tool_vendors: tuple[str, ...] = ()
    template_vendor: str = "Design"
    scaled_vendor: str = ""
    scaled_factor: float = 0.7


@dataclass(frozen=True)
class DealRules:
    """House-specific choices of the deal plans."""

    excluded_modules: tuple[str, ...] = ("gift cards", "poliza de seguro")
    excluded_partner_pattern: str = ""
    es_pipeline_pattern: str = "%"
    own_company_patterns: tuple[str, ...] = ("% TEST %",)
    es_excluded_modules: tuple[str, ...] = ("Gift Cards",)
    es_excluded_module_pattern: str = "%Gift Cards%"


@dataclass(frozen=True)
class RewardsRules:
    """House-specific choices of the rewards ledgers."""

    internal_prefix: str = ""
    internal_names: tuple[str, ...] = ()
    home_country: str = HOME_COUNTRY
    home_zone: str = HOME_ZONE
    portal_channel: str = "b2b-wallet-platform"


@dataclass(frozen=True)
class Rules:
    """All house-specific rules, one object handed to every plan."""

    revenue: RevenueRules = field(default_factory=RevenueRules)
    expense: ExpenseRules = field(default_factory=ExpenseRules)
    deal: DealRules = field(default_factory=DealRules)
    rewards: RewardsRules = field(default_factory=RewardsRules)


DateLike = dt.date | None
