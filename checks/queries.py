"""Every plan and operator run on the given tables, one named query each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.views import VIEWS, load_views
from ledgerloom import apply_scale_settings
from ledgerloom import rules as R
from ledgerloom.functions import business as B
from ledgerloom.functions import scalars as S
from ledgerloom.operators import allocate as A
from ledgerloom.operators import classify as C
from ledgerloom.operators import lookup as L
from ledgerloom.operators import reconcile as RC
from ledgerloom.operators import series as TS
from ledgerloom.operators.fx import fx_convert
from ledgerloom.operators.control import ControlTotals
from ledgerloom.operators.difference import differences
from ledgerloom.operators.patterns import label_by_patterns
from ledgerloom.operators.running import RunningTotals
from ledgerloom.plans import acquisition, engagement, expenses, pnl, revenue, rewards
from ledgerloom.sources import ordered, shapes, shredded
from ledgerloom.sources.asof import AsOf
from ledgerloom.sources.colocated import Colocated, join_colocated, write_colocated
from ledgerloom.sources.cubes import read_cube, write_cube
from ledgerloom.sources.incremental import StoredCube
from ledgerloom.sources.schemas import SCHEMAS
from ledgerloom.sources.shared import new_path, stored
from ledgerloom.sources.warehouse import conform

RULES = R.Rules(
    revenue=R.RevenueRules(
        excluded_streams=("Staff",),
        cube_excluded_streams=("Covid",),
        entity_prefix="House",
        history_entity_prefix="House",
        related_patterns=("%00000001%", "%ALLHANDS%"),
        financial_entity="Financial House",
        qa_exceptions=("Group 4", "Group 10"),
        rewards_lines=(("Close CO", "A18"), ("Close MX", "A43")),
    ),
    expense=R.ExpenseRules(
        outsourcing_vendors=("Supplier#000000001", "Supplier#000000002", "Supplier#000000003"),
        external_payroll_vendors=("Supplier#000000004", "Supplier#000000005"),
        excluded_details=("Reversed entry",),
        service_vendors=("Supplier#000000006", "Supplier#000000007"),
        management_vendors=("Supplier#000000008", "Supplier#000000009", "SMB"),
        always_management_vendors=("Supplier#000000010",),
        tool_vendors=("Supplier#000000008", "Supplier#000000011"),
        template_vendor="Studio",
        scaled_vendor="Supplier#000000012",
    ),
    deal=R.DealRules(
        excluded_partner_pattern="%agency one%",
        es_pipeline_pattern="%iberia%",
        own_company_patterns=("%HOUSE%", "% TEST %"),
        es_excluded_modules=("Platform build", "Gift Cards"),
    ),
    rewards=R.RewardsRules(internal_prefix="acme", internal_names=("points house",)),
)

# Dates that fit the given tables.
EXPENSE_DATES = (dt.date(1995, 1, 1), dt.date(2002, 1, 1))
MIN_YEAR = 1997
LATER_MIN_YEAR = 1998
SINCE = dt.date(1997, 1, 1)
AS_OF = dt.date(2001, 6, 15)
REWARDS_SINCE = dt.date(2024, 1, 1)
REWARDS_AS_OF = dt.date(2024, 3, 1)
CUTOVER = dt.date(2000, 8, 1)


class ViewTables(Mapping):
    """The plans' input tables: views over the given tables, and cubes computed by other plans."""

    def __init__(self, spark: SparkSession, sf_dir: str, views: Mapping[str, DataFrame] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.view = load_views(spark, sf_dir, views)
        self._built: dict[str, DataFrame] = {}

    def _build(self, name: str) -> DataFrame:
        if name == "expense_cube":
            return expenses.expense_cube(self, "a", EXPENSE_DATES)
        if name == "cube_rewards":
            return rewards_revenue(self)
        if name == "revenue_cube":
            return revenue.revenue_cube(self, RULES)
        if name == "buildup_cube":
            return revenue.buildup(self, RULES, "with_product")
        df = self.view(name)
        return conform(df, SCHEMAS[name]) if name in SCHEMAS else df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def rewards_revenue(t: Mapping[str, DataFrame]) -> DataFrame:
    lines = [revenue.rewards_lines(t, source, account) for source, account in RULES.revenue.rewards_lines]
    return shapes.union_all(lines)


def portable(df: DataFrame) -> DataFrame:
    """Types two engines print alike: dates and times as text, exact amounts as doubles."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        columns.append(c.alias(field.name))
    return df.select(*columns)


Plan = Callable[[ViewTables], DataFrame]
_PLANS: dict[str, Plan] = {}


def query(plan: Plan) -> Plan:
    _PLANS[plan.__name__] = plan
    return plan


# ---- revenue ---------------------------------------------------------------------------------------


@query
def reconciled_monthly_revenue(t: ViewTables) -> DataFrame:
    return revenue.monthly_revenue_usd(t, RULES)


@query
def union_sources(t: ViewTables) -> DataFrame:
    columns = ["document_number", "legal_client_id", "document_type", "revenue_stream", "value_lc",
               "service_date", "product", "contract_plan_id"]
    return revenue.merged_ledger(t, columns, revenue.ALL_LEDGERS)


@query
def union_sources_main_family(t: ViewTables) -> DataFrame:
    columns = ["document_number", "revenue_stream", "value_lc", "product"]
    family = F.col("product").isin(*R.MAIN_FAMILY)
    return revenue.merged_ledger(t, columns, revenue.RECENT_LEDGERS, family)


@query
def dim_distinct(t: ViewTables) -> DataFrame:
    return revenue.holding_dim(t, ("holding_name", "service_country", "client_segment"))


@query
def enrich_normalized_key(t: ViewTables) -> DataFrame:
    lines = t["ledger_current"].select("document_number", "legal_client_id", "revenue_stream", "legal_entity_country")
    return L.lookup(lines, t["holdings"], revenue.HOLDING_KEYS, ["holding_name", "client_segment", "holding_cohort"])


@query
def tax_factor(t: ViewTables) -> DataFrame:
    net = B.net_of_tax(S.money("value_lc"), "local_currency").alias("net_lc")
    return t["ledger_current"].select("document_number", "local_currency", "value_lc", net)


@query
def fx_rates(t: ViewTables) -> DataFrame:
    lines = t["ledger_history"].select("document_number", "service_date", "local_currency", "value_lc")
    return fx_convert(lines, t["fx_budget"], "value_lc", "service_date", "local_currency")


@query
def arpu_gross_and_net(t: ViewTables) -> DataFrame:
    net = B.net_of_tax(S.money("value_lc"), "local_currency")
    return t["ledger_corrections"].unionByName(t["ledger_current"]).select(
        "document_number", B.arpu("value_lc", "quantity_charged").alias("arpu_gross"),
        B.arpu(net, "quantity_charged").alias("arpu_net"),
    )


def _enriched(t: ViewTables) -> DataFrame:
    lines = t["ledger_current"].filter(F.col("document_type") != R.FREE_TYPE).select(
        "document_number", "legal_client_id", "document_type", "revenue_stream", "legal_entity_country",
        "service_date",
    )
    return L.lookup(lines, t["holdings"], revenue.HOLDING_KEYS, ["holding_name"])


@query
def reconcile_by_holding(t: ViewTables) -> DataFrame:
    kept = RC.reconcile(_enriched(t), ["holding_name", "service_date", "revenue_stream"])
    return kept.withColumn("document_status", B.document_status("document_binary"))


@query
def reconcile_by_holding_country(t: ViewTables) -> DataFrame:
    keys = ["holding_name", "service_date", "revenue_stream", "legal_entity_country"]
    kept = RC.reconcile(_enriched(t), keys)
    return kept.withColumn("document_status", B.document_status("document_binary"))


@query
def group_flag(t: ViewTables) -> DataFrame:
    keys = ["holding_name", "service_date", "revenue_stream"]
    flag = F.max(B.document_class("document_type"))
    return L.group_value(_enriched(t), keys, {"document_binary": flag}).select("document_number", "document_binary")


@query
def code_map(t: ViewTables) -> DataFrame:
    code = "legal_entity_country"
    return t["ledger_current"].select(
        "document_number", code, B.country_name(code).alias("country_name"),
        B.entity_name(code, "House").alias("entity_name"),
    )


@query
def product_bucket(t: ViewTables) -> DataFrame:
    variants = ("merged", "split", "explicit")
    return t["ledger_current"].select(
        "document_number", *[B.product_bucket("revenue_stream", "product", v).alias(f"product_{v}") for v in variants]
    )


@query
def addon_zero_quantity(t: ViewTables) -> DataFrame:
    return t["ledger_current"].select(
        "document_number", "product", B.zero_quantity_for("quantity_charged", "product").alias("quantity")
    )


def _months(t: ViewTables, variant: str = "with_product") -> DataFrame:
    return revenue.reconciled_months(t, RULES, revenue.BUILDUPS[variant])


@query
def monthly_rollup(t: ViewTables) -> DataFrame:
    return _months(t, "no_product").drop("convertible", "usd_given")


@query
def gap_fill(t: ViewTables) -> DataFrame:
    months = _months(t).drop("convertible", "usd_given")
    grain = [c for c in months.columns if c not in ("full_date", "value_lc", "quantity")]
    return TS.gap_fill(months, "full_date", grain, ["value_lc", "quantity"])


@query
def revenue_base(t: ViewTables) -> DataFrame:
    v = revenue.BUILDUPS["with_product"]
    return revenue.revenue_base(t, revenue.reconciled_months(t, RULES, v), v)


@query
def cohort_from_first(t: ViewTables) -> DataFrame:
    v = revenue.BUILDUPS["main_family"]
    base = revenue.revenue_base(t, revenue.reconciled_months(t, RULES, v), v)
    return base.select("holding_name", "full_date", "holding_cohort", "invoice_number").distinct()


@query
def months_since_cohort(t: ViewTables) -> DataFrame:
    lines = t["ledger_current"].select("document_number", "legal_client_id", "revenue_stream",
                                       "legal_entity_country", "document_date")
    dated = L.lookup(lines, t["holdings"], revenue.HOLDING_KEYS, ["holding_cohort"])
    return dated.select("document_number", S.months_since("document_date", "holding_cohort").alias("invoice_number"))


@query
def period_context(t: ViewTables) -> DataFrame:
    v = revenue.BUILDUPS["no_product"]
    base = revenue.revenue_base(t, revenue.reconciled_months(t, RULES, v), v)
    return revenue.with_context(base, v)


def _buildup_part(t: ViewTables, variant: str, *prefixes: str) -> DataFrame:
    df = revenue.buildup(t, RULES, variant)
    keys = [c for c in ("full_date", "service_country", "revenue_stream", "holding_name", "sponsor", "product",
                        "holding_cohort", "client_segment", "local_currency", "invoice_number") if c in df.columns]
    return df.select(*keys, *[c for c in df.columns if c.startswith(prefixes)])


@query
def movement_members(t: ViewTables) -> DataFrame:
    return _buildup_part(t, "no_product", "members")


@query
def movement_value(t: ViewTables) -> DataFrame:
    return _buildup_part(t, "no_product", "value_")


@query
def movement_logos(t: ViewTables) -> DataFrame:
    return _buildup_part(t, "other_products", "logo_")


@query
def linked_churn(t: ViewTables) -> DataFrame:
    return _buildup_part(t, "main_family", "members_churn", "value_lc_churn", "value_usd_churn", "logo_churn")


@query
def buildup_with_product(t: ViewTables) -> DataFrame:
    return revenue.buildup(t, RULES, "with_product")


@query
def buildup_no_product(t: ViewTables) -> DataFrame:
    return revenue.buildup(t, RULES, "no_product")


@query
def buildup_other_products(t: ViewTables) -> DataFrame:
    return revenue.buildup(t, RULES, "other_products")


@query
def buildup_main_family(t: ViewTables) -> DataFrame:
    return revenue.buildup(t, RULES, "main_family")


@query
def revenue_cube(t: ViewTables) -> DataFrame:
    return t["revenue_cube"]


@query
def revenue_lines(t: ViewTables) -> DataFrame:
    return revenue.revenue_lines(t, RULES)


@query
def revenue_schema(t: ViewTables) -> DataFrame:
    return rewards_revenue(t)


@query
def related_party_exclusion(t: ViewTables) -> DataFrame:
    return revenue.financial_entity_lines(t, RULES)


@query
def non_subscription_history(t: ViewTables) -> DataFrame:
    return revenue.history_lines(t, RULES)


@query
def client_revenue_share(t: ViewTables) -> DataFrame:
    return revenue.client_revenue(t, RULES, SINCE)


@query
def share_of_total(t: ViewTables) -> DataFrame:
    weighted = t["orders_bo"].groupBy("countryId", "companyId").agg(F.sum(S.money("totalamount")).alias("amount"))
    return L.share_of_total(weighted, ["countryId"], "amount", "share")


@query
def qa_running_flag(t: ViewTables) -> DataFrame:
    return revenue.mixed_product_check(t, RULES, SINCE)


@query
def running_flag(t: ViewTables) -> DataFrame:
    rows = _enriched(t).select("holding_name", "legal_client_id", "document_type").distinct()
    hit = F.col("document_type") == "Bill"
    return L.running_flag(rows, ["holding_name"], "legal_client_id", hit, "seen")


@query
def product_cohort(t: ViewTables) -> DataFrame:
    return revenue.product_cohort(t)


@query
def new_activations(t: ViewTables) -> DataFrame:
    return revenue.new_activations(t, SINCE)


# ---- expenses and allocation -------------------------------------------------------------------------


@query
def expense_cube_a(t: ViewTables) -> DataFrame:
    return expenses.expense_cube(t, "a", EXPENSE_DATES)


@query
def expense_cube_b(t: ViewTables) -> DataFrame:
    return expenses.expense_cube(t, "b", (dt.date(1996, 2, 1), dt.date(2000, 2, 1)))


@query
def segment_from_name(t: ViewTables) -> DataFrame:
    segment = expenses.segment_from_name("accounting_account_name", F.lit(R.NO_SEGMENT))
    return t["expenses_base_a"].select("expense_id", "accounting_account_name", segment.alias("segment"))


@query
def expense_control(t: ViewTables) -> DataFrame:
    return expenses.expense_control(t, RULES, MIN_YEAR)


@query
def allocate_weights(t: ViewTables) -> DataFrame:
    return expenses.acquisition_cost(t, MIN_YEAR)


@query
def allocate_reassign(t: ViewTables) -> DataFrame:
    return expenses.acquisition_cost_by_attribution(t)


@query
def attribution_category(t: ViewTables) -> DataFrame:
    keys = ["revenue_stream", "holding_segment", "service_country"]
    summed = t["expense_cube"].groupBy(*keys).agg(F.count(F.lit(1)).alias("expense_lines"))
    return summed.withColumn("category", C.attribution_category()).withColumn("label", C.attribution_label("category"))


@query
def tag_lookup(t: ViewTables) -> DataFrame:
    keyed = t["expense_cube"].groupBy("management_department").agg(F.count(F.lit(1)).alias("expense_lines")).withColumn(
        "aux", F.concat("management_department", F.lit("-payroll-Local"))
    )
    return expenses.tag_lookup(keyed, t["tags"])


@query
def classify_cost(t: ViewTables) -> DataFrame:
    keys = ["management_account_name", "management_department"]
    summed = t["expense_cube"].groupBy(*keys).agg(F.count(F.lit(1)).alias("expense_lines"))
    return summed.withColumn("sub_type", C.classify(R.COST_SUBTYPE_RULES)).withColumn("type", C.cost_type())


@query
def split_head_office(t: ViewTables) -> DataFrame:
    keys = ["year", "month", "service_country"]
    summed = t["expense_cube"].groupBy(*keys).agg(F.sum(S.money("value_lc")).cast("double").alias("original_value"))
    return expenses.split_head_office(summed.withColumnRenamed("service_country", "o_service_country"))


@query
def monthly_template(t: ViewTables) -> DataFrame:
    months = t["payroll_external"].select("year", "month").distinct()
    return A.cross_templates(months, [{"country": c, "amount": 350.0} for c in R.MONTHLY_TEMPLATE_COUNTRIES])


@query
def vendor_scale(t: ViewTables) -> DataFrame:
    totals = t["expenses_base_a"].groupBy("business_partner_name").agg(
        F.sum(S.money("value_lc")).cast("double").alias("total")
    )
    scaled = A.scale_for("business_partner_name", RULES.expense.scaled_vendor, "total", 0.7)
    return totals.withColumn("scaled", scaled)


@query
def management_cost(t: ViewTables) -> DataFrame:
    return expenses.management_cost(t, RULES, MIN_YEAR)


@query
def cutover_union(t: ViewTables) -> DataFrame:
    return expenses.financial_cost(t, RULES, MIN_YEAR, CUTOVER)


# ---- deals -------------------------------------------------------------------------------------------


@query
def won_deals(t: ViewTables) -> DataFrame:
    return acquisition.won_deals(t["deal_versions"], RULES, SINCE).select(
        "deal_id", "company_id", "deal_name", "closed_date", "last_modified_date",
        acquisition.business_unit().alias("bu"),
    )


@query
def latest_version(t: ViewTables) -> DataFrame:
    return L.latest_by(t["deal_versions"], "deal_id", "last_modified_date").select(
        "deal_id", "last_modified_date", "deal_stage", "number_of_employees"
    )


@query
def won_deals_latest(t: ViewTables) -> DataFrame:
    return acquisition.won_deals_es(t["deal_versions"], RULES, SINCE, AS_OF).select(
        "deal_id", "company_id", "closed_date", "last_modified_date", "number_of_employees"
    )


@query
def first_time_company(t: ViewTables) -> DataFrame:
    return acquisition.booked_logos(t, RULES, SINCE, AS_OF)


@query
def booked_members(t: ViewTables) -> DataFrame:
    return acquisition.booked_members(t, RULES, SINCE, AS_OF)


@query
def meetings_by_month(t: ViewTables) -> DataFrame:
    return acquisition.meetings_by_month(t)


@query
def booked_mrr(t: ViewTables) -> DataFrame:
    return acquisition.booked_mrr(t, RULES, SINCE)


# ---- engagement --------------------------------------------------------------------------------------


@query
def calendar_months(t: ViewTables) -> DataFrame:
    return shapes.calendar_months(t["calendar"], SINCE, AS_OF)


@query
def month_spine(t: ViewTables) -> DataFrame:
    """Orders per month of a generated spine."""
    spine = shapes.month_spine(t.spark, dt.date(1996, 5, 1), AS_OF)
    monthly = t["orders_bo"].groupBy(S.month_start("createdAt").alias("m")).agg(F.count(F.lit(1)).alias("n_orders"))
    return L.lookup(spine, monthly, [L.Key("month", "m")], ["n_orders"])


@query
def engagement_rates(t: ViewTables) -> DataFrame:
    return engagement.engagement_rates(t, SINCE)


@query
def engagement_on_calendar(t: ViewTables) -> DataFrame:
    return engagement.engagement_on_calendar(t, SINCE, AS_OF)


@query
def engagement_by_segment(t: ViewTables) -> DataFrame:
    return engagement.engagement_by_segment(t)


@query
def cumulative_by_calendar(t: ViewTables) -> DataFrame:
    return engagement.cumulative_activity(t, dt.date(1996, 1, 1), AS_OF)


# ---- rewards -----------------------------------------------------------------------------------------


@query
def rewards_loaded(t: ViewTables) -> DataFrame:
    return rewards.loaded(t, RULES, REWARDS_SINCE, REWARDS_AS_OF)


@query
def rewards_orders(t: ViewTables) -> DataFrame:
    return rewards.orders(t, RULES, SINCE)


@query
def rewards_redeemed(t: ViewTables) -> DataFrame:
    return rewards.redeemed(t, RULES, REWARDS_SINCE, REWARDS_AS_OF)


@query
def rewards_voided(t: ViewTables) -> DataFrame:
    return rewards.voided(t, RULES, REWARDS_SINCE, REWARDS_AS_OF)


@query
def clean_order_id(t: ViewTables) -> DataFrame:
    c = "transactionId"
    return t["loads"].select(
        "document_id", c, S.clean_order_id(c).alias("order_id"), B.bonus_transaction_id(c).alias("bonus_id"),
        B.reloaded_flag(c).alias("reloaded"), S.before(c, ".").alias("head"),
    )


@query
def corrected_country(t: ViewTables) -> DataFrame:
    joined = L.lookup(
        t["loads"].select("document_id", "transactionId", S.before("transactionId", ".").alias("label")),
        t["orders_bo"], [L.Key("label", "label")], {"countryId": "order_country"},
    )
    return joined.select("document_id", B.corrected_country("order_country", "transactionId").alias("country"))


@query
def duplicate_keys(t: ViewTables) -> DataFrame:
    return L.duplicate_keys(t["holdings"], ["tax_id_client"])


@query
def json_members(t: ViewTables) -> DataFrame:
    c = "giftCards_member"
    return S.with_json(t["loads"], c).select(
        "document_id",
        *[S.json_value(c, f"$.{k}").alias(k) for k in ("nationalId", "email", "id", "allowedGiftCardIds")],
        S.json_value(c, "$.amount").try_cast("double").alias("amount"),
        S.text_to_long(S.json_value(c, "$.amount")).alias("amount_long"),
    )


@query
def zone_months(t: ViewTables) -> DataFrame:
    local = S.local_datetime("createdAt", R.HOME_ZONE)
    return t["loads"].select("document_id", local.alias("local_created"), S.year_month(local).alias("year_month"))


# ---- profit and loss -----------------------------------------------------------------------------------


@query
def pnl_costs(t: ViewTables) -> DataFrame:
    return pnl.cost_lines(t["expense_cube"], MIN_YEAR, LATER_MIN_YEAR)


@query
def pnl_stack(t: ViewTables) -> DataFrame:
    return pnl.buildup_lines(t["buildup_cube"], MIN_YEAR)


@query
def pnl_other_revenue(t: ViewTables) -> DataFrame:
    return pnl.other_revenue_lines(t["revenue_cube"], LATER_MIN_YEAR)


@query
def consolidated_pnl(t: ViewTables) -> DataFrame:
    """The P&L with its cubes computed on the way, each part stored before the next."""
    lines = _ledgers_stored(t)
    t = Replaced(lines, buildup_cube=revenue.buildup(lines, RULES, "with_product", store=_store(t)))
    return pnl.consolidated_pnl(t, RULES, MIN_YEAR, LATER_MIN_YEAR, SINCE, SINCE, _store(lines))


# ---- stored, ordered and incremental results -----------------------------------------------------------


def _store(t: ViewTables) -> Callable[[str, DataFrame], DataFrame]:
    return lambda name, df: stored(t.spark, name, df)


def _ledgers_stored(t: ViewTables) -> ViewTables:
    """The tables with the ledgers' lines joined and stored once. Otherwise each use of each ledger joins them anew."""
    lines = t.view("ledger_lines")
    return ViewTables(t.spark, t.sf_dir, {"ledger_lines": stored(t.spark, "ledger-lines", lines)})


class Replaced(Mapping):
    """The plans' tables with some of them replaced."""

    def __init__(self, t: Mapping[str, DataFrame], **frames: DataFrame):
        self._t, self._frames = t, frames

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name] if name in self._frames else self._t[name]

    def __iter__(self) -> Iterator[str]:
        return iter({*self._t, *self._frames})

    def __len__(self) -> int:
        return len({*self._t, *self._frames})


def _stored(t: ViewTables, name: str, df: DataFrame, partition: str = "year") -> DataFrame:
    """`df` written as a cube and read back under its declared schema."""
    path = new_path(t.spark, name)
    write_cube(df, path, [partition])
    return read_cube(t.spark, path, name if name in SCHEMAS else None).select(*df.columns)


@query
def revenue_cube_from_stored_rewards(t: ViewTables) -> DataFrame:
    """The rewards lines of both countries as a stored cube, which the revenue cube reads."""
    return revenue.revenue_cube(Replaced(t, cube_rewards=_stored(t, "cube_rewards", t["cube_rewards"])), RULES)


@query
def consolidated_pnl_from_stored_cubes(t: ViewTables) -> DataFrame:
    """Every cube written once, in the order in which they read each other, and the P&L from what is stored."""
    t = _ledgers_stored(t)
    stored = Replaced(t, expense_cube=_stored(t, "expense_cube", t["expense_cube"]))
    stored = Replaced(stored, cube_rewards=_stored(t, "cube_rewards", rewards_revenue(stored)))
    cubes = {
        "revenue_cube": revenue.revenue_cube(stored, RULES, _store(t)),
        "buildup_cube": revenue.buildup(stored, RULES, "with_product", store=_store(t)),
    }
    stored = Replaced(stored, **{name: _stored(t, name, df) for name, df in cubes.items()})
    return pnl.consolidated_pnl(stored, RULES, MIN_YEAR, LATER_MIN_YEAR, SINCE, SINCE)


@query
def ordered_revenue_cube(t: ViewTables) -> DataFrame:
    """Global places of the revenue cube's lines in their output order."""
    order = {"year": "asc", "month": "asc", "revenue_stream": "asc", "tax_id_client": "asc"}
    path = new_path(t.spark, "ordered-revenue")
    ordered.write_ordered(t["revenue_cube"], path, order)
    return ordered.read_ordered(t.spark, path, "place").select(*order, "place")


@query
def ordered_financial_cost(t: ViewTables) -> DataFrame:
    """The same with mixed directions: latest months first, then the smallest original cost."""
    order = {"year": "desc", "month": "desc", "original_value": "asc"}
    path = new_path(t.spark, "ordered-cost")
    ordered.write_ordered(expenses.financial_cost(t, RULES, MIN_YEAR, CUTOVER), path, order)
    return ordered.read_ordered(t.spark, path, "place").select(*order, "place")


def _ledger_sources(t: ViewTables) -> dict[str, DataFrame]:
    return {name: t[name] for name in revenue.ALL_LEDGERS}


def _by_month(sources: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, object]]:
    return {name: (df, S.year_month("service_date")) for name, df in sources.items()}


@query
def incremental_revenue_lines(t: ViewTables) -> DataFrame:
    """Revenue lines stored by month from a ledger with one month wrong, one missing and one too many, and brought up
    to date with the real ledger: only these months are recomputed."""
    t = _ledgers_stored(t)
    sources = _ledger_sources(t)
    current, period = sources["ledger_current"], F.trunc("service_date", "MONTH")
    wrong, missing = F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1997, 6, 1))
    early = current.where(period.isNull() | (period != missing)).withColumn(
        "value_lc", F.when(period == wrong, F.col("value_lc") * 2).otherwise(F.col("value_lc"))
    )
    extra = current.where(period == missing).withColumn("service_date", F.add_months("service_date", 1200).cast(current.schema["service_date"].dataType))
    early = early.unionByName(extra)

    def build(parts: Mapping[str, DataFrame]) -> DataFrame:
        lines = revenue.revenue_lines(Replaced(t, **parts), RULES, _store(t))
        return lines.withColumn("period", S.year_month("full_date").cast("long"))

    cube = StoredCube(t.spark, new_path(t.spark, "revenue-lines"))
    context = {"holdings": t["holdings"], "fx_budget": t["fx_budget"]}
    cube.refresh(_by_month({**sources, "ledger_current": early}), build, context)
    cube.refresh(_by_month(sources), build, context)
    return cube.read().drop("period")


def _written(t: ViewTables, name: str, df: DataFrame) -> DataFrame:
    return stored(t.spark, name, df)


def _document_changes(t: ViewTables) -> tuple[DataFrame, DataFrame]:
    """Stored documents and what changes them into the present ones, by the last digit of the document number: 0 comes
    late, 1 was stored as a provision, 2 has a second document that is withdrawn."""
    lines = _written(t, "lines", _enriched(t))
    number, kind = F.col("document_number"), F.col("document_type")
    digit = F.substring(number, -1, 1)
    old = lines.withColumn("document_type", F.when(digit == "1", "Provision").otherwise(kind))
    twin = lines.where(digit == "2").withColumns({"document_number": F.concat(number, F.lit("-x")), "document_type": F.lit("Invoice")})
    before = old.where(digit != "0").unionByName(twin)
    fixed = lines.where((digit == "1") & ~kind.eqNullSafe(F.lit("Provision")))
    signs = [
        (lines.where(digit == "0"), 1), (twin, -1), (fixed, 1), (fixed.withColumn("document_type", F.lit("Provision")), -1),
    ]
    changes = shapes.union_all([df.withColumn("change", F.lit(n)) for df, n in signs])
    return _written(t, "documents", before), _written(t, "changes", changes)


RECONCILE_KEYS = ("holding_name", "service_date", "revenue_stream")


@query
def reconcile_changed_documents(t: ViewTables) -> DataFrame:
    """A stored reconciled result after late, corrected and withdrawn documents: equal to the full plan."""
    before, changes = _document_changes(t)
    stored = _written(t, "reconciled", RC.reconcile(before, RECONCILE_KEYS))
    delta = _written(t, "delta", RC.reconcile_delta(before, changes, RECONCILE_KEYS))
    now = RC.apply_delta(stored, delta, RECONCILE_KEYS)
    return now.withColumn("document_status", B.document_status("document_binary"))


@query
def reconcile_delta(t: ViewTables) -> DataFrame:
    """The rows that these changes enter into the result and retract from it."""
    before, changes = _document_changes(t)
    return RC.reconcile_delta(before, changes, RECONCILE_KEYS)


@query
def cumulative_extended(t: ViewTables) -> DataFrame:
    """Running totals stored up to a year with one month loaded in part, extended by the years after it, and corrected
    by that month's whole rows."""
    start, cut, partial = dt.date(1996, 1, 1), F.lit(dt.date(1997, 1, 1)), F.lit(dt.date(1996, 5, 1))
    sessions, kpis = engagement.monthly_sessions(t, AS_OF), engagement.ACTIVITY_KPIS
    month = F.col("month_act")
    totals = RunningTotals(t.spark, new_path(t.spark, "activity-totals"), kpis)
    totals.extend(sessions.where((month < cut) & ((month != partial) | (F.col("minutes") > 40))), "month_act")
    totals.extend(sessions.where(month >= cut), "month_act")
    totals.extend(sessions.where(month == partial), "month_act")
    return engagement.activity_units(totals.by_calendar(shapes.calendar_months(t["calendar"], start, AS_OF)))


def _with_members(t: ViewTables, name: str) -> DataFrame:
    """A table stored with the members that the rewards ledgers use in columns of their own."""
    document, members = rewards.DOCUMENTS[name]
    return _written(t, name, shredded.shred(t[name], document, members.values()))


@query
def rewards_loaded_from_members(t: ViewTables) -> DataFrame:
    return rewards.loaded(Replaced(t, loads=_with_members(t, "loads")), RULES, REWARDS_SINCE, REWARDS_AS_OF)


@query
def rewards_orders_from_members(t: ViewTables) -> DataFrame:
    stored = Replaced(t, balance_tx=_with_members(t, "balance_tx"), orders_bo=_with_members(t, "orders_bo"))
    return rewards.orders(stored, RULES, SINCE)


@query
def rewards_redeemed_from_members(t: ViewTables) -> DataFrame:
    stored = Replaced(t, user_giftcards=_with_members(t, "user_giftcards"))
    return rewards.redeemed(stored, RULES, REWARDS_SINCE, REWARDS_AS_OF)


# ---- rule lists, control totals, differences -----------------------------------------------------------


@query
def large_rule_list(t: ViewTables) -> DataFrame:
    """Customers labelled by the first of as many patterns as there are parts: the last four digits of a part's number."""
    digits = F.substring(F.lpad(F.col("p_partkey").cast("string"), 9, "0"), -4, 4)
    rules = t.view("part").select(
        F.col("p_partkey").alias("rank"), F.concat(F.lit("%"), digits, F.lit("%")).alias("pattern"), F.col("p_name").alias("label")
    )
    return label_by_patterns(t.view("customer").select("c_custkey", "c_name"), "c_name", rules, "label")


@query
def control_totals(t: ViewTables) -> DataFrame:
    """Rows and amounts of a rate look-up, a holding look-up that multiplies and loses rows, and an allocation whose
    weights add up to 0.9999, observed while the results are written."""
    totals = ControlTotals(t.spark)
    lines = t["ledger_history"].select("document_number", "service_date", "local_currency", S.money("value_lc").alias("value"))
    rated = lines.withColumn("rate_year", F.year("service_date").cast("string"))
    rate_keys = [L.Key("rate_year", "Year"), L.Key("local_currency", "Currency")]
    _written(t, "rated", totals.lookup("rates", rated, t["fx_budget"], rate_keys, {"Value": "rate"}, "value"))
    current = t["ledger_current"].select("legal_client_id", "revenue_stream", "legal_entity_country", S.money("value_lc").alias("value"))
    client = [L.Key("legal_client_id", "tax_id_client", left_by=S.normalize_id, right_by=S.normalize_id)]
    _written(t, "held", totals.lookup("holdings", current, t["holdings"], client, ["holding_name"], "value", "inner"))
    cost = t["expenses_base_a"].groupBy("currency").agg(F.sum(S.money("value_lc")).alias("value"))
    thirds = [(c, country, 0.3333) for c in ("CLP", "MXN", "BRL", "USD", "EUR") for country in ("CL", "MX", "ES")]
    weights = shapes.literal_table(t.spark, thirds, "currency string, country string, weight double")
    spread = totals.allocate("weights", cost, weights, {"currency": "currency"}, "value", "weight", "share", {"country": ("country", "currency")})
    _written(t, "spread", spread)
    return totals.report()


REPLAY = dt.date(1998, 6, 20)


@query
def buildup_as_of(t: ViewTables) -> DataFrame:
    """The buildup as it was on an earlier day: documents dated later are unknown, and what its month shows as the last
    of a series has not churned."""
    return revenue.buildup(AsOf(t, REPLAY), RULES, "with_product", censor=REPLAY)


@query
def first_time_company_as_of(t: ViewTables) -> DataFrame:
    """Booked logos from the versions of deals that were valid on an earlier day."""
    return acquisition.booked_logos(AsOf(t, REPLAY), RULES, SINCE, REPLAY)


@query
def enrich_colocated(t: ViewTables) -> DataFrame:
    """Ledger and holdings stored by their normalised id, stream and country, and joined where they lie."""
    lines = t["ledger_current"].select("document_number", "legal_client_id", "revenue_stream", "legal_entity_country")

    def stored(name: str, df: DataFrame, keys: tuple[str, str, str]) -> Colocated:
        path = new_path(t.spark, name)
        columns = [S.normalize_id(F.col(keys[0])), F.col(keys[1]), F.col(keys[2])]
        return write_colocated(df, path.rsplit("/", 1)[1].replace("-", "_"), path, columns, 8)

    left = stored("ledger", lines, ("legal_client_id", "revenue_stream", "legal_entity_country"))
    right = stored("holdings", t["holdings"], ("tax_id_client", "revenue_stream", "service_country"))
    return join_colocated(t.spark, left, right, ["holding_name", "client_segment", "holding_cohort"])


@query
def weights_that_do_not_add_up(t: ViewTables) -> DataFrame:
    """Shares of companies in their country's orders, cut to ten-thousandths: the countries whose shares lose cost."""
    ten_thousandths = F.floor(F.col("share") * 10000).cast("decimal(10,0)")
    weights = share_of_total(t).withColumn("weight", ten_thousandths * F.lit("0.0001").cast("decimal(4,4)"))
    return A.check_weights(weights, ["countryId"], "weight")


@query
def cube_against_buildup(t: ViewTables) -> DataFrame:
    """Months, holdings and streams in which the revenue cube and the buildup don't agree, with the reason."""
    t, keys = _ledgers_stored(t), ["period", "holding_name", "revenue_stream", "service_country"]
    cube = t["revenue_cube"].select(S.month_start("full_date").alias("period"), *keys[1:], S.money("value_lc").alias("value"))
    buildup = revenue.buildup(t, RULES, "with_product", store=_store(t))
    built = buildup.select(F.col("full_date").alias("period"), *keys[1:], S.money("value_lc").alias("value"))
    return differences(cube, built, keys, ["value"], 0.01, _store(t))


@lru_cache(maxsize=4)
def _tables(spark: SparkSession, sf_dir: str) -> ViewTables:
    """Lazy plans of the views, built once per session and folder."""
    return ViewTables(apply_scale_settings(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(plan(_tables(spark, sf_dir)))

        return run

    return {name: runner(plan) for name, plan in _PLANS.items()}
