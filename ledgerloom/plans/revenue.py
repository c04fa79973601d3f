"""Revenue plans: document-line cube, monthly buildups, client cards, cohorts and checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.business import (
    arpu,
    country_name,
    document_class,
    document_status,
    entity_name,
    net_of_tax,
    product_bucket,
    zero_quantity_for,
)
from ledgerloom.functions.scalars import (
    any_of,
    converted,
    in_list,
    map_values,
    money,
    month_of,
    month_start,
    months_since,
    net_money,
    normalize_id,
    not_in_list,
    safe_divide,
    strip_chars,
    year_of,
)
from ledgerloom.operators.fx import fx_convert, with_rate
from ledgerloom.operators.lookup import Key, lookup, running_flag, share_of_total
from ledgerloom.operators.reconcile import reconcile, reconcile_totals
from ledgerloom.operators.series import (
    cohort_from_first,
    gap_fill,
    linked_end,
    logo_counts,
    movement,
    period_context,
    sibling_value,
)
from ledgerloom.sources.schemas import SCHEMAS
from ledgerloom.sources.shapes import conform_union, pad, union_sources
from ledgerloom.sources.shared import Store, not_stored
from ledgerloom.sources.warehouse import Tables

LEDGER_COLUMNS = SCHEMAS["ledger_current"].fieldNames()
HOLDING_KEYS = (
    Key("legal_client_id", "tax_id_client", left_by=normalize_id, right_by=normalize_id),
    Key("revenue_stream", "revenue_stream"),
    Key("legal_entity_country", "service_country"),
)


# ---- sources ---------------------------------------------------------------------------------------


def merged_ledger(
    t: Tables,
    columns: Sequence[str],
    names: Sequence[str],
    where: Column | None = None,
    current_where: Column | None = None,
) -> DataFrame:
    """Union of ledger tables. History rows without a client id are left out; `current_where`
    filters the current table only. Columns a history table lacks come as empty text."""
    frames = []
    for name in names:
        df = t[name]
        if name.startswith("ledger_history"):
            df = df.filter(F.col("legal_client_id").isNotNull())
        if name == "ledger_current" and current_where is not None:
            df = df.filter(current_where)
        lacking = [c for c in columns if c not in df.columns]
        frames.append(pad(df, **{c: "" for c in lacking}) if lacking else df)
    return union_sources(frames, columns, where)


ALL_LEDGERS = ("ledger_current", "ledger_history", "ledger_history_old", "ledger_corrections")
RECENT_LEDGERS = ("ledger_current", "ledger_corrections")


def holding_dim(t: Tables, columns: Sequence[str]) -> DataFrame:
    return t["holdings"].select(*columns).distinct()


# ---- monthly buildups ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Buildup:
    """What tells the four buildup variants apart."""

    ledgers: tuple[str, ...] = ALL_LEDGERS
    product_filter: str = "all"  # all | main_family | other
    product_variant: str = "merged"  # see product_bucket
    with_product: bool = True  # product is part of the grain
    product_series: bool = False  # product is part of the period keys
    zero_addon_members: bool = False
    other_country: bool = True
    holding_columns: tuple[str, ...] = (
        "tax_id_client", "holding_name", "revenue_stream", "service_country", "client_segment", "holding_cohort",
    )
    cohort: str = "dimension"  # dimension | first_seen
    linked_products: bool = False
    exclude_addon_logos: bool = False
    ignore_negative_local: bool = False


_WITH_UNIT = (
    "tax_id_client", "holding_name", "revenue_stream", "service_country", "client_segment", "business_unit",
    "holding_cohort",
)
BUILDUPS = {
    "with_product": Buildup(zero_addon_members=True),
    "no_product": Buildup(product_variant="split", with_product=False, holding_columns=_WITH_UNIT),
    "other_products": Buildup(
        ledgers=RECENT_LEDGERS, product_filter="other", product_variant="split", product_series=True,
        holding_columns=_WITH_UNIT, cohort="first_seen", exclude_addon_logos=True,
    ),
    "main_family": Buildup(
        ledgers=RECENT_LEDGERS, product_filter="main_family", product_variant="split", product_series=True,
        holding_columns=_WITH_UNIT, other_country=False, cohort="first_seen", linked_products=True,
        exclude_addon_logos=True, ignore_negative_local=True,
    ),
}


def _product_condition(kind: str) -> Column | None:
    family = F.col("product").isin(*R.MAIN_FAMILY)
    return {"all": None, "main_family": family, "other": ~family | F.col("product").isNull()}[kind]


def reconciled_months(t: Tables, rules: R.Rules, v: Buildup, store: Store = not_stored) -> DataFrame:
    """Reconciled revenue per month and holding grain.

    Columns: full_date, the grain, value_lc (net, both kinds of source), convertible (the part still
    to be converted to USD), usd_given (already in USD) and quantity. Amounts are exact decimals.

    Only clients with a holding count in the end, so the holding join is an inner one and unmatched
    clients, the largest group, never reach a shuffle with their NULL key. Documents are summed per
    client and class before that join: a client with very many documents is a few rows by then. `store` takes
    these sums.
    """
    columns = [
        "legal_client_id", "document_type", "revenue_stream", "quantity_charged", "value_lc", "local_currency",
        "service_date", "legal_entity_country", "sponsor", "product",
    ]
    ledger = merged_ledger(t, columns, v.ledgers, _product_condition(v.product_filter))
    quantity = F.col("quantity_charged")
    if v.zero_addon_members:
        quantity = zero_quantity_for(quantity, "product")
    bucket = product_bucket("revenue_stream", "product", v.product_variant)
    product = [bucket.alias("product")] if v.with_product else []

    lines = ledger.filter(
        in_list("revenue_stream", R.BUILDUP_STREAMS)
        & not_in_list("revenue_stream", rules.revenue.excluded_streams)
        & (F.col("document_type") != R.FREE_TYPE)
    ).select(
        normalize_id("legal_client_id").alias("legal_client_id"), "revenue_stream", "legal_entity_country",
        "service_date", "local_currency", "sponsor", *product,
        document_class("document_type").alias("doc_class"), money("value_lc").alias("value_lc"),
        money(quantity).alias("quantity"),
    ).filter(F.col("doc_class").isNotNull())
    client_keys = [c for c in lines.columns if c not in ("value_lc", "quantity")]
    per_client = lines.groupBy(*client_keys).agg(
        F.sum("value_lc").alias("value_lc"), F.sum("quantity").alias("quantity")
    )
    per_client = store("per_client", per_client)

    # An inner join makes the dimension's rows without a holding name irrelevant.
    holdings = holding_dim(t, v.holding_columns).filter(F.col("holding_name") != "")
    joined = lookup(
        per_client, holdings, HOLDING_KEYS, ["holding_name", "client_segment", "holding_cohort"], how="inner"
    ).withColumnRenamed("legal_entity_country", "service_country")

    grain = [
        "service_country", "holding_name", "holding_cohort", "client_segment", "local_currency", "sponsor",
        "revenue_stream", *(["product"] if v.with_product else []),
    ]
    rows = joined.select(
        "service_date", *grain, "doc_class", "value_lc", "quantity",
        F.lit(None).cast(R_USD_SUM).alias("usd_given"),
    )
    if v.other_country:
        given = t["cube_other_country"].filter(
            in_list("revenue_stream", R.BUILDUP_STREAMS) & (F.col("holding_name") != "")
        )
        rows = rows.unionByName(given.select(
            F.col("full_date").alias("service_date"), *grain, F.lit(None).cast("int").alias("doc_class"),
            money("value_lc").cast(R_MONEY_SUM).alias("value_lc"),
            money("quantity_charged").cast(R_MONEY_SUM).alias("quantity"),
            converted("value_usd_bdg").cast(R_USD_SUM).alias("usd_given"),
        ))
    # Every later grouping and window has these keys, so this is the last shuffle of the plan. Rows are sums per client
    # already; summing them per holding first would be one more shuffle for few rows less.
    together = ["holding_name"] if v.cohort == "first_seen" else ["holding_name", "revenue_stream", "service_country"]
    totals = rows.repartition(*together).groupBy("service_date", *grain, "doc_class").agg(
        *[F.sum(c).alias(c) for c in ("value_lc", "quantity", "usd_given")]
    )
    kept = reconcile_totals(
        totals, ["holding_name", "service_date", "revenue_stream", "service_country"], "doc_class",
        keep_unclassed=True,
    )
    gross = F.col("value_lc").cast(R_MONEY_SUM)
    net = net_money(net_of_tax(gross, "local_currency"))
    own = F.col("doc_class").isNotNull()
    split = kept.select(
        month_start("service_date").alias("full_date"), *grain,
        F.when(own, net).otherwise(net_money(gross)).alias("value_lc"),
        F.when(own, net).alias("convertible"), "usd_given", "quantity",
    )
    monthly = split.groupBy("full_date", *grain).agg(
        *[F.sum(c).alias(c) for c in ("value_lc", "convertible", "usd_given", "quantity")]
    )
    return monthly.filter(F.col("value_lc") != 0)


R_MONEY_SUM = "decimal(28,4)"
R_USD_SUM = "decimal(34,10)"
MONTH_MEASURES = ("value_lc", "convertible", "usd_given", "quantity")


def _valued(t: Tables, months: DataFrame) -> DataFrame:
    """Local value, USD value and members as doubles; parts that are missing count as zero."""
    rated = with_rate(months, t["fx_budget"], "full_date", "local_currency", "rate")
    zero = F.lit(0.0)
    converted = F.coalesce(safe_divide("convertible", "rate"), zero)
    return rated.select(
        *[c for c in months.columns if c not in MONTH_MEASURES],
        F.coalesce(F.col("value_lc").cast("double"), zero).alias("value_lc"),
        (converted + F.coalesce(F.col("usd_given").cast("double"), zero)).alias("value_usd"),
        F.coalesce(F.col("quantity").cast("double"), zero).alias("members"),
    )


def revenue_base(t: Tables, months: DataFrame, v: Buildup) -> DataFrame:
    """Contiguous months per series with zero-filled measures, USD value and invoice number.

    With the dimension's cohort, a series and month is one row, so amounts are valued before the
    gaps are filled, on the fewer rows. With the first month seen as cohort, series of one holding
    merge after filling and their exact amounts are added before they are valued.
    """
    grain = [c for c in months.columns if c not in ("full_date", *MONTH_MEASURES)]
    if v.cohort == "first_seen":
        filled = gap_fill(months, "full_date", grain, MONTH_MEASURES)
        merged = [c for c in grain if c != "holding_cohort"]
        filled = filled.groupBy("full_date", *merged).agg(*[F.sum(c).alias(c) for c in MONTH_MEASURES])
        base = _valued(t, cohort_from_first(filled, ["holding_name"], "full_date"))
    else:
        sparse = _valued(t, months)
        measures = ("value_lc", "value_usd", "members")
        filled = gap_fill(sparse, "full_date", grain, measures)
        base = filled.select(
            "full_date", *grain, *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in measures]
        )
    return base.withColumn("invoice_number", months_since("full_date", "holding_cohort"))


SERIES_KEYS = ("holding_name", "revenue_stream", "service_country", "sponsor")
MEASURES = ("members", "value_lc", "value_usd")


def with_context(base: DataFrame, v: Buildup) -> DataFrame:
    keys = [*SERIES_KEYS, *(["product"] if v.product_series else [])]
    used = {"full_date", "invoice_number", *MEASURES, *keys}
    rest = [c for c in base.columns if c not in used]
    return period_context(base, keys, "full_date", MEASURES, tie_break=rest)


def decomposition(context: DataFrame, v: Buildup, censor: dt.date | None = None) -> DataFrame:
    """Movement of members, local and USD value, and logo counters. With `censor`, nothing has churned yet in the month
    of that day or later, where a series has no next month only because the data end."""
    df = context
    ends: dict[str, Column | None] = dict.fromkeys(MEASURES)
    if v.linked_products:
        month_keys = [*SERIES_KEYS, "full_date"]
        main = F.col("product") == R.MAIN_PRODUCT
        df = df.select(
            "*", *[sibling_value(month_keys, main, F.col(f"{m}_next")).alias(f"{m}_main_next") for m in MEASURES]
        )
        ends = {m: linked_end(m, R.MAIN_PRODUCT, R.ADDON_PRODUCT, f"{m}_main_next") for m in MEASURES}
    ended = F.lit(True) if censor is None else F.col("full_date") < F.lit(censor.replace(day=1))
    if censor is not None:
        ends = {m: ended & (F.col(f"{m}_next").isNull() if end is None else end) for m, end in ends.items()}
    ignore = {"members": False, "value_lc": v.ignore_negative_local, "value_usd": True}
    columns = []
    for m in MEASURES:
        parts = movement(m, new_after_gap=m == "members", ignore_negative=ignore[m], churn_when=ends[m])
        columns += [c.alias(f"{m}_{kind}") for kind, c in parts.items()]
    logos = logo_counts(
        exclude=R.ADDON_PRODUCT if v.exclude_addon_logos else None,
        only_churn=R.MAIN_PRODUCT if v.linked_products else None,
    )
    if censor is not None:
        logos["logo_churn"] = F.when(ended, logos["logo_churn"]).otherwise(F.lit(0).cast("long"))
    return df.select("*", *columns, *[c.alias(n) for n, c in logos.items()])


def buildup(
    t: Tables, rules: R.Rules, variant: str = "with_product", censor: dt.date | None = None, store: Store = not_stored
) -> DataFrame:
    """Month-over-month revenue buildup: one row per holding grain and month. `censor`: see `decomposition`; `store`:
    see `reconciled_months`."""
    v = BUILDUPS[variant]
    parts = decomposition(with_context(revenue_base(t, reconciled_months(t, rules, v, store), v), v), v, censor)
    columns = [
        F.col("full_date"), year_of("full_date").alias("year"), month_of("full_date").alias("month"),
        *[F.col(c) for c in ("service_country", "revenue_stream", "holding_name", "sponsor")],
        *([F.col("product")] if v.with_product else []),
        *[F.col(c) for c in ("holding_cohort", "client_segment", "local_currency", "value_lc", "members")],
        F.col("invoice_number"),
    ]
    for m in MEASURES:
        columns += [F.col(f"{m}_{k}") for k in ("bop", "new", "retention", "churn")]
        columns.append(F.col(m).alias(f"{m}_eop"))
    columns += [F.col(c) for c in ("logo_bop", "logo_new", "logo_churn", "logo_eop")]
    return parts.select(*columns)


def monthly_revenue_usd(t: Tables, rules: R.Rules, variant: str = "with_product") -> DataFrame:
    """Reconciled monthly revenue per holding grain, in local currency and USD."""
    months = reconciled_months(t, rules, BUILDUPS[variant])
    rated = with_rate(months, t["fx_budget"], "full_date", "local_currency", "rate")
    converted, given = safe_divide("convertible", "rate"), F.col("usd_given").cast("double")
    zero = F.lit(0.0)
    known = converted.isNotNull() | given.isNotNull()
    total = F.when(known, F.coalesce(converted, zero) + F.coalesce(given, zero))
    keep = [c for c in months.columns if c not in MONTH_MEASURES]
    return rated.select(
        *keep, F.col("value_lc").cast("double").alias("value_lc"), total.alias("value_usd_bdg"),
        F.col("quantity").cast("double").alias("quantity_charged"),
    )


# ---- document-line cube ----------------------------------------------------------------------------


def revenue_lines(t: Tables, rules: R.Rules, store: Store = not_stored) -> DataFrame:
    """Reconciled document lines in the cube's 30 columns. Groups are holding, date and stream,
    without the country. `store` takes the lines with their holdings, and those that are kept."""
    house = rules.revenue
    ledger = merged_ledger(
        t, LEDGER_COLUMNS, ALL_LEDGERS, current_where=F.col("legal_entity_country") != house.cube_excluded_country
    ).filter(
        not_in_list("revenue_stream", (*house.excluded_streams, *house.cube_excluded_streams))
        & (F.col("document_type") != R.FREE_TYPE)
    )
    dim = holding_dim(t, _WITH_UNIT)
    enriched = lookup(ledger, dim, HOLDING_KEYS, ["holding_name", "client_segment", "holding_cohort"])
    enriched = store("enriched", enriched)
    kept = store("kept", reconcile(enriched, ["holding_name", "service_date", "revenue_stream"]))
    valued = kept.withColumn("net_lc", net_of_tax("value_lc", "local_currency"))
    converted = fx_convert(
        valued, t["fx_budget"], "net_lc", "service_date", "local_currency", "value_usd_bdg", "fx_value_bdg"
    )
    return converted.select(
        "document_number",
        strip_chars("legal_client_id", ".-").alias("tax_id_client"),
        F.col("legal_client_name").alias("client_legal_name"),
        "invoice_description", "document_type", "revenue_stream", F.col("document_type").alias("type"),
        "quantity_charged",
        F.col("net_lc").cast("double").alias("value_lc"),
        "local_currency", F.col("service_date").alias("full_date"), F.lit("Real").alias("version"),
        arpu("value_lc", "quantity_charged").alias("arpu"),
        "client_segment", F.lit("").alias("holding_id"), "holding_name", "sponsor", "holding_cohort",
        F.col("legal_entity_country").alias("service_country"),
        country_name("legal_entity_country").alias("legal_entity_country"),
        entity_name("legal_entity_country", house.entity_prefix).alias("legal_entity_name"),
        F.lit("Direct").alias("sales_channel"),
        product_bucket("revenue_stream", "product", "explicit").alias("product"),
        "fx_value_bdg", "value_usd_bdg", F.lit("Cubo").alias("source"),
        month_of("service_date").alias("month"), year_of("service_date").alias("year"),
        document_status("document_binary").alias("document_status"), "contract_plan_id",
    )


def expense_as_revenue(lines: DataFrame, product: str) -> DataFrame:
    """Shape expense-cube lines into the cube's 29 shared columns."""
    def text(value: str, name: str) -> Column:
        return F.lit(value).alias(name)

    return lines.select(
        text("0", "document_number"), F.col("business_partner_id").alias("tax_id_client"),
        F.col("business_partner_name").alias("client_legal_name"),
        F.col("transaction_detail").alias("invoice_description"),
        text("-", "document_type"), text(R.STREAM_FINANCIAL, "revenue_stream"), text("Real", "type"),
        F.lit(1.0).alias("quantity_charged"), "value_lc", F.col("currency").alias("local_currency"),
        F.col("full_date").cast("date").alias("full_date"), text("Real", "version"), F.lit(0.0).alias("arpu"),
        text("-", "client_segment"), text("-", "holding_id"),
        F.col("business_partner_name").alias("holding_name"), text("-", "sponsor"),
        F.lit(dt.date(2021, 1, 1)).alias("holding_cohort"), "service_country", "legal_entity_country",
        "legal_entity_name", text("-", "sales_channel"), text(product, "product"),
        F.col("value_fx_bdg").alias("fx_value_bdg"), "value_usd_bdg", "source", "month", "year",
        text(R.STATUS_ACTUAL, "document_status"),
    )


def exclude_related(df: DataFrame, patterns: Sequence[str], name: str = "business_partner_name") -> DataFrame:
    """Drop related parties by name pattern; lines without a name stay."""
    related = any_of(F.col(name).like(p) for p in patterns)
    return df.filter(~F.coalesce(related, F.lit(False)))


def financial_entity_lines(t: Tables, rules: R.Rules) -> DataFrame:
    """Revenue booked in the expense cube by the financial-services entity, without related parties."""
    lines = t["expense_cube"].filter(
        (F.col("legal_entity_name") == rules.revenue.financial_entity)
        & (F.col("management_account_name") == "Revenue")
        & (F.col("subversion") == "REAL")
    )
    return expense_as_revenue(exclude_related(lines, rules.revenue.related_patterns), "GC-XX-XX")


def rewards_lines(t: Tables, source: str, account: str) -> DataFrame:
    """Revenue of one country's rewards business: one source label and account of the cube."""
    lines = t["expense_cube"].filter(
        (F.col("source") == source) & (F.col("accounting_account_id") == account)
    )
    return expense_as_revenue(lines, "GC-XX-01")


def history_lines(t: Tables, rules: R.Rules) -> DataFrame:
    """Non-subscription history in the cube's 29 shared columns."""
    prefix = rules.revenue.history_entity_prefix
    names = {code: f"{prefix} {R.COUNTRY_NAMES[code]}" for code in ("CL", "BR")}
    converted = fx_convert(
        t["history_non_subscription"], t["fx_budget"], "value_lc", "service_date", "local_currency",
        "value_usd_bdg", "fx_value_bdg",
    )
    country = F.col("legal_entity_country")
    return converted.select(
        "document_number", F.col("legal_client_id").alias("tax_id_client"),
        F.col("legal_client_name").alias("client_legal_name"), "invoice_description", "document_type",
        "revenue_stream", F.lit("Real").alias("type"), "quantity_charged", "value_lc", "local_currency",
        F.col("service_date").alias("full_date"), F.lit("Real").alias("version"), F.lit(0.0).alias("arpu"),
        F.lit("").alias("client_segment"), F.lit("").alias("holding_id"),
        F.col("legal_client_name").alias("holding_name"), F.lit("").alias("sponsor"),
        F.lit(dt.date(1899, 12, 1)).alias("holding_cohort"), country.alias("service_country"),
        country, map_values(country, names).alias("legal_entity_name"),
        F.lit("Direct").alias("sales_channel"), F.lit("").alias("product"), "fx_value_bdg", "value_usd_bdg",
        F.lit("Historicos_non_subs").alias("source"), month_of("service_date").alias("month"),
        year_of("service_date").alias("year"), F.lit(R.STATUS_ACTUAL).alias("document_status"),
    )


def revenue_cube(t: Tables, rules: R.Rules, store: Store = not_stored) -> DataFrame:
    """Consolidated revenue at document-line level. `store`: see `revenue_lines`."""
    others = [
        t["cube_other_country"],
        t["cube_non_subscription"],
        financial_entity_lines(t, rules),
        history_lines(t, rules),
        t["cube_rewards"],
    ]
    frames = [revenue_lines(t, rules, store), *[pad(df, contract_plan_id="") for df in others]]
    return conform_union(frames, SCHEMAS["revenue_cube"]).filter(F.col("revenue_stream").isNotNull())


# ---- client cards, cohorts, checks -----------------------------------------------------------------


def client_revenue(
    t: Tables, rules: R.Rules, since: dt.date = dt.date(2025, 1, 1), countries: Sequence[str] = ("CL", "MX")
) -> DataFrame:
    """Per client and month: quantity, revenue, average per member, USD, weight in its country."""
    columns = [
        "legal_client_id", "legal_client_name", "document_type", "revenue_stream", "quantity_charged", "value_lc",
        "local_currency", "service_date", "legal_entity_country",
    ]
    where = (F.col("revenue_stream") == R.STREAM_EMPLOYEE) & (F.col("service_date") >= F.lit(since))
    ledger = merged_ledger(t, columns, RECENT_LEDGERS, where).filter(
        not_in_list("revenue_stream", rules.revenue.excluded_streams)
        & (F.col("document_type") != R.FREE_TYPE)
        & F.col("legal_entity_country").isin(*countries)
    )
    keys = [
        "legal_client_id", "legal_client_name", "revenue_stream", "local_currency", "service_date",
        "legal_entity_country", "doc_class",
    ]
    per_client = ledger.withColumn("doc_class", document_class("document_type")).groupBy(*keys).agg(
        F.sum(money("value_lc")).alias("value_lc"), F.sum(money("quantity_charged")).alias("quantity")
    )
    enriched = lookup(per_client, t["holdings"], HOLDING_KEYS, ["holding_name", "client_segment"])
    groups = ["holding_name", "service_date", "revenue_stream", "legal_entity_country"]
    kept = reconcile(enriched, groups, flag="doc_class", type_column=None)
    grain = [
        "service_date", "holding_name", "client_segment", "legal_client_id", "legal_client_name",
        "legal_entity_country", "local_currency",
    ]
    summed = kept.groupBy(*grain).agg(
        F.sum("quantity").alias("quantity"), F.sum("value_lc").alias("gross"),
    ).withColumn("revenue", net_of_tax("gross", "local_currency"))
    usd = fx_convert(summed, t["fx_budget"], "revenue", "service_date", "local_currency", "revenue_usd", "rate")
    shared = share_of_total(usd, ["service_date", "legal_entity_country"], "revenue", "revenue_weight")
    return shared.select(
        "service_date", "holding_name", F.col("client_segment").alias("holding_size"),
        strip_chars("legal_client_id", ".-").alias("tax_id"), F.col("legal_client_name").alias("company_name"),
        F.col("legal_entity_country").alias("country"), F.col("local_currency").alias("currency"),
        F.col("quantity").cast("double").alias("quantity"), F.col("revenue").cast("double").alias("revenue"),
        arpu("revenue", "quantity").alias("arpu"), "revenue_usd",
        arpu("revenue_usd", "quantity").alias("arpu_usd"), "revenue_weight",
    )


def mixed_product_check(
    t: Tables, rules: R.Rules, since: dt.date = dt.date(2024, 11, 1), countries: Sequence[str] = ("CL", "MX")
) -> DataFrame:
    """Lines without a product in holdings where, in client order so far, the main family occurs."""
    ledger = t["ledger_current"].filter(
        (F.col("service_date") >= F.lit(since))
        & (F.col("document_type") != R.FREE_TYPE)
        & (F.col("revenue_stream") == R.STREAM_EMPLOYEE)
        & F.col("legal_entity_country").isin(*countries)
    ).select("legal_client_id", "revenue_stream", "legal_entity_country", "product").distinct()
    enriched = lookup(ledger, t["holdings"], HOLDING_KEYS, {"holding_name": "holding_name", "service_country": "service_country"})
    rows = enriched.filter(F.col("service_country").isNotNull()).select(
        "service_country", "legal_client_id", "holding_name", "product"
    ).distinct()
    family = F.upper(F.col("product")).isin(*[p.upper() for p in R.MAIN_FAMILY])
    flagged = running_flag(rows, ["holding_name"], "legal_client_id", family, "check_product_por_holding")
    return flagged.filter(
        F.col("product").isNull()
        & (F.col("check_product_por_holding") == 1)
        & not_in_list("holding_name", rules.revenue.qa_exceptions)
    )


def product_cohort(t: Tables, countries: Sequence[str] = ("CL", "MX")) -> DataFrame:
    """First service date of the main family per client and country; spellings of a client's id are unified first."""
    raw = t["ledger_current"].filter(
        F.col("product").isin(*R.MAIN_FAMILY) & F.col("legal_entity_country").isin(*countries)
    )
    label = F.when(F.col("product").isin(*R.MAIN_FAMILY), "health").otherwise("legacy")
    cohorts = raw.groupBy(
        F.col("legal_entity_country").alias("service_country"), normalize_id("legal_client_id").alias("legal_client_id"),
        label.alias("product"),
    ).agg(F.min("service_date").alias("product_cohort"))
    names = t["holdings"].select("tax_id_client", "holding_name").distinct()
    joined = lookup(cohorts, names, [Key("legal_client_id", "tax_id_client")], ["holding_name"])
    return joined.select("product_cohort", "service_country", "legal_client_id", "holding_name", "product").distinct()


def new_activations(
    t: Tables,
    since: dt.date,
    countries: Sequence[str] = ("Chile", "Mexico"),
    excluded_types: Sequence[str] = ("Renewal", "Upside"),
) -> DataFrame:
    """Deals activated since a date, with the client's legal id."""
    acquired = t["deals"].filter(
        (F.col("activation_date") >= F.lit(since))
        & F.col("deal_country").isin(*countries)
        & not_in_list("development_type_use", excluded_types)
    ).select(
        "deal_country", "company_id", F.col("company_name").alias("deal_company_name"), "product_modules",
        "activation_date", "development_type_use",
    ).distinct()
    companies = t["companies"].select("company_id", "company_legal_id", "company_name").distinct()
    joined = lookup(acquired, companies, [Key("company_id", "company_id")], ["company_legal_id", "company_name"])
    return joined.select(
        "deal_country", "company_legal_id", "company_name", "product_modules", "development_type_use",
        "activation_date",
    )
