"""Rewards points: load, order, redemption and void ledgers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.business import (
    bonus_transaction_id,
    corrected_country,
    is_internal,
    reloaded_flag,
    yes_no,
)
from ledgerloom.functions.scalars import (
    before,
    clean_order_id,
    local_datetime,
    text_to_long,
    year_month,
)
from ledgerloom.operators.lookup import Key, lookup
from ledgerloom.sources.shapes import within_spine
from ledgerloom.sources.shredded import with_members
from ledgerloom.sources.warehouse import Tables

# Members that the ledgers take from documents.
LOAD_MEMBERS = {
    "limited_to": "$.allowedGiftCardIds", "amount_text": "$.amount", "user nationalId": "$.nationalId", "user_email": "$.email",
    "bonus_id": "$.id",
}
WITHDRAWAL_MEMBERS = {"withdrawn_order": "$.orderId", "withdrawn_text": "$.amount"}
PRODUCT_MEMBERS = {"product_quantity": "$.quantity"}
CONTRIBUTION_MEMBERS = {"taken_text": "$.totalTakenAmount", "bonus_id": "$.bonusId"}
DOCUMENTS = {
    "loads": ("giftCards_member", LOAD_MEMBERS), "balance_tx": ("withdraworders_member", WITHDRAWAL_MEMBERS),
    "orders_bo": ("products_member", PRODUCT_MEMBERS), "user_giftcards": ("contributions_member", CONTRIBUTION_MEMBERS),
}

LOAD_SPINE_START = dt.date(2023, 1, 1)
ORDER_START = dt.date(2023, 6, 1)
LEDGER_START = dt.date(2025, 1, 1)


def _on_or_after(c: str, day: dt.date) -> Column:
    return F.col(c).cast("date") >= F.lit(day)


def _order_like(c: str, country_ids: str) -> Column:
    return F.col(c).rlike(R.ORDER_ID_REGEX) | F.col(c).rlike(country_ids)


def _company_names(t: Tables, df: DataFrame, key: str) -> DataFrame:
    return lookup(df, t["companies_app"], [Key(key, "document_id")], {"name": "companyNameApp"})


def _company_records(t: Tables, df: DataFrame, key: str) -> DataFrame:
    return lookup(
        df, t["companies_bo"], [Key(key, "document_id")],
        {"nationalId": "companyNationalIdBO", "countryId": "companyNationalityBO"},
    )


def _internal(rules: R.Rules) -> Column:
    return yes_no(is_internal("companyNameApp", rules.rewards.internal_prefix, rules.rewards.internal_names))


def loaded(
    t: Tables, rules: R.Rules, since: dt.date = LEDGER_START, as_of: dt.date | None = None,
    spine_start: dt.date = LOAD_SPINE_START,
) -> DataFrame:
    """Points loaded, home country after correction, without loads limited to certain gift cards."""
    home = rules.rewards.home_country
    member = "giftCards_member"
    dated = t["loads"].filter(
        within_spine("createdAt", spine_start, as_of)
        & _on_or_after("createdAt", since)
        & _order_like("transactionId", R.LOAD_COUNTRY_ID_REGEX)
    )
    members = with_members(dated, member, LOAD_MEMBERS)
    loads = members.filter(F.col("limited_to").isNull()).select(
        "createdAt", "transactionId", "companyId", *[c for c in LOAD_MEMBERS if c != "limited_to"]
    )
    by_label = [Key("transactionId", "label")]
    order_companies = t["orders_bo"].select("document_id", "label", "companyId").distinct()
    named = _company_names(t, loads, "companyId")
    placed = lookup(named, order_companies, by_label, {"companyId": "orderCompanyId"})
    country = corrected_country("companyNationalityBO", "transactionId", home)
    at_home = _company_records(t, placed, "orderCompanyId").withColumn(
        "companyNationalityBO_corregido", country
    ).filter(F.col("companyNationalityBO_corregido") == home)
    with_user = lookup(at_home, t["bonuses"], [Key("bonus_id", "document_id")], {"userId": "user_id"})
    paid = lookup(with_user, t["orders_bo"], by_label, {"paymentMethod": "paymentmethod"})
    return paid.select(
        "createdAt", year_month("createdAt").alias("AnoMes Loaded"), text_to_long("amount_text").alias("amount"),
        "companyNameApp", "companyNationalIdBO", "companyNationalityBO_corregido", "user nationalId", "user_email",
        "user_id", "transactionId", clean_order_id("transactionId").alias("transactionId Limpio"),
        F.lit("points").alias("type"), "paymentmethod", _internal(rules).alias("empresa_interna"),
        F.concat("transactionId", "user nationalId").alias("llave_voided_loadedid_userid"),
        reloaded_flag("transactionId").alias("es_movimiento_reloaded"),
    )


def invoiced_orders(t: Tables) -> DataFrame:
    """Orders paid from the balance of another order: both labels and the amount withdrawn."""
    member = "withdraworders_member"
    moves = with_members(t["balance_tx"], member, WITHDRAWAL_MEMBERS).select(
        "depositorderid", "withdrawn_order", text_to_long("withdrawn_text").alias("withdrawn_amount"),
    )
    orders = t["orders_bo"]
    funded = lookup(
        moves, orders, [Key("depositorderid", "document_id")], {"label": "label_order_facturada"}, how="inner"
    )
    both = lookup(
        funded, orders, [Key("withdrawn_order", "document_id")], {"label": "label_order_ingresada"}, how="inner"
    )
    return both.select("label_order_facturada", "label_order_ingresada", "withdrawn_amount")


def orders(t: Tables, rules: R.Rules, since: dt.date = ORDER_START) -> DataFrame:
    """Completed orders with invoices, the order that funded them and that order's first month."""
    done = t["orders_bo"].filter(
        _on_or_after("createdAt", since)
        & (F.col("countryId") == rules.rewards.home_country)
        & (F.col("status") == "done")
    )
    linked = lookup(
        with_members(done, "products_member", PRODUCT_MEMBERS), invoiced_orders(t), [Key("label", "label_order_ingresada")],
        ["label_order_facturada", "withdrawn_amount"],
    ).withColumn("super_label", F.coalesce("label_order_facturada", "label")).withColumn(
        "super_id", clean_order_id("super_label")
    )
    first_month = linked.groupBy("super_id").agg(F.min(F.col("createdAt").cast("date")).alias("first_date"))
    # The product table adds no column, and its fan-out would be removed by the final distinct.
    dated = lookup(linked, first_month, [Key("super_id", "super_id")], ["first_date"])
    companies = lookup(
        dated, t["companies_bo"], [Key("companyId", "document_id")],
        {"nationalId": "bo_national_id", "legalName": "bo_legal_name"},
    )
    clients = t["client"].withColumn("id", F.col("id").cast("string"))
    named = lookup(
        companies, clients, [Key("companyId", "id")],
        {"document_value": "client_document", "company_name": "client_name"},
    )
    invoiced = lookup(
        named, t["invoices"], [Key("document_id", "orderId")],
        {"invoiceNumber": "invoiceNumber", "amount": "invoiceAmount"},
    )
    portal = F.lower("channel") == rules.rewards.portal_channel
    return invoiced.select(
        F.col("createdAt").alias("orderCreatedDate"), year_month("createdAt").alias("AnoMes Order"),
        F.col("label").alias("orderId"), clean_order_id("label").alias("orderId Limpio"),
        F.col("paymentMethod").alias("orderPaymentMethod"), F.col("status").alias("orderStatus"),
        F.coalesce("bo_national_id", "client_document").alias("companyNationalId"),
        F.coalesce("bo_legal_name", "client_name").alias("companyLegalName"), "invoiceNumber", "invoiceAmount",
        F.col("super_label").alias("invoiced_orden_factura_suprema"),
        F.col("super_id").alias("invoiced_orden_factura_suprema Limpio"),
        year_month("first_date").alias("AnoMes Order Supremo"),
        F.col("withdrawn_amount").alias("withdrawn_amount_saldo"),
        text_to_long("product_quantity").alias("productAmount"),
        F.when(portal, "Portal").otherwise("BO").alias("channel"),
    ).distinct()


def load_records(t: Tables) -> DataFrame:
    """Loads with the paying order (label = id up to the first dot) and both company records."""
    ids = t["loads"].select("document_id", "transactionId", "createdAt", "companyId").distinct()
    ids = ids.withColumn("order_label", before("transactionId", "."))
    paid = lookup(
        ids, t["orders_bo"], [Key("order_label", "label")],
        {"paymentMethod": "paymentmethod", "companyId": "orderCompanyId"},
    )
    return _company_records(t, _company_names(t, paid, "companyId"), "orderCompanyId")


def redeemed(
    t: Tables, rules: R.Rules, since: dt.date = LEDGER_START, as_of: dt.date | None = None
) -> DataFrame:
    """Points redeemed per contribution, with months in the home time zone."""
    home, zone = rules.rewards.home_country, rules.rewards.home_zone
    member = "contributions_member"
    kept = t["user_giftcards"].filter(
        F.col("voidedAt").isNull()
        & ~F.col("status").isin("voided", "reversed")
        & F.col("userGiftCardRedeemRequestId").isNotNull()
        & F.col("contributions_index").isNotNull()
        & within_spine("createdAt", since, as_of)
    ).withColumn("local_created", local_datetime("createdAt", zone)).filter(
        _on_or_after("local_created", since)
    )
    redemptions = with_members(kept, member, CONTRIBUTION_MEMBERS).select(
        "local_created", F.col("amount").alias("total_amount"), "giftCardId", "code", "userId",
        text_to_long("taken_text").alias("taken"), "bonus_id",
    )
    bonuses = t["bonuses"].filter(F.col("giftCardsLoadId").isNotNull()).select(
        "document_id", "giftCardsLoadId", "userId"
    ).distinct()
    users = t["users"].filter(F.col("nationality") == home)
    country = corrected_country("companyNationalityBO", "transactionId", home)
    loads = load_records(t).filter(
        _order_like("transactionId", R.REDEEM_COUNTRY_ID_REGEX) & (country == home)
    ).select(
        "document_id", "transactionId", F.col("createdAt").alias("load_created"), "companyId", "paymentmethod",
        "companyNameApp", "companyNationalIdBO", "companyNationalityBO",
    ).distinct()
    linked = lookup(
        redemptions, bonuses, [Key("bonus_id", "document_id"), Key("userId", "userId")], ["giftCardsLoadId"],
        how="inner",
    )
    load_columns = ["transactionId", "load_created", "companyNameApp", "companyNationalIdBO"]
    on_load = lookup(linked, loads, [Key("giftCardsLoadId", "document_id")], load_columns, how="inner")
    rows = lookup(
        on_load, users, [Key("userId", "document_id")], {"document_id": "user_id", "nationalId": "user_nationalId"},
        how="inner",
    )
    short_id = bonus_transaction_id("transactionId")
    return rows.select(
        F.col("local_created").alias("Redeemed createdAt"), year_month("local_created").alias("AnoMes Redeemed"),
        F.col("total_amount").alias("userGiftCardAmount"), F.col("taken").alias("bonusLoadRedeemedContributionAmount"),
        "giftCardId", "code", "user_id", "user_nationalId", short_id.alias("bonusLoadTransactionId"),
        clean_order_id("transactionId").alias("bonusLoadTransactionId Limpio"),
        year_month(local_datetime("load_created", zone)).alias("AnoMes Loaded"), "companyNameApp",
        "companyNationalIdBO", _internal(rules).alias("empresa_interna"),
        F.concat(short_id, "user_id").alias("llave_bonus_user"),
    )


def voided(
    t: Tables, rules: R.Rules, since: dt.date = ORDER_START, as_of: dt.date | None = None
) -> DataFrame:
    """Voided bonuses of unrestricted loads, home country after correction."""
    home = rules.rewards.home_country
    bonuses = t["bonuses"].filter(
        within_spine("createdAt", since, as_of)
        & F.col("giftCardsLoadId").isNotNull()
        & (F.col("allowedGiftCardIds") == F.lit(False))
        & (F.col("status") == "voided")
    ).select(
        "giftCardsLoadId", "createdAt", "voidedat", "amount", "email", F.col("nationalId").alias("userNationalId")
    )
    loads = t["loads"].select("document_id", "transactionId", "companyId").distinct()
    linked = lookup(
        bonuses, loads, [Key("giftCardsLoadId", "document_id")],
        {"transactionId": "bonusLoadTransactionId", "companyId": "companyId"}, how="inner",
    ).withColumn("order_label", before("bonusLoadTransactionId", "."))
    named = _company_names(t, linked, "companyId")
    paid = lookup(
        named, t["orders_bo"], [Key("order_label", "label")],
        {"paymentMethod": "paymentmethod", "companyId": "orderCompanyId"},
    )
    country = corrected_country("companyNationalityBO", "bonusLoadTransactionId", home)
    rows = _company_records(t, paid, "orderCompanyId").withColumn("companyNationalityBO_corregido", country)
    return rows.filter(F.col("companyNationalityBO_corregido") == home).select(
        F.col("voidedat").alias("voidedAt"), year_month("voidedat").alias("AnoMes Voided"),
        F.col("createdAt").alias("bonusLoadCreatedAt"), year_month("createdAt").alias("AnoMes Loaded"), "amount",
        "email", "userNationalId", "companyNameApp", "companyNationalIdBO", "companyNationalityBO_corregido",
        "bonusLoadTransactionId", clean_order_id("bonusLoadTransactionId").alias("bonusLoadTransactionId Limpio"),
        "paymentmethod", _internal(rules).alias("empresa_interna"),
    )
