"""The consolidated profit-and-loss table in long format."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.scalars import converted, first_of, map_values, money, net_money, not_in_list
from ledgerloom.operators.series import stack_metrics
from ledgerloom.plans.acquisition import booked_mrr
from ledgerloom.plans.engagement import engagement_rates
from ledgerloom.sources.schemas import PNL_SCHEMA
from ledgerloom.sources.shapes import conform_union
from ledgerloom.sources.shared import Store, not_stored
from ledgerloom.sources.warehouse import Tables

KEYS = ("period", "country", "segment", "revenue_stream")

# --- fixed values: line labels and the buildup measures behind them (label, local, USD) --------------
BUILDUP_LINES = (
    ("Revenue_EoP", "value_lc_eop", "value_usd_eop"),
    ("Revenue_New", "value_lc_new", "value_usd_new"),
    ("Revenue_Churn", "value_lc_churn", "value_usd_churn"),
    ("Revenue_Retention", "value_lc_retention", "value_usd_retention"),
    ("Logos_EoP", "logo_eop", None),
    ("Logos_New", "logo_new", None),
    ("Logos_Churn", "logo_churn", None),
    ("Members_EoP", "members_eop", None),
    ("Members_New", "members_new", None),
    ("Members_Churn", "members_churn", None),
    ("Members_Retention", "members_retention", None),
)
# --- fixed values: product code of an employee stream to its report name ------------------------------
EMPLOYEE_PRODUCTS = {
    "EB-XX-1": "Wellbeing",
    "S.C": "Health",
    "S.C cargas": "Health",
    "IN-XX-1": "Insurance-ES",
    "VO-XX-1": "Interchange-ES",
}


def buildup_lines(buildup: DataFrame, min_year: int = 2024) -> DataFrame:
    """Eleven lines out of the buildup measures: one grouping, one unpivot."""
    stream = F.col("revenue_stream")
    label = F.when(stream == R.STREAM_EMPLOYEE, map_values("product", EMPLOYEE_PRODUCTS, stream)).otherwise(stream)
    sums = []
    for _, local, usd in BUILDUP_LINES:
        if local.startswith("logo"):
            sums.append(F.sum(local).alias(local))
        else:
            sums.append(F.sum(net_money(local)).alias(local))
        if usd:
            sums.append(F.sum(converted(usd)).alias(usd))
    grouped = buildup.filter(F.col("year") >= min_year).groupBy(
        F.col("full_date").cast("date").alias("period"), F.col("service_country").alias("country"),
        F.col("client_segment").alias("segment"), label.alias("revenue_stream"),
    ).agg(*sums)
    return stack_metrics(grouped, KEYS, BUILDUP_LINES)


def cost_lines(cube: DataFrame, min_year: int = 2024, rewards_min_year: int = 2025) -> DataFrame:
    """Cost of goods, rewards cost of goods and overhead in one scan: the three filters exclude each
    other, so a label per row and one grouping are enough."""
    sub, stream = F.col("mgmt_account_subclasification"), F.col("revenue_stream")
    account, department = F.col("management_account_name"), F.col("management_department")
    segment = F.col("holding_segment")
    real = F.col("subversion") == "REAL"
    recent = F.col("year") >= min_year
    direct = (
        (sub == "COGS") & (department == "Sales") & real & recent
        & (((stream == "Employee Benefit") & segment.isin("SME", "Enterprise")) | (stream == "Affinity"))
        & (account != R.COGS_EXCLUDED_ACCOUNT) & (F.col("service_country") != R.HEAD_OFFICE)
    )
    rewards = (
        (sub == "COGS") & (stream == "Rewards") & real & (F.col("version") == "REAL")
        & (F.col("year") >= rewards_min_year)
    )
    overhead = (
        (sub == "SG&A") & (F.col("mgmt_account_classification") == "P&L") & real & recent
        & not_in_list(account, R.SGA_EXCLUDED_ACCOUNTS)
        & (F.col("accounting_account_id") != R.VACATION_ACCOUNT)
    )
    is_rewards = sub.eqNullSafe("COGS") & stream.eqNullSafe("Rewards")
    return cube.filter(direct | rewards | overhead).groupBy(
        first_of("year", "month").alias("period"), F.col("service_country").alias("country"),
        F.when(~is_rewards, map_values(segment, R.COST_SEGMENTS, segment)).alias("segment"),
        F.when(is_rewards, R.STREAM_FINANCIAL).otherwise(map_values(stream, R.COST_STREAMS, stream))
        .alias("revenue_stream"),
        F.when(sub == "COGS", "COGS").otherwise("SGA").alias("pnl_line"),
        F.when(~is_rewards, department).alias("department"),
    ).agg(
        F.sum(money("value_lc")).cast("double").alias("amount_local"),
        F.sum(converted("value_usd_bdg")).cast("double").alias("amount_usd"),
    )


def other_revenue_lines(cube: DataFrame, min_year: int = 2025) -> DataFrame:
    """Revenue outside subscriptions, from the revenue cube."""
    streams = (R.STREAM_FINANCIAL, R.STREAM_OTHER)
    return cube.filter(F.col("revenue_stream").isin(*streams) & (F.col("year") >= min_year)).groupBy(
        first_of("year", "month").alias("period"), F.col("service_country").alias("country"), "revenue_stream"
    ).agg(
        F.sum(net_money("value_lc")).cast("double").alias("amount_local"),
        F.sum(converted("value_usd_bdg")).cast("double").alias("amount_usd"),
    ).withColumn("pnl_line", F.lit("Revenue_EoP"))


def _complete(df: DataFrame, **constants: object) -> DataFrame:
    """Add the columns of the long table a fact set lacks: the given constants, else NULL."""
    absent = [f for f in PNL_SCHEMA if f.name not in df.columns]
    return df.select("*", *[F.lit(constants.get(f.name)).cast(f.dataType).alias(f.name) for f in absent])


def consolidated_pnl(
    t: Tables,
    rules: R.Rules,
    min_year: int = 2024,
    later_min_year: int = 2025,
    bookings_since: dt.date = dt.date(2025, 1, 1),
    engagement_since: dt.date = dt.date(2024, 1, 1),
    store: Store = not_stored,
) -> DataFrame:
    """Revenue movements, logos, members, costs, overhead, bookings, other revenue and engagement
    rates in one long table. Reads the stored buildup, expense and revenue cubes. `store` takes each part, where
    these are computed on the way."""
    rates = engagement_rates(t, engagement_since)
    engagement = stack_metrics(
        rates, KEYS, [("ONB_Rate", "onb_rate", None), ("MAU_Rate", "mau_rate", None)]
    )
    parts = {
        "buildup_lines": buildup_lines(t["buildup_cube"], min_year),
        "cost_lines": cost_lines(t["expense_cube"], min_year, later_min_year),
        "bookings": _complete(booked_mrr(t, rules, bookings_since), pnl_line="Booked_MRR"),
        "other_revenue_lines": other_revenue_lines(t["revenue_cube"], later_min_year),
        "engagement": engagement,
    }
    return conform_union([store(name, _complete(p)) for name, p in parts.items()], PNL_SCHEMA)
