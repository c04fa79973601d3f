"""Currency conversion at the yearly budget rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import safe_divide
from ledgerloom.operators.lookup import Key, lookup


def with_rate(
    df: DataFrame,
    fx: DataFrame,
    date_column: str,
    currency_column: str,
    rate: str = "fx_value",
    any_case: bool = False,
) -> DataFrame:
    """Add the budget rate of the row's year (a text in the rate table) and currency."""
    fold = F.upper if any_case else None
    keys = [
        Key(F.year(date_column).cast("string"), "Year"),
        Key(currency_column, "Currency", left_by=fold, right_by=fold),
    ]
    return lookup(df, fx, keys, {"Value": rate})


def fx_convert(
    df: DataFrame,
    fx: DataFrame,
    value_column: str,
    date_column: str,
    currency_column: str,
    out: str = "value_usd_bdg",
    rate: str = "fx_value",
    any_case: bool = False,
) -> DataFrame:
    """Add the rate and the converted amount; NULL where the rate is missing or zero."""
    rated = with_rate(df, fx, date_column, currency_column, rate, any_case)
    return rated.withColumn(out, safe_divide(value_column, rate))
