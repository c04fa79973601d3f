"""Column helpers with a business meaning, composed from the scalar ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.scalars import (
    ColumnLike,
    any_of,
    as_column,
    first_match,
    has_text,
    in_list,
    is_blank,
    map_values,
    safe_divide,
    tax_factor,
)


def document_class(document_type: ColumnLike) -> Column:
    """1 for invoices, bills and credit notes, 0 for provisions, NULL for anything else."""
    kind = as_column(document_type)
    return F.when(kind.isin(*R.ACTUAL_TYPES), 1).when(kind.isin(*R.PROVISIONAL_TYPES), 0)


def document_status(flag: ColumnLike) -> Column:
    return F.when(as_column(flag) == 0, R.STATUS_PROVISIONAL).otherwise(R.STATUS_ACTUAL)


def net_of_tax(value: ColumnLike, currency: ColumnLike) -> Column:
    """Amount after the sales-tax haircut of its currency, exact for exact input."""
    return as_column(value) * tax_factor(currency, R.TAX_FACTORS)


def arpu(value: ColumnLike, quantity: ColumnLike) -> Column:
    return safe_divide(value, quantity)


def country_name(code: ColumnLike) -> Column:
    return map_values(code, R.COUNTRY_NAMES)


def entity_name(code: ColumnLike, prefix: str) -> Column:
    return map_values(code, {k: f"{prefix} {v}" for k, v in R.COUNTRY_NAMES.items()})


def product_bucket(stream: ColumnLike, product: ColumnLike, variant: str) -> Column:
    """Product code used for reporting.

    `merged`  : the main family is one product, other employee products take the default code
    `split`   : main product and add-on stay apart, other employee products take the default code
    `explicit`: as `split`, but only a missing product takes the default code, others become NULL
    """
    s, p = as_column(stream), as_column(product)
    employee = s == R.STREAM_EMPLOYEE
    family = p.isin(*R.MAIN_FAMILY)
    default = F.lit(R.DEFAULT_EMPLOYEE_PRODUCT)
    affinity = (s == R.STREAM_AFFINITY, p)
    if variant == "merged":
        return first_match([(employee & family, F.lit(R.MAIN_PRODUCT)), (employee, default), affinity])
    if variant == "split":
        return first_match([(employee & family, p), (employee, default), affinity])
    if variant == "explicit":
        return first_match([(employee & family, p), (employee & is_blank(p), default), affinity])
    raise ValueError(f"unknown product variant {variant!r}")


def zero_quantity_for(quantity: ColumnLike, product: ColumnLike, addon: str = R.ADDON_PRODUCT) -> Column:
    """The add-on brings revenue but no members."""
    return F.when(as_column(product) == addon, F.lit(0)).otherwise(as_column(quantity))


def corrected_country(country: ColumnLike, transaction_id: ColumnLike, home: str = R.HOME_COUNTRY) -> Column:
    """Company country if it is the home one, else inferred from the id, else a catch-all."""
    by_id = is_blank(country) & any_of(has_text(transaction_id, m) for m in R.LOCAL_ORDER_MARKERS)
    return F.when((as_column(country) == home) | by_id, home).otherwise(R.OTHER_COUNTRY)


def is_internal(name: ColumnLike, prefix: str, names: Sequence[str]) -> Column:
    """Company name starts with the house prefix or is one of the house names (any case)."""
    text = F.lower(as_column(name))
    starts = text.startswith(prefix.lower()) if prefix else F.lit(False)
    return starts | in_list(text, [n.lower() for n in names])


def yes_no(condition: Column) -> Column:
    return F.when(condition, "SI").otherwise("NO")


def reloaded_flag(transaction_id: ColumnLike) -> Column:
    text = F.lower(as_column(transaction_id))
    return yes_no(has_text(text, ".") | has_text(text, "bonus"))


def bonus_transaction_id(transaction_id: ColumnLike) -> Column:
    """Order ids lose everything from the first dot, then from the first comma; other ids stay."""
    source = as_column(transaction_id)
    short = F.substring_index(F.substring_index(source, ".", 1), ",", 1)
    return F.when(source.rlike(R.ORDER_ID_REGEX), short).otherwise(source)
