"""Column-to-column helpers. Everything here is a built-in Spark expression."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Money is summed exactly and turned into a double once, at the end of a plan.
MONEY = T.DecimalType(18, 4)
# Net amounts carry six decimals: four of the amount, two of the haircut.
NET_MONEY = T.DecimalType(28, 6)
# Quotients of a currency conversion keep ten decimals until they are summed.
CONVERTED = T.DecimalType(24, 10)


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of the conditions; true when there are none."""
    out = None
    for condition in conditions:
        out = condition if out is None else out & condition
    return F.lit(True) if out is None else out


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions; false when there are none."""
    out = None
    for condition in conditions:
        out = condition if out is None else out | condition
    return F.lit(False) if out is None else out


# ---- numbers ---------------------------------------------------------------------------------------


def money(c: ColumnLike) -> Column:
    """Exact amount with four decimals."""
    return as_column(c).cast(MONEY)


def net_money(c: ColumnLike) -> Column:
    """Exact net amount with six decimals."""
    return as_column(c).cast(NET_MONEY)


def converted(c: ColumnLike) -> Column:
    """Converted amount with ten decimals, so that many tiny ones add up."""
    return as_column(c).cast(CONVERTED)


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Floating ratio, NULL when the denominator is zero or NULL."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def to_long(c: ColumnLike) -> Column:
    """Float to integer, rounding half away from zero (a plain cast would truncate)."""
    return F.round(as_column(c)).cast("long")


def text_to_long(c: ColumnLike) -> Column:
    """Text holding a number to integer, rounding half away from zero, exact for all digits; NULL when it is no number
    or too large."""
    return F.round(as_column(c).try_cast("decimal(38,18)")).try_cast("long")


def tax_factor(currency: ColumnLike, factors: Mapping[str, str]) -> Column:
    """Exact multiplier by currency, 1 for currencies without a rule."""
    out = None
    for code, factor in factors.items():
        value = F.lit(Decimal(factor)).cast("decimal(5,4)")
        hit = as_column(currency) == code
        out = F.when(hit, value) if out is None else out.when(hit, value)
    one = F.lit(Decimal("1")).cast("decimal(5,4)")
    return one if out is None else out.otherwise(one)


# ---- conditional picks -----------------------------------------------------------------------------


def map_values(c: ColumnLike, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Look a value up in a small code map; `default` (NULL if unset) when it is not listed."""
    source = as_column(c)
    out = None
    for key, value in mapping.items():
        hit = source == key
        out = F.when(hit, value) if out is None else out.when(hit, value)
    fallback = F.lit(None).cast("string") if default is None else default
    return fallback if out is None else out.otherwise(fallback)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first rule whose condition is true. Rules are tried in order."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        return F.lit(default) if not isinstance(default, Column) else default
    return out if default is None else out.otherwise(default)


def like_first_match(
    c: ColumnLike, patterns: Sequence[tuple[str, str]], default: Column | None = None
) -> Column:
    """Label of the first LIKE pattern the upper-cased text matches."""
    text = F.upper(as_column(c))
    return first_match([(text.like(p), F.lit(v)) for p, v in patterns], default)


# ---- predicates ------------------------------------------------------------------------------------


def is_blank(c: ColumnLike) -> Column:
    return as_column(c).isNull() | (as_column(c) == "")


def not_like_any(c: ColumnLike, patterns: Iterable[str]) -> Column:
    """Lower-cased text matches none of the patterns. NULL stays NULL, so a filter drops it."""
    return all_of(~F.lower(as_column(c)).like(p) for p in patterns)


def not_like_any_or_null(c: ColumnLike, patterns: Iterable[str]) -> Column:
    """Like `not_like_any`, but NULL passes."""
    return not_like_any(c, patterns) | as_column(c).isNull()


def not_in_or_null(c: ColumnLike, values: Sequence[str]) -> Column:
    return (~as_column(c).isin(*values)) | as_column(c).isNull()


def in_list(c: ColumnLike, values: Sequence[str]) -> Column:
    """IN over a literal list; an empty list is false for every known value."""
    source = as_column(c)
    return source.isin(*values) if values else F.lit(False)


def not_in_list(c: ColumnLike, values: Sequence[str]) -> Column:
    """NOT IN over a literal list. NULL is dropped even by an empty list, as `<>` would."""
    source = as_column(c)
    return ~source.isin(*values) if values else source.isNotNull()


# ---- text ------------------------------------------------------------------------------------------


def normalize_id(c: ColumnLike, strip: str = ".-") -> Column:
    """Upper-case an identifier and remove punctuation."""
    return F.translate(F.upper(as_column(c)), strip, "")


def strip_chars(c: ColumnLike, strip: str) -> Column:
    return F.translate(as_column(c), strip, "")


def before(c: ColumnLike, separator: str) -> Column:
    """Text in front of the first separator (all of it when there is none)."""
    return F.substring_index(as_column(c), separator, 1)


def has_text(c: ColumnLike, part: str) -> Column:
    return F.instr(as_column(c), part) > 0


def clean_order_id(c: ColumnLike) -> Column:
    """First run of 13 digits, else first run of 6 digits, as an integer; NULL when neither occurs."""
    source = as_column(c)
    return F.coalesce(
        F.regexp_substr(source, F.lit(r"\d{13}")), F.regexp_substr(source, F.lit(r"\d{6}"))
    ).cast("long")


def with_json(df: DataFrame, name: str) -> DataFrame:
    """JSON text of a column parsed into a variant of the same name, malformed text into NULL. Generating it keeps
    the optimizer from parsing again for each use."""
    parsed = F.explode(F.array(F.try_parse_json(name))).alias("__json")
    return df.select("*", parsed).drop(name).withColumnRenamed("__json", name)


def json_value(c: ColumnLike, path: str) -> Column:
    """Scalar at a path of a parsed document as text. Objects, arrays, JSON null and malformed text give NULL."""
    document = as_column(c)
    node = F.try_variant_get(document, path, "variant")
    kind = F.schema_of_variant(node)
    nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    return F.when(~nested, F.try_variant_get(document, path, "string"))


# ---- dates -----------------------------------------------------------------------------------------


def today(as_of: dt.date | None = None) -> Column:
    """The reporting date: the given one, else the current date."""
    return F.current_date() if as_of is None else F.lit(as_of)


def month_start(c: ColumnLike) -> Column:
    return F.trunc(as_column(c).cast("date"), "MONTH")


def year_of(c: ColumnLike) -> Column:
    return F.year(as_column(c)).cast("long")


def month_of(c: ColumnLike) -> Column:
    return F.month(as_column(c)).cast("long")


def year_month(c: ColumnLike) -> Column:
    """yyyyMM as an integer."""
    source = as_column(c)
    return (F.year(source) * 100 + F.month(source)).cast("long")


def first_of(year: ColumnLike, month: ColumnLike) -> Column:
    return F.make_date(as_column(year).cast("int"), as_column(month).cast("int"), F.lit(1))


def first_full_month(day: dt.date) -> dt.date:
    """First month start not before a date: dates from it on are those whose month start is."""
    if day.day == 1:
        return day
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


def months_since(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Number of month boundaries between two dates."""
    a, b = as_column(later), as_column(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("long")


def local_datetime(c: ColumnLike, zone: str, source_zone: str = "UTC") -> Column:
    """Zone-less date-time of an instant in a named zone. Zone-less input is read as `source_zone`;
    a TIMESTAMP input is first taken in the session zone, which the package sets to UTC."""
    ntz = as_column(c).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ntz)
