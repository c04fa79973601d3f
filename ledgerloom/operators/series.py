"""Monthly series: gap filling, neighbouring periods, movement decomposition, cumulative totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def gap_fill(
    df: DataFrame, ts: str, partition_by: Sequence[str], values: Sequence[str], step: str = "1 month"
) -> DataFrame:
    """Emit every step between a series' first and last row; measures are NULL in the gaps.

    One window per series and an explode, no join. `ts` must be a date on the step's grid, one row
    per series and step, as a grouping in front gives. NULL partition keys form series of their own.
    """
    series = Window.partitionBy(*partition_by).orderBy(ts)
    upcoming = F.lead(ts).over(series)
    interval = F.expr(f"INTERVAL {step}")
    last = F.greatest(F.col(ts), (upcoming - interval).cast("date"))
    steps = F.sequence(F.col(ts), F.coalesce(last, F.col(ts)), interval)
    keep = [c for c in df.columns if c != ts and c not in values]
    filled = df.withColumn("__steps", steps).select(
        *keep, *values, F.posexplode("__steps").alias("__pos", ts)
    )
    measures = [F.when(F.col("__pos") == 0, F.col(v)).alias(v) for v in values]
    return filled.select(ts, *keep, *measures)


def period_context(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    measures: Sequence[str],
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Add begin-of-period, two-back and next value of each measure.

    `<m>_bop` and `<m>_bop2` are 0 where there is no earlier row; `<m>_next` is NULL in the last
    one. All nine share one window. `tie_break` completes the order when the keys are coarser than
    the grain of `df`.
    """
    w = Window.partitionBy(*keys).orderBy(order, *tie_break)
    added = []
    for m in measures:
        zero = F.lit(0).cast(df.schema[m].dataType)
        added.append(F.coalesce(F.lag(m, 1).over(w), zero).alias(f"{m}_bop"))
        added.append(F.coalesce(F.lag(m, 2).over(w), zero).alias(f"{m}_bop2"))
        added.append(F.lead(m, 1).over(w).alias(f"{m}_next"))
    return df.select("*", *added)


def movement(
    measure: str,
    invoice_number: str = "invoice_number",
    new_after_gap: bool = False,
    ignore_negative: bool = False,
    churn_when: Column | None = None,
) -> dict[str, Column]:
    """Split a period's change into new, retention and churn.

    New business is counted up to the second month after the cohort, against an opening balance:
    none in the cohort month, last month's value in month 1, and in month 2 last month's value or,
    across a zero month, the one before. `new_after_gap` counts month 2 in full when both are zero.
    Retention takes decreases in months 1 and 2 and any change later. Churn is the value of the last
    period; `ignore_negative` books no churn for a negative value.
    """
    n = F.col(invoice_number)
    now, bop, bop2 = F.col(measure), F.col(f"{measure}_bop"), F.col(f"{measure}_bop2")
    zero = F.lit(0)

    second = F.when(bop > 0, bop).when((bop == 0) & (bop2 > 0), bop2)
    if new_after_gap:
        second = second.when((bop == 0) & (bop2 == 0), zero)
    opening = F.when(n == 1, bop).when(n == 2, second)
    gained = F.greatest(now - opening, zero)
    new = F.when(n == 0, now).otherwise(gained)

    change = now - bop
    retention = F.when(n > 2, change).when(n.isin(1, 2), F.least(change, zero)).otherwise(zero)

    ended = F.col(f"{measure}_next").isNull() if churn_when is None else churn_when
    lost = F.greatest(now, zero) if ignore_negative else now
    churn = F.when(ended, lost).otherwise(zero)
    return {"new": new, "retention": retention, "churn": churn}


def linked_end(measure: str, main: str, addon: str, sibling: str, product: str = "product") -> Column:
    """Churn condition of two linked products: the main one ends with its own series, the add-on
    only when the main one (`sibling` holds its next value) has ended. Others never churn."""
    p = F.col(product)
    own = F.col(f"{measure}_next").isNull()
    return F.coalesce(((p == main) & own) | ((p == addon) & F.col(sibling).isNull()), F.lit(False))


def sibling_value(keys: Sequence[str], condition: Column, value: Column) -> Column:
    """Value of the row of a group that satisfies `condition`, seen from all its rows. Meant for
    groups of a few rows, such as the products of one holding in one month."""
    return F.max(F.when(condition, value)).over(Window.partitionBy(*keys))


def logo_counts(
    date: str = "full_date",
    cohort: str = "holding_cohort",
    invoice_number: str = "invoice_number",
    next_value: str = "value_lc_next",
    exclude: str | None = None,
    only_churn: str | None = None,
    product: str = "product",
) -> dict[str, Column]:
    """Client counters per row: begin, new, churned, end of period.

    `exclude` names a product that is never counted; a missing product is then not counted as new
    or churned either. `only_churn` restricts churn to one product. The begin-of-period counter
    depends on the invoice number alone, so it is 1 in the cohort month as well.
    """
    one, zero = F.lit(1), F.lit(0)
    counted = F.lit(True) if exclude is None else F.coalesce(F.col(product) != exclude, F.lit(False))
    is_excluded = F.lit(False) if exclude is None else F.coalesce(F.col(product) == exclude, F.lit(False))
    ends = F.col(next_value).isNull()
    churns = ends & (counted if only_churn is None else F.coalesce(F.col(product) == only_churn, F.lit(False)))
    before_cohort = F.coalesce(F.col(invoice_number) < 0, F.lit(False))
    not_started = F.coalesce(F.col(date) < F.col(cohort), F.lit(False))
    counters = {
        "logo_bop": F.when(before_cohort | is_excluded, zero).otherwise(one),
        "logo_new": F.when((F.col(invoice_number) == 0) & counted, one).otherwise(zero),
        "logo_churn": F.when(churns, one).otherwise(zero),
        "logo_eop": F.when(not_started | is_excluded, zero).otherwise(one),
    }
    return {name: c.cast("long") for name, c in counters.items()}


def cohort_from_first(
    df: DataFrame, keys: Sequence[str], date: str, name: str = "holding_cohort"
) -> DataFrame:
    """Cohort = first date seen for the keys, on rows already summed per month: a group then has no
    more rows than months times a few codes, and one pass over the source is enough."""
    return df.withColumn(name, F.min(date).over(Window.partitionBy(*keys)))


def cumulative_by_calendar(
    df: DataFrame,
    months: DataFrame,
    month: str,
    measures: Mapping[str, str],
    name: str = "kpi",
    value: str = "val_total",
) -> DataFrame:
    """Running total of each measure at every calendar month, over all earlier rows.

    `measures` maps a measure column to its output label. Rows are summed per month first; the
    running sum then walks over months only, not over rows. Activity from before the calendar
    counts. Calendar months without activity appear once there is any earlier activity; months
    outside the calendar do not appear.
    """
    columns = list(measures)
    monthly = df.groupBy(F.col(month).alias("month")).agg(
        *[F.sum(c).alias(c) for c in columns], F.count(F.lit(1)).alias("__rows")
    )
    marks = months.select(F.col("month"), F.lit(True).alias("__listed"))
    grid = monthly.join(marks, "month", "full").select(
        "month",
        *columns,
        F.coalesce("__rows", F.lit(0)).alias("__rows"),
        F.coalesce("__listed", F.lit(False)).alias("__listed"),
    )
    pairs = ", ".join(f"'{label}', `{c}`" for c, label in measures.items())
    tall = grid.selectExpr("month", "__rows", "__listed", f"stack({len(columns)}, {pairs}) AS ({name}, __v)")
    w = Window.partitionBy(name).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    running = tall.select(
        "month", name, "__listed", F.sum("__v").over(w).alias(value), F.sum("__rows").over(w).alias("__seen")
    )
    return running.filter(F.col("__listed") & (F.col("__seen") > 0)).select("month", name, value)


def stack_metrics(
    df: DataFrame, keys: Sequence[str], lines: Sequence[tuple[str, str, str | None]]
) -> DataFrame:
    """Unpivot measures into (line, local amount, USD amount) rows in one pass over `df`.

    Each entry of `lines`: label, local column, USD column or None for no USD amount.
    """
    parts = []
    for label, local, usd in lines:
        usd_expr = f"CAST(`{usd}` AS DOUBLE)" if usd else "CAST(NULL AS DOUBLE)"
        parts.append(f"'{label}', CAST(`{local}` AS DOUBLE), {usd_expr}")
    spec = f"stack({len(lines)}, {', '.join(parts)}) AS (pnl_line, amount_local, amount_usd)"
    return df.selectExpr(*[f"`{k}`" for k in keys], spec)

