"""Rule lists turned into labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import rules as R
from ledgerloom.functions.scalars import all_of, first_match, in_list

AccountRule = tuple[str, Sequence[str], Sequence[str] | None]


def classify(
    rules: Sequence[AccountRule], account: str = "management_account_name", department: str = "management_department"
) -> Column:
    """Label of the first rule matching account and department; NULL when none does."""
    pairs = []
    for label, accounts, departments in rules:
        tests = [F.col(account).isin(*accounts)]
        if departments is not None:
            tests.append(F.col(department).isin(*departments))
        pairs.append((all_of(tests), F.lit(label)))
    return first_match(pairs)


def cost_type(sub_type: str = "sub_type") -> Column:
    return F.when(F.col(sub_type).isin(*R.INITIATIVE_SUBTYPES), "initiatives").otherwise("other")


def allocation_tag(segment: str = "holding_segment") -> Column:
    """Whether a cost still has to be spread over segments. NULL for any other segment."""
    text = F.upper(F.col(segment))
    return F.when(text == R.NO_SEGMENT.upper(), "distribuible").when(
        text.isin("ENTERPRISE", "SME"), "no_distribuible"
    )


def attribution_category(
    stream: str = "revenue_stream", segment: str = "holding_segment", country: str = "service_country"
) -> Column:
    """Older attribution rules, one set per stream, in one pass. NULL for streams without rules."""
    head = F.col(country) == R.HEAD_OFFICE
    elsewhere = F.col(country) != R.HEAD_OFFICE
    open_segment = F.col(segment) == R.NO_SEGMENT
    corporate, local, direct = "no_atribuible_pais_corp", "no_atribuible", "atribuible"
    employee = (
        F.when(open_segment & elsewhere, local)
        .when(in_list(segment, ("SMB", "Enterprise", R.NO_SEGMENT)) & head, corporate)
        .otherwise(direct)
    )
    affinity = F.when(head, corporate).otherwise(direct)
    unassigned = F.when(open_segment & elsewhere, local).when(head, corporate).otherwise(direct)
    return (
        F.when(F.col(stream) == "Employee Benefit", employee)
        .when(F.col(stream) == "Affinity", affinity)
        .when(F.col(stream) == "N/R", unassigned)
    )


def attribution_label(category: str) -> Column:
    c = F.col(category)
    return (
        F.when(c == "atribuible", "Local")
        .when(c == "no_atribuible", "Distribuido local")
        .when(c == "no_atribuible_pais_corp", "Corp")
    )
