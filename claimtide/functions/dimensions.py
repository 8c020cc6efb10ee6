"""Descriptive columns of the result (pure column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimtide import fixed_values as V


def cob_grouping(cob_group: Column, cob_name: Column) -> Column:
    """Reporting group of a class of business; the first rule that matches wins.

    A construction class name beats only the construction group and the default.
    """
    by_group = [(g, label) for g, label in V.GROUP_OF_COB_GROUP.items()]
    expr = None
    for label in dict.fromkeys(label for _, label in by_group):
        groups = [g for g, l in by_group if l == label]
        hit = cob_group.isin(groups)
        if label == "Construction":
            hit = cob_name.isin(V.CONSTRUCTION_COB_NAMES) | hit
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(V.OTHER_GROUP)


def partner_spelling(channel: Column) -> Column:
    """Both spellings of the partner channel become one."""
    return F.when(channel.isin(V.PARTNER_SPELLINGS), V.PARTNER_CHANNEL).otherwise(channel)


def channel_of(agency_type: Column, channel: Column) -> Column:
    """The partner's agencies sell through the partner's channel, whatever the row says."""
    return F.when(agency_type.isin(V.PARTNER_SPELLINGS), V.PARTNER_CHANNEL).otherwise(
        partner_spelling(channel)
    )


def bop_policy_flag(is_bop_policy: Column) -> Column:
    return F.when(is_bop_policy == 1, V.BOP_LABEL).otherwise(V.NOT_BOP_LABEL)


def repaired_report_age(ry_age: Column, ay_age: Column) -> Column:
    """A report age below zero is replaced by the accident age; NULL stays NULL."""
    return F.when(ry_age < 0, ay_age).otherwise(ry_age)


def yes_no(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").otherwise("No")


def injury_type(lob: Column, indemnity: Column, medical: Column) -> Column:
    """Workers compensation only; NULL elsewhere."""
    kind = (
        F.when(indemnity > 0, "Indemnity")
        .when(medical > 0, "Medical Only")
        .otherwise("Expense Only")
    )
    return F.when(lob == "WC", kind)


def appetite(lob: Column, cob_name: Column) -> Column:
    """Workers compensation only; NULL elsewhere."""
    label = F.when(cob_name.isin(V.WC_OUT_OF_APPETITE), "Not in appetite").otherwise("In appetite")
    return F.when(lob == "WC", label)


def attorney_flag(legal_status: Column) -> Column:
    return F.when(legal_status.isin(V.ATTORNEY_STATUSES), 1).otherwise(0)


def in_suit_flag(legal_status: Column) -> Column:
    return F.when(legal_status == V.IN_SUIT, 1).otherwise(0)
