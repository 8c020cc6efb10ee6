"""Legal status of claims, from a status history kept per exposure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimtide.functions.dimensions import attorney_flag, in_suit_flag
from claimtide.operators.interval_join import interval_left_join
from claimtide.operators.salted_join import Skew

CLAIM_MONTH = ["claim_number", "transaction_month"]


def _days(scd: DataFrame) -> DataFrame:
    return scd.withColumns({
        "first_day": F.to_date("start_datetime"),
        "last_day": F.date_sub(F.to_date("end_datetime"), 1),
    })


def scd_interval_join(changes: DataFrame, scd: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Every change with each status that covers its date; NULL where none does.

    Equal changes are joined once, with their number, and repeated after: they can't be told
    apart, so no spreading would part them.
    """
    ranges = _days(scd).select("exposure_id", "legal_status", "first_day", "last_day")
    distinct = changes.groupBy("claim_number", "exposure_id", "date").agg(
        F.count(F.lit(1)).alias("copies")
    )
    joined = interval_left_join(distinct, ranges, "exposure_id", spread=["claim_number", "date"], skew=skew)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return joined.withColumn("copy", copies).select(
        "claim_number", "exposure_id", "date", "legal_status"
    )


def last_changes(changes: DataFrame) -> DataFrame:
    """Date of the last change per claim, exposure and month."""
    month = F.trunc(F.to_date("date"), "month").alias("transaction_month")
    return changes.groupBy("claim_number", "exposure_id", month).agg(F.max("date").alias("date"))


def _flags_at_last_change(changes: DataFrame, scd: DataFrame, skew: Skew = Skew()) -> DataFrame:
    # A status counts by its day range and flags only, so equal ranges collapse before
    # the join, and again once they are cut to months.
    ranges = (
        _days(scd)
        .groupBy("exposure_id", "first_day", "last_day")
        .agg(
            F.max(in_suit_flag(F.col("legal_status"))).alias("in_suit_flag"),
            F.max(attorney_flag(F.col("legal_status"))).alias("attorney_rep_flag"),
        )
    )
    return interval_left_join(
        last_changes(changes), ranges, "exposure_id", spread=["claim_number", "transaction_month"],
        merged=["in_suit_flag", "attorney_rep_flag"], skew=skew,
    )


def _strongest() -> list[Column]:
    return [
        F.max(F.coalesce(flag, F.lit(0))).alias(flag)
        for flag in ("in_suit_flag", "attorney_rep_flag")
    ]


def legal_month_end(changes: DataFrame, scd: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Status flags at the last change of each claim, exposure and month.

    Several statuses on that date count by the strongest one. A suit implies an
    attorney, so the strongest flags are the flags of the strongest status.
    """
    return (
        _flags_at_last_change(changes, scd, skew=skew)
        .groupBy("claim_number", "exposure_id", "transaction_month", "date")
        .agg(*_strongest())
    )


def legal_flags_by_claim_month(changes: DataFrame, scd: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Flags of a claim in a month: set if they are on any of its exposures.

    A maximum over exposures of maxima over statuses, so one grouping does both.
    """
    return (
        _flags_at_last_change(changes, scd, skew=skew).groupBy(*CLAIM_MONTH).agg(*_strongest())
    )
