"""One row per key: the last one in an order where NULL counts as the largest value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimtide.functions.money import exact_total, to_units


def last_per_key(
    rows: DataFrame, keys: list[str], order: list[str], extra: list[Column]
) -> DataFrame:
    """The `order` columns of each key's largest row, with `extra` aggregates beside them.

    The same row as `row_number() = 1` over `order` descending with nulls first, but as
    a MAX: every task keeps one candidate per key before the shuffle, so a key that
    holds a third of the rows sends one row per task and no task ever ranks it.
    """
    ranked = F.struct(*[
        field
        for c in order
        for field in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c).alias(c))
    ])
    return (
        rows.groupBy(*keys)
        .agg(F.max(ranked).alias("last"), *extra)
        .select("*", *[F.col(f"last.{c}").alias(c) for c in order])
        .drop("last")
    )


def latest_agency(lrd: DataFrame) -> DataFrame:
    """Latest agency type of each policy over the whole fact, with the policy's row count.

    Rows without a policy are one group of their own. The fact is counted by its distinct
    months and agencies first, where strings are only keys and hash; what is ranked after
    that is a few rows per policy.
    """
    distinct = lrd.groupBy("policy_reference", "transaction_month", "agency_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return last_per_key(
        distinct,
        keys=["policy_reference"],
        order=["transaction_month", "agency_type"],
        extra=[F.sum("n").alias("n_rows")],
    ).select("policy_reference", "agency_type", "n_rows")


def incurred_by_cause(lrd: DataFrame) -> DataFrame:
    """Incurred amounts by claim, cause and month over the whole fact; rows without a claim
    are groups like others, which no join finds."""
    return lrd.groupBy("claim_number", "loss_cause_type_name", "transaction_month").agg(
        exact_total(to_units(F.col("incurred_loss_and_alae_ss"))).alias("total_incurred"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def dominant_cause(by_cause: DataFrame) -> DataFrame:
    """Each claim's cause in its latest month: largest incurred first, then name."""
    return last_per_key(
        by_cause,
        keys=["claim_number"],
        order=["transaction_month", "total_incurred", "loss_cause_type_name"],
        extra=[],
    ).select("claim_number", "loss_cause_type_name")
