"""The three insurance inputs, derived from order and line-item tables.

The test tables hold no insurance data, so a line item plays a row of the loss and
premium fact, its order the exposure, and a customer's year the policy. Every value
is a function of the whole tables' columns; nothing is sampled or left out.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimtide.schema import FIN_CHANGES, LRD, MONEY_IN


# The tables that the inputs are derived from.
TABLES = ("nation", "customer", "orders", "lineitem")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(number: Column, values: list[str | None]) -> Column:
    """The entry of a fixed list at `number` modulo its length."""
    return F.get(
        F.array(*[F.lit(v).cast("string") for v in values]), F.pmod(number, F.lit(len(values))).cast("int")
    )


# Fixed values of the mapping, by customer key.
_LOB = ["WC", "GL", "CP", "CA", "PL", "IM", "BOP", "WC"]
_COB_NAME = [
    "Tree Services", "Welding, Cutting and Metal Frame Erection", "Masonry Work",
    "Dance Clubs", "Bakery", "Plumbing", "Nail Salons",
]
_COB_GROUP = [
    "Food & beverage", "Food & beverage - deprecated", "Retail", "Retail - deprecated",
    "Professional Services", "Professional Services - deprecated", "Day Care",
    "Construction", "Fitness",
]
_CHANNEL = ["AP Intego", "APIntego", "Digital", "Agency", "Wholesale"]
# By part key.
_AGENCY = ["AP Intego", "Broker", "Captive", None, "APIntego"]
_NO_END = "9999-12-31"


def _insured_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order's and customer's keys under short names.

    Orders meet customers and nations first, so the large table moves once.
    """
    orders = (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.col("o_custkey").alias("k"),
            F.year("o_orderdate").alias("yr"),
            F.col("n_name").alias("state"),
        )
    )
    lines = _table(spark, folder, "lineitem")
    # Shuffled at every size: a file too small to split would keep all that follows in one task.
    joined = lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    year_and_key = F.concat(F.col("k"), F.lit("-"), F.col("yr"))
    k, pk = F.col("k"), F.col("l_partkey")
    return (
        joined.withColumns({
            # Some line items have no policy.
            "policy_reference": F.when(
                (F.col("l_linenumber") == 6) & (F.pmod(k, F.lit(5)) == 0), F.lit(None).cast("string")
            ).otherwise(F.concat(F.lit("P"), year_and_key)),
            "claim_number": F.when(
                F.col("l_returnflag") == "N", F.lit(None).cast("string")
            ).otherwise(F.concat(F.lit("C"), year_and_key)),
            "accident_month": F.make_date(
                F.col("yr"), (1 + F.pmod(k, F.lit(12))).cast("int"), F.lit(1)
            ),
        })
        .withColumn(
            "transaction_month",
            F.add_months("accident_month", (F.pmod(pk, F.lit(6)) - 1).cast("int")),
        )
    )


def fact_and_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The fact's columns, and beside them exposure and date of the row's financial change."""
    lines = _insured_lines(spark, folder).withColumns({
        "q": F.col("l_quantity").cast("int"),
        "n": F.col("l_linenumber"),
        "is_open": F.col("l_linestatus") == "O",
    })
    k, n, q, yr = F.col("k"), F.col("n"), F.col("q"), F.col("yr")

    def money(value: Column) -> Column:
        return value.cast(MONEY_IN)

    zero = F.lit(Decimal("0.00")).cast(MONEY_IN)
    missing = F.lit(None).cast(MONEY_IN)
    amount = money(
        money(F.col("l_extendedprice").cast("decimal(18,2)")) * F.when(n == 7, F.lit(12)).otherwise(F.lit(1))
    )
    lines = lines.withColumns({
        "incurred_loss": F.when(q % 10 == 0, zero).when(q % 10 == 9, missing).otherwise(amount),
        # Allocated amounts have parts of a cent.
        "paid_dcce": F.when(n % 3 == 0, zero).otherwise(money(10 * q + F.lit(Decimal("0.0025")))),
        "paid_aoe": F.when(n == 5, missing).otherwise(money(q)),
        "paid_subro": F.when(q % 7 == 0, money(F.lit(-50))).otherwise(missing),
        "paid_salvage": F.when(q % 11 == 0, money(F.lit(-25))).otherwise(zero),
        "report_month": F.add_months("accident_month", F.pmod(k, F.lit(5)).cast("int")),
        "policy_start_date": F.date_add(
            F.make_date(yr, F.lit(1), F.lit(1)), F.pmod(k, F.lit(28)).cast("int")
        ),
    })
    loss = F.col("incurred_loss")
    tm, am, rm = F.col("transaction_month"), F.col("accident_month"), F.col("report_month")

    def age(year: Column) -> Column:
        return 12 * (F.year(tm) - year) + F.month(tm)

    parts = ["incurred_loss", "paid_dcce", "paid_aoe", "paid_subro", "paid_salvage"]
    net_incurred = money(reduce(Column.__add__, [F.coalesce(F.col(part), zero) for part in parts]))
    lines = lines.withColumns({
        "lob": _pick(k, _LOB),
        "cob_name": _pick(k, _COB_NAME),
        "cob_group": _pick(k, _COB_GROUP),
        "channel": _pick(k, _CHANNEL),
        "agency_type": _pick(F.col("l_partkey"), _AGENCY),
        "loss_cause_type_name": F.when(n == 1, "Slip").when(n == 2, "Fire").when(n == 3, "Theft")
        .when(n == 4, F.lit(None).cast("string")).otherwise("Other"),
        "coverage": F.when(n % 2 == 0, "BI").otherwise("PD"),
        "renewal_tag": F.when(yr == 1995, "New").otherwise("Renewal"),
        "paygo_indicator": F.pmod(k, F.lit(2)),
        "food_and_bev_express_ind": F.when(F.pmod(k, F.lit(9)) < 2, F.pmod(k, F.lit(2))),
        "is_bop_policy": F.when(F.pmod(k, F.lit(3)) == 0, 1).when(F.pmod(k, F.lit(3)) == 1, 0),
        "policy_end_date": F.date_add(
            "policy_start_date", F.when(F.pmod(k, F.lit(6)) == 0, 180).otherwise(365)
        ),
        "ay_age": age(F.year(am)),
        "py_age": age(yr),
        "ry_age": age(F.year(rm)),
        "am_age": age(F.year(am)) - F.month(am) + 1,
        "paid_loss": F.when(~F.col("is_open"), loss).when(q % 4 == 0, zero)
        .otherwise(money(loss - 500)),
        "incurred_dcce": money(
            F.col("paid_dcce") + F.when(F.col("is_open"), F.lit(100)).otherwise(F.lit(0))
        ),
        "incurred_aoe": F.col("paid_aoe"),
        "incurred_indemnity_loss": F.when(n % 2 == 0, loss).otherwise(zero),
        "incurred_medical_loss": F.when(n % 2 == 1, loss).otherwise(zero),
        "incurred_loss_and_alae_ss": net_incurred,
        "earned_premium": money(100 * q + F.pmod(F.col("l_partkey"), F.lit(10_000)) * F.lit(Decimal("0.0001"))),
    })
    return lines.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LRD],
        F.col("l_orderkey").alias("exposure_id"),
        F.date_add(
            "transaction_month", F.pmod(F.col("l_suppkey"), F.lit(28)).cast("int")
        ).alias("date"),
    )


def fact_of(lines: DataFrame) -> DataFrame:
    return lines.select(*LRD.names)


def changes_of(lines: DataFrame) -> DataFrame:
    """One financial change per fact row that has a claim."""
    return lines.filter(F.col("claim_number").isNotNull()).select(*FIN_CHANGES.names)


def lrd(spark: SparkSession, folder: str) -> DataFrame:
    """The loss and premium fact."""
    return fact_of(fact_and_changes(spark, folder))


def fin_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes_of(fact_and_changes(spark, folder))


def legal_scd(spark: SparkSession, folder: str) -> DataFrame:
    """Status history per order: pending orders have an attorney from a morning on, escalate
    after 60 days, and the two statuses overlap for 30 days."""
    opened = F.to_date("o_orderdate")
    morning = F.expr("CAST(to_date(o_orderdate) AS TIMESTAMP_NTZ) + INTERVAL '08:30' HOUR TO MINUTE")

    def status(name: str, first: Column, end: Column) -> Column:
        return F.struct(
            F.lit(name).alias("legal_status"),
            first.cast("timestamp_ntz").alias("start_datetime"),
            end.cast("timestamp_ntz").alias("end_datetime"),
        )

    no_end = F.lit(_NO_END).cast("date")
    escalated = F.date_add(opened, 60)
    history = F.when(
        F.col("o_orderstatus") == "P",
        F.array(
            status("attorney rep", morning, F.date_add(escalated, 30)),
            status("in suit", escalated, no_end),
        ),
    ).when(F.col("o_orderstatus") == "F", F.array(status("none", opened, no_end)))
    return (
        _table(spark, folder, "orders")
        .select(F.col("o_orderkey").alias("exposure_id"), F.explode(history).alias("h"))
        .select("exposure_id", "h.*")
    )
