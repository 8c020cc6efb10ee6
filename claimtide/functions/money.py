"""Money as whole units of a ten-thousandth.

Amounts come in as decimals with at most four places and leave as decimal(38,4). In between
they are 64-bit integers: a decimal wider than 18 digits is a heap object in every
addition and 24 bytes in every shuffled row, where a long is 8 bytes and stays in a
register. Nothing is rounded, row by row or after.

Where few sums are needed, `exact_total` adds a high and a low part of the units apart: exact at
any size, in any session. The branches, with their scores of sums, add one long each: exact up
to 9.2e14 currency units per group, and anything beyond is an error in ANSI mode, which
`require_exact_sums` asks for, as without it Spark would wrap around silently.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, SparkSession, functions as F, types as T

from claimtide.schema import MONEY_IN, MONEY_OUT, PLACES

UNIT = 10**PLACES
_ONE = Decimal(1).scaleb(-PLACES)

# Units that no addition can leave, as wide as a product with `_ONE` allows.
WIDE_UNITS = T.DecimalType(33, 0)
_WIDE = T.DecimalType(20, 0)


def require_exact_sums(spark: SparkSession) -> None:
    """Raises, when a plan is built, in a session where an overflow would go unseen."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise ValueError("money is summed in 64 bits: set spark.sql.ansi.enabled to true, or sums could overflow unseen")


def exact_total(units: Column) -> Column:
    """The sum of 64-bit units as a decimal, in two parts that can't overflow below 2^31 rows a
    group times 2^32: each unit is high * 2^32 + low with a low part that isn't negative."""
    high, low = F.sum(F.shiftright(units, 32)), F.sum(units.bitwiseAND(F.lit(2**32 - 1)))
    return (high.cast(_WIDE) * F.lit(Decimal(2**32)) + low.cast(_WIDE)).cast(WIDE_UNITS)


def exact_decimal(amount: Column, kind: T.DataType) -> Column:
    """A floating-point amount as the decimal that it stands for; an error, when it is read, for one
    with more places than money has."""
    exact = amount.cast(MONEY_IN)
    refused = F.raise_error(F.concat(F.lit("not an amount of money: "), amount.cast("string")))
    return F.when(amount.isNull() | (exact.cast(kind) == amount), exact).otherwise(refused.cast(MONEY_IN))


def to_units(amount: Column) -> Column:
    return (amount.cast(MONEY_IN) * UNIT).cast("bigint")


def from_units_sql(units: str) -> str:
    return f"CAST(CAST({units} AS {WIDE_UNITS.simpleString()}) * {_ONE:f}BD AS {MONEY_OUT.simpleString()})"


def from_units(units: Column) -> Column:
    return (units.cast(WIDE_UNITS) * F.lit(_ONE)).cast(MONEY_OUT)


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast("bigint"))
