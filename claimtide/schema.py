"""Column contracts: the three inputs and the 125-column result."""

from __future__ import annotations

from pyspark.sql import types as T

from claimtide.fixed_values import CAPS

# Decimal places of money: inputs may have fewer, never more.
PLACES = 4
MONEY_IN = T.DecimalType(18, PLACES)
MONEY_OUT = T.DecimalType(38, PLACES)

# What a field's metadata may say: its type is left as it comes, or a time of day is.
AS_GIVEN = "as_given"
MAY_HOLD_TIME = "may_hold_time"


def _fields(kind: T.DataType, names: str, *marks: str) -> list[T.StructField]:
    return [T.StructField(name, kind, metadata=dict.fromkeys(marks, True)) for name in names.split()]


FACT_MONEY = (
    "paid_loss incurred_loss paid_dcce incurred_dcce paid_aoe incurred_aoe "
    "paid_subro paid_salvage incurred_indemnity_loss incurred_medical_loss "
    "incurred_loss_and_alae_ss earned_premium"
)

LRD = T.StructType(
    _fields(T.StringType(), "policy_reference claim_number lob cob_name cob_group channel "
                            "agency_type loss_cause_type_name")
    # Descriptions that are only carried through to the result.
    + _fields(T.StringType(), "state coverage renewal_tag", AS_GIVEN)
    + _fields(T.IntegerType(), "paygo_indicator food_and_bev_express_ind", AS_GIVEN)
    + _fields(T.IntegerType(), "is_bop_policy")
    + _fields(T.DateType(), "accident_month report_month transaction_month "
                            "policy_start_date policy_end_date")
    + _fields(T.IntegerType(), "ay_age py_age ry_age am_age")
    + _fields(MONEY_IN, FACT_MONEY)
)

# A change may carry a time of day, which decides whether a change on the last day of a
# status still falls inside it.
FIN_CHANGES = T.StructType(
    _fields(T.StringType(), "claim_number")
    + _fields(T.LongType(), "exposure_id", AS_GIVEN)
    + _fields(T.DateType(), "date", MAY_HOLD_TIME)
)

LEGAL_SCD = T.StructType(
    _fields(T.LongType(), "exposure_id", AS_GIVEN)
    + _fields(T.StringType(), "legal_status")
    + _fields(T.TimestampNTZType(), "start_datetime end_datetime")
)

# The result's dimensions, in output order.
DIMENSIONS = (
    "claim_number transaction_month lob cob_name cob_group cob_grouping channel state coverage "
    "ay py ry ay_age py_age ry_age am_age loss_cause_type_name paygo_indicator "
    "indemnity_medicalonly current_appetite attorney_represented litigated "
    "food_and_bev_express_ind agency_type renewal_tag bop_policy_flag"
).split()

PREMIUM_MEASURES = ["earned_premium", "earned_policy_years"]


def capped(base: str, caps: dict[str, int] = CAPS) -> list[str]:
    """The limited versions of a measure, one for each cap."""
    return [f"{base}_capped_{level}" for level in caps]


STATUS_COUNTS = (
    "cwp_cc cnp_cc closed_cc open_cc reported_cc nonzero_reported_cc expenseonly_cc "
    "closed_expenseonly_cc closed_nolossorexpense_cc litigated_claim_count "
    "attorney_rep_claim_count litigated_nonzero_claim_count attorney_nonzero_claim_count"
).split()


def large_loss_counts(caps: dict[str, int] = CAPS) -> list[str]:
    return [f"ll_{level}_cc" for level in caps]


def counts(caps: dict[str, int] = CAPS) -> set[str]:
    return {*STATUS_COUNTS, *large_loss_counts(caps)}


def claim_measures(caps: dict[str, int] = CAPS) -> list[str]:
    """The claim measures, in output order."""
    plain = (
        "paid_alae reported_alae paid_loss_ss reported_loss_ss reported_lossandalae_ss "
        "paid_lossandalae_ss case_lossandalae nonzero_reported_loss_ss "
        "nonzero_reported_lossandalae_ss total_ss total_incurred_xss reported_loss "
        "paid_lossalaess_on_closed reported_lossalaessss_on_open paid_lossalaess_on_open "
        "reported_lossss_on_open paid_lossss_on_closed"
    ).split()
    last = "case_loss case_lossalae_on_open case_loss_on_open paid_lossss_on_open".split()
    limited = (
        "paid_lossalaess_on_closed paid_lossss_on_closed reported_lossalaess_on_open "
        "case_lossalae_on_open paid_lossalaess_on_open reported_lossss_on_open "
        "case_loss_on_open paid_lossss_on_open"
    ).split()
    return [
        *STATUS_COUNTS, *plain, *large_loss_counts(caps), *last,
        *(name for base in limited for name in capped(base, caps)),
    ]


COUNTS = counts()
CLAIM_MEASURES = claim_measures()
MEASURES = PREMIUM_MEASURES + CLAIM_MEASURES

_INT_DIMENSIONS = set(
    "ay py ry ay_age py_age ry_age am_age paygo_indicator food_and_bev_express_ind".split()
)


# Dimensions whose type is that of the input.
GIVEN_DIMENSIONS = {f.name for f in LRD if AS_GIVEN in f.metadata}


def output_type(name: str, caps: dict[str, int] = CAPS) -> T.DataType:
    if name == "transaction_month":
        return T.DateType()
    if name in _INT_DIMENSIONS:
        return T.IntegerType()
    if name in DIMENSIONS:
        return T.StringType()
    if name == "earned_policy_years":
        return T.DoubleType()
    return T.LongType() if name in counts(caps) else MONEY_OUT


def output(caps: dict[str, int] = CAPS) -> T.StructType:
    """The result's columns under a set of caps."""
    names = [*DIMENSIONS, *PREMIUM_MEASURES, *claim_measures(caps)]
    return T.StructType([T.StructField(n, output_type(n, caps)) for n in names])


OUTPUT = output()

# The result's sort order.
SORT_ORDER = "ay py ry ay_age py_age ry_age lob bop_policy_flag".split()
