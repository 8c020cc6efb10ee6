"""Inline rows for the three inputs: give what matters, the rest has plain defaults."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month
from claimtide.operators.salted_join import Skew
from claimtide.plans import claims
from claimtide.schema import FACT_MONEY, FIN_CHANGES, LEGAL_SCD, LRD

_DEFAULTS = {
    "policy_reference": "P1", "claim_number": "C1", "lob": "GL", "cob_name": "Bakery",
    "cob_group": "Fitness", "channel": "Digital", "agency_type": "Broker",
    "loss_cause_type_name": "Fire", "state": "NY", "coverage": "BI", "renewal_tag": "New",
    "paygo_indicator": 0, "food_and_bev_express_ind": 0, "is_bop_policy": 0,
    "accident_month": date(2024, 1, 1), "report_month": date(2024, 1, 1),
    "transaction_month": date(2024, 2, 1), "policy_start_date": date(2024, 1, 15),
    "policy_end_date": date(2025, 1, 14), "ay_age": 2, "py_age": 2, "ry_age": 2, "am_age": 2,
}


def fact(spark, *rows):
    def value(row, name):
        given = row.get(name, _DEFAULTS.get(name))
        if name in FACT_MONEY.split():
            given = row.get(name, 0)
            return None if given is None else Decimal(str(given)).quantize(Decimal("0.0001"))
        return given

    return spark.createDataFrame([[value(r, f.name) for f in LRD] for r in rows], LRD)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), FIN_CHANGES)


def history(spark, *rows):
    return spark.createDataFrame(list(rows), LEGAL_SCD)


PLAIN = Skew()

FOREVER = datetime(9999, 12, 31)


def claim_level(spark, lrd, fin=None, scd=None):
    fin = fin if fin is not None else changes(spark)
    scd = scd if scd is not None else history(spark)
    return claims.claim_level(
        lrd, latest_agency(lrd), incurred_by_cause(lrd),
        legal_flags_by_claim_month(fin, scd, PLAIN), PLAIN,
    )


def claims_branch(spark, lrd, fin=None, scd=None):
    fin = fin if fin is not None else changes(spark)
    scd = scd if scd is not None else history(spark)
    return claims.claims_branch(
        lrd, latest_agency(lrd), incurred_by_cause(lrd),
        legal_flags_by_claim_month(fin, scd, PLAIN), PLAIN,
    )
