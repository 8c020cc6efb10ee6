"""The claim level without cause, flags and agency: the same groups and amounts as with them."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from builders import changes, fact, history
from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month
from claimtide.operators.salted_join import Skew
from claimtide.plans import claims
from claimtide.queries import queries

SMALL = "/root/testdata/sf0.001"
HOT = Skew(rows_per_lane=20, least_share=0.001)


def odd_rows(spark):
    """Few policies, claims and months, with several channels and agencies each, and nulls in all."""
    rng = random.Random(7)
    rows = [
        {
            "policy_reference": rng.choice(["P1", "P2", "P3", None]), "claim_number": rng.choice(["C1", "C2", "C3", None]),
            "transaction_month": rng.choice([date(2024, 2, 1), date(2024, 3, 1), None]),
            "channel": rng.choice(["AP Intego", "APIntego", "Digital", "Agency", None]),
            "agency_type": rng.choice(["AP Intego", "Broker", None, "APIntego"]),
            "loss_cause_type_name": rng.choice(["Fire", "Slip", None]), "coverage": rng.choice(["BI", "PD"]),
            "paid_loss": rng.choice([None, 0, 10.5]), "incurred_loss": rng.choice([None, 0, 70_000]),
            "paid_dcce": rng.choice([None, 1]), "incurred_aoe": rng.choice([None, 2]), "paid_subro": rng.choice([None, -3]),
        }
        for _ in range(300)
    ]
    # One channel, missing in a row: the policy's agency decides for both.
    rows += [{"policy_reference": "P9", "claim_number": "C9", "channel": c, "agency_type": "APIntego"} for c in ("AP Intego", None)]
    return fact(spark, *rows)


@pytest.mark.parametrize("skew", [Skew(), HOT])
@pytest.mark.parametrize("net_only", [False, True])
def test_the_same_groups_and_amounts_as_with_the_lookups(spark, skew, net_only):
    lrd = odd_rows(spark).cache()
    legal = legal_flags_by_claim_month(changes(spark), history(spark))
    level = claims.claim_level_units(lrd, latest_agency(lrd), incurred_by_cause(lrd), legal, skew=skew)
    lean = claims.claim_amounts(lrd, net_only=net_only, skew=skew)
    # Raw channels that an agency didn't have to bring together stand as they were.
    columns = [c for c in lean.columns if c not in ("channel", "month_number")]
    assert Counter(lean.select(*columns).collect()) == Counter(level.select(*columns).collect())
    assert ("paid_alae" in columns) != net_only and set(claims.LIMITED) <= set(columns)
    if skew is HOT:
        assert lean.groupBy("claim_number", "month_number").count().count() > 6


def test_an_agency_brings_several_channels_together(spark):
    """Limits are per claim-level row: two rows of 60,000 that become one have 100,000 of it, not 120,000."""
    both = [{"channel": c, "agency_type": a, "incurred_loss": 60_000} for c, a in (("Digital", "AP Intego"), ("Agency", "AP Intego"))]
    apart = [{**row, "policy_reference": "P2", "claim_number": "C2", "agency_type": "Broker"} for row in both]
    level = claims.claim_amounts(fact(spark, *both, *apart), net_only=True)
    found = Counter((r.claim_number, r.reported_loss_ss) for r in level.collect())
    assert found == {("C1", 1_200_000_000): 1, ("C2", 600_000_000): 2}


@pytest.mark.parametrize("name", ["cap_ladder", "capped_case", "net_loss_measures"])
def test_totals_by_year_and_line_move_net_amounts_once(spark, name):
    """One shuffle of the rows, which the question for agencies shares; neither causes nor flags."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    plan = re.sub(r"#\d+L?", "", plan)
    assert "loss_cause_type_name" not in plan and "exposure_id" not in plan
    lines = plan.splitlines()
    wide = [line for line in lines if "paygo_indicator" in line and "ReusedExchange" in line]
    moved = [k for k, line in enumerate(lines) if "+- Exchange hashpartitioning(claim_number, month_number" in line]
    assert wide and len([k for k in moved if "paygo_indicator" in lines[k + 1]]) == 1
    assert "reported_medical_loss" not in plan


def test_agencies_are_not_read_where_no_claim_month_has_several_channels(spark):
    rows = [{"policy_reference": f"P{k}", "claim_number": f"C{k}", "agency_type": "AP Intego"} for k in range(5)]
    frame = claims.claim_amounts(fact(spark, *rows)).agg(F.count("*"))
    assert frame.collect()[0][0] == 5
    final, initial = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")
    assert "agency_type_missing" in initial and "agency_type_missing" not in final
