"""Plan shape: what is read, pushed, reused and never done."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month
from claimtide.operators.salted_join import Skew
from claimtide.plans import claims, premium
from claimtide.plans.emergence import emergence
from claimtide.queries import queries
from claimtide.sources import driver_tables
from conftest import SMALL


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture()
def shuffled_joins(spark):
    """Plans as they are for tables too large to broadcast."""
    saved = {
        k: spark.conf.get(k)
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in saved.items():
        spark.conf.set(key, value)


def branches(small, skew):
    agency, by_cause = latest_agency(small.lrd), incurred_by_cause(small.lrd)
    legal = legal_flags_by_claim_month(small.fin_changes, small.legal_scd, skew)
    return (
        claims.claims_branch(small.lrd, agency, by_cause, legal, skew),
        premium.premium_branch(small.lrd, agency, skew),
    )


@pytest.mark.parametrize("skew", [Skew(), Skew(rows_per_lane=5)])
def test_no_cross_product_and_no_python(small, shuffled_joins, skew):
    plan = plan_of(emergence(small.lrd, small.fin_changes, small.legal_scd, skew))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


def test_filters_and_columns_reach_the_scan(small):
    plan = plan_of(claims.summed_rows(small.lrd))
    assert "In(lob, [CA,CP,GL,IM,PL,WC])" in plan
    assert "GreaterThan(ay_age,0)" in plan and "IsNotNull(claim_number)" in plan
    agency = plan_of(latest_agency(small.lrd))
    assert "ReadSchema: struct<policy_reference:string,agency_type:string,transaction_month:date>" \
        in agency


@pytest.mark.parametrize("skew", [Skew(), Skew(rows_per_lane=5)])
def test_claim_level_and_result_run_inside_the_last_join(small, shuffled_joins, skew):
    """The top of the claims plan: project and two groupings, no shuffle down to the join."""
    plan = plan_of(branches(small, skew)[0])
    top = plan[: plan.index("SortMergeJoin")]
    assert top.count("HashAggregate") == 4 and "Exchange" not in top


def test_the_last_shuffle_of_cold_rows_is_by_claim_and_month(small, shuffled_joins):
    plan = plan_of(branches(small, Skew())[0])
    below = plan[plan.index("SortMergeJoin"):]
    first = next(line for line in below.splitlines() if "Exchange hashpartitioning" in line)
    assert "claim_number" in first and "month_number" in first


def test_hot_claim_months_are_shuffled_by_all_keys(small, shuffled_joins):
    """Of the claim level of hot claim months, policy and accident month are part of the shuffle."""
    inputs = (small.lrd, latest_agency(small.lrd), incurred_by_cause(small.lrd),
              legal_flags_by_claim_month(small.fin_changes, small.legal_scd))
    first = next(line for line in plan_of(claims.claim_level_parts(*inputs)[1]).splitlines() if "Exchange hashpartitioning" in line)
    assert all(column in first for column in ("policy_reference", "accident_month", "claim_number", "coverage"))


def test_each_input_is_scanned_once_for_each_use(spark, small, shuffled_joins):
    """The fact five times (claims, causes, agencies, premium, and the rows of hot claim months), the
    changes and the history once: weights and lookups share what they group."""
    plan = plan_of(emergence(*small))
    assert plan.count("FileScan") == 7
    assert plan_of(legal_flags_by_claim_month(small.fin_changes, small.legal_scd)).count("FileScan") == 2


def test_the_branch_of_hot_claim_months_is_left_out_where_there_are_none(spark, small):
    result = emergence(*small)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString()
    final, initial = final.split("== Initial Plan ==", 1)
    of_claim_rows = re.compile(r"FileScan parquet \[policy_reference#\d+,claim_number")
    assert len(of_claim_rows.findall(final)) == 1 and len(of_claim_rows.findall(initial)) > 1


def test_premium_sums_are_shuffled_once(small, shuffled_joins):
    plan = plan_of(branches(small, Skew())[1])
    assert plan.count("sum(cast((earned_premium") == 3 and "ReusedExchange" in plan


def test_exposure_and_premium_share_one_scan(spark, shuffled_joins):
    plan = plan_of(queries()["earned_exposure_incremental"](spark, SMALL))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_latest_agency_hashes_the_fact(small):
    """The grouping next to the scan hashes; what is sorted after it is a few rows a policy."""
    lines = plan_of(latest_agency(small.lrd)).splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line)
    above = next(line for line in reversed(lines[:scan]) if "Aggregate" in line)
    assert "HashAggregate" in above and "SortAggregate" not in above


def test_hot_keys_need_no_sort_or_limit(small, shuffled_joins):
    plan = plan_of(emergence(*small))
    assert "TakeOrderedAndProject" not in plan and plan.count("BroadcastHashJoin") >= 6


def shuffles(plan: str) -> list[str]:
    return [line for line in re.sub(r"#\d+L?", "", plan).splitlines() if "+- Exchange hashpartitioning" in line]


def test_premium_rows_are_shuffled_by_all_keys_and_by_policy_only(small, shuffled_joins):
    """Terms are differenced and agencies looked up where the rows lie by policy: of the shuffles of
    premium rows, one is by raw keys, one by policy and lane, one by result keys."""
    plan = shuffles(plan_of(branches(small, Skew())[1]))
    assert not [line for line in plan if "(policy_reference, transaction_month, policy_start_date, policy_end_date, 2)" in line]
    assert len([line for line in plan if "(policy_reference, lane, 2)" in line]) == 1
    assert len([line for line in plan if "renewal_tag" in line]) == 2


def test_rows_of_cold_claim_months_are_not_shuffled_by_all_keys(small, shuffled_joins):
    agency, by_cause = latest_agency(small.lrd), incurred_by_cause(small.lrd)
    legal = legal_flags_by_claim_month(small.fin_changes, small.legal_scd)
    cold, _ = claims.claim_level_parts(small.lrd, agency, by_cause, legal)
    assert not [line for line in shuffles(plan_of(cold)) if "coverage" in line]


def test_hot_exposures_are_found_without_shuffling_all(small, shuffled_joins):
    """A count by exposure only comes after the exposures of small hashes are left out."""
    plan = plan_of(legal_flags_by_claim_month(small.fin_changes, small.legal_scd))
    lines = re.sub(r"#\d+L?", "", plan).splitlines()
    counts = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(exposure_id, 2)" in line and "Reused" not in line]
    assert counts and all(any("hash_bucket" in line for line in lines[k:k + 8]) for k in counts)


@pytest.mark.parametrize("name", ["final_rollup", "ordered_output"])
def test_the_result_is_shuffled_in_units(spark, name):
    """No decimal of the output goes through a shuffle of whole rows."""
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Project" and "decimal(38,4)" in plan.schema().catalogString()
    assert "decimal" not in plan.children().apply(0).schema().catalogString()


def test_stored_rows_are_made_by_methods_that_the_jvm_compiles(spark, shuffled_joins):
    """It interprets methods of 8,000 bytes and more."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        driver_tables.fact_and_changes(spark, SMALL).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_only_policies_of_claim_months_are_shuffled_by_policy(small, shuffled_joins):
    """The amounts of cold claim months move once: by claim and month."""
    agency, by_cause = latest_agency(small.lrd), incurred_by_cause(small.lrd)
    legal = legal_flags_by_claim_month(small.fin_changes, small.legal_scd)
    cold, _ = claims.claim_level_parts(small.lrd, agency, by_cause, legal)
    lines = re.sub(r"#\d+L?", "", plan_of(cold)).splitlines()
    by_policy = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(policy_reference, lane" in line]
    assert by_policy and not [k for k in by_policy if "paygo_indicator" in lines[k + 1]]
    assert [line for line in lines if "ReusedExchange" in line and "paygo_indicator" in line]
