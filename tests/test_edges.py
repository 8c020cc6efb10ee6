"""Hand-computed answers for the rows where engines and intuitions differ."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from builders import FOREVER, PLAIN, changes, claim_level, claims_branch, fact, history
from claimtide.functions import dimensions as D
from claimtide.functions.exposure import cumulative_days
from claimtide.functions.money import from_units, to_units
from claimtide.operators import latest, legal
from claimtide.operators.earned_exposure import TERM_MONTH, term_months
from claimtide.plans import claims, premium
from claimtide.schema import CLAIM_MEASURES, OUTPUT, PREMIUM_MEASURES
from comparing import bag

D4 = Decimal("0.0001")


def dec(value):
    return Decimal(str(value)).quantize(D4)


# --- exposure ----------------------------------------------------------------------


def earned(spark, *rows):
    """Earned days by month, from rows of (month, overrides)."""
    lrd = fact(spark, *[{"transaction_month": m, **o} for m, o in rows])
    days = premium.earning_rows(lrd).groupBy("transaction_month").agg(F.sum("earned_days"))
    return {row[0]: row[1] for row in days.collect()}


def test_increments_of_a_policy(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    # Two rows in February: one earns the month, the other nothing.
    assert earned(spark, (jan, {}), (feb, {}), (feb, {"coverage": "PD"})) == {jan: 16, feb: 29}


def test_ties_go_to_the_first_row_in_order(spark):
    feb = date(2024, 2, 1)
    lrd = fact(spark, *[{"transaction_month": feb, "coverage": c} for c in ("PD", "BI", "BI")])
    days = premium.earning_rows(lrd).groupBy("coverage").agg(F.sum("earned_days"))
    assert {r[0]: r[1] for r in days.collect()} == {"BI": 45, "PD": 0}


@pytest.mark.parametrize("month, override, days", [
    (date(2025, 1, 1), {}, 365),
    (date(2023, 12, 1), {}, -15),
    (date(2025, 1, 1), {"policy_end_date": None}, 382),
    (date(2025, 1, 1), {"policy_start_date": None}, None),
    (date(2024, 2, 1), {"policy_end_date": date(2024, 1, 10)}, -5),
])
def test_cumulative_days(spark, month, override, days):
    assert earned(spark, (month, override)) == {month: days}


def test_row_after_an_unknown_start_earns_its_whole_term(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert earned(spark, (jan, {"policy_start_date": None}), (feb, {})) == {jan: None, feb: 45}


def test_missing_month_comes_last(spark):
    jan = date(2024, 1, 1)
    assert earned(spark, (None, {}), (jan, {})) == {jan: 16, None: None}


def test_exposure_in_policy_years(spark):
    lrd = fact(spark, {"earned_premium": "10.50"}, {"earned_premium": None, "claim_number": None})
    row = premium.premium_branch(lrd, latest.latest_agency(lrd), PLAIN).collect()[0]
    assert (row.earned_policy_years, row.earned_premium) == (45 / 365.0, dec("10.50"))


def test_premium_rows_ignore_age_and_claim_but_not_line(spark):
    lrd = fact(spark, {"ay_age": 0}, {"claim_number": None, "coverage": "PD"}, {"lob": "BOP"})
    rows = premium.premium_branch(lrd, latest.latest_agency(lrd), PLAIN).collect()
    assert sorted(r.coverage for r in rows) == ["BI", "PD"]


def test_other_lines_do_not_count_as_the_row_before(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert earned(spark, (jan, {"lob": "BOP"}), (feb, {})) == {feb: 45}


# --- caps, status and amounts ------------------------------------------------------


def test_limit(spark):
    rows = [(None,), (Decimal("-10"),), (Decimal("25000"),), (Decimal("25000.01"),)]
    df = spark.createDataFrame(rows, "x decimal(18,2)")
    cents = df.select(to_units(F.col("x")).alias("x"))
    limited = cents.select(from_units(F.expr(claims.limit("x", 25_000))))
    assert [r[0] for r in limited.collect()] == [None, dec(-10), dec(25000), dec(25000)]


def test_units_are_exact_at_the_edges_of_the_type(spark):
    values = [Decimal("99999999999999.9999"), Decimal("-99999999999999.9999"), Decimal("0.0001")]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(18,4)")
    assert [r[0] for r in df.select(from_units(to_units(F.col("x")))).collect()] == values


@pytest.mark.parametrize("incurred, paid, is_open", [(5, 5, 0), ("5.01", 5, 1), (4, 5, 0)])
def test_open_needs_a_positive_case(spark, incurred, paid, is_open):
    row = claims_branch(spark, fact(spark, {"incurred_loss": incurred, "paid_loss": paid}))
    assert [(r.open_cc, r.closed_cc) for r in row.collect()] == [(is_open, 1 - is_open)]


@pytest.mark.parametrize("paid, with_pay, no_pay", [(5, 1, 0), (0, 0, 1), (None, 0, 0), (-5, 0, 0)])
def test_closed_split(spark, paid, with_pay, no_pay):
    incurred = -5 if paid == -5 else 0
    row = claims_branch(spark, fact(spark, {"incurred_loss": incurred, "paid_loss": paid}))
    assert [(r.closed_cc, r.cwp_cc, r.cnp_cc) for r in row.collect()] == [(1, with_pay, no_pay)]


def test_alae_loses_rows_that_lack_a_part(spark):
    row = claim_level(spark, fact(
        spark, {"paid_dcce": 10, "paid_aoe": None}, {"paid_dcce": 1, "paid_aoe": 2}
    )).collect()[0]
    assert row.paid_alae == dec(3) and row.paid_lossandalae_ss == dec(13)


def test_paid_recoveries_count_on_both_sides(spark):
    row = claim_level(spark, fact(spark, {
        "paid_loss": 100, "incurred_loss": 150, "paid_subro": -30, "paid_salvage": None,
    })).collect()[0]
    assert (row.paid_loss_ss, row.reported_loss_ss, row.case_loss) == (dec(70), dec(120), dec(50))


def test_all_null_sums_stay_null(spark):
    row = claims_branch(spark, fact(spark, {"incurred_loss": None, "paid_loss": None})).collect()[0]
    assert row.reported_loss is None and row.reported_loss_ss == dec(0)


def test_caps_apply_per_claim_level_row_not_per_claim(spark):
    big = {"incurred_loss": 30_000, "paid_loss": 0}
    rows = claims_branch(spark, fact(
        spark, {**big, "policy_reference": "P1"}, {**big, "policy_reference": "P2"}
    )).collect()
    assert len(rows) == 1 and rows[0].reported_cc == 2
    assert rows[0].reported_lossalaess_on_open_capped_a == dec(50_000)
    assert rows[0].ll_a_cc == 2


def test_different_channels_of_one_agency_merge_before_the_caps(spark):
    big = {"incurred_loss": 20_000, "paid_loss": 0, "agency_type": "APIntego"}
    rows = claims_branch(
        spark, fact(spark, {**big, "channel": "Digital"}, {**big, "channel": "Agency"})
    ).collect()
    assert [(r.channel, r.reported_cc, r.ll_a_cc) for r in rows] == [("AP Intego", 1, 1)]
    assert rows[0].reported_lossalaess_on_open_capped_a == dec(25_000)


def test_capped_case_is_a_difference_of_capped_amounts(spark):
    row = claims_branch(spark, fact(spark, {"incurred_loss": 60_000, "paid_loss": 30_000}))
    row = row.collect()[0]
    assert row.case_loss_on_open_capped_a == dec(0)
    assert row.case_loss_on_open_capped_b == dec(20_000)
    assert row.case_loss_on_open_capped_c == dec(30_000)


# --- lookups -----------------------------------------------------------------------


def test_missing_agency_is_the_largest(spark):
    lrd = fact(spark, {"agency_type": "Broker"}, {"agency_type": None})
    assert [r.agency_type for r in latest.latest_agency(lrd).collect()] == [None]


def test_agency_sees_other_lines_and_ages(spark):
    lrd = fact(spark, {}, {
        "lob": "BOP", "ay_age": -1, "agency_type": "Captive",
        "transaction_month": date(2024, 6, 1),
    })
    assert [r.agency_type for r in claim_level(spark, lrd).collect()] == ["Captive"]


def test_cause_ties_go_by_amount_then_name(spark):
    lrd = fact(spark, *[
        {"loss_cause_type_name": c, "incurred_loss_and_alae_ss": a}
        for c, a in (("Fire", 10), ("Theft", 10), ("Slip", 9))
    ])
    cause = latest.dominant_cause(latest.incurred_by_cause(lrd)).collect()
    assert [r.loss_cause_type_name for r in cause] == ["Theft"]


def test_missing_cause_and_amount_are_the_largest(spark):
    lrd = fact(
        spark,
        {"loss_cause_type_name": "Fire", "incurred_loss_and_alae_ss": 10},
        {"loss_cause_type_name": "Slip", "incurred_loss_and_alae_ss": None},
    )
    cause = latest.dominant_cause(latest.incurred_by_cause(lrd)).collect()
    assert [r.loss_cause_type_name for r in cause] == ["Slip"]


def test_row_without_a_month_still_finds_its_cause(spark):
    lrd = fact(spark, {"transaction_month": None, "loss_cause_type_name": "Theft"})
    assert [r.loss_cause_type_name for r in claim_level(spark, lrd).collect()] == ["Theft"]


def test_row_without_a_policy_is_kept(spark):
    lrd = fact(spark, {"policy_reference": None, "earned_premium": 5})
    assert [r.agency_type for r in claim_level(spark, lrd).collect()] == [None]
    row = premium.premium_branch(lrd, latest.latest_agency(lrd), PLAIN).collect()[0]
    assert (row.earned_premium, row.earned_policy_years) == (dec(5), 45 / 365.0)


# --- legal status ------------------------------------------------------------------


@pytest.mark.parametrize("when, status", [
    (datetime(2024, 2, 1, 0, 0), "in suit"),
    (datetime(2024, 2, 28, 0, 0), "in suit"),
    (datetime(2024, 2, 28, 10, 0), None),
    (datetime(2024, 1, 31, 23, 0), None),
])
def test_status_covers_whole_days_up_to_the_day_before_its_end(spark, when, status):
    scd = history(spark, (1, "in suit", datetime(2024, 2, 1, 9), datetime(2024, 2, 29)))
    fin = spark.createDataFrame(
        [("C1", 1, when)], "claim_number string, exposure_id bigint, date timestamp_ntz"
    )
    assert [r.legal_status for r in legal.scd_interval_join(fin, scd, PLAIN).collect()] == [status]


def test_status_without_an_end_never_matches(spark):
    scd = history(spark, (1, "in suit", datetime(2024, 2, 1), None))
    fin = changes(spark, ("C1", 1, date(2024, 3, 1)))
    rows = legal.legal_flags_by_claim_month(fin, scd, PLAIN).collect()
    assert [(r.in_suit_flag, r.attorney_rep_flag) for r in rows] == [(0, 0)]


def test_any_exposure_sets_the_flags_of_a_claim(spark):
    scd = history(spark, (1, "in suit", datetime(2024, 1, 1), FOREVER))
    fin = changes(spark, ("C1", 1, date(2024, 3, 1)), ("C1", 2, date(2024, 3, 9)))
    rows = legal.legal_flags_by_claim_month(fin, scd, PLAIN).collect()
    assert [(r.in_suit_flag, r.attorney_rep_flag) for r in rows] == [(1, 1)]


def test_last_change_of_the_month_decides(spark):
    scd = history(
        spark,
        (1, "in suit", datetime(2024, 3, 1), datetime(2024, 3, 10)),
        (1, "none", datetime(2024, 3, 10), FOREVER),
    )
    fin = changes(spark, ("C1", 1, date(2024, 3, 3)), ("C1", 1, date(2024, 3, 20)))
    rows = legal.legal_flags_by_claim_month(fin, scd, PLAIN).collect()
    assert [(r.in_suit_flag, r.attorney_rep_flag) for r in rows] == [(0, 0)]


def test_overlapping_statuses_count_by_the_strongest(spark):
    scd = history(
        spark,
        (1, "attorney rep", datetime(2024, 3, 1), FOREVER),
        (1, "none", datetime(2024, 2, 1), FOREVER),
    )
    fin = changes(spark, ("C1", 1, date(2024, 3, 3)))
    row = legal.legal_month_end(fin, scd, PLAIN).collect()[0]
    assert (row.in_suit_flag, row.attorney_rep_flag) == (0, 1)
    assert legal.scd_interval_join(fin, scd, PLAIN).count() == 2


def test_flags_hold_only_in_months_with_a_change(spark):
    scd = history(spark, (1, "in suit", datetime(2024, 1, 1), FOREVER))
    fin = changes(spark, ("C1", 1, date(2024, 2, 9)))
    lrd = fact(spark, {}, {"transaction_month": date(2024, 3, 1)})
    rows = claim_level(spark, lrd, fin, scd).collect()
    assert {r.transaction_month.month: r.in_suit_flag for r in rows} == {2: 1, 3: 0}


# --- dimensions --------------------------------------------------------------------


@pytest.mark.parametrize("group, name, expected", [
    ("Retail", "Tree Services", "Retail"),
    ("Fitness", "Tree Services", "Construction"),
    ("Construction", None, "Construction"),
    ("Day Care", "Bakery", "Day Care"),
    ("day care", "Bakery", "All Other"),
    (None, None, "All Other"),
])
def test_cob_grouping(spark, group, name, expected):
    df = spark.createDataFrame([(group, name)], "g string, n string")
    assert df.select(D.cob_grouping(F.col("g"), F.col("n"))).first()[0] == expected


@pytest.mark.parametrize("agency, channel, expected", [
    (None, "APIntego", "AP Intego"), ("APIntego", "Digital", "AP Intego"),
    ("Broker", "Digital", "Digital"), (None, None, None),
])
def test_channel(spark, agency, channel, expected):
    df = spark.createDataFrame([(agency, channel)], "a string, c string")
    assert df.select(D.channel_of(F.col("a"), F.col("c"))).first()[0] == expected


@pytest.mark.parametrize("ry, expected", [(-1, 11), (None, None), (0, 0)])
def test_report_age(spark, ry, expected):
    df = spark.createDataFrame([(ry, 11)], "r int, a int")
    assert df.select(D.repaired_report_age(F.col("r"), F.col("a"))).first()[0] == expected


@pytest.mark.parametrize("lob, indemnity, medical, expected", [
    ("WC", 1, 1, "Indemnity"), ("WC", 0, 1, "Medical Only"),
    ("WC", None, None, "Expense Only"), ("GL", 1, 1, None),
])
def test_injury_type(spark, lob, indemnity, medical, expected):
    df = spark.createDataFrame([(lob, indemnity, medical)], "l string, i int, m int")
    assert df.select(D.injury_type(F.col("l"), F.col("i"), F.col("m"))).first()[0] == expected


@pytest.mark.parametrize("lob, name, expected", [
    ("WC", "Dance Clubs", "Not in appetite"), ("WC", "Bakery", "In appetite"),
    ("WC", None, "In appetite"), ("GL", "Dance Clubs", None),
])
def test_appetite(spark, lob, name, expected):
    df = spark.createDataFrame([(lob, name)], "l string, n string")
    assert df.select(D.appetite(F.col("l"), F.col("n"))).first()[0] == expected


@pytest.mark.parametrize("bop, expected", [
    (1, "BOP Policy"), (0, "Not BOP Policy"), (None, "Not BOP Policy"),
])
def test_bop(spark, bop, expected):
    df = spark.createDataFrame([(bop,)], "b int")
    assert df.select(D.bop_policy_flag(F.col("b"))).first()[0] == expected


# --- branches ----------------------------------------------------------------------


def test_branch_fill(spark):
    lrd = fact(spark, {"earned_premium": 7})
    claim = claims_branch(spark, lrd).collect()[0]
    prem = premium.premium_branch(lrd, latest.latest_agency(lrd), PLAIN).collect()[0]
    assert all(claim[m] is None for m in PREMIUM_MEASURES)
    assert prem.claim_number == "" and prem.litigated == "N/A"
    assert all(prem[m] == 0 for m in CLAIM_MEASURES)
    assert (prem.ay, prem.ry, prem.ay_age, prem.ry_age, prem.am_age) == (2024, 2024, 2, 2, 2)


def test_both_branches_have_the_output_contract(spark):
    lrd = fact(spark, {})
    wanted = [(f.name, f.dataType) for f in OUTPUT]
    for branch in (
        claims_branch(spark, lrd), premium.premium_branch(lrd, latest.latest_agency(lrd), PLAIN)
    ):
        assert [(f.name, f.dataType) for f in branch.schema] == wanted
    assert len(wanted) == 125


def test_rows_without_a_policy_follow_each_other_over_months(spark):
    """The differences are those of one window over all rows without a policy."""
    rows = []
    for i in range(400):
        rows.append({
            "policy_reference": None if i % 2 else f"P{i % 5}",
            "transaction_month": None if i % 37 == 0 else date(2023 + i % 2, 1 + i % 11, 1),
            "policy_start_date": None if i % 41 == 0 else date(2023, 1 + i % 12, 1 + i % 28),
            "policy_end_date": None if i % 43 == 0 else date(2024, 1 + i % 7, 1 + i % 28),
        })
    terms = fact(spark, *rows).select(*TERM_MONTH, "lob").distinct()
    got = term_months(terms, ["lob"]).select(*TERM_MONTH, "earned_days")
    order = Window.partitionBy("policy_reference").orderBy(
        F.col("transaction_month").asc_nulls_last(), F.col("policy_start_date").asc_nulls_first(),
        F.col("policy_end_date").asc_nulls_first())
    days = cumulative_days(F.col("policy_start_date"), F.col("policy_end_date"), F.col("transaction_month"))
    plain = terms.select(*TERM_MONTH, days.alias("d")).withColumn(
        "earned_days", F.coalesce(F.col("d") - F.lag("d", 1).over(order), F.col("d"))).drop("d")
    assert bag(got) == bag(plain) and got.filter("policy_reference IS NULL").count() > 100


def test_a_row_without_policy_and_dates_is_the_first_of_its_month(spark):
    """Missing start and end are the smallest place within a month, which is no overflow."""
    none = {"policy_reference": None, "policy_start_date": None, "policy_end_date": None}
    later = {"policy_reference": None, "transaction_month": date(2024, 3, 1)}
    days = premium.earning_rows(fact(spark, none, {"policy_reference": None}, later))
    got = {(r.transaction_month.month, r.policy_start_date): r.earned_days for r in days.collect()}
    assert got == {(2, None): None, (2, date(2024, 1, 15)): 45, (3, date(2024, 1, 15)): 31}


def test_policies_of_one_claim_month_have_their_own_agencies(spark):
    """Of a claim and month, or a claim without a month: two policies, one without an agency, and none."""
    rows = [
        {"policy_reference": policy, "agency_type": agency, "transaction_month": month, "coverage": coverage, "paid_dcce": 1, "paid_aoe": aoe}
        for policy, agency in (("P1", "Broker"), ("P2", "Captive"), ("P3", None), (None, "Broker"))
        for month in (date(2024, 2, 1), None) for coverage, aoe in (("BI", 2), ("PD", None))
    ]
    found = claim_level(spark, fact(spark, *rows)).select(
        "policy_reference", "transaction_month", "coverage", "agency_type", "paid_alae"
    ).collect()
    own = {"P1": "Broker", "P2": "Captive"}
    assert len(found) == len(rows) and {tuple(row) for row in found} == {
        (row["policy_reference"], row["transaction_month"], row["coverage"], own.get(row["policy_reference"]),
         dec(3) if row["coverage"] == "BI" else None) for row in rows
    }
