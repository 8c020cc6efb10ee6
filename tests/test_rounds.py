"""A large fact is worked off in rounds, whose shuffles don't stay; the results are those of one plan."""

import os
import time
from datetime import date, datetime

import pytest

from builders import FOREVER, changes, fact, history
from claimtide.plans import claims, premium, rounds
from claimtide.plans.emergence import emergence, emergence_units
from claimtide.plans.layout import RANGE, SORT_ORDER, result_borders, with_range
from claimtide.queries import queries
from claimtide.session import scratch_root
from claimtide.sources import staged
from claimtide.sources.staged import Inputs
from claimtide.sources.tables import published
from conftest import SMALL
from test_plans import plan_of


@pytest.fixture()
def many_rounds(monkeypatch):
    monkeypatch.setattr(rounds, "ROUND_ROWS", 1)
    monkeypatch.setattr(rounds, "MOST_ROUNDS", 2)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of several claims, without claim, policy or month, of several causes and channels."""
    rows = [
        {
            "claim_number": None if k % 5 == 0 else f"C{k % 7}", "policy_reference": None if k % 4 == 0 else f"P{k % 3}",
            "transaction_month": None if k % 11 == 0 else date(2024, 1 + k % 3, 1), "lob": "WC" if k % 2 else "GL",
            "loss_cause_type_name": ("Fire", "Slip", None)[k % 3], "channel": ("Digital", "APIntego")[k % 2],
            "agency_type": ("AP Intego", "Broker", None)[k % 3], "paid_loss": k * 1000 - 3000, "incurred_loss": None if k % 6 == 0 else k * 2000,
            "incurred_loss_and_alae_ss": k, "earned_premium": k, "paid_dcce": k, "paid_aoe": None if k % 9 == 0 else 1,
        }
        for k in range(60)
    ]
    made = changes(spark, *[(f"C{k % 7}", k % 4, date(2024, 1 + k % 3, 3)) for k in range(20)])
    told = history(spark, (1, "in suit", datetime(2024, 1, 1), datetime(2024, 3, 1)), (2, "attorney rep", datetime(2024, 2, 1), FOREVER))
    return Inputs(fact(spark, *rows).cache(), made.cache(), told.cache())


def bag(rows):
    return sorted(map(repr, rows.collect()))


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = set()
    for folder in blocks.localDirs():
        for _, _, found in os.walk(folder.getPath()):
            names |= {name for name in found if name.startswith("shuffle_")}
    return names


def new_shuffle_files(spark, before: set[str]) -> set[str]:
    """What is left of them after a while: executors remove files in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return shuffle_files(spark) - before


def test_rounds_follow_the_number_of_rows(small, monkeypatch):
    rows = small.lrd.count()
    assert rounds.rounds_of(small.lrd) == 1
    monkeypatch.setattr(rounds, "ROUND_ROWS", rows // 2)
    assert rounds.rounds_of(small.lrd) == 3
    monkeypatch.setattr(rounds, "ROUND_ROWS", 1)
    assert rounds.rounds_of(small.lrd) == rounds.MOST_ROUNDS == 8


def test_results_in_rounds_are_those_of_one_plan(odd, many_rounds):
    agency, by_cause = rounds.latest_agency(odd.lrd), rounds.incurred_by_cause(odd.lrd)
    legal = rounds.legal_flags_by_claim_month(odd.fin_changes, odd.legal_scd)
    whole = bag(emergence_units(*odd))
    assert len(whole) > 20
    assert bag(rounds.result_units(odd)) == whole
    assert bag(rounds.rolled_up_units(odd)) == whole
    assert bag(claims.finished_level(rounds.claim_levels(odd, claims.labelled_level))) == bag(
        claims.claim_level(odd.lrd, agency, by_cause, legal)
    )
    assert bag(rounds.claims_units(odd, lambda rows: rows)) == bag(claims.claims_units(odd.lrd, agency, by_cause, legal))
    assert bag(rounds.premium_units(odd)) == bag(premium.premium_units(odd.lrd, agency))


def test_the_order_holds_over_rounds(spark, odd, many_rounds, tmp_path):
    whole = emergence(*odd)
    found = rounds.ordered_result(odd)
    assert found.schema.simpleString() == whole.schema.simpleString()
    rows = found.collect()

    def place(row):
        return [(row[c] is None, row[c] if row[c] is not None else "") for c in SORT_ORDER]

    assert [place(r) for r in rows] == sorted(place(r) for r in rows) and sorted(map(repr, rows)) == bag(whole)
    rounds.publish_result(odd, str(tmp_path / "published"))
    assert bag(published(spark, str(tmp_path / "published"))) == bag(whole)


def test_a_fact_without_rows_gives_no_rows_in_rounds(spark, odd, many_rounds, tmp_path, monkeypatch):
    monkeypatch.setattr(rounds, "rounds_of", lambda lrd: 2)
    none = Inputs(*[rows.limit(0) for rows in odd])
    assert not rounds.ordered_result(none).collect() and not rounds.rolled_up_units(none).collect()
    rounds.publish_result(none, str(tmp_path / "published"))
    assert not published(spark, str(tmp_path / "published")).collect()


@pytest.mark.parametrize("name", ["emergence_full", "claims_branch", "wc_appetite"])
def test_what_a_round_has_shuffled_does_not_stay(spark, many_rounds, name):
    """Before, all of it stayed until the result was read."""
    staged.stage(spark, SMALL)
    before = shuffle_files(spark)
    plan = plan_of(queries()[name](spark, SMALL))
    assert not new_shuffle_files(spark, before)
    assert "claim_number" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("name", ["final_rollup", "ordered_output", "publish_roundtrip"])
def test_parts_leave_neither_shuffles_nor_tables(spark, many_rounds, name):
    staged.stage(spark, SMALL)
    before = shuffle_files(spark)
    root = scratch_root(spark).removeprefix("file:")
    tables = set(os.listdir(root))
    queries()[name](spark, SMALL)
    assert not new_shuffle_files(spark, before)
    assert {entry.split("-")[0] for entry in set(os.listdir(root)) - tables} <= {"rolled", "ordered", "published"}


def test_storing_the_inputs_leaves_no_shuffles(spark, monkeypatch):
    monkeypatch.setattr(staged, "_stored", {})
    before = shuffle_files(spark)
    staged.stage(spark, SMALL)
    assert not new_shuffle_files(spark, before)


def test_the_code_of_a_row_is_made_once(small):
    """And not again for each border that it is compared with."""
    borders = result_borders(small.lrd, ranges=9)
    plan = with_range(emergence_units(*small), borders).select(RANGE)._jdf.queryExecution().optimizedPlan().toString()
    comparing = [line for line in plan.splitlines() if "lambdafunction" in line]
    assert comparing and not any("lpad" in line for line in comparing)
