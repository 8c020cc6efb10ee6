"""The registered queries: every operator of the pipeline, each over whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimtide import fixed_values as V
from claimtide.functions import dimensions as D
from claimtide.functions.exposure import policy_years
from claimtide.functions.money import exact_total, from_units, or_zero, to_units
from claimtide.operators import earned_exposure as E, latest as L, legal as G
from claimtide.operators.salted_join import salted_left_join
from claimtide.plans import claims as C, premium as P
from claimtide.plans.rounds import (
    claim_levels, claims_units, ordered_result, premium_units, publish_result, result_units, rolled_up_units,
)
from claimtide.schema import (
    CLAIM_MEASURES, COUNTS, MONEY_OUT, PREMIUM_MEASURES, capped,
)
from claimtide.session import scratch_root
from claimtide.sources import driver_tables
from claimtide.sources.staged import Inputs, inputs
from claimtide.sources.tables import published

# A second set of limits, which the result takes as well as the default ones.
OTHER_CAPS = {"low": 12_345, "mid": 60_000, "high": 2_500_000}

# Levels whose limits stand in a table, by its row.
CAP_REGIONS = {"first": "AFRICA", "third": "ASIA"}

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def _over_inputs(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Registers a query over the three stored inputs under its function's name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(inputs(spark, folder))

    _REGISTRY[build.__name__] = run
    return build


def _over_source(build: Query) -> Query:
    """Registers a query that derives its input itself."""
    _REGISTRY[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _n() -> Column:
    return F.count(F.lit(1)).alias("n_rows")


def _added() -> Column:
    """Rows counted before a join, added up after it."""
    return F.sum("n_rows").alias("n_rows")


def _money(expr: Column, name: str) -> Column:
    return expr.cast(MONEY_OUT).alias(name)


def _units_total(units: Column, name: str) -> Column:
    return from_units(F.sum(units)).alias(name)


# --- scans, constants and the sink -------------------------------------------------


@_over_source
def scan_lrd(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.lrd(spark, folder)


@_over_source
def scan_fin_changes(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.fin_changes(spark, folder)


@_over_source
def scan_legal_scd(spark: SparkSession, folder: str) -> DataFrame:
    return driver_tables.legal_scd(spark, folder).select(
        "exposure_id",
        "legal_status",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("start_datetime", "end_datetime")],
    )


def _caps() -> list[Column]:
    return [F.lit(float(cap)).alias(f"cap_{level}") for level, cap in V.CAPS.items()]


@_over_inputs
def cap_inputs(t: Inputs) -> DataFrame:
    """The seven limits beside every reported line of business."""
    return P.premium_rows(t.lrd).groupBy("lob").agg(_n()).select("*", *_caps())


@_over_source
def publish_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The result, written by the sink and read back."""
    path = f"{scratch_root(spark)}/published"  # one place, replaced by every call
    publish_result(inputs(spark, folder), path)
    return published(spark, path)


# --- filters -----------------------------------------------------------------------


@_over_inputs
def filter_lob(t: Inputs) -> DataFrame:
    return P.premium_rows(t.lrd).groupBy("lob", "coverage").agg(
        _n(), _money(F.sum("earned_premium"), "earned_premium")
    )


@_over_inputs
def filter_claim_rows(t: Inputs) -> DataFrame:
    return C.claim_rows(t.lrd).groupBy("lob", "ay_age").agg(
        _n(), _money(F.sum("incurred_loss"), "incurred_loss")
    )


# --- legal status ------------------------------------------------------------------


@_over_inputs
def scd_interval_join(t: Inputs) -> DataFrame:
    return G.scd_interval_join(t.fin_changes, t.legal_scd)


@_over_inputs
def legal_month_end(t: Inputs) -> DataFrame:
    return G.legal_month_end(t.fin_changes, t.legal_scd)


@_over_inputs
def legal_flags_by_claim_month(t: Inputs) -> DataFrame:
    return G.legal_flags_by_claim_month(t.fin_changes, t.legal_scd)


@_over_inputs
def legal_status_flags(t: Inputs) -> DataFrame:
    """Flags of every status, and of changes without one."""
    status = F.col("legal_status")
    return (
        G.scd_interval_join(t.fin_changes, t.legal_scd)
        .groupBy("legal_status")
        .agg(_n())
        .withColumns({
            "attorney_rep_flag": D.attorney_flag(status),
            "in_suit_flag": D.in_suit_flag(status),
        })
    )


@_over_inputs
def join_legal_flags(t: Inputs) -> DataFrame:
    """Every claim row with its month's flags, 0 where the month has no change.

    Counted by claim, month and line first: a few rows per key meet the flags, however many
    the claim has.
    """
    rows = C.claim_rows(t.lrd).groupBy(*G.CLAIM_MONTH, "lob").agg(_n())
    weights = rows.groupBy(*G.CLAIM_MONTH).agg(_n())
    flags = ["in_suit_flag", "attorney_rep_flag"]
    return (
        salted_left_join(
            rows, G.legal_flags_by_claim_month(t.fin_changes, t.legal_scd),
            G.CLAIM_MONTH, weights, spread=["lob"],
        )
        .withColumns({f: F.coalesce(f, F.lit(0)) for f in flags})
        .groupBy("lob", "transaction_month", *flags)
        .agg(_added())
    )


# --- lookups from the fact ---------------------------------------------------------


@_over_inputs
def latest_agency(t: Inputs) -> DataFrame:
    return L.latest_agency(t.lrd).drop("n_rows")


@_over_inputs
def join_latest_agency(t: Inputs) -> DataFrame:
    rows = t.lrd.groupBy("policy_reference", "lob", "channel").agg(_n())
    return (
        C.with_agency(rows, _counted_agency(t, rows), spread=["lob", "channel"])
        .groupBy("lob", "agency_type")
        .agg(_added())
    )


def _counted_agency(t: Inputs, rows: DataFrame) -> DataFrame:
    """The agencies, weighed by the rows that are really joined."""
    weights = rows.groupBy("policy_reference").agg(_n())
    return L.latest_agency(t.lrd).drop("n_rows").join(weights, "policy_reference")


@_over_inputs
def incurred_by_cause(t: Inputs) -> DataFrame:
    return L.incurred_by_cause(t.lrd).select(
        "claim_number", "loss_cause_type_name", "transaction_month",
        from_units(F.col("total_incurred")).alias("total_incurred"),
    )


@_over_inputs
def dominant_loss_cause(t: Inputs) -> DataFrame:
    return L.dominant_cause(L.incurred_by_cause(t.lrd))


@_over_inputs
def join_dominant_cause(t: Inputs) -> DataFrame:
    rows = C.claim_rows(t.lrd).groupBy("claim_number", "lob").agg(_n())
    weights = rows.groupBy("claim_number").agg(_n())
    return (
        salted_left_join(
            rows, L.dominant_cause(L.incurred_by_cause(t.lrd)), ["claim_number"], weights,
            spread=["lob"],
        )
        .groupBy("lob", "loss_cause_type_name")
        .agg(_added())
    )


# --- dimensions --------------------------------------------------------------------


@_over_inputs
def cob_grouping(t: Inputs) -> DataFrame:
    return (
        t.lrd.groupBy("cob_group", "cob_name")
        .agg(_n())
        .withColumn("cob_grouping", D.cob_grouping(F.col("cob_group"), F.col("cob_name")))
    )


@_over_inputs
def channel_normalised(t: Inputs) -> DataFrame:
    rows = t.lrd.groupBy("policy_reference", "channel", F.col("channel").alias("raw_channel")).agg(_n())
    return (
        C.with_agency(rows, _counted_agency(t, rows), spread=["raw_channel"])
        .groupBy("agency_type", "raw_channel", "channel")
        .agg(_added())
    )


@_over_inputs
def ry_age_repair(t: Inputs) -> DataFrame:
    return t.lrd.groupBy("ry_age", "ay_age").agg(_n()).select(
        F.col("ry_age").alias("raw_ry_age"), "ay_age", "n_rows",
        D.repaired_report_age(F.col("ry_age"), F.col("ay_age")).alias("ry_age"),
    )


@_over_inputs
def bop_policy_flag(t: Inputs) -> DataFrame:
    return (
        t.lrd.groupBy("is_bop_policy").agg(_n())
        .withColumn("bop_policy_flag", D.bop_policy_flag(F.col("is_bop_policy")))
    )


@_over_inputs
def development_axes_claims(t: Inputs) -> DataFrame:
    return C.claim_rows(t.lrd).groupBy(
        F.year("accident_month").alias("ay"),
        F.year("policy_start_date").alias("py"),
        F.year("report_month").alias("ry"),
    ).agg(_n())


@_over_inputs
def development_axes_premium(t: Inputs) -> DataFrame:
    year, month = F.year("transaction_month"), F.month("transaction_month")
    return (
        P.premium_rows(t.lrd)
        .groupBy(
            "transaction_month", F.year("policy_start_date").alias("py"), "py_age"
        )
        .agg(_n())
        .withColumns({
            "ay": year, "ry": year, "ay_age": month, "ry_age": month, "am_age": month,
        })
    )


# --- claim level -------------------------------------------------------------------


def _level_units(t: Inputs, names: list[str]) -> DataFrame:
    """Some columns of the claim level."""
    return claim_levels(t, lambda level: C.with_result_labels(level).select(*names))


def _by_year_and_lob(t: Inputs, *totals: Column, net_only: bool = False) -> DataFrame:
    """Totals of claim-level amounts, for which no cause, flag or agency is needed."""
    level = C.claim_amounts(t.lrd, net_only=net_only)
    return level.groupBy(F.year("accident_month").alias("ay"), "lob").agg(*totals)


def _result_totals(t: Inputs, names: list[str]) -> DataFrame:
    """Result measures by accident year and line, straight from the claim level."""
    derived = C.derived_measures()
    used = set(re.findall(r"\w+", " ".join(derived.get(name, name) for name in names)))
    by_flags = [label for label in ("attorney_represented", "litigated") if label in used]
    sums = {name: total for name, total in C.result_sums().items() if name in used}
    amounts = set(re.findall(r"\w+", " ".join(sums.values()))) & set(C.CLAIM_LEVEL_MEASURES)
    level = _level_units(t, ["ay", "lob", *by_flags, *sorted(amounts)]) if by_flags else C.claim_amounts(
        t.lrd, net_only=amounts <= set(C.LIMITED)
    ).withColumn("ay", F.year("accident_month"))
    rolled = level.groupBy("ay", "lob", *by_flags).agg(*[
        F.expr(f"{total} AS {name}") for name, total in sums.items()
    ])
    measures = rolled.selectExpr(
        "ay", "lob", *[f"{derived.get(name, name)} AS {name}" for name in names]
    )
    return measures.groupBy("ay", "lob").agg(*[
        F.sum(name).alias(name) if name in COUNTS else _units_total(F.col(name), name)
        for name in names
    ])


@_over_inputs
def claim_level(t: Inputs) -> DataFrame:
    return C.finished_level(claim_levels(t, C.labelled_level))


@_over_inputs
def net_loss_measures(t: Inputs) -> DataFrame:
    names = ["paid_loss_ss", "reported_loss_ss", "paid_lossandalae_ss", "reported_lossandalae_ss"]
    return _by_year_and_lob(t, *[_units_total(F.col(m), m) for m in names], net_only=True)


@_over_inputs
def alae_measures(t: Inputs) -> DataFrame:
    return _by_year_and_lob(
        t, *[_units_total(F.col(m), m) for m in ("paid_alae", "reported_alae")]
    )


@_over_inputs
def case_reserves(t: Inputs) -> DataFrame:
    pairs = {
        "case_lossandalae": ("reported_lossandalae_ss", "paid_lossandalae_ss"),
        "case_loss": ("reported_loss_ss", "paid_loss_ss"),
    }
    return _by_year_and_lob(
        t, *[_units_total(F.col(reported) - F.col(paid), case) for case, (reported, paid) in pairs.items()],
        net_only=True,
    )


@_over_inputs
def gross_loss_measures(t: Inputs) -> DataFrame:
    names = (
        "paid_loss reported_loss paid_dcce paid_aoe reported_dcce reported_aoe "
        "reported_indemnity_loss reported_medical_loss total_ss total_incurred_xss"
    ).split()
    return _by_year_and_lob(t, *[_units_total(F.col(m), m) for m in names])


def _claims_under(t: Inputs, caps: C.Caps, names: list[str]) -> DataFrame:
    """Year, line, large-loss counts and some measures of the claims branch under other caps."""
    chosen = ["ay", "lob", *[f"ll_{level}_cc" for level in caps], *names]
    return claims_units(t, lambda rows: C.finished(rows, caps).select(*chosen), caps)


@_over_inputs
def cross_join_caps(t: Inputs) -> DataFrame:
    """The claims branch under other caps than the default ones: counts and limited amounts."""
    limited = ["paid_lossalaess_on_closed", "case_lossalae_on_open"]
    rows = _claims_under(t, OTHER_CAPS, [name for base in limited for name in capped(base, OTHER_CAPS)])
    return rows.groupBy("ay", "lob").agg(
        *[F.sum(f"ll_{level}_cc").alias(f"ll_{level}_cc") for level in OTHER_CAPS],
        *[_money(F.sum(name), name) for base in limited for name in capped(base, OTHER_CAPS)],
    )


@_over_source
def caps_from_a_table(spark: SparkSession, folder: str) -> DataFrame:
    """The claims branch under caps that are rows of a table, read when the query runs."""
    t = inputs(spark, folder)
    regions = spark.read.parquet(f"{folder}/region.parquet").filter(F.col("r_name").isin(*CAP_REGIONS.values()))
    level = reduce(lambda found, pair: F.when(F.col("r_name") == pair[1], pair[0]).otherwise(found), CAP_REGIONS.items(), F.lit(None))
    table = regions.select(level.alias("level"), ((F.col("r_regionkey") + 1) * 15_000).alias("cap"))
    limited = capped("case_lossalae_on_open", dict.fromkeys(CAP_REGIONS))
    rows = _claims_under(t, C.caps_of(table, list(CAP_REGIONS)), limited)
    return rows.groupBy("ay", "lob").agg(
        *[F.sum(f"ll_{level}_cc").alias(f"ll_{level}_cc") for level in CAP_REGIONS],
        *[_money(F.sum(name), name) for name in limited],
    )


@_over_inputs
def cap_ladder(t: Inputs) -> DataFrame:
    return _by_year_and_lob(t, *[
        _units_total(F.expr(C.limit(amount, cap)), f"capped_{level}_{amount}")
        for amount in C.LIMITED for level, cap in V.CAPS.items()
    ], net_only=True)


@_over_inputs
def capped_case(t: Inputs) -> DataFrame:
    pairs = {
        "case_lossandalae": ("reported_lossandalae_ss", "paid_lossandalae_ss"),
        "case_loss": ("reported_loss_ss", "paid_loss_ss"),
    }
    return _by_year_and_lob(t, *[
        _units_total(
            or_zero(F.expr(C.limit(reported, cap))) - or_zero(F.expr(C.limit(paid, cap))),
            f"capped_{level}_{case}",
        )
        for case, (reported, paid) in pairs.items() for level, cap in V.CAPS.items()
    ], net_only=True)


@_over_inputs
def large_loss_counts(t: Inputs) -> DataFrame:
    return _result_totals(t, [f"ll_{level}_cc" for level in V.CAPS])


@_over_inputs
def open_closed_status(t: Inputs) -> DataFrame:
    return _result_totals(
        t,
        "open_cc closed_cc cwp_cc cnp_cc closed_expenseonly_cc closed_nolossorexpense_cc".split(),
    )


@_over_inputs
def claim_counts(t: Inputs) -> DataFrame:
    return _result_totals(t, [
        "reported_cc", "nonzero_reported_cc", "expenseonly_cc",
        "litigated_claim_count", "attorney_rep_claim_count",
    ])


@_over_inputs
def nonzero_amounts(t: Inputs) -> DataFrame:
    return _result_totals(t, ["nonzero_reported_loss_ss", "nonzero_reported_lossandalae_ss"])


@_over_inputs
def legal_nonzero_counts(t: Inputs) -> DataFrame:
    return _result_totals(t, ["litigated_nonzero_claim_count", "attorney_nonzero_claim_count"])


@_over_inputs
def paid_on_closed(t: Inputs) -> DataFrame:
    bases = ["paid_lossalaess_on_closed", "paid_lossss_on_closed"]
    return _result_totals(t, [name for base in bases for name in [base, *capped(base)]])


@_over_inputs
def amounts_on_open(t: Inputs) -> DataFrame:
    return _result_totals(t, [m for m in CLAIM_MEASURES if "_on_open" in m])


@_over_inputs
def legal_labels(t: Inputs) -> DataFrame:
    keys = ["ay", "in_suit_flag", "attorney_rep_flag", "litigated", "attorney_represented"]
    return _level_units(t, keys).groupBy(*keys).agg(_n())


@_over_inputs
def wc_injury_type(t: Inputs) -> DataFrame:
    keys = ["ay", "lob", "indemnity_medicalonly"]
    return _level_units(t, keys).groupBy(*keys).agg(_n())


@_over_inputs
def wc_appetite(t: Inputs) -> DataFrame:
    keys = ["lob", "cob_name", "current_appetite"]
    return _level_units(t, keys).groupBy(*keys).agg(_n())


# --- premium and exposure ----------------------------------------------------------


@_over_inputs
def earned_exposure_cumulative(t: Inputs) -> DataFrame:
    return E.with_cumulative_days(P.premium_rows(t.lrd).groupBy(*E.TERM_MONTH).agg(_n()))


@_over_inputs
def earned_exposure_incremental(t: Inputs) -> DataFrame:
    """Earned days and premium by policy, month and coverage; the tie order decides the
    coverage. Days and premium come from the same summed rows, which are shuffled once."""
    return (
        P.earning_rows(t.lrd)
        .groupBy("policy_reference", "transaction_month", "lob", "coverage")
        .agg(F.sum("earned_days").alias("earned_days"), _units_total(F.col("premium"), "earned_premium"))
    )


@_over_inputs
def scalar_dates(t: Inputs) -> DataFrame:
    day = F.col("date")
    return t.fin_changes.groupBy("date").agg(_n()).withColumns({
        "month_start": F.to_date(F.trunc(day, "month")),
        "day_before": F.date_sub(day, 1),
        "month_end": F.last_day(day),
        "days_to_month_end": F.datediff(F.last_day(day), day),
        "year_of": F.year(day),
        "month_of": F.month(day),
    })


@_over_inputs
def scalar_conditional(t: Inputs) -> DataFrame:
    """Coalesce, nested conditions, casts and arithmetic over every fact row."""
    def units(name: str) -> Column:
        return to_units(F.col(name))

    paid = reduce(Column.__add__, [
        or_zero(units(m)) for m in ("paid_loss", "paid_subro", "paid_salvage")
    ])
    size = (
        F.when(units("incurred_loss") > 0, F.when(F.col("paid_loss") > 0, "paid").otherwise("case"))
        .when(F.col("incurred_loss").isNull(), "unknown")
        .otherwise("none")
    )
    rows = t.lrd.groupBy("lob", size.alias("loss_kind")).agg(
        _n(), exact_total(paid).alias("units"),
        F.sum(F.datediff("policy_end_date", "policy_start_date")).alias("days"),
    )
    return rows.select(
        "lob", "loss_kind", "n_rows", from_units(F.col("units")).alias("paid_net"),
        policy_years(F.col("days")).alias("term_years"),
    )


# --- the result --------------------------------------------------------------------


@_over_inputs
def claims_branch(t: Inputs) -> DataFrame:
    return C.finished(claims_units(t, lambda rows: rows))


@_over_inputs
def premium_branch(t: Inputs) -> DataFrame:
    return C.finished(premium_units(t))


@_over_inputs
def branch_union(t: Inputs) -> DataFrame:
    """Size and fill of each branch within the union."""
    rows = C.finished(result_units(t))
    filled = [*PREMIUM_MEASURES, "reported_cc", "reported_loss", "paid_lossandalae_ss"]
    return rows.groupBy(
        F.when(F.col("claim_number") == "", "premium").otherwise("claims").alias("branch"),
        "lob", "litigated",
    ).agg(_n(), *[F.count(m).alias(f"n_{m}") for m in filled])


@_over_inputs
def emergence_full(t: Inputs) -> DataFrame:
    return C.finished(result_units(t))


@_over_inputs
def final_rollup(t: Inputs) -> DataFrame:
    """The result grouped once more by all dimensions, which changes no value; its sums in units."""
    return C.finished(rolled_up_units(t))


@_over_inputs
def ordered_output(t: Inputs) -> DataFrame:
    return ordered_result(t)
