"""Claims branch: fact rows -> claim level -> limits, flags and splits -> result rows.

The wide fact is shuffled once, by claim and month, never by a bare business key. Cause and legal
flags are looked up there in one go. The agency belongs to the policy: only the distinct policies of
each claim and month go to the agencies and come back with theirs (`with_agency_of_policies`).

Claim level and result are both groupings within claim and month, so they run inside
that partitioning: the 99-column rows are never shuffled.

Measures that ask for neither cause, flags nor agency have a claim level of their own (`claim_amounts`):
what follows from claim and month, or from the policy, parts no group, so it isn't looked up. An
agency is asked for only where it may bring rows of several channels together.

A claim and month with more rows than a task should take (a placeholder claim of many
policies) goes another way, from the scan on: such hot claim months are few, so their cause
and flags are broadcast, their rows are added up map-side by all raw keys before anything moves
(`summed_rows`), the claim level is shuffled by all its keys, and the result's sums are merged
map-side before one more shuffle. Where there are none, adaptive execution finds the
list empty and leaves that branch out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField

from claimtide import fixed_values as V
from claimtide.functions import dimensions as D
from claimtide.functions.exposure import policy_years
from claimtide.functions.money import (
    UNIT, from_units, from_units_sql, or_zero, require_exact_sums, to_units,
)
from claimtide.operators.latest import last_per_key, latest_agency
from claimtide.operators.salted_join import (
    LANE, Skew, bucket_of, hot_keys_of, in_buckets, salted_left_join, with_hot,
)
from claimtide.schema import (
    DIMENSIONS, GIVEN_DIMENSIONS, capped, claim_measures, counts, output,
)

# What a raw row is grouped by before anything is looked up. Texts of varying length come last: what
# stands behind them in a shuffled row moves from row to row, and packs worse.
_CARRIED = (
    "paygo_indicator food_and_bev_express_ind is_bop accident_month py ry ay_age py_age ry_age am_age "
    "transaction_month coverage renewal_tag lob claim_number policy_reference channel state cob_group cob_name"
).split()

_LOOKED_UP = ["agency_type", "loss_cause_type_name", "in_suit_flag", "attorney_rep_flag"]

# Amounts of a row from whose sums every claim-level amount follows.
_AMOUNTS = {
    "paid_loss": "paid_loss",
    "reported_loss": "incurred_loss",
    "paid_dcce": "paid_dcce",
    "paid_aoe": "paid_aoe",
    "reported_dcce": "incurred_dcce",
    "reported_aoe": "incurred_aoe",
    "reported_indemnity_loss": "incurred_indemnity_loss",
    "reported_medical_loss": "incurred_medical_loss",
}

# Added before summing: a row that lacks either part counts for nothing.
_ADDED = {"paid_alae": ("paid_dcce", "paid_aoe"), "reported_alae": ("reported_dcce", "reported_aoe")}

_BASE_SUMS = [*_AMOUNTS, *_ADDED, "total_ss"]

CLAIM_LEVEL_MEASURES = (
    "paid_loss reported_loss paid_dcce paid_aoe paid_alae reported_dcce reported_aoe "
    "reported_alae paid_loss_ss reported_loss_ss paid_lossandalae_ss reported_lossandalae_ss "
    "case_lossandalae case_loss reported_indemnity_loss reported_medical_loss total_ss "
    "total_incurred_xss"
).split()

CLAIM_LEVEL_DIMENSIONS = (
    "policy_reference claim_number lob cob_name cob_group cob_grouping channel paygo_indicator "
    "state loss_cause_type_name accident_month ay py ry ay_age py_age ry_age am_age "
    "transaction_month coverage in_suit_flag attorney_rep_flag food_and_bev_express_ind "
    "agency_type renewal_tag bop_policy_flag"
).split()

# The four amounts that are limited, and the capped case each pair gives.
LIMITED = ["reported_lossandalae_ss", "paid_lossandalae_ss", "reported_loss_ss", "paid_loss_ss"]

# What each of them adds up, besides recoveries.
_NET_OF = {
    "paid_loss_ss": ("paid_loss",),
    "reported_loss_ss": ("reported_loss",),
    "paid_lossandalae_ss": ("paid_loss", "paid_dcce", "paid_aoe"),
    "reported_lossandalae_ss": ("reported_loss", "reported_dcce", "reported_aoe"),
}

# Result measures that are split by status: name -> (claim-level amount, status).
_SPLITS = {
    "paid_lossalaess_on_closed": ("paid_lossandalae_ss", "closed_with_pay"),
    "paid_lossss_on_closed": ("paid_loss_ss", "closed_with_pay"),
    "reported_lossalaess_on_open": ("reported_lossandalae_ss", "open"),
    "paid_lossalaess_on_open": ("paid_lossandalae_ss", "open"),
    "reported_lossss_on_open": ("reported_loss_ss", "open"),
    "paid_lossss_on_open": ("paid_loss_ss", "open"),
}

# Fixed value: the unlimited form of this measure is spelled with four s's.
_UNLIMITED_NAME = {"reported_lossalaess_on_open": "reported_lossalaessss_on_open"}

# Case measures on open rows: reported minus paid, unlimited and at each limit.
_CASE_ON_OPEN = {
    "case_lossalae_on_open": ("reported_lossalaess_on_open", "paid_lossalaess_on_open"),
    "case_loss_on_open": ("reported_lossss_on_open", "paid_lossss_on_open"),
}

# Stands for a missing month in the lookup key, so that a row without a month still
# finds its claim's cause. Lies outside the range of dates.
_NO_MONTH = -(2**31)


def _month_number(month: Column) -> Column:
    return F.coalesce(F.unix_date(month), F.lit(_NO_MONTH))


def claim_rows(lrd: DataFrame) -> DataFrame:
    """Fact rows of the claims branch."""
    return lrd.filter(
        (F.col("ay_age") > 0)
        & F.col("claim_number").isNotNull()
        & F.col("lob").isin(V.REPORTED_LOBS)
    )


def unit_rows(lrd: DataFrame, hot: DataFrame | None = None, side: str = "left_anti") -> DataFrame:
    """Every row's raw keys and amounts, in units; of rows outside the hot claim months
    (`left_anti`) or of these (`left_semi`), if they are given."""
    rows = claim_rows(lrd)
    if hot is not None:
        month = _month_number(F.col("transaction_month")).alias("month_number")
        rows = with_hot(rows, hot, [F.col("claim_number"), month], side)
    keyed = rows.withColumns({
        "channel": D.partner_spelling(F.col("channel")),
        "py": F.year("policy_start_date"),
        "ry": F.year("report_month"),
        "ry_age": D.repaired_report_age(F.col("ry_age"), F.col("ay_age")),
        "is_bop": F.coalesce(F.col("is_bop_policy") == 1, F.lit(False)),
    })

    require_exact_sums(lrd.sparkSession)

    def units(column: str) -> Column:
        return to_units(F.col(column))

    amounts = [units(column).alias(name) for name, column in _AMOUNTS.items()]
    recoveries = or_zero(units("paid_salvage")) + or_zero(units("paid_subro"))
    return keyed.select(*_CARRIED, *amounts, recoveries.alias("total_ss"))


def with_added(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.col(a) + F.col(b) for name, (a, b) in _ADDED.items()})


def _base_sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in _BASE_SUMS]


def summed_rows(lrd: DataFrame, hot: DataFrame | None = None, side: str = "left_anti") -> DataFrame:
    """Base sums in units by every raw key, combined map-side before the shuffle."""
    return with_added(unit_rows(lrd, hot, side)).groupBy(*_CARRIED).agg(*_base_sums())


def claim_context(by_cause: DataFrame, legal: DataFrame) -> DataFrame:
    """Cause and legal flags per claim and month, for every month the claim has rows in.

    The cause belongs to the claim; repeating it per month puts both lookups under one
    key, so the wide rows move once for both. The months of a claim are bounded by the
    calendar.
    """
    number = _month_number(F.col("transaction_month")).alias("month_number")
    months = (
        last_per_key(
            by_cause.filter("n_rows > 0"),  # all; see hot_claim_months
            keys=["claim_number"],
            order=["transaction_month", "total_incurred", "loss_cause_type_name"],
            extra=[F.collect_set(_month_number(F.col("transaction_month"))).alias("months")],
        )
        .select(
            "claim_number", "loss_cause_type_name", F.explode("months").alias("month_number")
        )
    )
    flags = legal.select("claim_number", number, "in_suit_flag", "attorney_rep_flag")
    # Rows without a month have no flags. Asked here and not of `legal`: a filter would reach one
    # of two uses of its changes, which then couldn't share a shuffle.
    has_month = F.col("month_number") != _NO_MONTH
    return months.join(flags, ["claim_number", "month_number"], "left").withColumns({
        name: F.coalesce(F.when(has_month, F.col(name)), F.lit(0)) for name in ("in_suit_flag", "attorney_rep_flag")
    })


def hot_claim_months(by_cause: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """Claim months with more rows than a task should take: at most 1 / `skew.share`."""
    number = _month_number(F.col("transaction_month")).alias("month_number")
    # Amounts are asked for so that this use of the grouping has the same columns as the causes'.
    counted = by_cause.filter(
        F.col("claim_number").isNotNull() & (F.col("total_incurred").isNotNull() | (F.col("n_rows") > 0))
    )
    return hot_keys_of(counted.select("claim_number", number, "n_rows"), ["claim_number", "month_number"], skew)


def with_agency(rows: DataFrame, agency: DataFrame, spread: list[str], skew: Skew = Skew()) -> DataFrame:
    """Adds the policy's latest agency type and lets it decide the channel.

    The agencies weigh their policies, too. Both uses ask for the same columns and rows, so
    they share one shuffle, also with those of the other branch.
    """
    return with_channel(salted_left_join(
        rows, agency_lookup(agency), ["policy_reference"], weights=policy_weights(agency), spread=spread, skew=skew,
    ).drop(LANE))


def with_agency_of_policies(rows: DataFrame, agency: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """`with_agency` of rows that are shuffled once, by claim and month, and have their `month_number`
    beside them. Every policy of a claim and month is sent to the agencies once, with nothing else.

    The rows and the question for their policies ask for all columns, so they share the shuffle.
    The answers are shuffled as the rows are, which leaves a policy's answer beside its rows.
    """
    return _with_answers(rows, lambda asked: agency, F.lit(True), skew)


def _with_answers(
    rows: DataFrame, agency_for: Callable[[DataFrame], DataFrame], wanted: Column, skew: Skew
) -> DataFrame:
    """The rows by claim and month, beside them the answers for the policies of which `wanted` holds."""
    key = ["claim_number", "month_number"]
    numbered = rows.withColumn("month_number", _month_number(F.col("transaction_month"))).drop("transaction_month")
    lying = numbered.repartition(*key)
    every = F.xxhash64(*lying.columns)
    asked = lying.groupBy("policy_reference", *key).agg(
        (F.count_if(every == 0) + F.count_if(every != 0)).alias("n_rows"), wanted.alias("wanted")
    ).filter("n_rows > 0 AND wanted").drop("n_rows", "wanted").withColumn(
        # What is inferred from the join for its key would else filter this use of the rows only.
        "policy_reference", F.explode(F.array("policy_reference"))
    )
    agency = agency_for(asked)
    answers = salted_left_join(
        asked, agency_lookup(agency), ["policy_reference"], weights=policy_weights(agency), spread=key, skew=skew,
    ).drop(LANE).filter("agency_type IS NOT NULL").repartition(*key)
    beside = Window.partitionBy(*key, "policy_reference")
    found = lying.withColumn("of_row", every).unionByName(answers, allowMissingColumns=True).withColumn(
        "agency_type", F.max("agency_type").over(beside)
    ).filter("of_row IS NOT NULL").drop("of_row")
    month = F.when(F.col("month_number") != _NO_MONTH, F.date_from_unix_date("month_number"))
    return with_channel(found.withColumn("transaction_month", month))


def agency_lookup(agency: DataFrame) -> DataFrame:
    return agency.filter("policy_reference IS NOT NULL").filter("n_rows > 0").select("policy_reference", "agency_type")


def policy_weights(agency: DataFrame) -> DataFrame:
    """The policies with their rows, asking for the same as the lookup of their agencies does."""
    return agency.filter("policy_reference IS NOT NULL").filter("agency_type IS NOT NULL OR n_rows > 0")


def with_channel(rows: DataFrame) -> DataFrame:
    return rows.withColumn("channel", D.channel_of(F.col("agency_type"), F.col("channel")))


def _level(rows: DataFrame) -> DataFrame:
    # A raw channel is finer than the final one, so rows that were summed are added up once more.
    return with_claim_amounts(rows.groupBy(*_CARRIED, *_LOOKED_UP, "month_number").agg(*_base_sums()))


def claim_level_parts(
    lrd: DataFrame, agency: DataFrame, by_cause: DataFrame, legal: DataFrame, skew: Skew = Skew()
) -> tuple[DataFrame, DataFrame]:
    """Claim-level amounts in units outside the hot claim months, partitioned by claim and
    month, and those of the hot ones, partitioned by all keys."""
    return claim_level_of(lrd, agency, hot_claim_months(by_cause, skew), claim_context(by_cause, legal), skew=skew)


def claim_level_of(
    lrd: DataFrame, agency: DataFrame, hot: DataFrame, context: DataFrame, skew: Skew = Skew()
) -> tuple[DataFrame, DataFrame]:
    """`claim_level_parts` from the hot claim months and the context of all."""
    key = ["claim_number", "month_number"]
    cold = with_agency_of_policies(unit_rows(lrd, hot, "left_anti"), agency, skew=skew)
    summed = with_agency(summed_rows(lrd, hot, "left_semi"), agency, spread=_CARRIED, skew=skew)
    summed = summed.withColumn("month_number", _month_number(F.col("transaction_month")))
    # One row a claim month, so no more than the list has.
    few = F.broadcast(with_hot(context, hot, key, "left_semi"))
    # Raw keys hold policy, claim, month and coverage, so summing by them merges few rows of a cold
    # claim month: not worth a shuffle before the claim level does it where the rows go anyway.
    return (
        _level(with_added(cold).join(context, key, "left")), _level(summed.join(few, key, "left")),
    )


def claim_level_units(
    lrd: DataFrame, agency: DataFrame, by_cause: DataFrame, legal: DataFrame, skew: Skew = Skew()
) -> DataFrame:
    """Claim-level amounts in units; keeps the join's `month_number`."""
    cold, hot = claim_level_parts(lrd, agency, by_cause, legal, skew=skew)
    return cold.unionByName(hot)


def with_net_amounts(rows: DataFrame) -> DataFrame:
    """The four amounts net of recoveries: of a claim-level row, or of each row that it sums."""
    return rows.withColumns({
        name: reduce(Column.__add__, [*(or_zero(F.col(part)) for part in parts), F.col("total_ss")])
        for name, parts in _NET_OF.items()
    })


def claim_amounts(lrd: DataFrame, net_only: bool = False, skew: Skew = Skew()) -> DataFrame:
    """The claim level in units for measures that need neither cause, flags nor agency: the rows of
    `claim_level_units`, without these. With `net_only`, just the four net amounts, which are
    added up before the rows move.

    Cause and flags follow from claim and month, and an agency from the policy, so they part no
    group; an agency only brings raw channels together.
    """
    def rows_of(side: str) -> DataFrame:
        rows = unit_rows(lrd, hot, side)
        return with_net_amounts(rows).select(*_CARRIED, *LIMITED) if net_only else rows

    def added(rows: DataFrame) -> DataFrame:
        return rows if net_only else with_added(rows)

    sums = [F.sum(name).alias(name) for name in (LIMITED if net_only else _BASE_SUMS)]
    month = _month_number(F.col("transaction_month")).alias("month_number")
    counted = lrd.filter(F.col("claim_number").isNotNull()).select("claim_number", month, F.lit(1).alias("n_rows"))
    hot = hot_keys_of(counted, ["claim_number", "month_number"], skew)
    cold = added(with_partner_channel(rows_of("left_anti"), lrd, skew))
    summed = added(rows_of("left_semi")).groupBy(*_CARRIED).agg(*sums)
    summed = with_agency(summed, agency_of_policies(lrd, summed), spread=_CARRIED, skew=skew)
    summed = summed.withColumn("month_number", _month_number(F.col("transaction_month")))
    level = reduce(DataFrame.unionByName, [
        rows.groupBy(*_CARRIED, "month_number").agg(*sums) for rows in (cold, summed)
    ])
    return level if net_only else with_claim_amounts(level)


def agency_of_policies(lrd: DataFrame, asked: DataFrame) -> DataFrame:
    """`latest_agency`, over the rows of the fact whose policies, by hash, are among those asked for."""
    return latest_agency(in_buckets(lrd, asked.select(bucket_of("policy_reference")).distinct(), "policy_reference"))


def with_partner_channel(rows: DataFrame, lrd: DataFrame, skew: Skew = Skew()) -> DataFrame:
    """`with_agency_of_policies` for groups within policy, claim and month that take the agency for its
    channel only: asked for are the policies that have several channels in a claim and month. Rows
    of the others keep their own channel, whatever it would become: it would for all of the group."""
    several = (F.min("channel") != F.max("channel")) | ((F.count("channel") > 0) & (F.count("channel") < F.count(F.lit(1))))
    return _with_answers(
        rows, lambda asked: agency_of_policies(lrd, asked),
        F.coalesce((F.count("policy_reference") > 0) & several, F.lit(False)), skew,
    )


def with_claim_amounts(level: DataFrame) -> DataFrame:
    """Amounts net of recoveries and case reserves, from the base sums.

    A sum of null-safe terms is the null-safe sum of its parts, so nothing is summed
    twice. Paid recoveries count on both the paid and the reported side.
    """
    return with_net_amounts(level).withColumns({
        "case_lossandalae": F.col("reported_lossandalae_ss") - F.col("paid_lossandalae_ss"),
        "case_loss": F.col("reported_loss_ss") - F.col("paid_loss_ss"),
        "total_incurred_xss": F.col("reported_lossandalae_ss") - F.col("total_ss"),
    })


def with_claim_labels(level: DataFrame) -> DataFrame:
    """Dimensions that follow from the others."""
    return level.withColumns({
        "cob_grouping": D.cob_grouping(F.col("cob_group"), F.col("cob_name")),
        "ay": F.year("accident_month"),
        "bop_policy_flag": D.bop_policy_flag(F.col("is_bop").cast("int")),
    })


def with_result_labels(level: DataFrame) -> DataFrame:
    """All dimensions of the result."""
    return with_claim_labels(level).withColumns({
        "indemnity_medicalonly": D.injury_type(
            F.col("lob"), F.col("reported_indemnity_loss"), F.col("reported_medical_loss")
        ),
        "current_appetite": D.appetite(F.col("lob"), F.col("cob_name")),
        "attorney_represented": D.yes_no(F.col("attorney_rep_flag")),
        "litigated": D.yes_no(F.col("in_suit_flag")),
    })


def claim_level(
    lrd: DataFrame, agency: DataFrame, by_cause: DataFrame, legal: DataFrame, skew: Skew = Skew()
) -> DataFrame:
    """One row per claim, month, coverage and the other 23 dimensions; 18 amounts."""
    return finished_level(labelled_level(claim_level_units(lrd, agency, by_cause, legal, skew=skew)))


def labelled_level(level: DataFrame) -> DataFrame:
    """Dimensions and amounts of the claim level, these in units."""
    return with_claim_labels(level).select(*CLAIM_LEVEL_DIMENSIONS, *CLAIM_LEVEL_MEASURES)


def finished_level(level: DataFrame) -> DataFrame:
    return level.select(*CLAIM_LEVEL_DIMENSIONS, *[from_units(F.col(m)).alias(m) for m in CLAIM_LEVEL_MEASURES])


# The measures below are SQL text rather than Column calls: there are hundreds of them, and
# one parsed expression costs the driver a tenth of what building it call by call does.


class RunTimeCaps(dict[str, str]):
    """Caps that come from a table: level -> column with its units, and the one row of them all."""

    def __init__(self, levels: list[str], row: Column) -> None:
        super().__init__({level: f"cap_units_{level}" for level in levels})
        self.row = row

    def beside(self, level: DataFrame) -> DataFrame:
        return level.withColumn("caps_row", self.row).withColumns(
            {column: F.col("caps_row").getField(name) for name, column in self.items()}
        ).drop("caps_row")


def caps_of(table: DataFrame, levels: list[str]) -> RunTimeCaps:
    """The caps in a table of (level, cap), read when the query runs: the plan, and the result's
    columns, depend on the names of the levels only. Each has to have one row with a cap; other
    levels are ignored. The table is reduced to one row where it lies, whatever its size.
    """
    def one(level: str) -> Column:
        own = F.when(F.col("level") == level, F.col("cap"))
        wrong = F.raise_error(F.lit(f"cap {level}: not one row"))
        return F.when(F.count(own) == 1, to_units(F.max(own))).otherwise(wrong.cast("bigint")).alias(level)

    return RunTimeCaps(levels, table.agg(F.struct(*[one(level) for level in levels]).alias("caps")).scalar())


Caps = dict[str, int] | RunTimeCaps


def cap_units(cap: int | str) -> str:
    return cap if isinstance(cap, str) else f"{cap * UNIT}L"


def limit(amount: str, cap: int | str) -> str:
    """The amount in units, at most `cap`; NULL stays NULL (`least` would return the cap)."""
    return f"CASE WHEN {amount} > {cap_units(cap)} THEN {cap_units(cap)} ELSE {amount} END"


# Statuses of a claim-level row. A NULL or negative paid loss is neither closed with pay nor
# closed without.
_CLOSED = "case_lossandalae <= 0"
STATUSES = {
    "open": "case_lossandalae > 0",
    "closed_with_pay": f"{_CLOSED} AND paid_loss > 0",
    "closed_without_pay": f"{_CLOSED} AND paid_loss = 0",
    "closed_expense_only": f"{_CLOSED} AND paid_loss = 0 AND paid_alae > 0",
    "closed_nothing": f"{_CLOSED} AND paid_loss = 0 AND paid_alae = 0",
    "nonzero_reported": "reported_loss > 0",
    "expense_only": "reported_loss = 0 AND reported_alae > 0",
}


def result_sums(caps: Caps = V.CAPS) -> dict[str, str]:
    """The 73 sums behind the 97 claim measures; `derived_measures` gives the rest."""
    def count(condition: str) -> str:
        return f"sum(CASE WHEN {condition} THEN 1 ELSE 0 END)"

    def total(condition: str, amount: str) -> str:
        return f"sum(CASE WHEN {condition} THEN {amount} ELSE 0L END)"

    sums = {
        "cwp_cc": count(STATUSES["closed_with_pay"]),
        "cnp_cc": count(STATUSES["closed_without_pay"]),
        "open_cc": count(STATUSES["open"]),
        "reported_cc": "count(1)",
        "nonzero_reported_cc": count(STATUSES["nonzero_reported"]),
        "expenseonly_cc": count(STATUSES["expense_only"]),
        "closed_expenseonly_cc": count(STATUSES["closed_expense_only"]),
        "closed_nolossorexpense_cc": count(STATUSES["closed_nothing"]),
    }
    for name in ("paid_alae", "reported_alae", *LIMITED, "total_ss", "reported_loss"):
        sums[name] = f"sum({name})"
    for name in ("reported_loss_ss", "reported_lossandalae_ss"):
        sums[f"nonzero_{name}"] = total(STATUSES["nonzero_reported"], name)
    for level, cap in caps.items():
        sums[f"ll_{level}_cc"] = count(f"reported_lossandalae_ss > {cap_units(cap)}")
    for name, (amount, state) in _SPLITS.items():
        sums[_UNLIMITED_NAME.get(name, name)] = total(STATUSES[state], amount)
        for level, cap in caps.items():
            sums[f"{name}_capped_{level}"] = total(STATUSES[state], limit(amount, cap))
    return sums


def derived_measures(caps: Caps = V.CAPS) -> dict[str, str]:
    """Measures that are differences of sums, or sums a group's labels decide."""
    def where_yes(label: str, count: str) -> str:
        return f"CASE WHEN {label} = 'Yes' THEN {count} ELSE 0 END"

    derived = {
        "closed_cc": "reported_cc - open_cc",
        "litigated_claim_count": where_yes("litigated", "reported_cc"),
        "attorney_rep_claim_count": where_yes("attorney_represented", "reported_cc"),
        "litigated_nonzero_claim_count": where_yes("litigated", "nonzero_reported_cc"),
        "attorney_nonzero_claim_count":
            where_yes("attorney_represented", "nonzero_reported_cc"),
        "case_lossandalae": "reported_lossandalae_ss - paid_lossandalae_ss",
        "case_loss": "reported_loss_ss - paid_loss_ss",
        "total_incurred_xss": "reported_lossandalae_ss - total_ss",
    }
    for name, (reported, paid) in _CASE_ON_OPEN.items():
        derived[name] = f"{_UNLIMITED_NAME.get(reported, reported)} - {paid}"
        for case, r, p in zip(
            capped(name, caps), capped(reported, caps), capped(paid, caps)
        ):
            derived[case] = f"{r} - {p}"
    return derived


def claims_units(
    lrd: DataFrame, agency: DataFrame, by_cause: DataFrame, legal: DataFrame, skew: Skew = Skew(),
    caps: Caps = V.CAPS,
) -> DataFrame:
    """The claims half of the result before `finished`: dimensions, and sums in units."""
    return units_of_level(*claim_level_parts(lrd, agency, by_cause, legal, skew=skew), caps)


def units_of_level(cold: DataFrame, hot: DataFrame, caps: Caps = V.CAPS) -> DataFrame:
    """`claims_units` from the two parts of the claim level."""
    if isinstance(caps, RunTimeCaps):
        cold, hot = caps.beside(cold), caps.beside(hot)
    sums = [F.expr(f"{total} AS {name}") for name, total in result_sums(caps).items()]
    # 27 keys and 73 sums: past spark.sql.codegen.maxFields (100), which is as it should
    # be. One generated method for all of them ran four times slower than Spark's
    # per-expression projections, because the JVM hardly optimises methods that size.
    rolled = with_result_labels(cold).groupBy(*DIMENSIONS, "month_number").agg(*sums).drop("month_number").unionByName(
        with_result_labels(hot).groupBy(*DIMENSIONS).agg(*sums)
    )
    # Premium has no meaning on a claim row.
    return as_units(rolled, dict.fromkeys(PREMIUM_UNITS, "NULL"), caps)


# Units of premium, and days, behind the two premium measures.
PREMIUM_UNITS = ["premium", "earned_days"]


def as_units(rows: DataFrame, values: dict[str, str], caps: Caps) -> DataFrame:
    """Dimensions in output types and all sums as 64-bit numbers: what either branch's rows are, and
    go through a shuffle as, before `finished` makes the wider output columns of them."""
    given = [
        f.name if f.name in GIVEN_DIMENSIONS else f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in output(caps) if f.name in DIMENSIONS
    ]
    numbers = [f"CAST({values.get(name, name)} AS BIGINT) AS {name}" for name in [*PREMIUM_UNITS, *result_sums(caps)]]
    return rows.selectExpr(*given, *numbers)


def finished(rows: DataFrame, caps: Caps = V.CAPS) -> DataFrame:
    """The output columns of rows in units."""
    values = {**derived_measures(caps), "earned_premium": "premium"}
    money = {*claim_measures(caps), "earned_premium"} - counts(caps)

    def column(field: StructField) -> str:
        value = values.get(field.name, field.name)
        if field.name in DIMENSIONS:
            return value
        if field.name in money:
            value = from_units_sql(value)
        return f"CAST({value} AS {field.dataType.simpleString()}) AS {field.name}"

    return rows.withColumn("earned_policy_years", policy_years(F.col("earned_days"))).selectExpr(
        *[column(field) for field in output(caps)]
    )


def claims_branch(
    lrd: DataFrame, agency: DataFrame, by_cause: DataFrame, legal: DataFrame, skew: Skew = Skew(),
    caps: Caps = V.CAPS,
) -> DataFrame:
    """The claims half of the result, in output columns and types, limited at `caps`."""
    return finished(claims_units(lrd, agency, by_cause, legal, skew=skew, caps=caps), caps)
