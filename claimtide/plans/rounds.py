"""The results over the stored inputs, in rounds where one plan would shuffle too much at once.

Spark keeps what a plan shuffles until the plan has run, so a result over a large fact takes many times
the fact's room on the disks. Here a large fact is worked off in rounds, by a hash of the claim in one
branch and of the policy in the other: every claim, and every policy, is whole in one round, so a round is
the plan of `claims` or `premium` over fewer rows. What a round gives is added to a scratch
table, in a format that packs better than a shuffle, and what it has shuffled is removed before the next.
Lookups are made first, once, and stored likewise. All rows are read in every round, and each is used in
one of them.

What orders the result, or groups it once more, takes the scratch table in parts: in ranges of the
order or by a hash of the keys. A part is removed when it is done.

Facts of up to `ROUND_ROWS` rows need one round, which is the plan as it is, and nothing is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from claimtide import fixed_values as V
from claimtide.operators.latest import incurred_by_cause, latest_agency
from claimtide.operators.legal import legal_flags_by_claim_month
from claimtide.operators.salted_join import Skew
from claimtide.plans import claims as C, premium as P
from claimtide.plans.emergence import emergence_units, rolled_up
from claimtide.plans.layout import ordered, part_of, result_borders, with_range
from claimtide.schema import DIMENSIONS
from claimtide.session import append, remove_folder, shared_folder
from claimtide.sources.files import Store
from claimtide.sources.staged import Inputs
from claimtide.sources.tables import Parts, publish_parquet, read_in_order, write_in_order

# Fact rows a round has about, and rounds there are at most: more rounds read the fact more often.
ROUND_ROWS = 4_000_000
MOST_ROUNDS = 8

_PART = "part"

Shape = Callable[[DataFrame], DataFrame]


def rounds_of(lrd: DataFrame) -> int:
    return min(MOST_ROUNDS, 1 + lrd.count() // ROUND_ROWS)  # counted from the files' footers


def _own(rows: DataFrame, key: str, k: int, rounds: int) -> DataFrame:
    """The rows of a round. Those without a key are in one round as well."""
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(rounds)) == k)


def _table(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


@contextmanager
def _kept(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that stores rows; what it has stored is removed in the end."""
    folders = []

    def keep(rows: DataFrame, purpose: str) -> DataFrame:
        folders.append(shared_folder(spark, purpose))
        append(rows, folders[-1])
        return _table(spark, folders[-1], rows.schema)

    try:
        yield keep
    finally:
        for folder in folders:
            remove_folder(spark, folder)


def _levels(t: Inputs, agency: DataFrame, rounds: int, skew: Skew) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The two parts of each round's claim level. A round's are gone when the next is asked for."""
    # Neither rows nor changes without a claim say anything about one.
    claimed, changes = (rows.filter(F.col("claim_number").isNotNull()) for rows in (t.lrd, t.fin_changes))
    with _kept(t.lrd.sparkSession) as keep:
        legal = keep(legal_flags_by_claim_month(changes, t.legal_scd, skew), "legal")
        by_cause = keep(incurred_by_cause(claimed), "causes")
        hot = keep(C.hot_claim_months(by_cause, skew), "hot")
        context = keep(C.claim_context(by_cause, legal), "context")
        for k in range(rounds):
            lrd, own = (_own(rows, "claim_number", k, rounds) for rows in (t.lrd, context))
            yield C.claim_level_of(lrd, agency, hot, own, skew)


def _premium(t: Inputs, agency: DataFrame, rounds: int, skew: Skew, caps: C.Caps, add: Callable[[DataFrame], None]) -> None:
    """Adds the premium half of the result. The rows of a policy are differenced in one round; what they
    earn is grouped by the result's keys, which policies share, after all rounds."""
    with _kept(t.lrd.sparkSession) as keep:
        hot = keep(P.hot_policies(agency, skew), "hot")
        folder = shared_folder(t.lrd.sparkSession, "earned")
        try:
            for k in range(rounds):
                lrd, own = (_own(rows, "policy_reference", k, rounds) for rows in (t.lrd, agency))
                earned = P.earned_by_policy(lrd, own, hot)
                append(earned, folder)
            add(P.units_of_earned(_table(t.lrd.sparkSession, folder, earned.schema), caps))
        finally:
            remove_folder(t.lrd.sparkSession, folder)


class _Added:
    """A scratch table that rows are added to, in one folder or one for each part."""

    def __init__(self, spark: SparkSession, purpose: str, part: Column | None = None) -> None:
        self._spark, self._part = spark, part
        self._folder = shared_folder(spark, purpose)
        self._schema: StructType | None = None

    def add(self, rows: DataFrame) -> None:
        self._schema = rows.schema
        if self._part is None:
            append(rows, self._folder)
        else:
            append(rows.withColumn(_PART, self._part), self._folder, by=_PART)

    def rows(self) -> DataFrame:
        return _table(self._spark, self._folder, self._schema)

    def parts(self) -> Iterator[DataFrame]:
        """The parts, by number; each is removed when the next is asked for."""
        prefix = f"{_PART}="
        numbers = sorted(
            int(name.removeprefix(prefix)) for name in Store(self._spark, self._folder).names(self._folder)
            if name.startswith(prefix)
        )
        if not numbers:
            yield self._spark.createDataFrame([], self._schema)
        for number in numbers:
            folder = f"{self._folder}/{prefix}{number}"
            yield _table(self._spark, folder, self._schema)
            remove_folder(self._spark, folder)
        remove_folder(self._spark, self._folder)


def _result(t: Inputs, rounds: int, part: Column | None = None, shape: Shape = lambda rows: rows) -> _Added:
    """`shape` of the result in units, stored."""
    spark = t.lrd.sparkSession
    found = _Added(spark, "result", part)
    with _kept(spark) as keep:
        agency = keep(latest_agency(t.lrd), "agencies")
        _premium(t, agency, rounds, Skew(), V.CAPS, lambda rows: found.add(shape(rows)))
        for cold, hot in _levels(t, agency, rounds, Skew()):
            found.add(shape(C.units_of_level(cold, hot)))
    return found


def result_units(t: Inputs) -> DataFrame:
    """`emergence_units`."""
    rounds = rounds_of(t.lrd)
    return emergence_units(*t) if rounds == 1 else _result(t, rounds).rows()


def claim_levels(t: Inputs, shape: Shape, skew: Skew = Skew()) -> DataFrame:
    """`shape`, which goes row by row, of `claims.claim_level_units`."""
    rounds, spark = rounds_of(t.lrd), t.lrd.sparkSession
    if rounds == 1:
        return shape(C.claim_level_units(
            t.lrd, latest_agency(t.lrd), incurred_by_cause(t.lrd),
            legal_flags_by_claim_month(t.fin_changes, t.legal_scd, skew), skew,
        ))
    found = _Added(spark, "claim-level")
    with _kept(spark) as keep:
        for cold, hot in _levels(t, keep(latest_agency(t.lrd), "agencies"), rounds, skew):
            found.add(shape(cold.unionByName(hot)))
    return found.rows()


def claims_units(t: Inputs, shape: Shape, caps: C.Caps = V.CAPS, skew: Skew = Skew()) -> DataFrame:
    """`shape`, which goes row by row, of `claims.claims_units`."""
    rounds, spark = rounds_of(t.lrd), t.lrd.sparkSession
    if rounds == 1:
        return shape(C.claims_units(
            t.lrd, latest_agency(t.lrd), incurred_by_cause(t.lrd),
            legal_flags_by_claim_month(t.fin_changes, t.legal_scd, skew), skew, caps,
        ))
    found = _Added(spark, "claims")
    with _kept(spark) as keep:
        for cold, hot in _levels(t, keep(latest_agency(t.lrd), "agencies"), rounds, skew):
            found.add(shape(C.units_of_level(cold, hot, caps)))
    return found.rows()


def premium_units(t: Inputs, caps: C.Caps = V.CAPS, skew: Skew = Skew()) -> DataFrame:
    """`premium.premium_units`."""
    rounds, spark = rounds_of(t.lrd), t.lrd.sparkSession
    if rounds == 1:
        return P.premium_units(t.lrd, latest_agency(t.lrd), skew, caps)
    found = _Added(spark, "premium")
    with _kept(spark) as keep:
        _premium(t, keep(latest_agency(t.lrd), "agencies"), rounds, skew, caps, found.add)
    return found.rows()


def rolled_up_units(t: Inputs) -> DataFrame:
    """`emergence.rolled_up` of the result in units."""
    rounds, spark = rounds_of(t.lrd), t.lrd.sparkSession
    if rounds == 1:
        return rolled_up(emergence_units(*t))
    found = _Added(spark, "rolled-up")
    for rows in _result(t, rounds, F.pmod(F.xxhash64(*DIMENSIONS), F.lit(rounds))).parts():
        found.add(rolled_up(rows))
    return found.rows()


def _in_ranges(t: Inputs, borders: list[str], rounds: int) -> DataFrame | Parts:
    if rounds == 1:
        return emergence_units(*t)
    found = _result(t, rounds, part_of(borders, rounds), lambda rows: with_range(rows, borders))
    return Parts(t.lrd.sparkSession, found.parts())


def ordered_result(t: Inputs) -> DataFrame:
    """The result in order, in output columns."""
    borders, rounds, spark = result_borders(t.lrd), rounds_of(t.lrd), t.lrd.sparkSession
    if rounds == 1:
        return C.finished(ordered(emergence_units(*t), borders))
    folder = shared_folder(spark, "ordered")
    write_in_order(_in_ranges(t, borders, rounds), folder, borders, C.finished, compression="zstd")
    return read_in_order(spark, folder, C.finished(emergence_units(*t)).schema)


def publish_result(t: Inputs, path: str) -> None:
    """Publishes the result, in order."""
    borders = result_borders(t.lrd)
    publish_parquet(_in_ranges(t, borders, rounds_of(t.lrd)), path, borders, C.finished)
