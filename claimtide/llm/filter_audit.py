"""Which of several filters removes what, in every order, by exact constrained least squares.

A document's failed filters are a bit mask. Counts by mask give the value of each coalition:
the documents that any filter of it removes. A step of an order removes the difference of two
coalitions. A filter's Shapley value is the solution of a least-squares problem over all
coalitions, weighted by the Shapley kernel and held to add up to what all filters remove
together; its normal equations are solved once, in rationals.
"""

from __future__ import annotations

import hashlib
import re
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import arrow, chosen, per_batch, stored

FILTERS = "ABCDE"  # the last is found by a join, the others in the text
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10  # the last two in percent
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(rb"[#$%&*|]")


def text_mask(text: str) -> tuple[int, bytes]:
    """The failed filters of a text as bits, but for the last filter, and the text's digest."""
    raw = text.encode()
    words = raw.split()  # on the white space of ASCII
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * len(text),
        _SYMBOL.search(raw) is not None,
    )
    return sum(1 << k for k, f in enumerate(failed) if f), hashlib.sha256(raw).digest()


def _masks(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [text_mask(text or "") for text in batch.column("text").to_pylist()]
    return arrow(doc_id=batch.column("doc_id"), part=batch.column("part"), mask=pa.array([m for m, _ in found], pa.int32()),
                 digest=pa.array([d for _, d in found], pa.binary()))


def solved(matrix: list[list[Fraction]], sides: list[list[Fraction]]) -> list[list[Fraction]]:
    """matrix⁻¹ · sides in rationals."""
    size = len(matrix)
    rows = [[*m, *s] for m, s in zip(matrix, sides)]
    for k in range(size):
        pivot = next(r for r in range(k, size) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(size):
            if r != k and rows[r][k]:
                factor = rows[r][k]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[k])]
    return [row[size:] for row in rows]


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """For each filter the weight of every coalition's value in its Shapley value.

    Minimises the sum over coalitions of kernel · (value − sum of the members' shares)², under
    the constraint that all shares add up to the value of the whole.
    """
    whole = (1 << filters) - 1
    kernel = {s: Fraction(filters - 1, comb(filters, n) * n * (filters - n))
              for s in range(1, whole) for n in [s.bit_count()]}
    inside = lambda s, f: s >> f & 1
    matrix = [[sum((k for s, k in kernel.items() if inside(s, f) and inside(s, g)), Fraction(0)) for g in range(filters)] + [Fraction(1)]
              for f in range(filters)]
    matrix.append([Fraction(1)] * filters + [Fraction(0)])
    sides = [[kernel[s] if s in kernel and inside(s, f) else Fraction(0) for s in range(whole + 1)] for f in range(filters)]
    sides.append([Fraction(int(s == whole)) for s in range(whole + 1)])
    return solved(matrix, sides)[:filters]


def document_masks(frame: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): the documents of a part by failed filters and labels."""
    docs = chosen(frame, doc_id="long", text="string", lang="string").select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    kinds = "doc_id long, part string, mask int, digest binary"
    # Repeated rows are one with a number from here on.
    rows = stored(docs.mapInArrow(per_batch(_masks), kinds).groupBy("doc_id", "part", "mask", "digest").agg(
        F.count("*").alias("n")), "masks")
    without = rows.where("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n")
    named = rows.where("doc_id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = chosen(labels, doc_id="long", quality="long", toxic="long").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c) for c in ("quality", "toxic")])
    repeated = F.when(F.col("is_first").isNull(), 1 << len(FILTERS) - 1).otherwise(0)
    joined = named.join(marked, "doc_id", "left").join(first, ["doc_id", "digest"], "left").select(
        "part", F.col("mask").bitwiseOR(repeated).alias("mask"), F.coalesce("quality", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), "n")
    return without.unionByName(joined).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _coalitions(amount: Column, name: str) -> Column:
    """For each coalition the sum of the amount over documents that any of its filters removes."""
    return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, amount).otherwise(0)) for s in range(1 << len(FILTERS))]).alias(name)


def audit(frame: DataFrame, labels: DataFrame) -> DataFrame:
    """The filters' effects in every order, per part (value of lang) of documents (doc_id, text,
    lang), with labels (doc_id, quality, toxic): part, filter_order, step, and documents kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley (the filter's removals
    added up over all orders).

    A null text is an empty one, a null lang the part ''. Repeated rows count each; rows that
    share an id don't repeat each other, unlike rows of equal texts under different ids. A
    document without an id repeats no other and has no label. A document with several labels
    is good or toxic if any says so; a null label says nothing. Other columns are ignored.
    Without documents there are no parts.
    """
    filters, n = len(FILTERS), F.col("n")
    counts = document_masks(frame, labels)
    alone = [F.sum(F.when(F.col("mask") == 1 << f, n).otherwise(0)) for f in range(filters)]
    values = counts.groupBy("part").agg(
        F.sum("n").alias("total"), _coalitions(n, "lost"), _coalitions(n * F.col("good"), "good"),
        _coalitions(n * F.col("toxic"), "toxic"), F.array(*alone).alias("alone"))
    orders = factorial(filters)
    shares = []
    for weights in shapley_weights(filters):
        whole = [orders * w for w in weights]
        assert all(w.denominator == 1 for w in whole)
        shares.append(sum((F.col("lost")[s] * int(w) for s, w in enumerate(whole) if w), F.lit(0).cast("long")))
    steps = []
    for order in permutations(range(filters)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(FILTERS[g] for g in order), step, f, 1 << f, before, before | 1 << f))
            before |= 1 << f
    columns = ["filter_order", "step", "f", "bit", "before", "after"]
    plan = F.arrays_zip(*[F.lit(list(c)).alias(name) for name, c in zip(columns, zip(*steps))])
    each = values.withColumn("shares", F.array(*shares)).select("*", F.explode(plan).alias("s")).select("*", "s.*")
    change = lambda name: F.col(name)[F.col("after")] - F.col(name)[F.col("before")]
    removed, fails = change("lost"), F.col("lost")[F.col("bit")]
    return each.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), (F.col("total") - F.col("lost")[F.col("after")]).alias("kept"),
        removed.alias("removed"), (fails - removed).alias("redundant"), F.col("alone")[F.col("f")].alias("unique_fails"),
        change("good").alias("good_lost"), change("toxic").alias("toxic_lost"), F.col("shares")[F.col("f")].alias("shapley"))
