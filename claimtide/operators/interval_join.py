"""Left join of dated rows onto day ranges of their key.

A key with few rows or few ranges is joined as it is. A key with many pairs of them is
indexed by months: each of its ranges is repeated for the months in which the key has rows,
clipped to them, so that a row meets the ranges of its own month only. An open-ended range
goes up to the key's last month with rows. Ranges that are equal once clipped can be merged,
which leaves a few hundred a month whatever number there were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimtide.operators.salted_join import (
    BUCKET, HOT_KEY, LANE, Skew, bucket_of, dealt, in_buckets, lanes_of, matched, with_hot,
)

MONTH = "month_bucket"
_ALL_MONTHS = 0  # the only bucket of keys that are not indexed


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _month_start(month: Column) -> Column:
    return F.make_date(F.floor(month / 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1))


def _number(rows: DataFrame, key: str) -> Column:
    """The number of rows, in a form that names every column: rows that come from a grouping
    have the same columns here as in the join, so that both uses share a shuffle."""
    every = F.xxhash64(*[c for c in rows.columns if c != key])
    return F.count_if(every == 0) + F.count_if(every != 0)


def index_of(rows: DataFrame, ranges: DataFrame, key: str, skew: Skew) -> DataFrame:
    """The keys to spread or to index: (hot_key, lanes, from_month, to_month), the months being
    NULL for keys that are only spread; at most 2 / `skew.share` rows.

    Rows and ranges are counted by hash of their key first, which is merged map-side: a key has no
    more of either than its hash, and only keys of hashes with enough of them are counted."""
    spark = rows.sparkSession
    bucket = bucket_of(key)
    rows_per_bucket = rows.groupBy(bucket).agg(_number(rows, key).alias("n_rows"))
    per_bucket = rows_per_bucket.withColumn("n_ranges", F.lit(0).cast("bigint")).unionByName(
        ranges.groupBy(bucket).agg(_number(ranges, key).alias("n_ranges")).withColumn("n_rows", F.lit(0).cast("bigint"))
    ).groupBy(BUCKET).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_ranges").alias("n_ranges"))
    share = skew.share(spark)
    least_rows = rows_per_bucket.agg((F.sum("n_rows") * share).alias("least")).scalar()
    large = per_bucket.filter(
        (F.col("n_rows") > skew.rows_per_lane)
        | (F.col("n_rows").cast("double") * F.col("n_ranges") > skew.pairs_per_key)
    )
    rows, ranges = in_buckets(rows, large, key), in_buckets(ranges, large, key)
    per_row = rows.groupBy(key).agg(
        _number(rows, key).alias("n_rows"),
        F.min(_month(F.col("date"))).alias("from_month"), F.max(_month(F.col("date"))).alias("to_month"),
    ).withColumn("n_ranges", F.lit(0).cast("bigint"))
    per_range = ranges.groupBy(key).agg(
        _number(ranges, key).alias("n_ranges")
    ).select(
        key, F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(None).cast("int").alias("from_month"), F.lit(None).cast("int").alias("to_month"), "n_ranges",
    )
    counted = per_row.unionByName(per_range).groupBy(key).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_ranges").alias("n_ranges"),
        F.min("from_month").alias("from_month"), F.max("to_month").alias("to_month"),
    ).withColumn("pairs", F.col("n_rows").cast("double") * F.col("n_ranges"))
    # Of the keys counted: a lower bar than all keys' pairs would give, which still bounds the list.
    least_pairs = counted.agg((F.sum("pairs") * share).alias("least")).scalar()
    many_rows = (F.col("n_rows") > skew.rows_per_lane) & (F.col("n_rows") > least_rows)
    many_pairs = (F.col("pairs") > skew.pairs_per_key) & (F.col("pairs") > least_pairs)
    return counted.filter(many_rows | many_pairs).select(
        F.struct(key).alias(HOT_KEY),
        F.when(many_rows, F.ceil(F.col("n_rows") / F.lit(skew.rows_per_lane)).cast("int")).alias("lanes"),
        F.when(many_pairs, F.col("from_month")).alias("from_month"),
        F.when(many_pairs, F.col("to_month")).alias("to_month"),
    )


def sides(
    rows: DataFrame, ranges: DataFrame, key: str, spread: list[str], merged: list[str], skew: Skew
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join, with the columns that it is on: key, lane and month."""
    # A range that ends before it starts, or lacks a day or key, covers nothing.
    ranges = ranges.filter((F.col("first_day") <= F.col("last_day")) & F.col(key).isNotNull())
    index = index_of(rows, ranges, key, skew)
    indexed = F.col("from_month").isNotNull()
    left = with_hot(rows, index, [key]).withColumn(
        MONTH, F.when(indexed, _month(F.col("date"))).otherwise(F.lit(_ALL_MONTHS))
    )
    left = dealt(left.drop(HOT_KEY, "from_month", "to_month"), [key], spread)

    first = F.greatest(_month(F.col("first_day")), F.col("from_month"))
    last = F.least(_month(F.col("last_day")), F.col("to_month"))
    months = F.when(~indexed, F.array(F.lit(_ALL_MONTHS))).when(first <= last, F.sequence(first, last)).otherwise(
        F.array().cast("array<int>")
    )
    repeated = with_hot(ranges, index, [key]).withColumn(MONTH, F.explode(months))
    start = _month_start(F.col(MONTH))
    repeated = repeated.withColumns({
        "first_day": F.when(indexed, F.greatest("first_day", start)).otherwise(F.col("first_day")),
        "last_day": F.when(indexed, F.least("last_day", F.last_day(start))).otherwise(F.col("last_day")),
    })
    on = [f"lookup_{key}", f"lookup_{LANE}", f"lookup_{MONTH}"]
    besides = [c for c in ranges.columns if c != key]
    right = repeated.select(
        F.col(key).alias(on[0]), F.explode(lanes_of()).alias(on[1]), F.col(MONTH).alias(on[2]), *besides
    )
    if merged:
        # Grouped inside the partitioning of the join.
        right = right.repartition(*on).groupBy(*on, "first_day", "last_day").agg(*[F.max(c).alias(c) for c in merged])
    return left, right


def interval_left_join(
    rows: DataFrame, ranges: DataFrame, key: str, spread: list[str], merged: list[str] = [],
    skew: Skew = Skew(),
) -> DataFrame:
    """`rows` (key, date, …) with each of the `ranges` (key, first_day, last_day, …) of their key
    that holds their date, and NULL where none does.

    A range holds midnight of its first day up to midnight of its last. With `merged` columns,
    equal ranges of a key are one with the largest values of these.
    """
    left, right = sides(rows, ranges, key, spread, merged, skew)
    inside = F.col("date").between(F.col("first_day"), F.col("last_day"))
    return matched(left, right, [key, LANE, MONTH], inside)
