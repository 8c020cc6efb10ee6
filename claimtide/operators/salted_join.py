"""Left join onto a lookup when a few keys may hold most of the rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LANE = "lane"

# Rows without a key match nothing; they only have to be kept apart.
NULL_LANES = 4096

# The keys of a hot key, as one column.
HOT_KEY = "hot_key"

# Rows are counted by so many hashes of their keys before any key is counted: a key can't have more
# rows than its hash, so only keys of large hashes need a count, and a shuffle, of their own. A power of two.
BUCKETS = 65_536
BUCKET = "hash_bucket"


@dataclass(frozen=True)
class Skew:
    """When a key counts as hot."""

    # Rows that one task of a join should read at most: a key with more of them is spread
    # over as many lanes as it takes. Choose about the joined rows over the number of
    # shuffle partitions.
    rows_per_lane: int = 2_000_000
    # A key is hot only if it holds more than this share of all rows, so no more keys than
    # its inverse can be, whatever the data. A smaller key fits a task of as many partitions.
    # By default the inverse of the session's shuffle partitions, 4,096 at least.
    least_share: float | None = None
    # Pairs of rows and ranges of one key from which on an interval join goes month by month.
    pairs_per_key: int = 1_000_000

    def share(self, spark: SparkSession) -> float:
        if self.least_share is not None:
            return self.least_share
        return 1 / max(4096, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(
    weights: DataFrame, keys: list[str], skew: Skew, carried: list[str] = [], all_weights: DataFrame | None = None
) -> DataFrame:
    """The keys to spread and how many lanes each needs: at most 1 / `skew.share` rows.

    `weights` has one row per key with its number of rows in `n_rows`; where it lacks keys that
    can't be hot, `all_weights` has the rows of all. The keys come as one struct: a join on it asks
    nothing of the weights' keys, so that Spark doesn't filter the weights differently from other
    uses of the same grouping, and they share a shuffle.
    """
    every = weights if all_weights is None else all_weights
    share = every.agg((F.sum("n_rows") * skew.share(weights.sparkSession)).alias("least")).scalar()
    lanes = F.ceil(F.col("n_rows") / F.lit(skew.rows_per_lane)).cast("int")
    return weights.filter(
        (F.col("n_rows") > skew.rows_per_lane) & (F.col("n_rows") > share)
    ).select(F.struct(*keys).alias(HOT_KEY), lanes.alias("lanes"), *carried)


def bucket_of(*keys: Column | str) -> Column:
    # Can't be NULL by its type, so that a join on it filters nothing before it.
    return F.xxhash64(*keys).bitwiseAND(F.lit(BUCKETS - 1)).alias(BUCKET)


def in_buckets(rows: DataFrame, buckets: DataFrame, *keys: Column | str) -> DataFrame:
    """The rows whose keys are in one of the buckets, which are broadcast."""
    return rows.join(F.broadcast(buckets.select(BUCKET)), bucket_of(*keys) == F.col(BUCKET)).drop(BUCKET)


def hot_keys_of(counted: DataFrame, keys: list[str], skew: Skew) -> DataFrame:
    """`hot_keys` of rows (keys, n_rows) that don't lie by key and may have it several times. They
    are added up by hash, map-side; only rows of hashes that may hold a hot key are shuffled."""
    per_bucket = counted.groupBy(bucket_of(*keys)).agg(F.sum("n_rows").alias("n_rows"))
    large = per_bucket.filter(F.col("n_rows") > skew.rows_per_lane)
    weights = in_buckets(counted, large, *keys).groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))
    return hot_keys(weights, keys, skew, all_weights=per_bucket)


def with_hot(rows: DataFrame, hot: DataFrame, keys: list[str] | list[Column], how: str = "left") -> DataFrame:
    """Rows with what the list of hot keys says about theirs, which is broadcast."""
    return rows.join(F.broadcast(hot), F.struct(*keys) == F.col(HOT_KEY), how)


def salted_left_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weights: DataFrame,
    spread: list[str],
    residual: Column | None = None,
    skew: Skew = Skew(),
) -> DataFrame:
    """`rows LEFT JOIN lookup USING (keys) [AND residual]`, plus the column `lane`.

    Rows of a hot key are dealt over its lanes by a hash of `spread`, and that key's
    lookup rows are repeated once per lane; every other key has lane 0 only. The lane
    is a pure function of the row, so a task that is run again deals the same way.
    """
    hot = hot_keys(weights, keys, skew)
    left = dealt(with_hot(rows, hot, keys).drop(HOT_KEY), keys, spread)
    right = with_hot(lookup, hot, keys).select(
        *_as_lookup_keys(keys), *_besides(lookup, keys), F.explode(lanes_of()).alias(f"lookup_{LANE}"),
    )
    return matched(left, right, [*keys, LANE], residual)


def matched(left: DataFrame, right: DataFrame, on: list[str], residual: Column | None) -> DataFrame:
    """The left join on columns that are called lookup_… on the right."""
    equal = reduce(Column.__and__, [F.col(k) == F.col(f"lookup_{k}") for k in on])
    joined = left.join(right, equal if residual is None else equal & residual, "left")
    return joined.drop(*[f"lookup_{k}" for k in on])


def lanes_of() -> Column:
    """The lanes of a row's key, after `with_hot`."""
    return F.sequence(F.lit(0), F.coalesce(F.col("lanes"), F.lit(1)) - 1)


def _as_lookup_keys(keys: list[str]) -> list[Column]:
    return [F.col(k).alias(f"lookup_{k}") for k in keys]


def _besides(lookup: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(c) for c in lookup.columns if c not in keys]


def dealt(rows: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Gives each row its lane: its key's `lanes` decide among how many."""
    deal = F.xxhash64(*spread)
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    lane = (
        F.when(no_key, F.pmod(deal, F.lit(NULL_LANES)))
        .when(F.col("lanes").isNotNull(), F.pmod(deal, F.col("lanes")))
        .otherwise(F.lit(0))
    )
    return rows.withColumn(LANE, lane.cast("int")).drop("lanes")
