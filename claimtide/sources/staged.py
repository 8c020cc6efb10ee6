"""The three inputs as stored tables.

The result reads the fact five times. Where the fact is a view (here: a join of four
tables), it is written once to the shared folder and read from there, so that every
use prunes its own columns and pushes its own filters, and a lost executor costs the
rows it was reading, not the join behind them. One table holds the fact and the columns of
the changes, which come from the same rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from claimtide.schema import FIN_CHANGES, LEGAL_SCD, LRD
from claimtide.session import append, shared_folder
from claimtide.sources import driver_tables
from claimtide.sources.files import Store
from claimtide.sources.tables import conform


class Inputs(NamedTuple):
    lrd: DataFrame
    fin_changes: DataFrame
    legal_scd: DataFrame


# Where this application has stored the inputs of a folder, and from which version of the tables.
# Another application stores its own; all of it is removed when the process ends.
_stored: dict[tuple[str, str], tuple[tuple, str]] = {}


def stage(spark: SparkSession, folder: str) -> str:
    """Where the inputs of `folder` are stored; writes them at an application's first use, and
    anew when a table behind them was rewritten. What was stored before stays to the end, as
    a query may still be reading it."""
    key = (spark.sparkContext.applicationId, folder)
    files = Store(spark, folder)
    version = tuple(files.version(f"{folder}/{name}.parquet") for name in driver_tables.TABLES)
    if key not in _stored or _stored[key][0] != version:
        target = shared_folder(spark, "inputs")
        append(driver_tables.fact_and_changes(spark, folder), f"{target}/lines")
        append(driver_tables.legal_scd(spark, folder), f"{target}/legal_scd")
        _stored[key] = version, target
    return _stored[key][1]


def inputs(spark: SparkSession, folder: str) -> Inputs:
    target = stage(spark, folder)
    lines = spark.read.parquet(f"{target}/lines")
    return Inputs(
        conform(driver_tables.fact_of(lines), LRD),
        conform(driver_tables.changes_of(lines), FIN_CHANGES),
        conform(spark.read.parquet(f"{target}/legal_scd"), LEGAL_SCD),
    )
