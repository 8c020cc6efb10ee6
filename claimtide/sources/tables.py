"""Reading the three inputs and writing the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from claimtide.functions.money import exact_decimal
from claimtide.plans.layout import ordered
from claimtide.schema import AS_GIVEN, MAY_HOLD_TIME, MONEY_IN, PLACES
from claimtide.session import shuffles_removed
from claimtide.sources.files import Store

_TIMED = (T.TimestampType, T.TimestampNTZType)


def conform(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its types; a missing column is an error.

    Descriptions and ids that are only compared or carried through keep their type, and a time
    of day stays where the contract allows one. Money with more places than the contract's is
    refused: it could not be added without rounding. Floating-point money is taken as the decimal
    it stands for, and a value with more places is an error when it is read. Columns that
    already fit pass as they are, without a cast or an alias, so that two uses of one table
    still look alike to Spark and can share a shuffle.
    """
    present = {f.name.lower(): f.dataType for f in rows.schema}
    missing = [f.name for f in contract if f.name not in present]
    if missing:
        raise ValueError(f"input lacks {', '.join(missing)}")

    def fits(field: T.StructField) -> bool:
        found = present[field.name]
        if field.dataType == MONEY_IN and not _exact(found):
            raise ValueError(
                f"{field.name} is {found.simpleString()}: cast it to a decimal with at most {PLACES} places"
            )
        timed = MAY_HOLD_TIME in field.metadata and isinstance(found, _TIMED)
        return timed or AS_GIVEN in field.metadata or found == field.dataType

    def column(field: T.StructField) -> Column:
        found = present[field.name]
        if field.dataType == MONEY_IN and isinstance(found, T.FractionalType) and not isinstance(found, T.DecimalType):
            return exact_decimal(F.col(field.name), found).alias(field.name)
        return F.col(field.name) if fits(field) else F.col(field.name).cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in contract])


def _exact(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale <= PLACES


def from_parquet(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), contract)


def from_table(spark: SparkSession, name: str, contract: T.StructType) -> DataFrame:
    return conform(spark.table(name), contract)


# The file of a published folder that names the version to read.
CURRENT = "_current"
_VERSION = "version-"


Finish = Callable[[DataFrame], DataFrame]


class Parts(NamedTuple):
    """Rows in parts that follow each other in result order, cut where ranges are."""

    sparkSession: SparkSession
    each: Iterator[DataFrame]


def write_in_order(
    rows: DataFrame | Parts, target: str, borders: list[str] | None, finish: Finish, compression: str | None = None
) -> None:
    """Writes the rows to a new folder, in files whose names are in order: every part has the numbers
    of all ranges and fills its own. What a part has shuffled is removed before the next."""
    for part in [rows] if isinstance(rows, DataFrame) else rows.each:
        with shuffles_removed(rows.sparkSession):
            finish(ordered(part, borders)).write.mode("append").parquet(target, compression=compression)


def read_in_order(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What `write_in_order` wrote, in that order: Spark reads the files of one scan largest first, so each is
    one of its own."""
    names = [name for name in Store(spark, folder).names(folder) if name.startswith("part-")]
    names.sort(key=lambda name: (int(name.split("-")[1]), name))
    found = [spark.read.schema(schema).parquet(f"{folder}/{name}") for name in names]
    while len(found) > 1:  # by twos, so that the plan isn't as deep as there are files
        found = [reduce(DataFrame.union, found[k:k + 2]) for k in range(0, len(found), 2)]
    return found[0]


def publish_parquet(
    rows: DataFrame | Parts, path: str, borders: list[str] | None = None, finish: Finish = lambda rows: rows
) -> None:
    """Replaces what is published at `path` by the rows in result order; `published` reads it.

    `finish` makes the columns to write, row by row, after the rows are put in order: rows that are
    narrower before it go through the shuffle as such.

    The rows become a version of their own below `path`, and the pointer to the version is then
    replaced by one rename: whatever fails before it leaves the old rows, and readers see one
    version or the other. The version before stays for those who are reading it; older ones,
    and what failed runs left, are removed first. One writer at a time.
    """
    store = Store(rows.sparkSession, path)
    _remove_but(store, path, store.read_text(f"{path}/{CURRENT}"))
    version = f"{_VERSION}{uuid.uuid4().hex}"
    write_in_order(rows, f"{path}/{version}", borders, finish)
    store.replace_text(f"{path}/{CURRENT}", version)


def published(spark: SparkSession, path: str) -> DataFrame:
    """What is published at `path` now."""
    version = Store(spark, path).read_text(f"{path}/{CURRENT}")
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{version}")


def publish_table(
    rows: DataFrame | Parts, name: str, borders: list[str] | None = None, finish: Finish = lambda rows: rows
) -> None:
    """Replaces the table by the rows in result order; a failure leaves the old one.

    As `publish_parquet`, with the table's location as the pointer. Where the columns have changed
    the new table takes the old one's name, which gets it back if that fails.
    """
    spark = rows.sparkSession
    folder = _versions_of(spark, name)
    store = Store(spark, folder)
    exists = spark.catalog.tableExists(name)
    _remove_but(store, folder, _location(spark, name).rsplit("/", 1)[-1] if exists else None)
    target = f"{folder}/{_VERSION}{uuid.uuid4().hex}"
    write_in_order(rows, target, borders, finish)
    if not exists:
        _table_at(spark, name, target)
    elif _columns(spark.table(name)) == _columns(spark.read.parquet(target)):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
    else:
        mark = uuid.uuid4().hex
        _table_at(spark, f"{name}_new_{mark}", target)
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}_old_{mark}")
        try:
            spark.sql(f"ALTER TABLE {name}_new_{mark} RENAME TO {name}")
        except Exception:
            spark.sql(f"ALTER TABLE {name}_old_{mark} RENAME TO {name}")
            raise
        spark.sql(f"DROP TABLE {name}_old_{mark}")
    spark.catalog.refreshTable(name)


def _table_at(spark: SparkSession, name: str, target: str) -> None:
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{target}'")


def _columns(rows: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in rows.schema]


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def _versions_of(spark: SparkSession, name: str) -> str:
    """The folder of a table's versions, below its database's."""
    *database, table = name.split(".")
    described = spark.sql(f"DESCRIBE DATABASE {'.'.join(database) or spark.catalog.currentDatabase()}")
    return f"{described.filter("info_name = 'Location'").first()['info_value'].rstrip('/')}/{table}__versions"


def _remove_but(store: Store, folder: str, current: str | None) -> None:
    for name in store.names(folder):
        if name.startswith(_VERSION) and name != current:
            store.remove(f"{folder}/{name}")
