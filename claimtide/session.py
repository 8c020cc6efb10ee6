"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from claimtide.sources.files import Store


def build_session(app: str = "claimtide", cores: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "8g")
        )
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the session names, or the warehouse, which is shared too."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


# The scratch folder of each application that this process drives, with its store. An
# application's folder lives as long as the process, which may read its tables to the end.
_scratch: dict[str, tuple[Store, str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder under the shared one, which is removed when the process ends."""
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        folder = f"{shared_root(spark)}/claimtide-{application}"
        if not _scratch:
            atexit.register(remove_scratch)
        _scratch[application] = Store(spark, folder), folder
    return _scratch[application][1]


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for tables that the application needs until it ends."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder that `shared_folder` gave, before the application ends."""
    Store(spark, folder).remove(folder)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled is removed when the write ends, not when the driver next
    collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(rows: DataFrame, folder: str, by: str | None = None) -> None:
    """Adds the rows to a scratch table, which lies in one folder for each value of the column `by`,
    and removes what was shuffled for them."""
    writer = rows.write if by is None else rows.write.partitionBy(by)
    with shuffles_removed(rows.sparkSession):
        writer.mode("append").parquet(folder, compression="zstd")


def remove_scratch() -> None:
    """Removes the scratch folders of this process's applications."""
    while _scratch:
        _, (store, folder) = _scratch.popitem()
        store.remove(folder)
