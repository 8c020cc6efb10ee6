"""Helpers that several text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from claimtide.session import shared_folder

Batches = Iterator[pa.RecordBatch]


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_session(spark: SparkSession) -> SparkSession:
    """The session, set to send tasks' Python 1,000 rows at a time unless it says otherwise: the
    default of 10,000 texts would take tens of megabytes on either side. For applications, such
    as the registered queries and the pipeline; the operators leave their session alone."""
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "1000")
    return spark


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared one that the session names (only where it names none, as in
    tests, under the warehouse, which is shared too). It is removed when the process ends."""
    return shared_folder(spark, f"llm-{purpose}")


def written(frame: DataFrame, compression: str = "zstd") -> DataFrameWriter:
    """A writer with small row groups: wide binary rows would else fill a task's memory."""
    return frame.write.option("compression", compression).option("parquet.block.size", 16 << 20)


def stored(frame: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder, of so many files if they are given: lineage
    ends there and work is not repeated."""
    spark = frame.sparkSession
    path = scratch_folder(spark, purpose)
    written(frame.repartition(files) if files else frame).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def chosen(frame: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, typed; all other columns, whatever their names, are left behind."""
    return frame.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()))


def documents(frame: DataFrame) -> DataFrame:
    """doc_id and text; a null text is an empty one."""
    return chosen(frame, doc_id="long", text="string").withColumn(
        "text", F.coalesce(F.col("text"), F.lit(""))
    )


def spare_name(frame: DataFrame, purpose: str) -> str:
    """A column name that the frame can't have."""
    return f"_{purpose}_{uuid.uuid4().hex}"


def small_batches(batch: pa.RecordBatch, column: str, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that each part holds about `most_chars` bytes of the column.

    A single longer text stays whole, in a part of its own.
    """
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    first, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > first and total + size > most_chars:
            yield batch.slice(first, k - first)
            first, total = k, 0
        total += size
    if len(sizes) > first:
        yield batch.slice(first)


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text",
              most_chars: int = 2 << 20) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that gives `work` parts of bounded size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Batches:
        for batch in batches:
            for part in small_batches(batch, column, most_chars):
                made = work(part)
                if made is not None and made.num_rows:
                    yield made

    return run


def arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


def running_base(rows: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Partition number -> how much lies in the partitions before it."""
    base, total = {}, 0
    for part, amount in sorted(rows):
        base[part] = total
        total += amount
    return base

