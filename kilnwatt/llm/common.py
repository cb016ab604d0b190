"""What the corpus operators share: tables, row keys, numbering without a single task, phases on shared storage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.session import materialise, settings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """64-bit name of a document row, from its id and whole text; rows equal in both share it."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row_key): other columns, whatever their names, play no part."""
    return docs.select("doc_id", "text").withColumn("row_key", row_key())


#: Rows of an Arrow batch between Spark and Python. Texts of some kilobytes make the default of 10,000 rows large.
BATCH_ROWS = 2_000


def lean(read: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`read`, after which the worker gives back the memory it has freed.

    A Python worker serves many tasks. What the allocators keep of one task is of no use to the next stages, but counts
    towards the executor's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from read(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


#: Settings that hold while a phase is written: batches of texts stay small, and its shuffle files go when it ends.
PHASE_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def phase(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back. The shuffle files that led to it are dropped when it is written.

    A long job would otherwise keep every earlier shuffle on the executors' disks until it ends. An executor lost later
    costs nothing, as the phases that follow only read what is written.
    """
    with settings(df.sparkSession, PHASE_SETTINGS):
        return materialise(df, label)


def numbered(rows: DataFrame, group: str, order: list[str], name: str, salt: Column, salts: int) -> DataFrame:
    """Add `name`: 0, 1, 2, ... without gaps within each `group`, in an order that `salt` and `order` fix.

    A group of any size is spread over `salts` numbering windows; their counts (groups x salts rows) are added up
    first. `rows` is read twice, so it should be a written table.
    """
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    counts = salted.groupBy(group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"), F.col("_salt").alias("_its"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(group, "_salt").orderBy(*order)
    return (
        salted.withColumn("_at", F.row_number().over(within))
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_salt") == F.col("_its")))
        .withColumn(name, F.col("_before") + F.col("_at") - 1)
        .drop("_salt", "_at", "_group", "_its", "_before")
    )


def salts_for(rows: int, per_window: int = 200_000) -> int:
    """Numbering windows a group is spread over, so that even one group of all rows has windows of bounded size."""
    return max(16, -(-rows // per_window))
