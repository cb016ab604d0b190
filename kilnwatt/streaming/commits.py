"""Tables written batch by batch that become visible together, and stay a bounded number of files.

A store is one folder:

* `<table>/batch_id=N/`: what batch N wrote to a table, by date where the table has a time;
* `<table>-merged/run=F-L/`: the rows of batches F to L, written again by date;
* `commits/run=F-L/`: one row, written last. What no record names isn't there for readers.

Readers take the runs that no wider run contains, so a batch shows in all tables or in none, and a merge replaces its
batches in one step. Merged batches stay on disk until they are cleaned up, for readers that have planned with them.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.sources.tables import create_table, dated

BATCHED = "{}, batch_id bigint, date date"
RECORD = "first bigint, last bigint, written_at double"
#: Neighbouring runs of one size class that are merged; a store of N batches has at most this many runs for each of the
#: log(N) classes.
FAN = 10
#: Seconds that replaced runs are kept for readers.
KEEP = 24 * 3600.0

Run = tuple[int, int]


@dataclass(frozen=True)
class Store:
    """Tables of one folder, by name and layout; those with a `time` column are laid out by date."""

    folder: str
    tables: Mapping[str, str]
    fan: int = field(default=FAN)

    def create(self, spark: SparkSession) -> None:
        """Make the folder of the commit records, if it isn't there."""
        create_table(spark, f"{self.folder}/commits", f"{RECORD}, run string", ("run",))

    def _by_date(self, table: str) -> bool:
        return any(column.split()[0] == "time" for column in self.tables[table].split(","))

    def write(self, table: str, rows: DataFrame, batch_id: int) -> None:
        """Write one batch to one table, in place of what an attempt that failed has left."""
        self._put(table, rows, f"{self.folder}/{table}/batch_id={batch_id}")

    def _put(self, table: str, rows: DataFrame, path: str) -> None:
        if self._by_date(table):
            by_date = dated(rows).hint("rebalance", "date").sortWithinPartitions("date", "time")
            by_date.write.mode("overwrite").partitionBy("date").parquet(path)
        else:
            # Few files, none of them by one task if the rows are many.
            rows.hint("rebalance").write.mode("overwrite").parquet(path)

    def commit(self, spark: SparkSession, first: int, last: int | None = None) -> None:
        """Make a batch, or a merged run, visible in all tables. The record is one file, which appears as a whole."""
        last = first if last is None else last
        record = spark.createDataFrame([(first, last, time.time())], RECORD)
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/run={first}-{last}")

    def records(self, spark: SparkSession) -> list:
        """All records: those of live runs, and of replaced ones not yet cleaned up."""
        self.create(spark)
        return spark.read.schema(RECORD).parquet(f"{self.folder}/commits").select("first", "last", "written_at").collect()

    def runs(self, spark: SparkSession) -> list[Run]:
        """The runs that readers see, in order."""
        return live(tuple(r)[:2] for r in self.records(spark))

    def committed(self, spark: SparkSession, batch_id: int) -> bool:
        return any(first <= batch_id <= last for first, last in self.runs(spark))

    def read(self, spark: SparkSession, table: str, runs: list[Run] | None = None) -> DataFrame:
        """Committed rows of a table, with their `batch_id` and, where it has a time, the `date` to prune by."""
        runs = self.runs(spark) if runs is None else runs
        ddl = BATCHED.format(self.tables[table]) if self._by_date(table) else f"{self.tables[table]}, batch_id bigint"
        single, merged = f"{self.folder}/{table}", f"{self.folder}/{table}-merged"
        parts = [
            (single, [f"{single}/batch_id={a}" for a, b in runs if a == b]),
            (merged, [f"{merged}/run={a}-{b}" for a, b in runs if a != b]),
        ]
        empty = spark.createDataFrame([], ddl)
        frames = [spark.read.schema(ddl).option("basePath", base).parquet(*paths).select(empty.columns) for base, paths in parts if paths]
        out = frames[0] if frames else empty
        return out.unionByName(frames[1]) if len(frames) > 1 else out

    def compact(self, spark: SparkSession) -> list[Run]:
        """Merge neighbouring runs of one size class, oldest first, until fewer than `fan` of each are left in a row.

        Batches may be written and read meanwhile. A merge that fails leaves no record and is made again. Every row is
        written again once for each size class it passes.
        """
        made = []
        while group := due(self.runs(spark), self.fan):
            first, last = group[0][0], group[-1][1]
            for table in self.tables:
                self._put(table, self.read(spark, table, group).drop("date"), f"{self.folder}/{table}-merged/run={first}-{last}")
            self.commit(spark, first, last)
            made.append((first, last))
        return made

    def clean(self, spark: SparkSession, keep: float = KEEP) -> int:
        """Delete runs that were replaced more than `keep` seconds ago; returns how many."""
        records = [tuple(r) for r in self.records(spark)]
        gone = 0
        for first, last, _ in records:
            wider = [at for a, b, at in records if a <= first and last <= b and (a, b) != (first, last)]
            if not wider or time.time() - min(wider) < keep:
                continue
            paths = [f"{self.folder}/{t}/batch_id={first}" if first == last else f"{self.folder}/{t}-merged/run={first}-{last}" for t in self.tables]
            for path in [*paths, f"{self.folder}/commits/run={first}-{last}"]:  # the record last, so that a clean-up that fails is made again
                remove(spark, path)
            gone += 1
        return gone


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def live(runs) -> list[Run]:
    """The runs that no other one contains, in order."""
    out: list[Run] = []
    for first, last in sorted(set(runs), key=lambda r: (r[0], -r[1])):
        if not out or last > out[-1][1]:
            out.append((first, last))
    return out


def due(runs: list[Run], fan: int) -> list[Run]:
    """The first `fan` neighbouring runs of one size class, or none. A run of n batches is of class log n to the base `fan`."""

    def size(run: Run) -> int:
        n, k = run[1] - run[0] + 1, 0
        while n >= fan:
            n, k = n // fan, k + 1
        return k

    for at in range(len(runs) - fan + 1):
        group = runs[at : at + fan]
        if len({size(r) for r in group}) == 1:
            return group
    return []
