"""Per-batch metrics from a query's progress: what the stream observed, and the rows its watermark dropped.

Nothing is counted a second time: the numbers come with the batch that Spark has just run.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kilnwatt.streaming.commits import Store

_logs: dict[str, MetricsLog] = {}


class MetricsLog(StreamingQueryListener):
    """Writes one row per batch with rows: the columns observed under `name`, and `late` if the layout has it.

    A batch that is run again after a restart reports again; its first row stays.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, ddl: str):
        self._spark, self._name = spark, name
        self.store = Store(folder, {"rows": ddl})
        self._columns = [c.split()[0] for c in ddl.split(",")]
        self._ended = threading.Event()
        self._id: str | None = None
        self.store.create(spark)

    def watch(self, query: StreamingQuery) -> None:
        _logs[str(query.id)] = self

    def onQueryStarted(self, event) -> None:
        if event.name == self._name:
            self._id = str(event.id)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self._name or not progress.numInputRows:
            return
        seen = progress.observedMetrics.get(self._name)
        values = dict(seen.asDict()) if seen is not None else {}
        values["late"] = (values.get("late") or 0) + sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        if "state_rows" in self._columns:
            values["state_rows"] = sum(s.numRowsTotal for s in progress.stateOperators)
        batch_id = progress.batchId
        if not values.get("rows", 1) and not values["late"] or self.store.committed(self._spark, batch_id):
            return
        row = self._spark.createDataFrame([tuple(values.get(c, 0) for c in self._columns)], self.store.tables["rows"])
        self.store.write("rows", row, batch_id)
        self.store.commit(self._spark, batch_id)

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self._id:
            self._ended.set()

    def wait(self, seconds: float = 60) -> None:
        self._ended.wait(seconds)


def finish(query: StreamingQuery) -> None:
    """Wait until the query has ended and its last batch is in its metrics."""
    try:
        query.awaitTermination()
    finally:
        log = _logs.pop(str(query.id), None)
        if log is not None:
            log.wait()
            log._spark.streams.removeListener(log)


def read_log(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    return Store(folder, {"rows": ddl}).read(spark, "rows")
