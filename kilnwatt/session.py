"""Session settings, the shared scratch folder, and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_scratch: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def build_session(app: str = "kilnwatt", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session with other settings, which get their former values back."""
    former = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in former.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may do without the setting; it then gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/kilnwatt"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="kilnwatt-")
    return _local_scratch[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Unlike executor-local caching the result outlives lost executors, and unlike an RDD checkpoint
    later passes can still prune its columns.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialise` returned and that nothing will read any more; others are left alone."""
    for table in tables:
        if "_scratch" not in vars(table):
            continue
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table._scratch)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_materialised(spark: SparkSession) -> int:
    """Delete the scratch tables this application wrote; returns how many paths were removed."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(target.getFileSystem(conf).delete(target, True))
    return removed
