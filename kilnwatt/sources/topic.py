"""Messages: JSON coding of processed readings, and topic sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kilnwatt.functions.measures import nan_to_null
from kilnwatt.functions.text import iso_time
from kilnwatt.schemas import MESSAGE_DDL, column_names

TOPIC = "energy_raw"  # fixed value
FILE_MESSAGES = "key string, value string"


def encode(df: DataFrame, time: str = "time") -> DataFrame:
    """(key, value): the time as text, and the row as a JSON object with nulls kept and the time in ISO form."""
    as_text = df.withColumn(time, iso_time(F.col(time)))
    body = F.to_json(F.struct(*as_text.columns), {"ignoreNullFields": "false"})
    key = F.regexp_replace(F.col(time), "T", " ")
    return as_text.select(key.alias("key"), body.alias("value"))


def decode(messages: DataFrame, ddl: str = MESSAGE_DDL, keep_null_time: bool = False) -> DataFrame:
    """Rows from JSON messages. Unreadable JSON or time gives a null time, and such rows are dropped.

    They are dropped inside the generator: as a filter, the condition would be pushed below the projection and
    every message parsed twice.
    """
    parsed = messages.select(F.from_json(F.col("value").cast("string"), ddl).alias("m"))
    if keep_null_time:
        rows = parsed.select("m.*")
    else:
        rows = parsed.select(F.inline(F.filter(F.array("m"), lambda m: m["time"].try_cast("timestamp").isNotNull())))
    return nan_to_null(rows.withColumn("time", F.col("time").try_cast("timestamp")))


#: Why a message can't be used; the first that holds.
REASONS = ("unreadable", "time missing", "time unreadable", "field missing")


def decode_all(messages: DataFrame, ddl: str = MESSAGE_DDL, required: tuple[str, ...] = ()) -> DataFrame:
    """Every message once: the decoded columns, the raw `value`, and the `reason` it can't be used, null for good ones.

    Each message is parsed once. Unreadable is what isn't a JSON object; of `required` fields none may be null.
    """
    text = F.col("value").cast("string")
    # The function is opened by a generator, so that later conditions aren't pushed below it and parse again.
    parsed = messages.select(text.alias("value"), F.from_json(text, f"{ddl}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}).alias("m"))
    rows = parsed.select("value", F.inline(F.array("m"))) if "value" not in column_names(ddl) else parsed.select("value", "m.*")
    read_time = F.col("time").try_cast("timestamp")
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    unreadable = F.col("value").isNull() | F.col("_corrupt").isNotNull() | ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    holds = (unreadable, F.col("time").isNull(), read_time.isNull(), missing)
    reason = F.lit(None).cast("string")
    for name, condition in reversed(list(zip(REASONS, holds, strict=True))):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return nan_to_null(rows.withColumn("reason", reason).withColumn("time", read_time).drop("_corrupt"))


def read_topic(
    spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest", fail_on_data_loss: bool = False
) -> DataFrame:
    """Broker topic as a stream (needs Spark's broker connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def read_message_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same shape from a folder of message files."""
    return spark.readStream.schema(FILE_MESSAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def publish(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_stream(messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, every: str = "15 seconds") -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )


def publish_files(messages: DataFrame, path: str) -> None:
    messages.write.mode("append").parquet(path)
