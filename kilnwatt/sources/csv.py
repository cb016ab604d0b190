"""Source CSV to raw readings."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.functions.text import day_first_time, plain_name
from kilnwatt.schemas import CSV_COLUMNS, RAW_DDL

log = logging.getLogger(__name__)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text: types are cast later, so no pass over the data infers them."""
    return spark.read.option("header", True).csv(path)


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_name(c) for c in df.columns])


def to_readings(df: DataFrame, mapping: Mapping[str, str] = CSV_COLUMNS, layout: str = RAW_DDL) -> DataFrame:
    """Rename to the raw layout and cast; unreadable values and missing columns become null, the latter reported."""
    missing = [source for source in mapping if source not in df.columns]
    if missing:
        log.warning("source columns missing: %s", ", ".join(missing))
    source_of = {target: source for source, target in mapping.items() if source not in missing}
    columns = []
    for name, kind in (field.split() for field in layout.split(",")):
        if name not in source_of:
            value = F.lit(None).cast(kind)
        elif kind == "timestamp":
            value = day_first_time(F.col(source_of[name]))
        else:
            value = F.col(source_of[name]).try_cast(kind)
        columns.append(value.alias(name))
    return df.select(*columns)


def load_csv(spark: SparkSession, path: str) -> DataFrame:
    return to_readings(normalise_names(read_csv(spark, path)))
