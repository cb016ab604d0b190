"""Column names, day-first dates and ISO time text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first spellings tried in turn before the general timestamp cast.
DAY_FIRST = ("d/M/yyyy H:mm", "d/M/yyyy H:mm:ss", "d/M/yyyy", "d-M-yyyy H:mm", "d-M-yyyy H:mm:ss", "d.M.yyyy H:mm")


def plain_name(name: str) -> str:
    """Lower-case identifier: blanks and dots become underscores, parentheses vanish."""
    return name.strip().lower().translate(str.maketrans({" ": "_", ".": "_", "(": None, ")": None}))


def day_first_time(text: Column, patterns: Sequence[str] = DAY_FIRST) -> Column:
    """Timestamp from day-first text, else from any form Spark can cast, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns], text.try_cast("timestamp"))


def iso_time(time: Column, separator: str = "T") -> Column:
    """ISO text with offset; the fraction is left out when it is zero."""
    day_and_clock = f"yyyy-MM-dd'{separator}'HH:mm:ss"
    whole = F.unix_micros(time) % 1_000_000 == 0
    return F.when(whole, F.date_format(time, day_and_clock + "xxx")).otherwise(
        F.date_format(time, day_and_clock + ".SSSSSSxxx")
    )
