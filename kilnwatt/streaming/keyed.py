"""Rolling frames of many series, continued in the state store from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kilnwatt.functions.measures import nan_to_null
from kilnwatt.schemas import RAW_COLUMNS, ROWS_1H, ROWS_4H

#: The state store that such state needs.
STORE_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: What the frames need of a reading that has passed, oldest first.
TAIL = "micros bigint, usage_kwh double"
ROLLED = "usage_ma_1h double, usage_ma_4h double, usage_diff double, usage_pct_change double"


class Frames(StatefulProcessor):
    """For each series: its new readings in order, with frames that reach back into the batches before. Readings not later
    than the newest one of their series are marked late and have no frames.

    The state is a list of at most one reading less than the longest frame. The order is that of the batch windows: time,
    value, then the other columns. One series' readings of one micro-batch are in memory together; the trigger's limits on
    files or offsets bound them.
    """

    def __init__(self, columns: list[str]):
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._tail = handle.getListState("tail", TAIL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        old = list(self._tail.get()) if self._tail.exists() else []
        late = new["micros"] <= old[-1][0] if old else pd.Series(False, index=new.index)
        if late.any():
            yield self._with_frames(new[late], {}, late=True)
            new = new[~late]
        if new.empty:
            return
        new = new.sort_values(["micros", "usage_kwh", *[c for c in self._columns if c not in ("time", "usage_kwh")]], kind="stable", na_position="first")
        past = pd.DataFrame({"micros": [r[0] for r in old], "usage_kwh": [r[1] for r in old]}).astype({"micros": "int64", "usage_kwh": "float64"})
        usage = pd.concat([past["usage_kwh"], new["usage_kwh"].astype("float64")], ignore_index=True)
        before = usage.shift(1)
        frames = {
            "usage_ma_1h": usage.rolling(ROWS_1H, min_periods=ROWS_1H).mean(),
            "usage_ma_4h": usage.rolling(ROWS_4H, min_periods=ROWS_4H).mean(),
            "usage_diff": usage - before,
            "usage_pct_change": (usage - before) / before.where(before != 0) * 100,
        }
        times = pd.concat([past["micros"], new["micros"]], ignore_index=True)
        kept = slice(max(0, len(usage) - ROWS_4H + 1), None)
        self._tail.put([(int(t), None if v != v else float(v)) for t, v in zip(times[kept], usage[kept], strict=True)])
        yield self._with_frames(new, {name: values.iloc[len(past) :] for name, values in frames.items()}, late=False)

    def _with_frames(self, rows: pd.DataFrame, frames: dict[str, pd.Series], late: bool) -> pd.DataFrame:
        out = rows[self._columns].reset_index(drop=True)
        for field in ROLLED.split(", "):
            name = field.split()[0]
            out[name] = frames[name].reset_index(drop=True) if name in frames else float("nan")
        return out.assign(late=late)

    def close(self) -> None:
        pass


def keyed_frames(readings: DataFrame, series: str, delay: str) -> DataFrame:
    """Add the rolling columns and `late` to a stream of readings, frames running within each value of `series`.

    Start the query with `STORE_SETTINGS`. Readings without a time or a series are left out.
    """
    columns = list(dict.fromkeys([*RAW_COLUMNS, series]))
    timed = nan_to_null(readings.select(*columns)).where(F.col("time").isNotNull() & F.col(series).isNotNull()).withWatermark("time", delay)
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in timed.schema.fields)
    numbered = timed.withColumn("micros", F.unix_micros("time"))
    return numbered.groupBy(series).transformWithStateInPandas(
        Frames(columns), outputStructType=f"{layout}, {ROLLED}, late boolean", outputMode="Append", timeMode="EventTime"
    )
