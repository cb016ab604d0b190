"""Row-frame windows over one long time-ordered series, without one task holding the series.

A window ordered by time but partitioned by nothing runs in a single task. Two ways give the same result:

* time slots: the time range is cut into equal slots, each a window partition, and each slot also receives the
  last rows before it (its halo) so that every trailing frame is complete. The halo comes from a scan of the few
  columns the frames read, so the wide rows are exchanged once and nothing is stored;
* positions, when the counted slots show that some time holds too much of the data: the series is range
  partitioned, rows are numbered, and equal runs of positions become the window partitions. Not even a mass of
  identical rows can fill one of those, at the price of a second exchange and a written table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from kilnwatt.session import materialise

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above, the position below


@dataclass(frozen=True)
class Layout:
    """How finely a series is cut.

    rows_per_task: intended size of a cut, which is a slot or a part of a range partition.
    least_tasks: cuts of the smallest series, so that it takes the same way as a long one.
    max_tasks: bounds the number of cuts, hence the per-slot counts kept on the driver and the bookkeeping rows that
    are broadcast.
    rows_per_partition: smaller cuts share Spark partitions of this size, since each of those costs a task, a result
    for the driver, keys sampled for its range, and a file.
    hot_factor: a slot this many times larger than intended sends the series to the path by positions.
    chunk_rows: length of a run of positions; the row count Spark keeps in memory per window group by default.
    """

    rows_per_task: int = 250_000
    least_tasks: int = 8
    max_tasks: int = 200_000
    rows_per_partition: int = 250_000
    hot_factor: int = 4
    chunk_rows: int = 4096

    def tasks_for(self, rows: int) -> int:
        return max(self.least_tasks, min(self.max_tasks, math.ceil(rows / self.rows_per_task)))

    def partitions_for(self, rows: int) -> int:
        """Spark partitions that hold the cuts: as many as cuts, unless these are small."""
        return min(self.tasks_for(rows), max(self.least_tasks, math.ceil(rows / self.rows_per_partition)))

    def cut_rows(self, rows: int) -> int:
        """Length of the cuts of a range partition; its last one is shorter."""
        return max(1, math.ceil(rows / self.tasks_for(rows)))

    def too_hot(self, largest: int, rows: int) -> bool:
        return largest > self.hot_factor * max(self.rows_per_task, rows / self.tasks_for(rows))


DEFAULT_LAYOUT = Layout()


@dataclass(frozen=True)
class Frames:
    """Windows handed to the column builder: the bare order, and trailing frames of n rows."""

    order: WindowSpec

    def last(self, rows: int) -> WindowSpec:
        return self.order.rowsBetween(1 - rows, Window.currentRow)


Build = Callable[[Frames], dict[str, Column]]


def series_order(df: DataFrame, time: str, tiebreak: Sequence[str] = (), values: Sequence[str] = ()) -> list[Column]:
    """Sort keys: time, the caller's tie-breakers, the windowed values, and a hash of the other columns.

    The values come before the hash so that the sequence of values is settled by the columns a halo carries.
    """
    named = list(dict.fromkeys([time, *tiebreak, *values]))
    rest = [c for c in df.columns if c not in named and not c.startswith("_")]
    return [*map(F.col, named), F.xxhash64(*(rest or named))]


def sort_series(df: DataFrame, time: str = "time", tiebreak: Sequence[str] = (), ascending: bool = True) -> DataFrame:
    """Global sort by time. The added last key lets a range boundary fall inside a group of equal times."""
    keys = [*map(F.col, (time, *tiebreak)), F.col("_spread")]
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    return spread.orderBy(*[k.asc() if ascending else k.desc() for k in keys]).drop("_spread")


def over_series(
    df: DataFrame,
    build: Build,
    reach: int,
    values: Sequence[str],
    time: str = "time",
    tiebreak: Sequence[str] = (),
    layout: Layout = DEFAULT_LAYOUT,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Add the window columns `build` describes.

    They may read the `values` columns only, and look back at most `reach` rows. Where `df` is costly to compute,
    `narrow` names a cheaper frame with the same times, tie-breakers and values for the counting and halo passes.
    """
    narrow = df if narrow is None else narrow
    slots = count_slots(narrow, time, reach, layout)
    rows = sum(slots.counts.values())
    if layout.too_hot(max(slots.counts.values(), default=0), rows):
        return by_position(df, build, reach, values, time, tiebreak, layout, rows)
    return by_slot(df, narrow, build, reach, values, time, tiebreak, layout, rows, slots)


@dataclass(frozen=True)
class Slots:
    """Equal cuts of the time range; `counts` and `ends` are the rows per slot and in the closing part of it."""

    of: Column
    closing: Column
    counts: Mapping[int, int]
    ends: Mapping[int, int]

    def thin(self, reach: int) -> list[int]:
        """Slots whose closing part holds too few rows for a halo, as at the edge of an outage."""
        return [slot for slot, n in self.counts.items() if self.ends[slot] < min(reach, n)]

    def closing_rows(self, df: DataFrame, reach: int) -> DataFrame:
        """Rows of the closing parts, and whole slots that are thin, with their `_slot`."""
        whole = df.sparkSession.createDataFrame([(slot,) for slot in self.thin(reach)], "_thin int")  # at most `max_tasks`
        placed = df.withColumn("_slot", self.of).withColumn("_closing", self.closing)
        return placed.join(F.broadcast(whole), F.col("_slot") == F.col("_thin"), "left").where(F.col("_closing") | F.col("_thin").isNotNull())


def count_slots(df: DataFrame, time: str, reach: int, layout: Layout) -> Slots:
    """Cut the series into slots and count them, in one pass for the range and one for the slots.

    At most `max_tasks` + 1 counts reach the driver. A null time precedes all others. The closing part is several times
    the share of a slot that `reach` rows need on average.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    rows, first, last = df.agg(F.count(F.lit(1)), F.min(micros), F.max(micros)).first()
    first, last = first or 0, last or 0
    tasks = layout.tasks_for(rows)
    width = max(1, math.ceil((last - first + 1) / tasks))
    offset = (micros - F.lit(first)) / F.lit(width)
    slot = F.coalesce(F.floor(offset), F.lit(-1)).cast("int")
    share = 8 * reach * tasks / max(1, rows)
    closing = F.coalesce(offset - F.floor(offset) >= 1 - share, F.lit(True)) if share < 1 else F.lit(True)
    found = df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.count_if(closing).alias("end")).collect()
    return Slots(slot, closing, {r["slot"]: r["n"] for r in found}, {r["slot"]: r["end"] for r in found})


def halo_sources(counts: Mapping[int, int], reach: int) -> Iterator[tuple[int, int, int]]:
    """(source slot, target slot, rows): whose last rows precede a target, back to `reach` rows in all."""
    slots = sorted(counts)
    for i, target in enumerate(slots):
        needed = reach
        for source in reversed(slots[max(0, i - reach):i]):
            take = min(needed, counts[source])
            yield source, target, take
            needed -= take
            if not needed:
                break


def by_slot(
    df: DataFrame,
    narrow: DataFrame,
    build: Build,
    reach: int,
    values: Sequence[str],
    time: str,
    tiebreak: Sequence[str],
    layout: Layout,
    rows: int,
    slots: Slots,
) -> DataFrame:
    carried = list(dict.fromkeys([time, *tiebreak, *values]))
    # Only the order of the carried columns counts here. Of the closing rows Spark keeps at most `reach` per
    # slot and task before the exchange.
    latest_first = Window.partitionBy("_slot").orderBy(*[F.desc(c) for c in carried])
    tails = (
        slots.closing_rows(narrow, reach)
        .select(*carried, "_slot")
        .withColumn("_back", F.row_number().over(latest_first))
        .where(F.col("_back") <= reach)
    )
    # At most `reach` rows per slot, usually one.
    sources = df.sparkSession.createDataFrame(list(halo_sources(slots.counts, reach)), "_slot int, _to int, _take int")
    halo = (
        tails.join(F.broadcast(sources), "_slot")
        .where(F.col("_back") <= F.col("_take"))
        .select(*carried, F.col("_to").alias("_slot"), F.lit(True).alias("_halo"))
    )
    body = df.withColumn("_slot", slots.of).withColumn("_halo", F.lit(False))
    # Slots are dealt out in turn, large ones to a task each: hashing their numbers would put several into one task.
    slotted = body.unionByName(halo, allowMissingColumns=True).repartitionById(layout.partitions_for(rows), "_slot")
    frames = Frames(Window.partitionBy("_slot").orderBy(*series_order(df, time, tiebreak, values)))
    return slotted.withColumns(build(frames)).where(~F.col("_halo")).drop("_slot", "_halo")


def index_series(
    df: DataFrame,
    time: str = "time",
    tiebreak: Sequence[str] = (),
    values: Sequence[str] = (),
    layout: Layout = DEFAULT_LAYOUT,
    rows: int | None = None,
) -> DataFrame:
    """Range partition, sort, and fix `_task` (a cut of a range partition) and `_pos` (position inside it) in a written table.

    A cut is named by the place of its first row, so cuts are in the order of the series. Range partitions hold several
    small ones.

    The table is written because a range partitioning is sampled anew each time it is planned. Ranges are cut by the
    whole order of the series, so a tie is cut as a plain window would order it; only rows that are equal in every key
    are cut by their place in the input, and those may swap freely.
    """
    rows = df.count() if rows is None else rows
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    order = series_order(df, time, tiebreak, values)
    ranged = spread.repartitionByRange(layout.partitions_for(rows), *order, "_spread").drop("_spread")
    placed = ranged.sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()
    )
    at = F.col("_at")
    place = at.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        materialise(placed, "series")
        .withColumn("_pos", place % F.lit(layout.cut_rows(rows)))
        .withColumn("_task", at - F.col("_pos"))
        .drop("_at")
    )


def task_starts(indexed: DataFrame) -> DataFrame:
    """Global position of each cut's first row: one row per cut, at most `max_tasks` and one per range partition."""
    sizes = indexed.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))


def by_position(
    df: DataFrame,
    build: Build,
    reach: int,
    values: Sequence[str],
    time: str,
    tiebreak: Sequence[str],
    layout: Layout,
    rows: int,
) -> DataFrame:
    if layout.chunk_rows < reach:
        raise ValueError("a run of positions must be at least as long as the reach of the frames")
    indexed = index_series(df, time, tiebreak, values, layout, rows)
    numbered = indexed.join(F.broadcast(task_starts(indexed)), "_task").withColumn(
        "_idx", F.col("_start") + F.col("_pos")
    )
    size = F.lit(layout.chunk_rows)
    home, place = F.floor(F.col("_idx") / size), F.col("_idx") % size
    copies = numbered.withColumn("_home", home).withColumn(
        "_chunk",
        F.explode(
            F.when(place >= layout.chunk_rows - reach, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
        ),
    )
    frames = Frames(Window.partitionBy("_chunk").orderBy("_idx"))
    return (
        copies.repartition(layout.partitions_for(rows), "_chunk")
        .withColumns(build(frames))
        .where(F.col("_chunk") == F.col("_home"))
        .drop("_task", "_pos", "_start", "_idx", "_home", "_chunk")
    )


def trailing_mean(value: str, rows: int, frames: Frames) -> Column:
    """Mean of the last `rows` values, null until all of them are present."""
    frame = frames.last(rows)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def previous(value: str, frames: Frames) -> Column:
    return F.lag(value).over(frames.order)


def change(value: str, frames: Frames) -> Column:
    return F.col(value) - previous(value, frames)


def percent_change(value: str, frames: Frames) -> Column:
    """Relative change in percent; null, not infinity, after a zero."""
    before = previous(value, frames)
    return F.try_divide(F.col(value) - before, before) * F.lit(100.0)


def running_sum_by_date(
    df: DataFrame,
    value: str = "usage_kwh",
    into: str = "cumulative_daily",
    time: str = "time",
    tiebreak: Sequence[str] = (),
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    """Running sum that restarts at midnight; null values stay null.

    Dates of counted, moderate size are window partitions. Otherwise a date is summed inside each cut of the range
    partitions and continued with the total of its earlier cuts, so that one date spreads over many tasks.
    """
    day = F.to_date(time)
    order = series_order(df, time, tiebreak, [value])
    daily = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    rows, largest = daily[0] or 0, daily[1] or 0
    running = F.when(F.col(value).isNotNull(), F.col(into))
    if not layout.too_hot(largest, rows):
        inside = Window.partitionBy("_date").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summed = df.withColumn("_date", day).withColumn(into, F.sum(value).over(inside))
        return summed.withColumn(into, running).drop("_date")

    indexed = index_series(df, time, tiebreak, [value], layout, rows).withColumn("_date", day)
    before = Window.partitionBy("_on").orderBy("_after").rowsBetween(Window.unboundedPreceding, -1)
    # Cuts are contiguous in time: these totals are at most `max_tasks`, one per range partition and one per date.
    carried = (
        indexed.groupBy(F.col("_date").alias("_on"), F.col("_task").alias("_after"))
        .agg(F.sum(value).alias("_part"))
        .withColumn("_carry", F.coalesce(F.sum("_part").over(before), F.lit(0.0)))
    )
    inside = Window.partitionBy("_date", "_task").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        indexed.repartition(layout.partitions_for(rows), "_date", "_task")
        .withColumn(into, F.sum(value).over(inside))
        .join(F.broadcast(carried), F.col("_date").eqNullSafe(F.col("_on")) & (F.col("_task") == F.col("_after")))
        .withColumn(into, F.col("_carry") + running)
        .select(*df.columns, into)
    )


def pad_forward(
    df: DataFrame,
    value: str,
    into: str,
    time: str = "time",
    tiebreak: Sequence[str] = (),
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    """Fill nulls with the last known value of the series, however far back it lies."""
    rows = df.count()
    indexed = index_series(df, time, tiebreak, [value], layout, rows)
    latest = indexed.groupBy("_task").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_pos"))).alias("_last")
    )
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per cut: bounded by `max_tasks` and one per range partition.
    carried = latest.select("_task", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = Window.partitionBy("_task").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        indexed.repartition(layout.partitions_for(rows), "_task")
        .join(F.broadcast(carried), "_task")
        .withColumn(into, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carry")))
        .select(*df.columns, into)
    )
