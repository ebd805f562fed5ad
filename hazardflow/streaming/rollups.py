"""Partial means of points by minute, hour and day, kept up by a stream and merged when read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.streaming.runs import RUN, RunStore

#: Seconds of each level, and the period whose partials are stored together.
LEVELS = {"minute": 60, "hour": 3600, "day": 86_400}
PERIODS = {"minute": "day", "hour": "month", "day": "year"}
SERIES = ["measurement", "location_id", "location_name", "field"]
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def _sums() -> list[Column]:
    return [
        F.sum("total").alias("total"),
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max("last").alias("last"),
    ]


def add_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Merge that adds partials up: they are what each run contributes, not the state after it."""
    return rows.groupBy(*keys).agg(*_sums(), *[F.max(c).alias(c) for c in RUN if c in rows.columns and c not in keys])


def partials(points: DataFrame, series: list[str] = SERIES) -> DataFrame:
    """Long points as partials of their minutes: series, start, total, n, low, high, last (time and
    value; of equal times the larger value). Points without a value are left out."""
    start = F.window("time", "1 minute")["start"].alias("start")
    known = points.where("value is not null")
    return known.groupBy(*series, start).agg(
        F.sum("value").alias("total"), F.count("value").alias("n"), F.min("value").alias("low"),
        F.max("value").alias("high"), F.max(F.struct("time", "value")).alias("last"),
    )


def all_levels(minutes: DataFrame, series: list[str] = SERIES) -> DataFrame:
    """Partials of every level: hours from minutes, days from hours, with `level` and `date`, the
    first day of the period they are stored in."""
    level, out = minutes, None
    for name in LEVELS:
        if name != "minute":
            start = F.window("start", f"1 {name}")["start"].alias("start")
            level = level.groupBy(*series, start).agg(*_sums())
        named = level.select(F.lit(name).alias("level"), _period(name, F.col("start")).alias("date"), "*")
        out = named if out is None else out.unionByName(named)
    return out


def _period(level: str, time: Column) -> Column:
    return F.to_date(F.date_trunc(PERIODS[level], time))


def rollup_store(spark: SparkSession, root: str, series: list[str] = SERIES) -> RunStore:
    """Where partials live: runs per level and period. A batch adds its own points' partials to every
    level, so a late point corrects all of them; compaction adds runs up."""
    return RunStore(spark, root, ["level", "date", *series, "start"], ["level", "date"], add_up, replaces=False)


def rollup_sink(store: RunStore, shape: Callable[[DataFrame], DataFrame] = lambda points: points,
                series: list[str] = SERIES) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function: long points (by `shape`) to partials of all levels. The batch's
    minutes are computed once. A retried batch replaces itself and is not added twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        minutes = partials(shape(batch), series).persist()
        try:
            store.write_batch(all_levels(minutes, series), batch_id)
        finally:
            minutes.unpersist()

    return write


def seconds(every: str) -> int:
    """Length of "15 minutes", "6 hours" and the like."""
    number, unit = every.split()
    return int(number) * UNITS[unit.lower().removesuffix("s")]


def level_of(every: str) -> str:
    """The coarsest level of which a window is a multiple."""
    fits = [name for name, size in LEVELS.items() if seconds(every) % size == 0]
    if not fits:
        raise ValueError(f"{every}: a window must be a multiple of a minute")
    return fits[-1]


def windowed(
    store: RunStore,
    every: str,
    keys: tuple[str, ...] = ("location_id", "location_name"),
    field_name: str = "probability",
    measurement: str | None = None,
    start: str | None = None,
    stop: str | None = None,
) -> DataFrame:
    """Tumbling windows from partials: keys, time (the window's stop), mean_value, n, low, high and the
    last value. Equal to the direct aggregate over all points the store was given.

    Only the level that the window needs is read, and of it the periods between `start` (inclusive)
    and `stop` (exclusive), which should be ends of windows: what is read follows the windows
    shown, not the points behind them.
    """
    level = level_of(every)
    folders, rows_of = F.col("level") == level, F.col("field") == field_name
    if start is not None:
        first = F.lit(start).cast("timestamp_ntz")
        folders, rows_of = folders & (F.col("date") >= _period(level, first)), rows_of & (F.col("start") >= first)
    if stop is not None:
        last = F.lit(stop).cast("timestamp_ntz")
        folders, rows_of = folders & (F.col("date") < last), rows_of & (F.col("start") < last)
    rows = store.read(folders).where(rows_of)
    if measurement is not None:
        rows = rows.where(F.col("measurement") == measurement)
    sums = rows.groupBy(F.window("start", every).alias("window"), *keys).agg(*_sums())
    return sums.select(
        *keys, F.col("window.end").alias("time"), (F.col("total") / F.col("n")).alias("mean_value"),
        "n", "low", "high", F.col("last.value").alias("last"),
    )
