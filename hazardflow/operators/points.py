"""Time-series points: projection, identity, long form, and the monitoring queries.

Every "latest" is an aggregate (`max_by`), not a sorted window: partial results combine before
the shuffle, so one busy location does not become one busy task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardflow.functions.casts import quoted, safe_double, safe_int

SERIES = ["location_id", "location_name", "alert_level", "field"]


@dataclass(frozen=True)
class PointSpec:
    """Which columns become tags, integer fields and double fields of a measurement."""

    measurement: str
    tags: list[str]
    ints: list[str]
    doubles: dict[str, str] = field(default_factory=dict)
    time: str = "processing_time"

    @property
    def fields(self) -> list[str]:
        return [*self.ints, *self.doubles]


# The two measurements.
FLOOD_POINTS = PointSpec(
    measurement="flood_prediction",
    tags=["location_id", "alert_level", "location_name"],
    ints=[
        "prediction",
        "alert_level_num",
        "elevation_m",
        "extreme_event",
        "critical_rainfall",
        "critical_water",
        "low_elevation",
        "high_discharge",
    ],
    doubles={
        "probability": "prob_flood",
        "flood_risk_index": "flood_risk_index",
        "latitude": "latitude",
        "longitude": "longitude",
        "rainfall_mm": "rainfall_mm",
        "water_level_m": "water_level_m",
        "river_discharge": "river_discharge",
        "temperature_c": "temperature_c",
        "humidity_pct": "humidity_pct",
    },
)
FIRE_POINTS = PointSpec(
    measurement="fire_prediction",
    tags=["location_id", "alert_level"],
    ints=["prediction", "alert_level_num"],
    doubles={
        "fire_weather_index": "fire_weather_index",
        "dryness_index": "dryness_index",
        "latitude": "c_latitude",
        "longitude": "c_longitude",
    },
)


def to_points(df: DataFrame, spec: PointSpec, keep: list[str] | None = None) -> DataFrame:
    """Project scored rows to points; bad field values become 0, the row is never lost.

    Integer fields an input lacks are 0 too. `keep` carries extra columns along.
    """
    have = set(df.columns)

    def whole(name: str) -> Column:
        return safe_int(name) if name in have else F.lit(0).cast("bigint")

    return df.select(
        *[quoted(k) for k in keep or []],
        F.lit(spec.measurement).alias("measurement"),
        *[quoted(t).cast("string").alias(t) for t in spec.tags],
        *[whole(n).alias(n) for n in spec.ints],
        *[safe_double(source).alias(n) for n, source in spec.doubles.items()],
        quoted(spec.time).alias("time"),
    )


def dedup_points(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One point per identity `keys`: the last by `order` replaces the earlier ones.

    The limit on the row number is applied before the shuffle too, so each task sends at most
    one row per identity and a hot identity stays small.
    """
    newest = Window.partitionBy(*keys).orderBy(*[quoted(c).desc() for c in order])
    return (
        df.withColumn("_place", F.row_number().over(newest))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def identity(spec: PointSpec) -> list[str]:
    """What makes a point of a measurement itself: a later one with the same replaces it."""
    return ["measurement", *spec.tags, "time"]


POINT_PARTITIONS = ["date", "measurement"]


def write_points(df: DataFrame, root: str, batch_id: int = 0, as_dealt: bool = False) -> None:
    """Write points by date and measurement, so that a panel reads only the days it shows.

    Within those, a batch has a folder of its own: a retried batch replaces itself and no other.
    `as_dealt` writes the tasks' rows as they are, for points of one day that a shuffle has just dealt out.
    """
    dated = df.withColumns({"date": F.to_date("time"), "batch_id": F.lit(batch_id).cast("bigint")})
    # Days go to as few files as their size allows, and a hot day to several.
    laid_out = dated if as_dealt else dated.hint("rebalance", *POINT_PARTITIONS)
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*POINT_PARTITIONS, "batch_id").parquet(root)


def read_points(
    spark: SparkSession,
    root: str,
    start: datetime | str | None = None,
    stop: datetime | str | None = None,
    measurement: str | None = None,
) -> DataFrame:
    """Stored points of a time range and a measurement; both also prune the folders read."""
    df = spark.read.parquet(root)
    if measurement is not None:
        df = df.where(F.col("measurement") == measurement)
    if start is not None:
        df = time_range(df, start).where(F.col("date") >= F.to_date(_instant(df, "time", start)))
    if stop is not None:
        last = _instant(df, "time", stop)
        df = df.where((F.col("time") < last) & (F.col("date") <= F.to_date(last)))
    return df


def points_long(df: DataFrame, spec: PointSpec = FLOOD_POINTS) -> DataFrame:
    """Wide points to one row per field: `measurement`, tags, `field`, `value`, `time`."""
    ids = ["measurement", *spec.tags, "time"]
    wide = df.select(*ids, *[quoted(f).cast("double").alias(f) for f in spec.fields])
    return wide.unpivot(ids, spec.fields, "field", "value")


def _instant(df: DataFrame, name: str, value: datetime | str) -> Column:
    return F.lit(value).cast(df.schema[name].dataType)


def time_range(
    df: DataFrame,
    start: datetime | str,
    stop: datetime | str | None = None,
    column: str = "time",
) -> DataFrame:
    """Rows from `start` (inclusive) to `stop` (exclusive)."""
    df = df.where(quoted(column) >= _instant(df, column, start))
    return df if stop is None else df.where(quoted(column) < _instant(df, column, stop))


def points(
    df: DataFrame, field_name: str | list[str], measurement: str | None = None
) -> DataFrame:
    """Long points of one or more fields, and of one measurement if it is named."""
    names = [field_name] if isinstance(field_name, str) else field_name
    if measurement is not None:
        df = df.where(F.col("measurement") == measurement)
    return df.where(F.col("field").isin(names))


def _last_value() -> Column:
    return F.max_by("value", F.struct("time", "value"))


def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Last value per series, by time; equal times fall to the larger value."""
    return df.groupBy(*keys).agg(
        _last_value().alias("value"), F.max("time").alias("time")
    )


def alert_map(
    df: DataFrame,
    fields: tuple[str, ...] = ("latitude", "longitude", "alert_level_num"),
    measurement: str | None = None,
) -> DataFrame:
    """Latest value of each field per location, for locations that have all of them.

    One conditional aggregate replaces a self-join per field.
    """
    when = {f: F.col("field") == f for f in fields}
    found = (
        points(df, list(fields), measurement)
        .groupBy("location_id")
        .agg(
            *[
                F.max_by(
                    F.when(cond, F.col("value")),
                    F.when(cond, F.struct("time", "value")),
                ).alias(f)
                for f, cond in when.items()
            ]
        )
    )
    return found.dropna(subset=list(fields))


def prediction_count(
    df: DataFrame, by_series: bool = True, measurement: str | None = None
) -> DataFrame:
    """Number of predictions per series, or over all of them."""
    rows = points(df, "prediction", measurement)
    if by_series:
        rows = rows.groupBy(*SERIES)
    return rows.agg(F.count("value").alias("predictions"))


def mean_probability(
    df: DataFrame, by_series: bool = True, measurement: str | None = None
) -> DataFrame:
    """Mean probability per series, or the mean of the series means as the panel shows it."""
    per_series = points(df, "probability", measurement).groupBy(*SERIES).agg(
        F.avg("value").alias("mean_probability")
    )
    if by_series:
        return per_series
    return per_series.agg(F.avg("mean_probability").alias("mean_probability"))


def extreme_series(df: DataFrame, measurement: str | None = None) -> DataFrame:
    """Number of series whose last `extreme_event` is 1; 0 when there are none."""
    last = latest(points(df, "extreme_event", measurement), SERIES)
    return last.agg(F.count_if(F.col("value").cast("bigint") == 1).alias("extreme_series"))


def level_distribution(
    df: DataFrame, field_name: str = "alert_level_num", measurement: str | None = None
) -> DataFrame:
    """Series per alert level. Level is a tag, so a location counts under each it visited."""
    last = latest(points(df, field_name, measurement), SERIES)
    return last.groupBy("alert_level").agg(F.count(F.lit(1)).alias("series"))


def windowed_mean(
    df: DataFrame,
    every: str,
    keys: tuple[str, ...] = ("location_id", "location_name"),
    field_name: str = "probability",
    measurement: str | None = None,
) -> DataFrame:
    """Mean per tumbling window and series, labelled by window stop; empty windows absent.

    Serves batch and streaming frames; the latter need a watermark on `time` first.
    """
    window = F.window("time", every)
    rows = points(df, field_name, measurement)
    means = rows.groupBy(window, *keys).agg(F.avg("value").alias("mean_value"))
    return means.select(*keys, F.col("window.end").alias("time"), "mean_value")


def series_legend(
    df: DataFrame, keys: tuple[str, ...] = ("location_id", "location_name")
) -> DataFrame:
    """Mean, maximum and last value per plotted series."""
    return df.groupBy(*keys).agg(
        F.avg("mean_value").alias("mean"),
        F.max("mean_value").alias("max"),
        F.max_by("mean_value", "time").alias("last"),
    )
