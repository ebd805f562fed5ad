"""Landing and continuous windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hazardflow.functions.casts import utc_instant, utc_wall
from hazardflow.operators.points import windowed_mean


def append_parquet(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet layer; `every=None` works off what is there and stops."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def land_stream(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Land decoded messages as they arrive."""
    return append_parquet(df, path, checkpoint, every)


def windowed_mean_stream(
    points_long: DataFrame, every: str, lateness: str, **options
) -> DataFrame:
    """Tumbling means over event time, for `upsert_parquet`, which shows windows still open too.

    Point times are UTC. Watermarks need an instant, so naive times are turned into one and the
    window stop is given back as naive UTC time. Points later than the watermark are dropped.
    """
    naive = isinstance(points_long.schema["time"].dataType, T.TimestampNTZType)
    timed = points_long.withColumn("time", utc_instant("time")) if naive else points_long
    means = windowed_mean(timed.withWatermark("time", lateness), every, **options)
    return means.withColumn("time", utc_wall("time"))


def upsert_parquet(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write what each micro-batch changed under its batch id; `newest` reads the last state.

    In update mode a window is written whenever it changes, so windows that are still open when
    a run ends are there as well. A retried batch replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(write).trigger(**trigger).start()


def newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The last written row per key of an upserted layer."""
    rest = [c for c in df.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("_row")
    return df.groupBy(*keys).agg(last).select(*keys, "_row.*")
