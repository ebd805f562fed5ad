"""Streaming scoring: decode, features, model, alert level, sink. Same functions as batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardflow.functions.alerts import fire_alert, flood_alert, high_alerts, prob_of
from hazardflow.functions.casts import quoted
from hazardflow.functions.fire import fire_features
from hazardflow.functions.flood import flood_features
from hazardflow.operators.columns import align_features, computed_once
from hazardflow.operators.forest import Fitted, score_all
from hazardflow.operators.joins import enrich_location, location_lookup
from hazardflow.operators.points import (
    FIRE_POINTS,
    FLOOD_POINTS,
    PointSpec,
    dedup_points,
    identity,
    to_points,
    write_points,
)
from hazardflow.sources.messages import decode
from hazardflow.sources.schemas import FIRE_ZERO_FILL, fire_message_schema, flood_message_schema
from hazardflow.streaming.landing import append_parquet
from hazardflow.streaming.runs import RunStore, newest_wins

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model: Transformer | Fitted, two_class: bool = True) -> Scorer:
    """Scorer of a fitted model; fails at start when its features are not all present.

    A row with a missing feature stays, with null results and `scored` false: a broken sensor
    must not vanish from the points. Other transformers decide that themselves.
    """

    def run(df: DataFrame) -> DataFrame:
        if isinstance(model, Fitted):
            align_features(df, model.features)
            df = score_all(df, model)
        else:
            df = model.transform(df).withColumn("scored", F.col("prediction").isNotNull())
        if two_class:
            df = df.withColumn("prob_flood", F.when(F.col("scored"), prob_of()))
        return computed_once(df)

    return run


def unscored(df: DataFrame) -> DataFrame:
    """(rows, unscored): how many rows a model could not score."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("scored")).alias("unscored")
    )


def score_flood_stream(
    messages: DataFrame, scorer: Scorer, fills: dict[str, object] | None = None
) -> DataFrame:
    """Messages to scored flood rows with alert levels; batch and streaming frames alike."""
    rows = decode(messages, flood_message_schema(), stamp=True)
    if fills:
        rows = rows.fillna(fills)
    return flood_alert(scorer(flood_features(rows)))


def score_fire_stream(messages: DataFrame, scorer: Scorer) -> DataFrame:
    """Messages to scored fire rows with alert levels."""
    rows = decode(messages, fire_message_schema(), stamp=True)
    rows = rows.fillna({c: 0 for c in FIRE_ZERO_FILL})
    # The trained neighbour time is a number; text that is none becomes null.
    rows = rows.withColumn("Neighbour_acq_time", F.col("timestamp").try_cast("double"))
    return fire_alert(scorer(fire_features(rows, neighbour_sum=True)))


# --- sinks ------------------------------------------------------------------------------------


def batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def parquet_sink(
    points_root: str, alerts_root: str | None, shape: Scorer, keys: list[str] | None = None
) -> Callable:
    """Write each micro-batch whole; a retried batch replaces itself.

    `shape` turns scored rows into points, of which one per identity `keys` is stored (the last by
    all other columns), by date and measurement. Alerts (the urgent rows) are a second table. The
    batch is computed once. Errors propagate, so a batch that could not be written is not
    committed.
    """

    def points_of(batch: DataFrame) -> DataFrame:
        points = shape(batch)
        if keys is None:
            return points
        return dedup_points(points, keys, [c for c in points.columns if c not in keys])

    def write(batch: DataFrame, batch_id: int) -> None:
        if alerts_root is None:
            write_points(points_of(batch), points_root, batch_id)
            return
        # Scoring runs once for both tables.
        batch = batch.persist()
        try:
            # Points of one stamp lie in one day: the shuffle of the identities has dealt them out already.
            as_dealt = keys is not None and _one_day(shape(batch))
            write_points(points_of(batch), points_root, batch_id, as_dealt)
            high_alerts(batch).write.mode("overwrite").parquet(batch_path(alerts_root, batch_id))
        finally:
            batch.unpersist()

    return write


def _one_day(points: DataFrame) -> bool:
    """Whether all points are of one day; those without a time are a day of their own."""
    day = F.to_date("time")
    row = points.agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count_if(day.isNull()).alias("none")).first()
    return row["first"] == row["last"] and (row["first"] is None or not row["none"])


def flood_points_shape(dim: DataFrame, keep: list[str] | None = None) -> Scorer:
    """Points of scored flood rows; the dimension is checked once, not per batch."""
    ready = location_lookup(dim)
    return lambda scored: to_points(enrich_location(scored, ready), FLOOD_POINTS, keep)


def fire_points_shape() -> Scorer:
    return lambda scored: to_points(scored, FIRE_POINTS)


def flood_sink(points_root: str, alerts_root: str | None, dim: DataFrame) -> Callable:
    """Sink of the flood job: points under their identity, alerts beside."""
    return parquet_sink(points_root, alerts_root, flood_points_shape(dim), identity(FLOOD_POINTS))


def fire_sink(points_root: str) -> Callable:
    """Sink of the fire job: points under their identity."""
    return parquet_sink(points_root, None, fire_points_shape(), identity(FIRE_POINTS))


def point_store(spark: SparkSession, root: str, spec: PointSpec) -> RunStore:
    """Store of a measurement's points by day: one point per identity over all batches, the newest
    batch's, in few files after compaction."""
    return RunStore(spark, root, ["date", *identity(spec)], ["date", "measurement"], newest_wins())


def store_sink(
    store: RunStore, shape: Scorer, compact_every: int | None = 240, keep: int = 240
) -> Callable[[DataFrame, int], None]:
    """Sink that keeps points in a `point_store` and compacts it on the way: at 15 seconds a batch,
    by the hour. `shape` turns scored rows into points."""
    return store.sink(lambda batch: shape(batch).withColumn("date", F.to_date("time")), compact_every, keep)


def run_scoring(
    scored: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "15 seconds",
) -> StreamingQuery:
    """Start the micro-batch sink with checkpointed progress.

    `every=None` works off what is there and stops.
    """
    if not checkpoint:
        raise ValueError("a checkpoint folder is required: without it restarts lose data")
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = scored.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def alerts_stream(
    scored: DataFrame, path: str, checkpoint: str, every: str | None = "15 seconds"
) -> StreamingQuery:
    """Append the urgent rows of a scored stream to their own table."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        high_alerts(scored)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def event_time(name: str = "timestamp") -> Column:
    """The instant that a message's own time text tells, as UTC; null where it tells none."""
    wall = F.try_to_timestamp(F.concat(quoted(name), F.lit("+00:00")), F.lit("yyyy-MM-dd HH:mm:ssXXX"))
    return F.coalesce(wall, F.try_to_timestamp(F.concat(quoted(name), F.lit("+00:00")), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def one_alert_per_event(
    scored: DataFrame, keys: tuple[str, ...] = ("location_id", "timestamp"), lateness: str = "1 hour"
) -> DataFrame:
    """Urgent rows of a scored stream, each event once however often its message is sent.

    An event is its `keys`; its time is the message's own, or the processing time where that cannot be
    read. A message sent again within `lateness` of the newest event gives no second alert. One that
    comes later than that gives none at all, sent before or not: what to do with it then cannot be
    told from state that has been given up, and its point is stored by its identity all the same.
    Only urgent rows enter the state, and they leave it with the watermark.
    """
    urgent = high_alerts(scored)
    timed = urgent.withColumn("event_time", F.coalesce(event_time(), F.col("processing_time").cast("timestamp")))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(list(keys))


def alerts_once_stream(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "15 seconds",
    keys: tuple[str, ...] = ("location_id", "timestamp"),
    lateness: str = "1 hour",
) -> StreamingQuery:
    """Append one alert per event to a table of their own."""
    return append_parquet(one_alert_per_event(scored, keys, lateness), path, checkpoint, every)
