"""The latest values as a stream: keyed state that forgets locations gone silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hazardflow.functions.casts import quoted, utc_instant
from hazardflow.operators.points import points

MAP_FIELDS = ("latitude", "longitude", "alert_level_num")


def _as_instant(long_points: DataFrame) -> DataFrame:
    naive = isinstance(long_points.schema["time"].dataType, T.TimestampNTZType)
    return long_points.withColumn("time", utc_instant("time")) if naive else long_points


def latest_stream(
    long_points: DataFrame,
    keys: list[str],
    fields: tuple[str, ...],
    silence: str = "1 hour",
    lateness: str = "1 hour",
    measurement: str | None = None,
) -> DataFrame:
    """Keys, one column per field with its latest value, `seen` (the key's newest time, in
    microseconds since 1970, UTC) and `gone`.

    A row comes for each key that a micro-batch changed, in update mode. The state of a key is the
    newest (time, value) per field, equal times falling to the larger value; so late and resent
    points change nothing that is newer. A key whose newest point is `silence` behind the watermark
    is told once more, with `gone`, and forgotten: state holds the keys of that stretch of time and
    no history. Points later than `lateness` may be dropped.

    A key's points of one micro-batch come to one task, in Arrow batches, of each of which one row per
    field is kept. Expiry by a key's own silence has no counterpart among the built-in aggregates,
    so this step runs in Python.
    """
    stretch = int(pd.Timedelta(silence).total_seconds() * 1000)
    timed = _as_instant(points(long_points, list(fields), measurement).where("value is not null"))
    timed = timed.withWatermark("time", lateness)
    micros = F.unix_micros("time").alias("at")
    rows = timed.select(*[quoted(k).cast("string").alias(k) for k in keys], "field", "value", micros, "time")
    names, size = list(fields), len(fields)
    state = T.StructType([T.StructField("at", T.ArrayType(T.LongType())), T.StructField("value", T.ArrayType(T.DoubleType()))])
    shape = T.StructType(
        [T.StructField(k, T.StringType()) for k in keys]
        + [T.StructField(f, T.DoubleType()) for f in names]
        + [T.StructField("seen", T.LongType()), T.StructField("gone", T.BooleanType())]
    )

    def step(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        at, value = (list(x) for x in held.get) if held.exists else ([None] * size, [None] * size)
        gone = held.hasTimedOut
        if gone:
            held.remove()
        else:
            for batch in batches:
                best = batch.sort_values(["at", "value"]).drop_duplicates("field", keep="last")
                for f, t, v in zip(best["field"], best["at"], best["value"]):
                    i = names.index(f)
                    if at[i] is None or (t, v) > (at[i], value[i]):
                        at[i], value[i] = int(t), float(v)
            held.update((at, value))
        seen = max(t for t in at if t is not None)
        if not gone:
            due = seen // 1000 + stretch
            # a key already that far behind goes with the next watermark
            held.setTimeoutTimestamp(max(due, held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([[*key, *value, seen, gone]], columns=shape.names).astype({f: "float64" for f in names})

    grouped = rows.groupBy(*keys)
    return grouped.applyInPandasWithState(step, shape, state, "update", GroupStateTimeout.EventTimeTimeout)


def alert_map_stream(long_points: DataFrame, silence: str = "1 hour", lateness: str = "1 hour", measurement: str | None = None) -> DataFrame:
    """The alert map as a stream: per location its latest latitude, longitude and level; a location
    leaves the map when it has been silent. See `latest_stream`."""
    return latest_stream(long_points, ["location_id"], MAP_FIELDS, silence, lateness, measurement)


def map_now(changes: DataFrame, keys: list[str], fields: tuple[str, ...] = MAP_FIELDS) -> DataFrame:
    """The map from its stored changes (`landing.upsert_parquet`): the last row per key, without
    those that are gone or lack a field."""
    rest = [c for c in changes.columns if c not in (*keys, "batch_id")]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row")).select(*keys, "_row.*")
    return last.where(~F.col("gone")).dropna(subset=list(fields)).select(*keys, *fields)
