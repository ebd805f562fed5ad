"""One alert per event, over resent, late and unreadable times, and over a restart."""

from pyspark.sql import functions as F

from hazardflow.plans.catalog import _drain
from hazardflow.sources import messages
from hazardflow.streaming import scoring

FIELDS = "location_id string, timestamp string, alert_level string, processing_time timestamp, n int"
STAMP = "2024-06-01 12:00:00"


def run(spark, path, rows):
    df = spark.createDataFrame([(*r[:3], None, r[3]) for r in rows], FIELDS).withColumn("processing_time", F.lit(STAMP).cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(f"{path}/in")
    source = messages.message_stream(spark, "parquet", {"path": f"{path}/in"}, schema=df.schema)
    _drain(scoring.alerts_once_stream(source, f"{path}/out", f"{path}/checkpoint", every=None, lateness="1 hour"))
    out = spark.read.parquet(f"{path}/out")
    return sorted((r["location_id"], r["timestamp"]) for r in out.collect())


def test_one_alert_per_event(spark, tmp_path):
    first = [("a", "2024-06-01 10:00:00", "HIGH", 1), ("a", "2024-06-01 10:00:00", "HIGH", 2), ("a", "2024-06-01T10:00:00", "HIGH", 3),
             ("b", "2024-06-01 10:30:00", "CRITICAL", 4), ("c", "2024-06-01 10:40:00", "LOW", 5), ("d", "2024-06-01 09:00:00", "HIGH", 6)]
    told = run(spark, tmp_path, first)
    assert told == [("a", "2024-06-01 10:00:00"), ("a", "2024-06-01T10:00:00"), ("b", "2024-06-01 10:30:00"), ("d", "2024-06-01 09:00:00")]
    # sent again and within the hour: nothing new; a new event of the same place: one more
    told = run(spark, tmp_path, [first[0], first[3], ("b", "2024-06-01 10:45:00", "HIGH", 7), ("b", "2024-06-01 10:45:00", "HIGH", 8)])
    assert len(told) == 5 and told.count(("b", "2024-06-01 10:45:00")) == 1
    # more than an hour behind the newest event: no alert, whether new or sent again
    told = run(spark, tmp_path, [("d", "2024-06-01 09:00:00", "HIGH", 9), ("e", "2024-06-01 08:00:00", "HIGH", 10)])
    assert len(told) == 5
    # a time that cannot be read counts as the time of processing
    told = run(spark, tmp_path, [("f", "soon", "HIGH", 11), ("f", "soon", "HIGH", 12), ("g", None, "HIGH", 13)])
    assert len(told) == 7


def test_event_time_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("2024-06-01 10:00:00",), ("x",), (None,)], "timestamp string")
        got = [r[0] for r in df.select(F.unix_seconds(scoring.event_time())).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1717236000, None, None]
