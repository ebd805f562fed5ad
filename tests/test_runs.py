"""Stores of runs: identity across batches, compaction, and roll-ups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazardflow.operators.points import PointSpec, series_legend, to_points, windowed_mean
from hazardflow.streaming import rollups
from hazardflow.streaming.runs import RunStore, newest_wins
from hazardflow.streaming.scoring import point_store, store_sink

SCHEMA = "date date, measurement string, location string, time timestamp_ntz, value double"
DAYS = [dt.date(2024, 1, d) for d in (1, 2)]


def store_at(spark, path):
    return RunStore(spark, str(path), ["date", "measurement", "location", "time"], ["date", "measurement"], newest_wins(["value"]))


def made(batches, days=DAYS):
    """Rows of some batches, in which identities come again; one location has no name."""
    r = random.Random(1)
    out = []
    for b in range(batches):
        for _ in range(6):
            day = r.choice(days)
            time = dt.datetime(day.year, day.month, day.day, r.randrange(3))
            out.append((day, "flood", r.choice(["a", "b", None]), time, float(r.randrange(100)), b))
    return out


def last(rows, upto=10**9):
    best = {}
    for *row, b in rows:
        if b <= upto:
            key = tuple(row[:4])
            best[key] = max(best.get(key, (-1, -1.0)), (b, row[4]))
    return sorted(((*k, v) for k, (_, v) in best.items()), key=str)


def seen(df):
    return sorted((tuple(r) for r in df.select("date", "measurement", "location", "time", "value").collect()), key=str)


def test_five_hundred_batches_become_few_files(spark, tmp_path):
    store, rows = store_at(spark, tmp_path), made(500, DAYS[:1])
    store.write_batch(spark.createDataFrame(rows, f"{SCHEMA}, batch long"), "batch")
    before = store.read()
    assert seen(before) == last(rows)
    assert store.runs().where("live").count() == 500
    assert store.compact(399) == 1
    assert seen(store.read()) == last(rows) and seen(before) == last(rows)
    assert store.compact(499) == 1
    # all 500 batches and the first sealed run are replaced; the second one stays
    assert store.expire(500) == 501
    assert seen(store.read()) == last(rows)
    assert store.runs().count() == 1 and len(spark.read.parquet(f"{tmp_path}/data").inputFiles()) <= 4
    assert store.compact(499) == 0 and store.expire(500) == 0


def test_readers_at_every_moment_of_a_compaction(spark, tmp_path, monkeypatch):
    store, rows = store_at(spark, tmp_path), made(6)
    for b in range(6):
        store.write_batch(spark.createDataFrame([r[:5] for r in rows if r[5] == b], SCHEMA), b)
    write, moments = RunStore._write, []

    def halted(self, merged):
        write(self, merged)
        # the sealed run is there and not yet noted
        moments.append(seen(store.read()))
        raise RuntimeError("lost")

    monkeypatch.setattr(RunStore, "_write", halted)
    with pytest.raises(RuntimeError):
        store.compact(3)
    monkeypatch.setattr(RunStore, "_write", write)
    assert moments == [last(rows)] and seen(store.read()) == last(rows)
    assert store.compact(3) == 2
    assert seen(store.read()) == last(rows)


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    store = store_at(spark, tmp_path)
    day = DAYS[0]
    at = dt.datetime(2024, 1, 1, 5)
    one = spark.createDataFrame([(day, "flood", "a", at, 1.0)], SCHEMA)
    with pytest.raises(ValueError):
        store.read()
    for _ in range(2):
        store.write_batch(one, 0)
    store.write_batch(one.withColumn("value", F.lit(9.0)), 1)
    store.write_batch(one.withColumn("value", F.lit(5.0)), 2)
    assert [r["value"] for r in store.read().collect()] == [5.0]
    assert store.compact(1) == 1
    assert [r["value"] for r in store.read().collect()] == [5.0]
    assert store.read(F.col("date") == "2024-01-02").count() == 0


def long_points(spark, n=900):
    r = random.Random(3)
    base = dt.datetime(2024, 3, 1)
    rows = [
        ("flood_prediction", f"L{r.randrange(4)}", None if r.random() < 0.1 else "Site", r.choice(["probability", "prediction"]),
         None if r.random() < 0.05 else r.randrange(1000) / 8, base + dt.timedelta(seconds=r.randrange(4 * 86_400)))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "measurement string, location_id string, location_name string, field string, value double, time timestamp_ntz")


@pytest.fixture(scope="module")
def rolled(spark, tmp_path_factory):
    """Points in five batches in no order of time, the first three compacted."""
    points = long_points(spark).withColumn("batch", F.pmod(F.hash("time", "location_id"), F.lit(5))).cache()
    store = rollups.rollup_store(spark, str(tmp_path_factory.mktemp("rollups")))
    write = rollups.rollup_sink(store)
    for b in range(5):
        write(points.where(F.col("batch") == b).drop("batch"), b)
        if b in (1, 2):
            store.compact(b)
    # the last batch comes again
    write(points.where("batch = 4").drop("batch"), 4)
    return points, store


@pytest.mark.parametrize("every,level", [("15 minutes", "minute"), ("6 hours", "hour"), ("90 minutes", "minute"), ("2 days", "day")])
def test_windows_from_partials_equal_the_direct_ones(rolled, every, level):
    points, store = rolled
    assert rollups.level_of(every) == level
    means = rollups.windowed(store, every)
    direct = windowed_mean(points.where("value is not null"), every)
    # eighths of whole numbers: sums are exact in any order
    names = ["location_id", "location_name", "time", "mean_value"]
    assert sorted(map(str, means.select(names).collect())) == sorted(map(str, direct.select(names).collect()))
    rounded = {c: F.round(c, 9) for c in ("mean", "max", "last")}
    legend = [sorted(map(str, series_legend(df).withColumns(rounded).collect())) for df in (means, direct)]
    assert legend[0] == legend[1]


def test_partials_keep_extremes_and_last(rolled):
    points, store = rolled
    day = rollups.windowed(store, "1 day", start="2024-03-02", stop="2024-03-03")
    got = {(r["location_id"], r["location_name"]): (r["n"], r["low"], r["high"], r["last"]) for r in day.collect()}
    want = {}
    rows = points.where("field = 'probability' and value is not null and time >= '2024-03-02' and time < '2024-03-03'").collect()
    for r in rows:
        want.setdefault((r["location_id"], r["location_name"]), []).append((r["time"], r["value"]))
    assert got == {k: (len(v), min(x for _, x in v), max(x for _, x in v), max(v)[1]) for k, v in want.items()}


def test_a_window_reads_its_level_and_periods_only(rolled):
    _, store = rolled
    hours = rollups.windowed(store, "30 minutes", start="2024-03-02 06:00:00", stop="2024-03-02 12:00:00")
    plan = hours._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "level" in filters and "date" in filters and "run" in filters
    times = [r["time"] for r in hours.collect()]
    assert times and min(times) > dt.datetime(2024, 3, 2, 6) and max(times) <= dt.datetime(2024, 3, 2, 12)
    with pytest.raises(ValueError):
        rollups.level_of("90 seconds")


def test_a_sink_keeps_its_store_compact(spark, tmp_path):
    """The flood job's points over many batches that tell the same places again."""
    spec = PointSpec("flood_prediction", ["location_id", "alert_level"], ["prediction"], {"probability": "prob"}, time="at")
    store = point_store(spark, str(tmp_path), spec)
    write = store_sink(store, lambda rows: to_points(rows, spec), compact_every=3, keep=2)
    at = dt.datetime(2024, 7, 1, 12)
    for b in range(8):
        rows = [(f"L{i}", "HIGH", 1, b / 10, at + dt.timedelta(seconds=0 if i < 2 else b)) for i in range(3)]
        write(spark.createDataFrame(rows, "location_id string, alert_level string, prediction int, prob double, at timestamp_ntz"), b)
    points = store.read().collect()
    # two places are told under one time, the third under eight
    assert len(points) == 10 and {r["probability"] for r in points if r["location_id"] != "L2"} == {0.7}
    runs = sorted((r["sealed"], r["run"], r["live"]) for r in store.runs().collect())
    assert [r for r in runs if r[2]] == [(0, 6, True), (0, 7, True), (1, 5, True)]
    assert all(r[1] >= 4 for r in runs)
