"""Points, panels and lookups against hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazardflow.functions.alerts import flood_alert
from hazardflow.functions.flood import flood_features
from hazardflow.operators import joins
from hazardflow.operators import points as P
from hazardflow.plans import dashboard

HOUR = datetime(2024, 1, 1)


def at(minute):
    return HOUR + timedelta(minutes=minute)


@pytest.fixture(scope="module")
def long(spark):
    data = [
        ("L1", "LOW", "probability", 10, 0.2),
        ("L1", "HIGH", "probability", 50, 0.8),
        ("L2", "LOW", "probability", 30, 0.4),
        ("L1", "LOW", "extreme_event", 10, 1.0),
        ("L1", "HIGH", "extreme_event", 50, 0.0),
        ("L2", "LOW", "extreme_event", 30, 1.0),
        ("L1", "HIGH", "latitude", 50, 33.0),
        ("L1", "HIGH", "longitude", 50, -7.0),
        ("L1", "HIGH", "alert_level_num", 50, 3.0),
        ("L2", "LOW", "latitude", 30, 34.0),
        ("L2", "LOW", "longitude", 30, -6.0),
        ("L1", "LOW", "prediction", 10, 0.0),
        ("L1", "LOW", "prediction", 20, 1.0),
        ("L2", "LOW", "prediction", 30, 0.0),
    ]
    return spark.createDataFrame(
        [("flood_prediction", loc, f"Site {loc}", lvl, f, v, at(m)) for loc, lvl, f, m, v in data],
        "measurement string, location_id string, location_name string, alert_level string, field string,"
        " value double, time timestamp_ntz",
    )


def test_latest(long, rows):
    got = P.latest(P.points(long, "probability"), ["location_id"])
    assert rows(got, "location_id", "value") == [("L1", 0.8), ("L2", 0.4)]


def test_alert_map_needs_every_field(long, rows):
    assert rows(P.alert_map(long)) == [("L1", 33.0, -7.0, 3.0)]


def test_alert_map_takes_the_newest_value(spark, long, rows):
    moved = long.unionByName(
        spark.createDataFrame(
            [("flood_prediction", "L1", "Site L1", "LOW", "latitude", 1.0, at(55))], long.schema
        )
    )
    assert rows(P.alert_map(moved)) == [("L1", 1.0, -7.0, 3.0)]


def test_probability_means(long, rows):
    got = P.mean_probability(long)
    assert rows(got, "location_id", "alert_level", "mean_probability") == [
        ("L1", "HIGH", 0.8),
        ("L1", "LOW", 0.2),
        ("L2", "LOW", 0.4),
    ]
    assert P.mean_probability(long, by_series=False).first()[0] == pytest.approx(1.4 / 3)


def test_prediction_count(long, rows):
    got = P.prediction_count(long)
    assert rows(got, "location_id", "predictions") == [("L1", 2), ("L2", 1)]
    assert P.prediction_count(long, by_series=False).first()[0] == 3


def test_extreme_series_counts_series_not_events(long):
    assert P.extreme_series(long).first()[0] == 2
    assert P.extreme_series(long.where("false")).first()[0] == 0


def test_level_distribution_counts_each_visited_level(long, rows):
    assert rows(P.level_distribution(long, "probability")) == [("HIGH", 1), ("LOW", 2)]


def test_windowed_mean_is_labelled_by_its_stop(long):
    means = P.windowed_mean(long, "30 minutes")
    got = {(r.location_id, r.time): r.mean_value for r in means.collect()}
    assert got == {("L1", at(30)): 0.2, ("L1", at(60)): 0.8, ("L2", at(60)): 0.4}
    legend = {r.location_id: tuple(r)[2:] for r in P.series_legend(means).collect()}
    assert legend["L1"] == (0.5, 0.8, 0.8) and legend["L2"] == (0.4, 0.4, 0.4)


def test_time_range_is_half_open(long):
    assert {r.time for r in P.time_range(long, at(10), at(50)).collect()} == {at(10), at(20), at(30)}
    assert P.time_range(long, at(50)).count() == 5


def test_panels(long):
    shown = dashboard.panels(long, at(60), "30 minutes")
    assert shown["map"].count() == 1 and shown["extreme_series"].first()[0] == 2
    assert set(shown) == {
        "map",
        "prediction_count",
        "mean_probability",
        "extreme_series",
        "probability_series",
        "level_distribution",
    }


def scored_row(spark):
    df = spark.createDataFrame(
        [("LOC_1", 20.0, 160.0, 50.0, 1000.0, 9.0, 10.7, 2, 1.0, 0.95, at(0))],
        "location_id string, temperature_c double, rainfall_mm double, humidity_pct double,"
        " river_discharge double, water_level_m double, elevation_m double,"
        " historical_floods int, prediction double, prob_flood double, processing_time timestamp_ntz",
    )
    return flood_alert(flood_features(df))


def dim(spark, *ids):
    return spark.createDataFrame(
        [(i, 10.0, 20.0, f"Name {i}") for i in ids],
        "location_id string, lat double, lon double, name string",
    )


def test_points_are_typed_and_complete(spark):
    wide = P.to_points(joins.enrich_location(scored_row(spark), dim(spark, "LOC_1")), P.FLOOD_POINTS)
    row = wide.first()
    assert dict(wide.dtypes)["prediction"] == "bigint"
    assert (row.prediction, row.alert_level, row.elevation_m) == (1, "CRITICAL", 10)
    assert (row.latitude, row.location_name, row.time) == (10.0, "Name LOC_1", at(0))
    assert P.points_long(wide).count() == len(P.FLOOD_POINTS.fields) == 17


def test_unknown_location_gets_defaults(spark):
    row = joins.enrich_location(scored_row(spark), dim(spark, "other")).first()
    assert (row.latitude, row.longitude, row.location_name) == (0.0, 0.0, "Unknown")


def test_dimension_beyond_the_bound_is_salted(spark, rows):
    fact = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    dims = spark.createDataFrame([("hot", 1), ("3", 2), ("9", 3), (None, 4)], "k string, v int")
    small = joins.lookup(dims, "k").join(fact)
    large = joins.lookup(dims, "k", most_bytes=10, salts=8).join(fact)
    assert rows(small, "id", "v") == rows(large, "id", "v")
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert large.columns == small.columns
    same = spark.range(800).select(F.lit("hot").alias("k"))
    salted = joins.lookup(dims, "k", most_bytes=10, salts=8)
    assert salted.join(same).count() == 800


def test_a_doubled_key_multiplies_no_row(spark, rows):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, id int")
    dims = spark.createDataFrame([("a", 9, "y"), ("a", 5, "z"), ("a", 5, None)], "k string, v int, t string")
    for most in (10**6, 1):
        got = joins.lookup(dims, "k", most_bytes=most).join(fact)
        assert rows(got, "id", "v", "t") == [(1, 5, None), (2, None, None), (3, None, None)]


def test_broadcast_is_bound_in_bytes(spark):
    wide = spark.range(10).select("id", F.lit("x" * 1000).alias("t"))
    assert joins.fits_broadcast(wide, 20_000) and not joins.fits_broadcast(wide, 9_000)


def test_measurements_do_not_mix(spark, long):
    other = long.withColumn("measurement", F.lit("fire_prediction"))
    both = long.unionByName(other)
    assert P.prediction_count(both, by_series=False).first()[0] == 6
    assert P.prediction_count(both, by_series=False, measurement="fire_prediction").first()[0] == 3
    shown, alone = (dashboard.panels(df, at(60), "30 minutes") for df in (both, long))
    for name in alone:
        assert sorted(map(tuple, shown[name].collect()), key=str) == sorted(map(tuple, alone[name].collect()), key=str)


def test_stored_points_prune_days_and_measurements(spark, tmp_path):
    wide = spark.range(96).select(
        F.lit("flood_prediction").alias("measurement"), "id",
        (F.lit(HOUR) + F.make_dt_interval(hours=F.col("id"))).cast("timestamp_ntz").alias("time"),
    )
    wide = wide.withColumn("id", F.col("id").cast("int"))
    root = str(tmp_path / "points")
    P.write_points(wide, root, 1)
    P.write_points(wide.limit(0), root, 2)
    P.write_points(wide, root, 1)
    assert spark.read.parquet(root).count() == 96
    day = P.read_points(spark, root, at(24 * 60), at(48 * 60), "flood_prediction")
    assert sorted(r["id"] for r in day.collect()) == list(range(24, 48))
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "date" in filters and "measurement" in filters


def test_dedup_keeps_the_last_point(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 10.0, 1), ("a", 1, 20.0, 3), ("a", 1, 15.0, 2), ("a", 2, 5.0, 0)],
        "tag string, time int, value double, seq int",
    )
    got = P.dedup_points(df, ["tag", "time"], ["seq"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == [("a", 1, 20.0, 3), ("a", 2, 5.0, 0)]
    assert plan.count("WindowGroupLimit") == 2  # before the shuffle and after it
