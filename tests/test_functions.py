"""Feature, alert and cast expressions against hand-computed rows."""

import math
from datetime import datetime

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hazardflow.functions import alerts, casts, fire, flood
from hazardflow.sources import schemas

INPUTS = (
    "temperature_c double, rainfall_mm double, humidity_pct double, river_discharge double,"
    " water_level_m double, elevation_m double, historical_floods int"
)
# Inputs, then expected features in the order of EXPECTED.
GOLDEN = [
    (
        (20.0, 100.0, 50.0, 1000.0, 5.0, 100.0, 2),
        (500, 5000, 100000, 9.90099, 19.607843, 2.380952, 0.69, 0, 0, 0, 0, 0),
    ),
    (
        (-1.0, 200.0, 60.0, 3000.0, 10.0, 50.0, 0),
        (2000, 30000, 600000, 14.925373, 4.950495, None, 1.5, 1, 1, 0, 1, 0),
    ),
    (
        (15.0, 201.0, 80.0, 500.0, 1.0, 49.0, 5),
        (201, 500, 100500, 2.475248, 44.545455, 5.0, 0.833, 1, 0, 1, 0, 1),
    ),
    (
        (10.0, 150.0, 40.0, 2000.0, 8.0, 50.0, 1),
        (1200, 16000, 300000, 13.245033, 6.17284, 3.636364, 1.11, 0, 0, 0, 0, 0),
    ),
]
EXPECTED = [
    "rain_water_interaction",
    "discharge_waterlevel",
    "rainfall_discharge",
    "discharge_per_rain",
    "elevation_water_ratio",
    "humidity_temp_ratio",
    "flood_risk_index",
    "critical_rainfall",
    "critical_water",
    "low_elevation",
    "high_discharge",
    "extreme_event",
]


@pytest.mark.parametrize("given, want", GOLDEN)
def test_flood_features(spark, given, want):
    row = flood.flood_features(spark.createDataFrame([given], INPUTS)).first()
    for name, value in zip(EXPECTED, want):
        assert row[name] == (None if value is None else pytest.approx(value, abs=1e-6)), name


def test_flood_features_with_nulls(spark):
    df = spark.createDataFrame(
        [(1.0, None, 1.0, 0.0, 11.0, 1.0, 1), (1.0, None, 1.0, 0.0, 1.0, 1.0, 1)], INPUTS
    )
    wet, dry = flood.flood_features(df).collect()
    assert (wet.extreme_event, wet.critical_rainfall, wet.flood_risk_index) == (1, 0, None)
    assert dry.extreme_event == 0


def test_stream_name_is_renamed(spark):
    df = spark.createDataFrame(
        [GOLDEN[0][0]], INPUTS.replace("river_discharge", "river_discharge_m3s")
    )
    out = flood.flood_features(df)
    assert "river_discharge" in out.columns and "river_discharge_m3s" not in out.columns


ALERTS = [
    (1, 0.95, "CRITICAL", 4),
    (1, 0.90, "HIGH", 3),
    (1, 0.70, "MODERATE", 2),
    (1, 0.51, "MODERATE", 2),
    (0, 0.95, "LOW", 1),
    (None, None, "LOW", 1),
]


def test_flood_alert(spark):
    df = spark.createDataFrame(
        [(p, q) for p, q, _, _ in ALERTS], "prediction int, prob_flood double"
    )
    got = [(r.alert_level, r.alert_level_num) for r in alerts.flood_alert(df).collect()]
    assert got == [(level, num) for _, _, level, num in ALERTS]


def test_flood_alert_is_monotone_in_probability(spark):
    df = spark.range(101).select(
        F.lit(1).alias("prediction"), (F.col("id") / 100).alias("prob_flood")
    )
    nums = [
        r.alert_level_num for r in alerts.flood_alert(df).orderBy("prob_flood").collect()
    ]
    assert nums == sorted(nums) and set(nums) == {2, 3, 4}


def test_fire_alert(spark):
    df = spark.createDataFrame([(2,), (1,), (0,), (None,)], "prediction int")
    got = [(r.alert_level, r.alert_level_num) for r in alerts.fire_alert(df).collect()]
    assert got == [("HIGH", 3), ("MEDIUM", 2), ("LOW", 1), ("LOW", 1)]


def test_level_label(spark):
    df = spark.createDataFrame([(1,), (4,), (9,), (None,)], "n int")
    got = [r[0] for r in df.select(alerts.level_label(F.col("n"))).collect()]
    assert got == ["LOW", "CRITICAL", None, None]


def test_prob_of(spark):
    df = spark.createDataFrame([(Vectors.dense([0.25, 0.75]),)], ["probability"])
    row = df.select(alerts.prob_of(), alerts.prob_of(cls=5)).first()
    assert tuple(row) == (0.75, None)


def test_high_alerts(spark, rows):
    df = spark.createDataFrame([("CRITICAL",), ("HIGH",), ("LOW",), (None,)], "alert_level string")
    assert rows(alerts.high_alerts(df)) == [("CRITICAL",), ("HIGH",)]


@pytest.mark.parametrize(
    "frp, want",
    [("799.99", 0), ("800", 1), ("1499.99", 1), ("1500", 2), (None, None), ("NaN", None)],
)
def test_fire_target(spark, frp, want):
    df = spark.createDataFrame([(frp,)], "frp string")
    assert fire.fire_target(df).first().frp_class == want


def test_fire_features(spark):
    df = spark.createDataFrame(
        [(30.0, 10.0, 2.0, 24.0, 4.0, 120.0, 20.0, 60.0, 50.0)],
        "TEMP_max double, WSPD_ave double, PRCP double, TEMP_ave double, CH_median double,"
        " ELEV_max double, ELEV_min double, ELEV_mean double, Neighbour_ELEV_mean double",
    )
    row = fire.fire_features(df, neighbour_sum=True).first()
    assert (row.fire_weather_index, row.dryness_index, row.veg_temp_interaction) == (100, 8, 120)
    assert (row.ELEV_range, row.ELEV_diff, row.ELEV_mean_sum) == (100, 10, 110)
    assert row.ELEV_ratio == pytest.approx(60 / 50.000001)
    assert "SLP_ratio" not in row.asDict() and "lat_lon_interaction" not in row.asDict()


def test_fire_indices_without_divisor(spark):
    df = spark.createDataFrame(
        [(30.0, 10.0, -1.0, 24.0)],
        "TEMP_max double, WSPD_ave double, PRCP double, TEMP_ave double",
    )
    row = fire.fire_features(df).first()
    assert row.fire_weather_index is None and row.dryness_index is None


def test_full_fire_schema_gives_the_trained_features(spark):
    from hazardflow.operators.columns import drop_columns, feature_columns

    raw = spark.createDataFrame([], schemas.fire_csv_schema())
    gold = fire.fire_features(fire.fire_target(drop_columns(raw, schemas.FIRE_DROPPED)))
    names = feature_columns(gold, schemas.FIRE_NOT_FEATURES)
    assert len(names) == 167
    assert names[0] == "Neighbour_acq_time" and names[63:66] == [
        "Shape",
        "c_latitude",
        "c_longitude",
    ]
    assert names[139:145] == [
        "ELEV_ratio",
        "SLP_ratio",
        "ELEV_range",
        "SLP_range",
        "fire_weather_index",
        "dryness_index",
    ]
    assert names[-1] == "CC_range"


def test_safe_casts(spark):
    texts = ["3.9", "-3.9", "abc", None, "NaN", "Infinity", " 7 ", "3000000000"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(casts.safe_int("x"), casts.safe_double("x")).collect()
    assert [r[0] for r in got] == [3, -3, 0, 0, 0, 0, 7, 3000000000]
    floats = [r[1] for r in got]
    assert floats[:4] == [3.9, -3.9, 0.0, 0.0] and math.isnan(floats[4])


def test_local_to_utc(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 15, 12),), (datetime(2024, 3, 15, 12),)], "t timestamp_ntz"
    )
    got = [r.u for r in casts.local_to_utc(df, "t", "Africa/Casablanca", "u").collect()]
    # One hour ahead of UTC, except during Ramadan.
    assert got == [datetime(2024, 1, 15, 11), datetime(2024, 3, 15, 12)]


def test_zoned_time_is_an_instant(spark):
    df = spark.sql("select timestamp '2024-01-15 12:00:00' as t")
    assert casts.local_to_utc(df, "t", "Africa/Casablanca").first().t == datetime(2024, 1, 15, 12)


def test_utc_times_do_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist in New York on this day, and 01:30 exists twice in November.
    walls = [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30), datetime(1960, 1, 1)]
    df = spark.createDataFrame([(w,) for w in walls], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        there = df.select("t", casts.utc_instant("t").alias("i"))
        back = there.select("t", casts.utc_wall("i").alias("w"), F.unix_micros("i").alias("u"))
        rows = back.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.w for r in rows] == [r.t for r in rows] == walls
    assert rows[0].u == 1710037800 * 1_000_000
