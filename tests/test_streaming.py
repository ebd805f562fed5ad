"""Streams give what the batch functions give; restarts lose and repeat nothing."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.operators import points as P
from hazardflow.operators.forest import train_forest
from hazardflow.plans import catalog
from hazardflow.plans.catalog import fire_risk_scorer, risk_scorer
from hazardflow.plans.views import view
from hazardflow.sources import messages, schemas
from hazardflow.streaming import landing, scoring
from tests.conftest import SF_DIR

SMALL = T.StructType(
    [
        T.StructField("a", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("d", T.DoubleType()),
    ]
)


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"a":"x","n":3,"d":1}', ("x", 3, 1.0)),
        ('{"a":"x","n":3.5,"d":1}', ("x", None, 1.0)),
        ('{"a":"x","n":3,"d":"oops"}', ("x", 3, None)),
        ('{"a":"y","extra":1}', ("y", None, None)),
        ("not json", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_decode(spark, text, want):
    df = spark.createDataFrame([(text,)], "value string")
    assert tuple(messages.decode(df, SMALL).first()) == want
    binary = df.select(F.col("value").cast("binary").alias("value"))
    assert tuple(messages.decode(binary, SMALL).first()) == want


def test_decode_parses_once_under_a_filter(spark):
    df = spark.createDataFrame([('{"a":"x","n":3}',)], "value string")
    out = messages.decode(df, SMALL).where("n = 3 and a = 'x'")
    assert out._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def message(i, **more):
    body = {
        "location_id": f"LOC_{i % 3}",
        "temperature_c": 20.0,
        "rainfall_mm": float(i * 10 % 250),
        "humidity_pct": 50.0,
        "river_discharge_m3s": float(i * 100 % 5000),
        "water_level_m": float(i % 15),
        "elevation_m": i,
        "historical_floods": i % 16,
        "timestamp": f"m{i:04d}",
    }
    return json.dumps({**body, **more})


@pytest.fixture
def inbox(spark, tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def deliver(name, texts):
        (folder / name).write_text("\n".join(texts) + "\n")

    def stream(limit=None):
        return messages.message_stream(spark, "text", {"path": str(folder)}, limit)

    def batch():
        return spark.read.text(str(folder))

    deliver.stream, deliver.batch, deliver.root = stream, batch, str(tmp_path)
    return deliver


def dim(spark):
    return spark.createDataFrame(
        [("LOC_0", 1.0, 2.0, "Zero"), ("LOC_1", 3.0, 4.0, "One")],
        "location_id string, lat double, lon double, name string",
    )


def flood_run(spark, inbox, every=None, limit=None):
    rows = scoring.score_flood_stream(inbox.stream(limit), risk_scorer)
    shape = scoring.flood_points_shape(dim(spark), keep=["timestamp"])
    sink = scoring.parquet_sink(f"{inbox.root}/points", f"{inbox.root}/alerts", shape)
    query = scoring.run_scoring(rows, sink, f"{inbox.root}/checkpoint", every)
    query.awaitTermination()
    return query


def test_stream_equals_batch_across_a_restart(spark, inbox, rows):
    inbox("a.json", [message(i) for i in range(40)])
    flood_run(spark, inbox)
    inbox("b.json", [message(i) for i in range(40, 90)] + ["broken"])
    flood_run(spark, inbox)
    got = spark.read.parquet(f"{inbox.root}/points").drop("time", "batch_id", "date")
    want = scoring.flood_points_shape(dim(spark), keep=["timestamp"])(
        scoring.score_flood_stream(inbox.batch(), risk_scorer)
    ).drop("time")
    assert got.count() == 91
    assert rows(got.select(want.columns)) == rows(want)
    alerts = spark.read.parquet(f"{inbox.root}/alerts")
    assert alerts.count() == want.where("alert_level_num >= 3").count() > 0


def test_processing_time_is_constant_within_a_batch(spark, inbox):
    inbox("a.json", [message(i) for i in range(10)])
    inbox("b.json", [message(i) for i in range(10)])
    flood_run(spark, inbox, limit=1)
    per_batch = (
        spark.read.parquet(f"{inbox.root}/points")
        .groupBy("batch_id")
        .agg(F.countDistinct("time").alias("times"), F.count(F.lit(1)).alias("n"))
        .collect()
    )
    # The rate limit of one file per trigger makes two batches.
    assert [(r.times, r.n) for r in per_batch] == [(1, 10), (1, 10)]


def test_retried_batch_replaces_itself(spark, inbox):
    sink = scoring.parquet_sink(f"{inbox.root}/p", None, lambda df: df)
    for size, batch in ((5, 7), (3, 7), (2, 8)):
        points = spark.range(5).selectExpr(
            "id", "'m' as measurement", "timestamp_ntz'2024-01-01 00:00:00' as time"
        )
        sink(points.where(f"id < {size}"), batch)
    assert spark.read.parquet(f"{inbox.root}/p").count() == 5


def test_the_job_stores_one_point_per_identity(spark, inbox):
    inbox("a.json", [message(i) for i in range(40)])
    rows = scoring.score_flood_stream(inbox.stream(), risk_scorer)
    sink = scoring.flood_sink(f"{inbox.root}/points", None, dim(spark))
    scoring.run_scoring(rows, sink, f"{inbox.root}/checkpoint", None).awaitTermination()
    points = spark.read.parquet(f"{inbox.root}/points")
    keys = P.identity(P.FLOOD_POINTS)
    assert points.count() == points.select(*keys).distinct().count() < 40


def test_failing_sink_fails_the_query_and_commits_nothing(spark, inbox):
    inbox("a.json", [message(i) for i in range(5)])
    rows = scoring.score_flood_stream(inbox.stream(), risk_scorer)

    def broken(batch, batch_id):
        raise RuntimeError("store is down")

    with pytest.raises(StreamingQueryException, match="store is down"):
        scoring.run_scoring(rows, broken, f"{inbox.root}/checkpoint", None).awaitTermination()
    flood_run(spark, inbox)
    assert spark.read.parquet(f"{inbox.root}/points").count() == 5


def test_interval_trigger_and_required_checkpoint(spark, inbox):
    inbox("a.json", [message(1)])
    rows = scoring.score_flood_stream(inbox.stream(), risk_scorer)
    with pytest.raises(ValueError, match="checkpoint"):
        scoring.run_scoring(rows, print, "")
    seen = []
    query = scoring.run_scoring(
        rows, lambda df, i: seen.append(df.count()), f"{inbox.root}/c", "1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert seen == [1]


def test_landing_and_alert_table(spark, inbox, rows):
    inbox("a.json", [message(i) for i in range(60)])
    schema = schemas.flood_message_schema(False)
    landed = messages.decode(inbox.stream(), schema)
    landing.land_stream(landed, f"{inbox.root}/l", f"{inbox.root}/lc").awaitTermination()
    assert rows(spark.read.parquet(f"{inbox.root}/l")) == rows(
        messages.decode(inbox.batch(), schema)
    )
    scored = scoring.score_flood_stream(inbox.stream(), risk_scorer)
    scoring.alerts_stream(scored, f"{inbox.root}/a", f"{inbox.root}/ac", None).awaitTermination()
    levels = {r.alert_level for r in spark.read.parquet(f"{inbox.root}/a").collect()}
    assert levels and levels <= {"CRITICAL", "HIGH"}


def fire_message(i):
    names = [f.name for f in schemas.fire_message_schema() if f.dataType == T.DoubleType()]
    return json.dumps(
        {"location_id": f"Z{i}", "timestamp": "12", **{n: float(i + k) for k, n in enumerate(names)}}
    )


def test_fire_stream_with_a_model(spark, inbox):
    inbox("a.json", [fire_message(i) for i in range(30)])
    features = ["Neighbour_acq_time", "TEMP_max", "fire_weather_index", "ELEV_mean_sum"]
    train = scoring.score_fire_stream(inbox.batch(), fire_risk_scorer).withColumn(
        "frp_class", F.col("prediction")
    )
    fitted = train_forest(train.drop("prediction"), features, "frp_class", {"numTrees": 3, "seed": 1})
    rows = scoring.score_fire_stream(inbox.stream(), scoring.model_scorer(fitted, two_class=False))
    sink = scoring.parquet_sink(f"{inbox.root}/f", None, scoring.fire_points_shape())
    scoring.run_scoring(rows, sink, f"{inbox.root}/fc", None).awaitTermination()
    points = spark.read.parquet(f"{inbox.root}/f")
    assert points.count() == 30 and set(P.FIRE_POINTS.fields) < set(points.columns)


def test_model_with_absent_features_fails_at_start(spark, inbox):
    inbox("a.json", [fire_message(1)])
    train = scoring.score_fire_stream(inbox.batch(), fire_risk_scorer)
    wide = train.select("TEMP_max", "prediction").withColumn("ELEV_sum", F.lit(1.0))
    fitted = train_forest(
        wide.withColumnRenamed("prediction", "y"), ["TEMP_max", "ELEV_sum"], "y", {"numTrees": 2}
    )
    with pytest.raises(ValueError, match="ELEV_sum"):
        scoring.score_fire_stream(inbox.stream(), scoring.model_scorer(fitted, two_class=False))


def test_filtered_alerts_run_the_model_once(spark, inbox):
    inbox("a.json", [fire_message(i) for i in range(20)])
    train = scoring.score_fire_stream(inbox.batch(), fire_risk_scorer)
    fitted = train_forest(
        train.select("TEMP_max", F.col("prediction").alias("y")), ["TEMP_max"], "y", {"numTrees": 2}
    )
    rows = scoring.score_fire_stream(
        inbox.batch(), scoring.model_scorer(fitted, two_class=False)
    ).where("alert_level = 'HIGH'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.index("Filter") < plan.index("Generate")


def test_rows_with_a_missing_feature_stay(spark, inbox):
    inbox("a.json", [fire_message(i) for i in range(20)])
    train = scoring.score_fire_stream(inbox.batch(), fire_risk_scorer)
    fitted = train_forest(
        train.select("TEMP_max", F.col("prediction").alias("y")), ["TEMP_max"], "y", {"numTrees": 2}
    )
    broken = [json.dumps({k: v for k, v in json.loads(fire_message(i)).items() if k != "TEMP_max"}) for i in range(5)]
    inbox("b.json", broken)
    rows = scoring.score_fire_stream(inbox.batch(), scoring.model_scorer(fitted, two_class=False))
    assert tuple(scoring.unscored(rows).first()) == (25, 5)
    assert rows.where("prediction is null and not scored").count() == 5
    assert scoring.fire_points_shape()(rows).count() == 25


def test_windowed_mean_stream_gives_every_window(spark, tmp_path):
    schema = schemas.points_long_schema()
    data = [
        ("m", f"L{i % 2}", "S", "LOW", "probability", i / 100, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00")
        for i in range(200)
    ]
    df = spark.createDataFrame(
        data,
        "measurement string, location_id string, location_name string, alert_level string,"
        " field string, value double, t string",
    ).withColumn("time", F.col("t").cast("timestamp_ntz"))
    df.drop("t").repartitionByRange(4, "time").write.parquet(str(tmp_path / "in"))
    stream = messages.message_stream(
        spark, "parquet", {"path": str(tmp_path / "in")}, 1, schema=schema
    )
    # Files come in any order here, so nothing may count as late.
    means = landing.windowed_mean_stream(stream, "1 hour", "1 day")
    landing.upsert_parquet(means, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()

    def table(frame):
        return {(r.location_id, r.time): round(r.mean_value, 9) for r in frame.collect()}

    done = landing.newest(
        spark.read.parquet(str(tmp_path / "o")), ["location_id", "location_name", "time"]
    )
    # 200 minutes: three hours are closed, the fourth is still open.
    assert table(done) == table(P.windowed_mean(df, "1 hour"))
    assert done.count() == 8


def test_kafka_options(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **given):
            seen.update(given)
            return self

        def load(self):
            return self

    class Session:
        readStream = Reader()

    messages.message_stream(Session(), options={"subscribe": "t", "startingOffsets": "earliest"}, rate_limit=10)
    assert seen == {
        "format": "kafka", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10",
    }


def test_exactly_so_many_files_are_written(spark, tmp_path):
    rows = spark.range(40).select(F.col("id").cast("string").alias("value"))
    for number, n in ((4, 40), (3, 1), (2, 0)):
        path = f"{tmp_path}/{number}"
        catalog._write_files(rows.limit(n), path, number)
        written = spark.read.parquet(f"{path}/*")
        assert len(written.inputFiles()) == number and written.count() == n


def test_parts_of_several_files_are_a_batch_each(spark, monkeypatch):
    monkeypatch.setattr(catalog, "ROWS_PER_FILE", 700)
    total = view(spark, SF_DIR, "readings").count()
    assert catalog._files_per_part(spark, SF_DIR) == -(-total // 2800) > 1
    limited = catalog.rate_limited_stream(spark, SF_DIR).collect()
    assert sorted((r["part"], r["batches"], r["stamps"]) for r in limited) == [(n, 1, 1) for n in range(4)]
    assert sum(r["rows"] for r in limited) == total
    assert tuple(catalog.triggered_stream(spark, SF_DIR).first()) == (total, 4, 0)
    assert catalog.restarted_stream(spark, SF_DIR).count() == total


def test_points_of_one_day_are_shuffled_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(
        [(k, f"2024-01-0{d} 0{k % 3}:00:00", float(k)) for d in (1, 2) for k in range(30)], "k int, at string, v double"
    ).selectExpr("'m' as measurement", "k % 7 as k", "cast(at as timestamp_ntz) as time", "v", "'LOW' as alert_level", "1 as alert_level_num")
    seen = []
    write = scoring.write_points
    monkeypatch.setattr(scoring, "write_points", lambda df, root, n, as_dealt: seen.append(as_dealt) or write(df, root, n, as_dealt))
    one = rows.where("date(time) = '2024-01-01'")
    lost = one.withColumn("time", F.when(F.col("k") > 0, F.col("time")))
    for n, (batch, dealt) in enumerate([(one, True), (rows, False), (lost, False), (one.limit(0), True)]):
        sink = scoring.parquet_sink(f"{tmp_path}/p{n}", f"{tmp_path}/a{n}", lambda b: b, ["k", "time"])
        sink(batch, 0)
        assert seen.pop() is dealt
        if batch.count():
            stored = spark.read.parquet(f"{tmp_path}/p{n}")
            want = batch.groupBy("k", "time").agg(F.max("v").alias("v"))
            assert sorted(map(str, stored.select("k", "time", "v").collect())) == sorted(map(str, want.collect()))
