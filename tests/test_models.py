"""Splits, scaling, metrics, forests and the console."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hazardflow.functions.alerts import prob_of
from hazardflow.operators import evaluate as E
from hazardflow.operators import forest as M
from hazardflow.operators import reports as R
from hazardflow.operators import split as S
from hazardflow.plans import dashboard
from hazardflow.plans.catalog import scored
from hazardflow.plans.flood import train_flood_job
from hazardflow.plans.views import view
from tests.conftest import SF_DIR


def test_split_is_disjoint_complete_and_stable(spark, rows):
    df = spark.range(5000).select(F.concat(F.lit("row-"), "id").alias("key"))
    parts = S.split_three(df, "key")
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(sizes.values()) == 5000
    assert abs(sizes["train"] - 3500) < 150 and abs(sizes["test"] - 750) < 100
    again = S.split_three(df.repartition(13).orderBy(F.rand()), "key")
    assert rows(parts) == rows(again)
    assert rows(parts) != rows(S.split_three(df, "key", seed=7))
    assert S.part(parts, "train").count() == sizes["train"]


def test_split_two_edges(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("key"))
    assert {r.part for r in S.split(df, "key", {"all": 1.0}).collect()} == {"all"}
    assert {r.part for r in S.split(df, "key", {"a": 1, "b": 0}).collect()} == {"a"}


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, 5)], "x double, k int")
    got = S.standardize(df, ["x", "k"]).orderBy("x").collect()
    assert [r.x_z for r in got] == [-1.0, 0.0, 1.0] and {r.k_z for r in got} == {0.0}


@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(2)
    data = []
    for _ in range(800):
        label = r.choice([0, 0, 1, 2])
        guess = label if r.random() < 0.7 else r.choice([0, 1])
        data.append((float(label), float(guess)))
    return spark.createDataFrame(data, "label double, prediction double")


def test_metrics_equal_the_library(judged):
    got = E.classification_metrics(judged).first()
    names = {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "weighted_f1": "f1",
    }
    for ours, theirs in names.items():
        want = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="prediction", metricName=theirs
        ).evaluate(judged)
        assert got[ours] == pytest.approx(want, abs=1e-12)
    assert got.weighted_recall == pytest.approx(got.accuracy)


def test_metrics_without_a_hit(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0)], "label double, prediction double")
    assert set(E.classification_metrics(df).first()) == {0.0}


def test_confusion_matrix_covers_all_rows(judged):
    assert E.confusion_matrix(judged).agg(F.sum("n")).first()[0] == 800


def test_auc_agrees_with_the_library(spark):
    r = random.Random(4)
    data = [(r.random(), int(r.random() < 0.4)) for _ in range(500)]
    df = spark.createDataFrame(
        [(Vectors.dense([1 - s, s]), s, y) for s, y in data], ["rawPrediction", "s", "y"]
    )
    want = BinaryClassificationEvaluator(labelCol="y").evaluate(df)
    assert E.auc(df, "s", "y").first()[0] == pytest.approx(want, abs=1e-3)


def test_train_flood_job(spark, tmp_path):
    data = view(spark, SF_DIR, "readings")
    run = train_flood_job(data, "reading_id", {"numTrees": 5, "maxDepth": 5})
    measured = {r.metric: r.value for r in run.test.collect()}
    assert measured["accuracy"] > 0.9 and measured["auc"] > 0.9
    assert run.fills.values["rainfall_mm"] == 125.0
    sections = {r.section for r in run.report.collect()}
    assert sections == {"parameter", "feature", "importance", "metric:validation", "metric:test"}
    ranked = M.importance(run.fitted, spark).collect()
    assert [r["rank"] for r in ranked] == list(range(1, 10))
    assert sum(r.importance for r in ranked) == pytest.approx(1.0)

    # The saved model scores as the fitted one does.
    M.save_model(run.fitted, str(tmp_path / "model"))
    M.write_report(run.report, str(tmp_path / "report"))
    loaded = M.load_model(spark, str(tmp_path / "model"))
    assert loaded.features == run.fitted.features and loaded.target == "flood_occurred"
    sample = spark.createDataFrame(
        [(100.0, 5.0, 1000.0, 50.0, 2, 500.0, 9.9, 0.69, 0)],
        "rainfall_mm double, water_level_m double, river_discharge double, elevation_m double,"
        " historical_floods int, rain_water_interaction double, discharge_per_rain double,"
        " flood_risk_index double, extreme_event int",
    )
    one, two = (M.score(sample, m).select(prob_of()).first()[0] for m in (run.fitted, loaded))
    assert one == two


def test_assembler_skips_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    assert M.assembler(["x"]).transform(df).count() == 1


def test_console(spark):
    df = scored(spark, SF_DIR)
    shown = dashboard.console(df, df.where("alert_level_num >= 3"), "reading_id")
    total = df.count()
    assert shown["summary"].first().total == total
    levels = shown["levels"].collect()
    assert sum(r.n for r in levels) == total
    assert [r.n for r in levels] == sorted((r.n for r in levels), reverse=True)
    risks = [r.flood_risk_index for r in shown["top_risk"].collect()]
    assert len(risks) == 10 and risks == sorted(risks, reverse=True)
    assert shown["alerts"].count() == 5 and shown["recent"].count() == 10


def test_top_k_needs_no_full_sort(spark):
    plan = R.top_risk(scored(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_overview_of_nothing(spark):
    empty = spark.createDataFrame([], "prediction int")
    assert tuple(R.prediction_overview(empty).first()) == (0, 0, 0, None, None)


def test_all_parts_at_once_equal_each_apart(spark):
    r = random.Random(12)
    rows = []
    for part in ("validation", "test", "one class", None):
        for _ in range(400):
            label = 1 if part == "one class" else r.choice([0, 1, 1, None])
            rows.append((part, label, float(r.choice([0, 1])), r.choice([None, round(r.random(), 2), r.random()])))
    df = spark.createDataFrame(rows, "part string, y int, prediction double, p double").repartition(5)
    got = {}
    for row in E.evaluate_parts(df, "y", "p", rows_per_range=60).collect():
        got.setdefault(row["part"], {})[row["metric"]] = row["value"]
    for part in ("validation", "test", "one class"):
        own = df.where(F.col("part") == part)
        want = E.classification_metrics(own, "y").first().asDict() | {"auc": E.auc(own, "p", "y").first()["auc"]}
        assert got[part].keys() == want.keys()
        for name, value in want.items():
            assert got[part][name] == (value if value is None else pytest.approx(value, abs=1e-12)), (part, name)
    assert set(got) == {"validation", "test", "one class", None}
    assert E.evaluate_parts(df, "y").where("metric = 'auc'").count() == 0
