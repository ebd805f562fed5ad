"""Missing values, imputation and validity filters."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hazardflow.operators import quality as Q

NAN = float("nan")
MIXED = "i int, d double, s string"
MIXED_ROWS = [(1, 1.0, "a"), (2, NAN, None), (None, None, None), (4, 8.0, None)]


def test_null_profile(spark):
    got = [tuple(r) for r in Q.null_profile(spark.createDataFrame(MIXED_ROWS, MIXED)).collect()]
    assert got == [("s", 3, 75.0), ("d", 2, 50.0), ("i", 1, 25.0)]


def test_null_profile_of_awkward_names_and_full_tables(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, "x")], "`Rain (mm).x` double, `b c` string")
    assert [tuple(r) for r in Q.null_profile(df).collect()] == [
        ("Rain (mm).x", 1, 50.0),
        ("b c", 1, 50.0),
    ]
    assert Q.null_profile(spark.createDataFrame([(1,)], "a int")).count() == 0


def test_null_total_and_ingest_summary(spark):
    df = spark.createDataFrame(MIXED_ROWS, MIXED)
    assert Q.null_total(df).first()[0] == 6
    assert tuple(Q.ingest_summary(df).first()) == (4, 3, 2, 3)


def test_constant_fill(spark, rows):
    df = spark.createDataFrame([(None, 1.0), (3, NAN), (4, None)], "i int, d double")
    assert rows(Q.impute(df, {"i": 2.7, "d": 5.0})) == [(2, 1.0), (3, 5.0), (4, 5.0)]


def test_median_fill_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (8.0,)], "d double")
    assert sorted(r[0] for r in Q.impute(df, {"d": "median"}).collect()) == [1.0, 1.0, 1.0, 8.0]


def test_columns_without_values_stay_and_are_reported(spark):
    df = spark.createDataFrame([(None, None)], "d double, s string")
    fills = Q.fit_imputer(df, {"d": "median", "s": "mode", "absent": "mean"})
    assert fills.values == {} and sorted(fills.unfilled) == ["d", "s"]
    assert tuple(Q.apply_imputer(df, fills).first()) == (None, None)


@pytest.mark.parametrize(
    "values, want",
    [(["a", None, None, None], "a"), (["b", "a", "b", "a", None], "a"), (["b", "b", "a"], "b")],
)
def test_mode_fill(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert Q.fit_imputer(df, {"s": "mode"}).values == {"s": want}


def test_mode_keeps_the_column_type(spark):
    df = spark.createDataFrame([(3, True), (3, None), (4, True)], "i int, b boolean")
    assert Q.fit_imputer(df, {"i": "mode", "b": "mode"}).values == {"i": 3, "b": True}


def test_mean_fill_ignores_nan(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (3.0,)], "d double")
    assert sorted(r[0] for r in Q.impute(df, {"d": "mean"}).collect()) == [1.0, 2.0, 3.0]


def test_imputation_is_complete_and_idempotent(spark, rows):
    rng = random.Random(5)
    data = [
        (rng.choice([None, NAN, rng.random()]), rng.choice([None, "x", "y"])) for _ in range(500)
    ]
    df = spark.createDataFrame(data, "d double, s string")
    once = Q.impute(df, {"d": "median", "s": "mode"})
    assert Q.null_total(once).first()[0] == 0
    assert rows(Q.impute(once, {"d": "median", "s": "mode"})) == rows(once)


def test_fit_on_one_part_apply_to_another(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "d double")
    test = spark.createDataFrame([(100.0,), (None,)], "d double")
    fills = Q.fit_imputer(train, {"d": "mean"})
    assert sorted(r[0] for r in Q.apply_imputer(test, fills).collect()) == [2.0, 100.0]


def test_approximate_median_is_close(spark):
    df = spark.range(10001).selectExpr("cast(id as double) as d")
    got = Q.fit_imputer(df, {"d": "median"}, relative_error=0.01).values["d"]
    assert abs(got - 5000) <= 110


def test_numeric_text(spark, rows):
    texts = ["12", "12.5", "12.", " 12", "1e3", "-1", "abc", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "frp string")
    assert rows(Q.keep_numeric_text(df, "frp")) == [(12.0,), (12.5,)]
    assert tuple(Q.numeric_text_report(df, "frp").first()) == (9, 2, 7)


def test_numeric_text_refuses_numbers(spark):
    with pytest.raises(TypeError):
        Q.keep_numeric_text(spark.createDataFrame([(1.0,)], "frp double"), "frp")


def test_drop_invalid(spark, rows):
    df = spark.createDataFrame([(1.0, 1), (NAN, 1), (2.0, None), (None, 3)], "a double, b int")
    assert rows(Q.drop_invalid(df, ["a", "b"])) == [(1.0, 1)]


def test_cleaning_report(spark):
    before = spark.createDataFrame([("1",), ("x",), (None,)], "frp string")
    after = Q.keep_numeric_text(before, "frp")
    got = {r.stage: tuple(r)[1:] for r in Q.cleaning_report(before, after).collect()}
    assert got == {"before": (3, 1, 1), "after": (1, 1, 0), "removed": (2, 0, 1)}


def test_describe(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "a int, s string")
    row = Q.describe(df).collect()
    assert [tuple(r) for r in row] == [("a", 3, 2.0, 1.0, 1.0, 3.0)]
    assert not math.isnan(row[0]["stddev"])


def test_describe_covers_every_numeric_column(spark):
    df = spark.range(3).select(*[F.col("id").alias(f"c{i}") for i in range(14)])
    assert Q.describe(df).count() == 14


def test_fills_work_on_dotted_names_and_large_numbers(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, 1.0), (big, None), (None, 3.0)], "`a.b` long, `x y.z` double")
    got = Q.impute(df, {"a.b": "median", "x y.z": "mean"})
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(big, 1.0), (big, 2.0), (big, 3.0)]
    filled = Q.impute(df, {"a.b": "mode", "x y.z": 7}).collect()
    assert sorted(map(tuple, filled)) == [(big, 1.0), (big, 3.0), (big, 7.0)]


def test_drop_invalid_without_features(spark):
    assert Q.drop_invalid(spark.range(3), []).count() == 3


def test_modes_by_leaders_equal_counts(spark):
    """Ties, near ties, one frequent value among distinct ones, all distinct, and none at all."""
    n = 4000
    data = [
        (f"id{i}", "often" if i % 3 == 0 else f"x{i}", "b" if i % 2 else "a", i % 5, i % 2 == 0, float(i % 900), None)
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "id string, rare string, tie string, num int, flag boolean, many double, none string").repartition(6)
    for tracked in (8, 64, 768):
        got = Q.column_modes(df, df.columns, tracked)
        assert got == {"id": "id0", "rare": "often", "tie": "a", "num": 0, "flag": False, "many": 0.0}, tracked


def test_one_frequent_value_ships_no_distinct_values(spark, monkeypatch):
    df = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("c"))
    monkeypatch.setattr(Q, "_counted_modes", lambda *_: pytest.fail("values were counted"))
    assert Q.column_modes(df, ["c"]) == {"c": "same"}
