"""Schema operators and file layers."""

import os

import pytest
from pyspark.sql import types as T

from hazardflow.operators import columns as C
from hazardflow.sources import files, schemas


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["  Rainfall (mm) ", " Temperature (°C) ", "Other"])
    out = C.rename(C.normalize_names(df), schemas.FLOOD_RENAMES)
    assert out.columns == ["rainfall_mm", "temperature_c", "other"]


def test_drop_select_cast(spark):
    df = spark.createDataFrame([("1.5", "x", 2)], "a string, b string, c int")
    assert C.drop_columns(df, ["b", "absent"]).columns == ["a", "c"]
    assert C.select_ml(df, ["c"], "a").columns == ["c", "a"]
    row = C.cast_columns(df, {"a": "double", "b": "double"}).first()
    assert (row.a, row.b) == (1.5, None)


def test_roles(spark):
    df = spark.createDataFrame(
        [], "i int, s smallint, y tinyint, m decimal(9,2), t string, r array<double>, frp double"
    )
    assert C.numeric_columns(df) == ["i", "s", "y", "m", "frp"]
    assert C.find_target(df, schemas.TARGET_CANDIDATES) == "frp"
    assert C.find_target(df, ["none"]) is None
    assert C.feature_columns(df, ["frp", "t"]) == ["i", "s", "y", "m", "r"]


def test_align_features(spark):
    df = spark.createDataFrame([], "a double, t string, b int")
    assert C.align_features(df, ["b", "a"]) == ["b", "a"]
    with pytest.raises(ValueError, match="not numeric"):
        C.align_features(df, ["a", "t", "gone"])
    assert C.align_features(df, ["a", "t", "gone", "b"], on_missing="skip") == ["a", "b"]


def test_schema_table(spark):
    df = spark.createDataFrame([], "a double, t string")
    assert [tuple(r) for r in C.schema_table(df).orderBy("position").collect()] == [
        (1, "a", "double"),
        (2, "t", "string"),
    ]


def test_computed_once_keeps_rows_and_stops_filters(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    out = C.computed_once(df)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    plan = out.where("a = 2")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_message_schemas():
    assert len(schemas.flood_message_schema().fields) == 16
    assert len(schemas.flood_message_schema(False).fields) == 13
    fire = schemas.fire_message_schema()
    kinds = [f.dataType for f in fire.fields]
    assert len(kinds) == 31 and kinds.count(T.DoubleType()) == 29


def test_csv_with_declared_schema(spark, tmp_path):
    path = tmp_path / "flood.csv"
    header = ",".join(f" {raw.upper()} " for raw in schemas.FLOOD_RENAMES)
    path.write_text(f"{header}\n100.5,20,50,1000,5,100,7,2,1,urban,clay,1\n,,,,,,,,,,,\n")
    raw = files.read_csv(spark, str(path), schemas.flood_csv_schema())
    out = C.rename(C.normalize_names(raw), schemas.FLOOD_RENAMES)
    full, empty = out.collect()
    assert out.columns == list(schemas.FLOOD_RENAMES.values())
    assert (full.rainfall_mm, full.historical_floods, full.soil_type) == (100.5, 2, "clay")
    assert set(empty) == {None}


def test_csv_binds_by_name(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b.c (x)", T.DoubleType())])
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("B.C (X) , A\n1.5,2\nx,3\n,oops\n")
    path = str(folder)
    assert sorted(map(tuple, files.read_csv(spark, path, schema).collect()), key=str) == [(2, 1.5), (3, None), (None, None)]
    counts = files.unparsed(files.read_csv_text(spark, path, schema), schema)
    assert sorted(map(tuple, counts.collect())) == [("a", 1), ("b.c (x)", 1)]
    assert files.read_csv(spark, path, schema).select("a").count() == 3


@pytest.mark.parametrize("header, fault", [("a", "missing: b"), ("a,b,c", "unknown: c"), ("a,b,A", "doubled: a")])
def test_csv_with_a_wrong_header_raises(spark, tmp_path, header, fault):
    path = tmp_path / "x.csv"
    path.write_text(f"{header}\n1,2,3\n")
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in "ab"])
    with pytest.raises(ValueError, match=fault):
        files.read_csv(spark, str(path), schema)


def test_csv_files_with_other_headers_raise(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n1,2\n")
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in "ab"])
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(folder), schema).collect()


def test_multiline_csv(spark, tmp_path):
    path = tmp_path / "fires.csv"
    path.write_text('id,note\n1,"two\nlines, ""quoted"""\n2,plain\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType())])
    df = files.read_csv(spark, str(path), schema, multiline=True, partitions=3)
    assert df.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, df.collect())) == [(1, 'two\nlines, "quoted"'), (2, "plain")]


def test_write_verified(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 as p")
    path = str(tmp_path / "layer")
    assert tuple(files.write_verified(df, path, ["p"]).first()) == (100, 100, True)
    assert tuple(files.write_verified(df.limit(5), path).first()) == (5, 5, True)
    assert files.read_layer(spark, path).count() == 5


def test_write_verified_raises_on_loss(spark, tmp_path, monkeypatch):
    original = files.write_layer

    def lossy(df, path, partition_by=None):
        original(df, path, partition_by)
        spark.range(1).write.mode("overwrite").parquet(path)

    monkeypatch.setattr(files, "write_layer", lossy)
    path = str(tmp_path / "layer")
    original(spark.range(4), path)
    with pytest.raises(RuntimeError, match="wrote 10 rows, read back 1"):
        files.write_verified(spark.range(10), path)
    assert spark.read.parquet(path).count() == 4


def test_write_verified_computes_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    df = spark.range(50).rdd.mapPartitions(count).toDF(["id"])
    seen.value = 0
    files.write_verified(df, str(tmp_path / "layer"))
    assert seen.value == 50


def test_export_csv(spark, tmp_path):
    df = spark.createDataFrame([(1.5, None), (0.1, 2)], "a double, b int").repartition(2)
    path = str(tmp_path / "out")
    files.export_csv(df, path, single=True)
    parts = [p for p in os.listdir(path) if p.startswith("part-")]
    assert len(parts) == 1
    back = files.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == [(0.1, 2), (1.5, None)]


def test_scratch_dir_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = files.scratch_dir(spark, "x"), files.scratch_dir(spark, "x")
    assert one.startswith(base) and one != two
