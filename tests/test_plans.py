"""Whole jobs, and the plans Spark makes of the queries."""

import csv
import random


from hazardflow.operators.columns import feature_columns
from hazardflow.plans import catalog, fire, flood
from hazardflow.plans.views import view
from hazardflow.sources import schemas
from hazardflow.sources.files import read_csv, read_layer
from tests.conftest import SF_DIR


def test_flood_layers(spark, tmp_path):
    rng = random.Random(1)
    path = tmp_path / "flood.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow([f" {h.title()} " for h in schemas.FLOOD_RENAMES])
        for i in range(300):
            numbers = [round(rng.uniform(1, 100), 2) for _ in range(7)]
            if i % 10 == 0:
                numbers[0] = ""
            out.writerow([*numbers, i % 5, i % 3, rng.choice(["urban", "forest", ""]), "clay", i % 2])
    paths = flood.flood_layers(spark, str(path), str(tmp_path))
    bronze = read_layer(spark, paths["ingested"])
    silver = read_layer(spark, paths["cleaned"])
    gold = read_csv(spark, paths["gold_csv"], schemas.flood_gold_schema())
    assert bronze.count() == silver.count() == gold.count() == 300
    assert "rainfall (mm)" in bronze.columns and "rainfall_mm" in silver.columns
    assert bronze.where("`rainfall (mm)` is null").count() == 30
    assert silver.where("rainfall_mm is null or land_cover is null").count() == 0
    assert gold.columns == [*schemas.FLOOD_MODEL_FEATURES, "flood_occurred"]
    assert gold.dropna().count() == 300


def test_fire_layers(spark, tmp_path):
    rng = random.Random(2)
    path = tmp_path / "fires.csv"
    schema = schemas.fire_csv_schema()
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(schema.names)
        for i in range(60):
            row = []
            for name in schema.names:
                if name == "frp":
                    row.append(rng.choice(["700", "900.5", "2000", "n/a", ""]))
                elif name == "Polygon_ID":
                    row.append(f"two\nlines {i}")
                elif name in ("PRCP", "TEMP_ave") and i % 7 == 0:
                    row.append("")
                elif name.endswith("_count"):
                    row.append(rng.randrange(1, 50))
                elif name in ("Neighbour", "acq_date"):
                    row.append('say ""x""')
                else:
                    row.append(round(rng.uniform(1, 100), 3))
            out.writerow(row)
    paths = fire.fire_layers(spark, str(path), str(tmp_path), partitions=4)
    bronze = read_layer(spark, paths["ingested"])
    silver = read_layer(spark, paths["cleaned"])
    gold = read_layer(spark, paths["features"])
    usable = bronze.where("frp rlike '^[0-9.]+$'").count()
    assert bronze.count() == 60 and 0 < silver.count() == usable < 60
    assert not set(schemas.FIRE_DROPPED) & set(silver.columns)
    assert silver.where("PRCP is null or TEMP_ave is null").count() == 0
    assert len(feature_columns(gold, schemas.FIRE_NOT_FEATURES)) == 167
    assert {r[0] for r in gold.select("frp_class").distinct().collect()} <= {0, 1, 2}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "predictions")
    catalog.scored(spark, SF_DIR).write.parquet(path)
    stored = read_layer(spark, path)
    plan = executed(catalog.R.top_risk(stored))
    assert "EqualTo(prediction,1)" in plan
    assert "humidity_pct" not in plan
    plan = executed(catalog.A.high_alerts(stored).select("reading_id"))
    assert "In(alert_level, [CRITICAL,HIGH])" in plan


def test_points_stored_by_field_are_pruned(spark, tmp_path):
    path = str(tmp_path / "points")
    view(spark, SF_DIR, "points_long").write.partitionBy("field").parquet(path)
    plan = executed(catalog.P.mean_probability(read_layer(spark, path)))
    assert "PartitionFilters: [isnotnull(field" in plan or "PartitionFilters: [field" in plan


def test_feature_plans_do_not_shuffle(spark):
    for name in ("flood_risk", "flood_flags", "flood_ml_dataset", "split_three", "safe_casts"):
        assert "Exchange" not in executed(catalog.QUERIES[name](spark, SF_DIR)), name


def test_lookup_of_a_small_dimension_moves_no_facts(spark):
    plan = executed(catalog.enrich(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan
    # The only shuffles are those that bring the dimension to one row per key.
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert moved and not any("reading_id" in line for line in moved)
    facts = plan[: plan.index("BroadcastExchange")]
    assert "SortMergeJoin" not in facts and "Exchange hashpartitioning" not in facts


def test_jobs_read_their_tables_few_times(spark):
    """Medians take at most three reads, and a training job's fills no more."""
    import json

    from hazardflow.operators.quality import impute
    from hazardflow.plans.views import view

    reads = spark.sparkContext.accumulator(0)
    plain = view(spark, SF_DIR, "readings").select("rainfall_mm", "population_density")
    total = plain.count()

    def count(rows):
        for r in rows:
            reads.add(1)
            yield r

    counted = spark.createDataFrame(plain.rdd.mapPartitions(count), plain.schema)
    impute(counted, {"rainfall_mm": "median", "population_density": "median"})
    assert reads.value <= 3 * total, json.dumps([reads.value, total])


def test_profile_is_one_scan(spark):
    plan = executed(catalog.null_profile(spark, SF_DIR))
    assert plan.count("FileScan") == 1


def test_no_python_in_the_plans(spark):
    skip = ("train", "model", "importance", "stream", "score", "csv", "round_trip")
    for name, query in catalog.QUERIES.items():
        if any(s in name for s in skip):
            continue
        plan = executed(query(spark, SF_DIR))
        assert "Python" not in plan and "CartesianProduct" not in plan, name

