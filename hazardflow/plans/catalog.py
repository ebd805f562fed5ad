"""The query catalogue: every operator over the whole test tables.

Each query takes (spark, folder) and returns a DataFrame. Its standard SQL counterpart, where
there is one, is in `oracle.py` under the same name.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions import alerts as A
from hazardflow.functions import casts, fire, flood
from hazardflow.operators import columns as C
from hazardflow.operators import evaluate as E
from hazardflow.operators import forest as M
from hazardflow.operators import points as P
from hazardflow.operators import quality as Q
from hazardflow.operators import reports as R
from hazardflow.operators import split as S
from hazardflow.operators import trees
from hazardflow.operators.joins import enrich_location
from hazardflow.operators.zonal import with_neighbours, zonal_stats
from hazardflow.plans import flood as flood_plan
from hazardflow.plans.fire import clean_fire, train_fire_job
from hazardflow.plans.views import derive, table, view
from hazardflow.sources import files, messages, schemas
from hazardflow.streaming import landing, latest, rollups, runs, scoring

# Stand-in fill of the queries that don't learn one.
RAIN_FILL = 125.0

# The range of the two queries about time ranges.
TIME_RANGE = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")

CELL_VARIABLES = {v: v.lower() for v in schemas.ZONAL_VARIABLES}


# --- shared inputs ----------------------------------------------------------------------------


def risk_scorer(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for a model: half the risk index, at most 1."""
    risk = F.col("flood_risk_index")
    df = df.withColumn("prob_flood", F.when(risk > 2, 1.0).otherwise(risk / 2))
    return df.withColumn("prediction", F.when(F.col("prob_flood") > 0.5, 1).otherwise(0))


def readings(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "readings")


def scored(spark: SparkSession, d: str) -> DataFrame:
    filled = readings(spark, d).fillna({"rainfall_mm": RAIN_FILL})
    return A.flood_alert(risk_scorer(flood.flood_features(filled)))


def long_points(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "points_long")


def zone_features(spark: SparkSession, d: str) -> DataFrame:
    """Zones with their statistics, those of the next zone, and weather."""
    spread = {v: ["max", "min", "mean"] for v in fire.PAIRED_VARIABLES}
    stats = zonal_stats(
        view(spark, d, "cells"), "zone", CELL_VARIABLES, {**spread, "CH": ["median"]}
    )
    means = [f"{v}_mean" for v in fire.PAIRED_VARIABLES]
    paired = with_neighbours(stats, "zone", means, F.col("zone") - 1)
    return paired.join(view(spark, d, "zone_weather"), "zone")


def fire_table(spark: SparkSession, d: str) -> DataFrame:
    """Wide fire table under the full zonal grammar: one row per fire, with its zone's statistics
    and those of the zone beside. Zones are computed once, stored and read back."""
    fires = view(spark, d, "fires")
    power = fires.groupBy("zone").agg(F.avg(casts.to_numeric("frp")).alias("frp"))
    stats = zonal_stats(view(spark, d, "cells"), "zone", CELL_VARIABLES)
    own = stats.join(view(spark, d, "zone_weather"), "zone").join(power, "zone", "left")
    near = [c for c in stats.columns if c != "zone"]
    near += ["Shape", "c_latitude", "acq_time", "frp"]
    path = files.scratch_dir(spark, "zones")
    files.write_layer(with_neighbours(own, "zone", near, F.col("zone") - 1).drop("frp"), path)
    zones = files.read_layer(spark, path)
    return fires.join(zones, "zone", "left").drop("zone").withColumnRenamed("fire_id", "polygon")


# --- quality ----------------------------------------------------------------------------------


def null_profile(spark, d):
    return Q.null_profile(readings(spark, d))


def null_total(spark, d):
    return Q.null_total(view(spark, d, "sparse_labels"))


def impute_median(spark, d):
    df = readings(spark, d).select("reading_id", "rainfall_mm", "population_density")
    return Q.impute(df, {"rainfall_mm": "median", "population_density": "median"})


def impute_mode(spark, d):
    df = readings(spark, d).select("reading_id", "land_cover", "soil_type")
    return Q.impute(df, {"land_cover": "mode", "soil_type": "mode"})


def impute_mean(spark, d):
    df = view(spark, d, "zone_weather").select("zone", "WDIR_ave", "PRES_ave", "TEMP_min")
    return Q.impute(df, {c: "mean" for c in ("WDIR_ave", "PRES_ave", "TEMP_min")})


def impute_constant(spark, d):
    df = view(spark, d, "zone_weather").select("zone", "PRCP", "SNOW")
    return Q.impute(df, {"PRCP": 0, "SNOW": 0})


def impute_labels(spark, d):
    """Imputation over values that are really missing."""
    return Q.impute(view(spark, d, "sparse_labels"), {"quality": "mode", "toxic": "median"})


def numeric_summary(spark, d):
    """All numeric columns: readings, and the flags and index derived from them."""
    df = readings(spark, d)
    df = Q.describe(df.withColumns({**flood.flags(), **flood.risk()}))
    return df.withColumns({"mean": F.round("mean", 7), "stddev": F.round("stddev", 6)})


def ingest_summary(spark, d):
    return Q.ingest_summary(readings(spark, d))


def cleaning_report(spark, d):
    before = view(spark, d, "dirty_frp")
    return Q.cleaning_report(before, Q.keep_numeric_text(before, "frp"))


def numeric_text_filter(spark, d):
    return Q.keep_numeric_text(view(spark, d, "dirty_frp"), "frp")


def numeric_text_report(spark, d):
    return Q.numeric_text_report(view(spark, d, "dirty_frp"), "frp")


def drop_invalid(spark, d):
    df = view(spark, d, "sparse_labels")
    return Q.drop_invalid(df, C.feature_columns(df, ["doc_id", "lang", "source"]))


def model_input(spark, d):
    df = flood.flood_features(readings(spark, d))
    names = C.align_features(df, schemas.FLOOD_MODEL_FEATURES)
    return Q.drop_invalid(df.select("reading_id", *names), names)


def clean_fire_table(spark, d):
    fires = view(spark, d, "dirty_frp").withColumnRenamed("fire_id", "zone")
    raw = fires.join(view(spark, d, "zone_weather"), "zone", "left")
    return clean_fire(raw).select("zone", "frp", *schemas.FIRE_WEATHER)


# --- columns and casts ------------------------------------------------------------------------


def normalize_names(spark, d):
    raw_of = {name: raw for raw, name in schemas.FLOOD_RENAMES.items()}
    df = readings(spark, d).drop("processing_time", "location_id")
    raw = df.toDF(*[f"  {raw_of[c].upper()} " if c in raw_of else c for c in df.columns])
    return C.drop_columns(
        C.rename(C.normalize_names(raw), schemas.FLOOD_RENAMES), ["infrastructure", "acq_date"]
    )


def safe_casts(spark, d):
    return view(spark, d, "dirty_frp").select(
        "fire_id",
        casts.safe_int("frp").alias("whole"),
        casts.safe_double("frp").alias("fraction"),
    )


def cast_frp(spark, d):
    return C.cast_columns(view(spark, d, "dirty_frp"), {"frp": "double"})


def local_to_utc(spark, d):
    df = readings(spark, d).select("reading_id", "processing_time")
    return casts.local_to_utc(df, "processing_time", "Africa/Casablanca", "utc_time")


def decode_payload(spark, d):
    fields = T.StructType(
        [
            T.StructField("a", T.StringType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("d", T.DoubleType()),
        ]
    )
    return messages.decode(view(spark, d, "payloads").select("value"), fields)


# --- features and alerts ----------------------------------------------------------------------


def _flood(columns: Callable[[], dict]) -> Callable:
    def run(spark, d):
        named = [c.alias(n) for n, c in columns().items()]
        return readings(spark, d).select("reading_id", *named)

    return run


def flood_ml_dataset(spark, d):
    return flood_plan.flood_gold(readings(spark, d))


def zonal_statistics(spark, d):
    return zonal_stats(view(spark, d, "cells"), "zone", CELL_VARIABLES)


def zonal_totals(spark, d):
    """Statistics that need no ordering: one partial aggregate."""
    stats = ["max", "min", "sum", "count", "mean"]
    return zonal_stats(view(spark, d, "cells"), "zone", {"ELEV": "elev", "CC": "cc"}, stats)


def fire_target(spark, d):
    return fire.fire_target(view(spark, d, "dirty_frp"))


def fire_features(spark, d):
    df = zone_features(spark, d)
    new = fire.fire_feature_columns(df.columns, neighbour_sum=True)
    return df.select("zone", *[F.round(c, 6).alias(n) for n, c in new.items()])


def flood_alerts(spark, d):
    df = scored(spark, d)
    return df.select(
        "reading_id",
        "prob_flood",
        "prediction",
        "alert_level",
        "alert_level_num",
        A.level_label(F.col("alert_level_num")).alias("label"),
    )


def fire_alerts(spark, d):
    classed = fire.fire_target(view(spark, d, "dirty_frp"), output="prediction")
    return A.fire_alert(classed.select("fire_id", "prediction"))


def high_alerts(spark, d):
    return A.high_alerts(scored(spark, d)).select(
        "reading_id", "location_id", "alert_level", "prob_flood"
    )


# --- points and panels ------------------------------------------------------------------------


def enriched(spark, d):
    return enrich_location(scored(spark, d), view(spark, d, "locations"))


def enrich(spark, d):
    return enriched(spark, d).select(
        "reading_id", "location_id", "latitude", "longitude", "location_name"
    )


def points_wide(spark, d):
    return P.to_points(enriched(spark, d), P.FLOOD_POINTS, keep=["reading_id"])


def fire_points(spark, d):
    df = fire_alert_zones(spark, d)
    return P.to_points(df, P.FIRE_POINTS, keep=["fire_id"])


def fire_alert_zones(spark, d):
    """Every fire with its zone's weather, its class and its level."""
    weather = view(spark, d, "zone_weather").fillna({"PRCP": 0.0})
    classed = fire.fire_target(view(spark, d, "fires"), output="prediction")
    rows = classed.select("fire_id", "zone", "prediction").join(weather, "zone", "left")
    return A.fire_alert(fire.fire_features(rows)).select(
        "*",
        F.concat(F.lit("ZONE_"), F.col("zone").cast("string")).alias("location_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("processing_time"),
    )


def both_measurements(spark, d):
    """Flood and fire points in one long table, as they are stored."""
    flood_points = P.to_points(enriched(spark, d), P.FLOOD_POINTS)
    fire_rows = P.to_points(fire_alert_zones(spark, d), P.FIRE_POINTS)
    return P.points_long(flood_points).unionByName(
        P.points_long(fire_rows, P.FIRE_POINTS), allowMissingColumns=True
    )


def measured_predictions(spark, d):
    """Predictions per series, of one measurement at a time."""
    long = both_measurements(spark, d)
    parts = [
        P.prediction_count(long, measurement=m).withColumn("measurement", F.lit(m))
        for m in (P.FLOOD_POINTS.measurement, P.FIRE_POINTS.measurement)
    ]
    return parts[0].unionByName(parts[1])


def stored_points(spark, d):
    """Points stored by date and measurement, and two days of one measurement read back."""
    root = files.scratch_dir(spark, "points")
    P.write_points(long_points(spark, d), root)
    back = P.read_points(
        spark, root, "2024-01-05 00:00:00", "2024-01-07 00:00:00", P.FLOOD_POINTS.measurement
    )
    return back.drop("date", "batch_id")


def points_long(spark, d):
    """Size and range of every long series."""
    long = P.points_long(P.to_points(enriched(spark, d), P.FLOOD_POINTS))
    return long.groupBy(*P.SERIES).agg(
        F.count("value").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.max("time").alias("last_time"),
    )


def points_dedup(spark, d):
    return P.dedup_points(
        points_wide(spark, d),
        ["measurement", "location_id", "alert_level", "location_name", "time"],
        ["reading_id"],
    )


def alert_map(spark, d):
    return P.alert_map(long_points(spark, d), measurement=P.FLOOD_POINTS.measurement)


def time_range(spark, d):
    """Points of a stretch of time."""
    return P.time_range(long_points(spark, d), *TIME_RANGE)


def alert_map_range(spark, d):
    """The map as it stood within a stretch of time."""
    return P.alert_map(time_range(spark, d), measurement=P.FLOOD_POINTS.measurement)


def latest_values(spark, d):
    return P.latest(long_points(spark, d), ["location_id", "field"])


def field_points(spark, d):
    return P.points(long_points(spark, d), "probability")


def prediction_count(spark, d):
    return P.prediction_count(long_points(spark, d))


def prediction_total(spark, d):
    return P.prediction_count(long_points(spark, d), by_series=False)


def mean_probability(spark, d):
    df = P.mean_probability(long_points(spark, d))
    return df.withColumn("mean_probability", F.round("mean_probability", 10))


def extreme_series(spark, d):
    return P.extreme_series(long_points(spark, d))


def level_distribution(spark, d):
    return P.level_distribution(long_points(spark, d))


def windowed_mean(spark, d):
    df = P.windowed_mean(long_points(spark, d), "6 hours")
    return df.withColumn("mean_value", F.round("mean_value", 10))


def series_legend(spark, d):
    df = P.series_legend(P.windowed_mean(long_points(spark, d), "6 hours"))
    return df.withColumns({c: F.round(c, 10) for c in ("mean", "max", "last")})


# --- reports ----------------------------------------------------------------------------------


def class_distribution(spark, d):
    return R.class_distribution(readings(spark, d), schemas.FLOOD_TARGET)


def target_distribution(spark, d):
    df = view(spark, d, "dirty_frp")
    target = C.find_target(df, schemas.TARGET_CANDIDATES)
    return R.class_distribution(df, target)


def prediction_overview(spark, d):
    return R.prediction_overview(scored(spark, d))


def alert_distribution(spark, d):
    return R.alert_distribution(scored(spark, d))


def condition_stats(spark, d):
    df = R.condition_stats(scored(spark, d))
    return df.select([F.round(c, 6).alias(c) for c in df.columns])


def console_summary(spark, d):
    df = R.console_summary(scored(spark, d))
    means = [c for c in df.columns if c.startswith(("avg", "max"))]
    return df.withColumns({c: F.round(c, 6) for c in means})


def layer_counts(spark, d):
    names = ["lineitem", "orders", "events", "documents", "labels"]
    return R.layer_counts({n: table(spark, d, n) for n in names})


def top_risk(spark, d):
    return R.top_risk(scored(spark, d))


def latest_predictions(spark, d):
    return R.latest_predictions(scored(spark, d))


def latest_alerts(spark, d):
    return R.latest_alerts(A.high_alerts(scored(spark, d)))


def sample_rows(spark, d):
    return R.sample(scored(spark, d).select("reading_id", "alert_level"), 10)


def sample_check(spark, d):
    """A sample: its size, and how many of its rows are not in the table."""
    df = scored(spark, d).select("reading_id", "alert_level")
    taken = R.sample(df, 10)
    strangers = taken.join(df, ["reading_id", "alert_level"], "left_anti")
    return taken.agg(F.count("*").alias("rows")).join(
        F.broadcast(strangers.agg(F.count("*").alias("strangers"))), F.lit(True)
    )


def column_listing(spark, d):
    return C.schema_table(readings(spark, d))


def flood_pipeline(spark, d):
    """Silver to report: fills learnt from the data, features, score, levels, top risks."""
    cleaned = Q.impute(readings(spark, d), flood_plan.FLOOD_FILLS)
    return R.top_risk(A.flood_alert(risk_scorer(flood.flood_features(cleaned))))


# --- split, scale, evaluate, train ------------------------------------------------------------


def split_three(spark, d):
    return S.split_three(readings(spark, d).select("reading_id"), "reading_id")


def split_two(spark, d):
    return S.split_two(readings(spark, d).select("reading_id"), "reading_id")


def standardize(spark, d):
    names = ["water_level_m", "river_discharge", "elevation_m", "historical_floods"]
    df = S.standardize(readings(spark, d).select("reading_id", *names), names)
    return df.select("reading_id", *[F.round(f"{n}_z", 6).alias(f"{n}_z") for n in names])


def confusion_matrix(spark, d):
    return E.confusion_matrix(scored(spark, d), schemas.FLOOD_TARGET)


def classification_metrics(spark, d):
    df = E.classification_metrics(scored(spark, d), schemas.FLOOD_TARGET)
    return df.select([F.round(c, 8).alias(c) for c in df.columns])


def auc(spark, d):
    return E.auc(scored(spark, d), "prob_flood", schemas.FLOOD_TARGET).select(
        F.round("auc", 8).alias("auc")
    )


def _training_partitions(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


# Trained models of this application, by kind and folder: several queries look at one model.
_TRAINED: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, kind: str, d: str, train: Callable):
    key = (spark.sparkContext.applicationId, kind, d)
    if key not in _TRAINED:
        _TRAINED[key] = train()
    return _TRAINED[key]


def _flood_run(spark, d) -> flood_plan.FloodRun:
    """The published flood forest on this folder's readings."""
    return _once(
        spark, "flood", d,
        lambda: flood_plan.train_flood_job(
            readings(spark, d), "reading_id", partitions=_training_partitions(spark)
        ),
    )


def train_flood(spark, d):
    run = _flood_run(spark, d)
    named = [
        df.select(F.lit(n).alias("part"), "*")
        for n, df in (("validation", run.validation), ("test", run.test))
    ]
    return named[0].unionByName(named[1])


def training_rows(spark, d):
    """Rows per part that the flood job stored, and those a model can use."""
    gold = _flood_run(spark, d).gold
    usable = Q.drop_invalid(gold, schemas.FLOOD_MODEL_FEATURES).groupBy("part").agg(F.count("*").alias("usable"))
    rows = gold.groupBy("part").agg(F.count("*").alias("rows"), F.sum(schemas.FLOOD_TARGET).alias("floods"))
    return rows.join(usable, "part")


def model_report(spark, d):
    return _flood_run(spark, d).report


def report_sections(spark, d):
    """What a report lists: sections and names."""
    return model_report(spark, d).select("section", "name")


def _reloaded(spark, d) -> M.Fitted:
    path = files.scratch_dir(spark, "flood-model")
    M.save_model(_flood_run(spark, d).fitted, path)
    return M.load_model(spark, path)


def score_flood_batch(spark, d):
    """Save, load, and score all readings with the loaded model."""
    filled = Q.impute(readings(spark, d), flood_plan.FLOOD_FILLS)
    gold = flood_plan.flood_gold(filled, "reading_id")
    rows = M.score(gold, _reloaded(spark, d)).withColumn("prob_flood", A.prob_of())
    return A.flood_alert(rows).select(
        "reading_id", "prediction", "prob_flood", "alert_level", "alert_level_num"
    )


def score_all_rows(spark, d):
    """Readings with holes under a model: all stay, those with a missing feature unscored; the
    loaded model must agree with the trained one, and probabilities must be such."""
    gold = flood_plan.flood_gold(readings(spark, d), "reading_id")
    p = F.when(F.col("scored"), A.prob_of())
    a = M.score_all(gold, _flood_run(spark, d).fitted).withColumn("p", p)
    b = M.score_all(gold, _reloaded(spark, d)).withColumn("p", p)
    names = ["reading_id", "p", "prediction"]
    signed = a.select(*names, "scored", F.lit(1).alias("sign")).unionByName(b.select(*names, "scored", F.lit(-1).alias("sign")))
    # Rows of one key pair off; what is left over differs between the two models. The trained model's
    # rows are counted on the way, so that it scores them once.
    ours = F.col("sign") == 1
    met = signed.groupBy(*names).agg(
        F.abs(F.sum("sign")).alias("d"), F.count_if(ours).alias("n"), F.count_if(ours & F.col("scored")).alias("s")
    )
    odd = F.col("p").isNotNull() & ~F.col("p").between(0, 1)

    def total(n):
        return F.coalesce(F.sum(n), F.lit(0))

    return met.agg(
        total("n").alias("rows"),
        total("s").alias("scored"),
        total(F.when(F.col("prediction").isNull(), F.col("n"))).alias("unscored"),
        total(F.when(odd, F.col("n"))).alias("no_probability"),
        F.sum("d").alias("changed_by_reload"),
    )


def _fire_run(spark, d):
    """The published fire forest on this folder's fires."""

    def train():
        gold = fire.fire_features(fire.fire_target(clean_fire(fire_table(spark, d))))
        path = files.scratch_dir(spark, "fire-gold")
        files.write_layer(gold, path)
        stored = files.read_layer(spark, path)
        return (*train_fire_job(stored, "polygon", partitions=_training_partitions(spark)), stored)

    return _once(spark, "fire", d, train)


def train_fire(spark, d):
    return _fire_run(spark, d)[1]


def fire_training_rows(spark, d):
    """Fires with a usable power, by class: what the fire job trains and tests on."""
    return _fire_run(spark, d)[2].groupBy(schemas.FIRE_TARGET).agg(F.count("*").alias("fires"))


def importance(spark, d):
    return M.importance(_fire_run(spark, d)[0], spark, top=10)


def importance_total(spark, d):
    """Importances of the flood model: its features, each once, adding up to 1."""
    ranked = M.importance(_flood_run(spark, d).fitted, spark)
    total = ranked.agg(F.round(F.sum("importance"), 6).alias("total"))
    return ranked.select("feature").join(F.broadcast(total), F.lit(True))


def _saved_nodes(spark, fitted: M.Fitted) -> DataFrame:
    path = files.scratch_dir(spark, "nodes")
    M.save_model(fitted, path)
    return trees.node_table(spark, path)


def _replayed(spark, rows: DataFrame, key: str, fitted: M.Fitted) -> DataFrame:
    """How many of a model's rows its saved nodes score otherwise; near ties may fall either way."""
    scored_rows = M.score(rows, fitted).select(key, "features", F.col("prediction"), vector_to_array("probability").alias("p"))
    both = trees.replay(scored_rows, key, _saved_nodes(spark, fitted), fitted.params["maxDepth"], keep=("prediction", "p"))
    apart = F.aggregate(F.zip_with("p", "probability", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, d: a + d)
    top = F.sort_array("p", asc=False)
    tied = top[0] - top[1] < 1e-9
    same = (apart < 1e-9) & ((F.col("prediction") == F.col("predicted")) | tied)
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("differ"))


def replay_flood(spark, d):
    """The flood forest from its saved nodes, over all rows it was held out from."""
    run = _flood_run(spark, d)
    held_out = run.gold.where("part != 'train'")
    return _replayed(spark, held_out.withColumn("row", F.monotonically_increasing_id()).transform(_stored), "row", run.fitted)


def replay_fire(spark, d):
    """The fire forest from its saved nodes, over all fires it can score."""
    fitted, _, stored = _fire_run(spark, d)
    rows = stored.select("polygon", *fitted.features).withColumnRenamed("polygon", "row")
    return _replayed(spark, rows, "row", fitted).select((F.col("rows") > 0).alias("scored"), "differ")


def _stored(df: DataFrame) -> DataFrame:
    path = files.scratch_dir(df.sparkSession, "rows")
    files.write_layer(df, path)
    return files.read_layer(df.sparkSession, path)


def importance_ranks(spark, d):
    """Ranks of the flood features by the model, and by its saved nodes: where they differ."""
    run = _flood_run(spark, d)
    ours = trees.node_importance(_saved_nodes(spark, run.fitted), run.fitted.features)
    both = M.importance(run.fitted, spark).alias("m").join(ours.alias("n"), F.col("m.feature") == F.col("n.feature"))
    far = F.abs(F.col("m.importance") - F.col("n.importance")) > 1e-9
    return both.agg(
        F.count("*").alias("features"), F.countDistinct("m.rank").alias("ranks"),
        F.count_if(far | ((F.col("m.rank") != F.col("n.rank")) & (F.col("m.importance") > 0))).alias("differ"),
    )


# --- files ------------------------------------------------------------------------------------


def layer_round_trip(spark, d):
    path = files.scratch_dir(spark, "readings")
    files.write_verified(readings(spark, d), path)
    return files.read_layer(spark, path)


def gold_csv(spark, d):
    path = files.scratch_dir(spark, "gold")
    files.export_csv(flood_plan.flood_gold(readings(spark, d)), path)
    return files.read_csv(spark, path, schemas.flood_gold_schema())


def csv_by_name(spark, d):
    """Columns in another order, with other case and blanks around the names."""
    path = files.scratch_dir(spark, "shuffled")
    gold = flood_plan.flood_gold(readings(spark, d))
    names = sorted(gold.columns, reverse=True)
    shuffled = gold.select(*names).toDF(*[f" {n.upper()} " for n in names])
    files.export_csv(shuffled, path)
    return files.read_csv(spark, path, schemas.flood_gold_schema())


def csv_unparsed(spark, d):
    """Values that hold text but no number."""
    path = files.scratch_dir(spark, "dirty")
    files.export_csv(view(spark, d, "dirty_frp").select("frp", "fire_id"), path)
    wanted = T.StructType([T.StructField("fire_id", T.LongType()), T.StructField("frp", T.DoubleType())])
    return files.unparsed(files.read_csv_text(spark, path, wanted), wanted)


def multiline_csv(spark, d):
    """Texts with line breaks and quotes through a multi-line CSV."""
    path = files.scratch_dir(spark, "documents")
    texts = table(spark, d, "documents").select("doc_id", "text")
    writer = texts.write.option("header", True).option("escape", '"').option("quoteAll", True)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**keep).csv(path)
    fields = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    )
    back = files.read_csv(spark, path, fields, multiline=True)
    return back.select("doc_id", F.length("text").alias("n"), F.md5("text").alias("digest"))


# --- streaming --------------------------------------------------------------------------------


def table_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A base table, one file or a folder of them, as a stream of files."""
    schema = table(spark, d, name).schema
    # The pattern matches just this name; a plain path would have to be a folder.
    path = f"{d}/{name}[.]parquet"
    return messages.message_stream(spark, "parquet", {"path": path}, schema=schema)


def flood_messages(spark: SparkSession, d: str) -> DataFrame:
    """Readings as JSON sensor messages, streaming."""
    rows = derive(spark, "readings", {"lineitem": table_stream(spark, d, "lineitem")})
    body = F.struct(
        "location_id",
        "temperature_c",
        "rainfall_mm",
        "humidity_pct",
        F.col("river_discharge").alias("river_discharge_m3s"),
        "water_level_m",
        F.col("elevation_m").cast("int").alias("elevation_m"),
        F.col("population_density").cast("int").alias("population_density"),
        "historical_floods",
        F.col("infrastructure").cast("string").alias("infrastructure"),
        "soil_type",
        "land_cover",
        F.col("reading_id").alias("timestamp"),
    )
    return rows.select(F.to_json(body).cast("binary").alias("value"))


def fire_messages(spark: SparkSession, d: str) -> DataFrame:
    """Zone weather as JSON sensor messages, streaming."""
    rows = derive(spark, "zone_weather", {"part": table_stream(spark, d, "part")})
    body = F.struct(
        F.concat(F.lit("ZONE_"), F.col("zone").cast("string")).alias("location_id"),
        F.lit("0").alias("timestamp"),
        "c_latitude",
        "c_longitude",
        *schemas.FIRE_WEATHER,
        F.col("Shape").alias("CH_median"),
    )
    return rows.select(F.to_json(body).alias("value"))


def fire_risk_scorer(df: DataFrame) -> DataFrame:
    """Deterministic stand-in for the fire model."""
    index = F.col("fire_weather_index")
    return df.withColumn(
        "prediction", F.when(index >= 100, 2.0).when(index >= 20, 1.0).otherwise(0.0)
    )


def _drain(query) -> None:
    query.awaitTermination()
    if (failure := query.exception()) is not None:
        raise failure


def land_stream(spark, d):
    root = files.scratch_dir(spark, "landing")
    rows = messages.decode(flood_messages(spark, d), schemas.flood_message_schema(False))
    _drain(landing.land_stream(rows, f"{root}/data", f"{root}/checkpoint"))
    return files.read_layer(spark, f"{root}/data")


def _flood_stream(spark, d, root: str) -> None:
    rows = scoring.score_flood_stream(
        flood_messages(spark, d), risk_scorer, {"rainfall_mm": RAIN_FILL}
    )
    shape = scoring.flood_points_shape(view(spark, d, "locations"), keep=["timestamp"])
    # A test message is its own event, so its number is part of the identity here.
    keys = [*P.identity(P.FLOOD_POINTS), "timestamp"]
    sink = scoring.parquet_sink(f"{root}/points", f"{root}/alerts", shape, keys)
    _drain(scoring.run_scoring(rows, sink, f"{root}/checkpoint", every=None))


def score_flood_stream(spark, d):
    root = files.scratch_dir(spark, "flood-stream")
    _flood_stream(spark, d, root)
    return files.read_layer(spark, f"{root}/points").drop("time", "batch_id", "date")


def points_identity_stream(spark, d):
    """The job's own sink: one point per series and stamp, and all of a batch have one stamp."""
    root = files.scratch_dir(spark, "flood-identity")
    rows = scoring.score_flood_stream(
        flood_messages(spark, d), risk_scorer, {"rainfall_mm": RAIN_FILL}
    )
    sink = scoring.flood_sink(f"{root}/points", None, view(spark, d, "locations"))
    _drain(scoring.run_scoring(rows, sink, f"{root}/checkpoint", every=None))
    return files.read_layer(spark, f"{root}/points").groupBy(
        "location_id", "alert_level", "location_name"
    ).agg(F.count(F.lit(1)).alias("points"), F.countDistinct("time", "batch_id").alias("stamps"))


LANDING_PARTS = 4


# Messages of a file at most; a part has more files when it has more rows.
ROWS_PER_FILE = 250_000


def _files_per_part(spark, d) -> int:
    """Files for each part of the readings, by the rows that the files' footers tell."""
    return max(1, math.ceil(view(spark, d, "readings").count() / (LANDING_PARTS * ROWS_PER_FILE)))


def _reading_files(spark, d, root: str, parts: range, files_each: int) -> None:
    """Readings as message files, `files_each` files for each part of the order keys."""
    rows = view(spark, d, "readings").select(
        "reading_id", (F.conv(F.substring(F.md5(F.col("reading_id").cast("binary")), 1, 4), 16, 10).cast("int") % LANDING_PARTS).alias("part")
    )
    body = F.to_json(F.struct(F.col("reading_id").alias("timestamp"), "part")).alias("value")
    for n in parts:
        _write_files(rows.where(F.col("part") == n).select(body), f"{root}/in", files_each)


def _write_files(df: DataFrame, path: str, number: int) -> None:
    """Append exactly so many files, all tasks writing. A writer leaves out a file without rows, but
    a rate limit counts files, so empty ones make up the number."""
    out = f"{path}/{uuid.uuid4().hex}"
    df.repartition(number).write.parquet(out)
    for _ in range(number - len(df.sparkSession.read.parquet(out).inputFiles())):
        df.limit(0).coalesce(1).write.mode("append").parquet(out)


def _landed(spark, root: str, query_rows: DataFrame) -> None:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    _drain(scoring.run_scoring(query_rows, write, f"{root}/checkpoint", every=None))


def _limited_stream(spark, root: str, limit: int) -> DataFrame:
    value = T.StructType([T.StructField("value", T.StringType())])
    raw = messages.message_stream(spark, "parquet", {"path": f"{root}/in/*"}, limit, value)
    fields = T.StructType([T.StructField("timestamp", T.StringType()), T.StructField("part", T.IntegerType())])
    return messages.decode(raw, fields, stamp=True)


def rate_limited_stream(spark, d):
    """The files of one part per trigger: each part is a batch of its own, under one processing time."""
    root = files.scratch_dir(spark, "limited")
    each = _files_per_part(spark, d)
    _reading_files(spark, d, root, range(LANDING_PARTS), each)
    _landed(spark, root, _limited_stream(spark, root, each))
    return files.read_layer(spark, f"{root}/out").groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("batch_id").alias("batches"),
        F.countDistinct("processing_time").alias("stamps"),
    )


def triggered_stream(spark, d):
    """Parts of the readings, one per trigger of a stream that starts a batch every two seconds:
    rows that came, batches with rows, and batches that began before their time, by
    the query's own progress."""
    root = files.scratch_dir(spark, "triggered")
    each = _files_per_part(spark, d)
    _reading_files(spark, d, root, range(LANDING_PARTS), each)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={batch_id}")

    query = scoring.run_scoring(_limited_stream(spark, root, each), write, f"{root}/checkpoint", every="2 seconds")
    try:
        query.processAllAvailable()
        seen = [(p["timestamp"], p["batchId"]) for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    began = spark.createDataFrame(seen, "began string, batch bigint").select(F.unix_millis(F.col("began").cast("timestamp")).alias("began"))
    # the clock is cut into stretches of two seconds, and in each at most one batch begins
    timing = began.agg((F.count("*") - F.countDistinct(F.floor(F.col("began") / 2000))).alias("early"))
    counted = files.read_layer(spark, f"{root}/out").agg(F.count("*").alias("rows"), F.countDistinct("batch_id").alias("batches"))
    return counted.join(F.broadcast(timing), F.lit(True))


def restarted_stream(spark, d):
    """Half of the files, a stop, the other half, and a start from the same progress."""
    root = files.scratch_dir(spark, "restarted")
    each = _files_per_part(spark, d)
    for parts in (range(LANDING_PARTS // 2), range(LANDING_PARTS // 2, LANDING_PARTS)):
        _reading_files(spark, d, root, parts, each)
        _landed(spark, root, _limited_stream(spark, root, 2 * each))
    return files.read_layer(spark, f"{root}/out").select(F.col("timestamp").alias("reading_id"), "part")


def alerts_stream(spark, d):
    root = files.scratch_dir(spark, "flood-alerts")
    rows = scoring.score_flood_stream(
        flood_messages(spark, d), risk_scorer, {"rainfall_mm": RAIN_FILL}
    )
    _drain(scoring.alerts_stream(rows, f"{root}/alerts", f"{root}/checkpoint", every=None))
    return files.read_layer(spark, f"{root}/alerts").select(
        F.col("timestamp").alias("reading_id"), "location_id", "alert_level", "prob_flood"
    )


def alerts_once_stream(spark, d):
    """Messages that carry their own time, each sent twice and all of them again after a restart: one
    alert for each location and time."""
    root = files.scratch_dir(spark, "alerts-once")
    rows = readings(spark, d)
    sent = F.to_json(F.struct(
        *[c for c in rows.columns if c not in ("reading_id", "processing_time", "flood_occurred", "river_discharge", "infrastructure")],
        F.col("river_discharge").alias("river_discharge_m3s"),
        F.date_format("processing_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    )).alias("value")
    twice = rows.select(sent).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    for _ in range(2):
        # as many files as tasks; without a rate limit all new ones are one batch
        twice.write.mode("append").parquet(f"{root}/in")
        messages_in = messages.message_stream(spark, "parquet", {"path": f"{root}/in"}, schema=twice.schema)
        scored_rows = scoring.score_flood_stream(messages_in, risk_scorer, {"rainfall_mm": RAIN_FILL})
        _drain(scoring.alerts_once_stream(scored_rows, f"{root}/out", f"{root}/checkpoint", every=None))
    return files.read_layer(spark, f"{root}/out").groupBy("location_id", F.col("timestamp").alias("event")).agg(
        F.count("*").alias("alerts")
    )


def score_fire_stream(spark, d):
    root = files.scratch_dir(spark, "fire-stream")
    rows = scoring.score_fire_stream(fire_messages(spark, d), fire_risk_scorer)
    sink = scoring.fire_sink(f"{root}/points")
    _drain(scoring.run_scoring(rows, sink, f"{root}/checkpoint", every=None))
    return files.read_layer(spark, f"{root}/points").drop("time", "batch_id", "date")


def windowed_mean_stream(spark, d):
    root = files.scratch_dir(spark, "windows")
    long = derive(spark, "points_long", {"events": table_stream(spark, d, "events")})
    means = landing.windowed_mean_stream(long, "1 day", "1 hour")
    _drain(landing.upsert_parquet(means, f"{root}/data", f"{root}/checkpoint"))
    done = landing.newest(
        files.read_layer(spark, f"{root}/data"), ["location_id", "location_name", "time"]
    )
    return done.withColumn("mean_value", F.round("mean_value", 10))


BATCHES = 3


def points_compacted(spark, d):
    """Points that come in three batches, an identity in up to all of them: the last replaces the
    others. The first two batches are compacted, the third is merged when read."""
    digest = F.conv(F.substring(F.md5(F.col("reading_id").cast("binary")), 1, 4), 16, 10)
    arriving = points_wide(spark, d).withColumns({"year": F.year("time"), "batch": digest.cast("int") % BATCHES})
    store = runs.RunStore(
        spark, files.scratch_dir(spark, "runs"), ["year", *P.identity(P.FLOOD_POINTS)], ["year", "measurement"],
        runs.newest_wins(["reading_id"]),
    )
    store.write_batch(arriving, "batch")
    store.compact(BATCHES - 2)
    store.expire(BATCHES - 2)
    return store.read().drop("year")


def _point_files(spark, d, root: str, parts: range) -> None:
    """Long points as files, a few points of every day in each."""
    long = long_points(spark, d)
    part = F.crc32(F.concat_ws("|", "location_id", F.col("time").cast("string")).cast("binary")) % LANDING_PARTS
    for n in parts:
        long.where(part == n).coalesce(1).write.mode("append").parquet(f"{root}/in")


def windowed_mean_rollup(spark, d):
    """Six-hour means from hourly partials of a stream, stopped and compacted half way; in each
    batch come points of all days, so most of them are late."""
    root = files.scratch_dir(spark, "rollups")
    store = rollups.rollup_store(spark, f"{root}/store")
    for parts in (range(LANDING_PARTS // 2), range(LANDING_PARTS // 2, LANDING_PARTS)):
        _point_files(spark, d, root, parts)
        points = messages.message_stream(
            spark, "parquet", {"path": f"{root}/in"}, LANDING_PARTS // 2, long_points(spark, d).schema
        )
        _drain(scoring.run_scoring(points, rollups.rollup_sink(store), f"{root}/checkpoint", every=None))
        store.compact(parts.stop // 2 - 1, least=1)
    means = rollups.windowed(store, "6 hours", measurement=P.FLOOD_POINTS.measurement)
    return means.select("location_id", "location_name", "time", F.round("mean_value", 10).alias("mean_value"))


MAP_SPLIT = "2024-01-15 00:00:00"


def alert_map_stream(spark, d):
    """The alert map of a stream that stops and starts again half way; locations without a point in
    the last day (and the hour that points may be late) are not on it."""
    root = files.scratch_dir(spark, "map")
    long = long_points(spark, d)
    for half in (F.col("time") < MAP_SPLIT, F.col("time") >= MAP_SPLIT):
        long.where(half).coalesce(1).write.mode("append").parquet(f"{root}/in")
        points = messages.message_stream(spark, "parquet", {"path": f"{root}/in"}, schema=long.schema)
        changes = latest.alert_map_stream(points, "1 day", "1 hour", P.FLOOD_POINTS.measurement)
        _drain(landing.upsert_parquet(changes, f"{root}/out", f"{root}/checkpoint"))
    return latest.map_now(files.read_layer(spark, f"{root}/out"), ["location_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flood_pipeline": flood_pipeline,
    "null_profile": null_profile,
    "null_total": null_total,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "impute_mean": impute_mean,
    "impute_constant": impute_constant,
    "impute_labels": impute_labels,
    "numeric_summary": numeric_summary,
    "ingest_summary": ingest_summary,
    "cleaning_report": cleaning_report,
    "numeric_text_filter": numeric_text_filter,
    "numeric_text_report": numeric_text_report,
    "drop_invalid": drop_invalid,
    "model_input": model_input,
    "clean_fire": clean_fire_table,
    "normalize_names": normalize_names,
    "safe_casts": safe_casts,
    "cast_frp": cast_frp,
    "local_to_utc": local_to_utc,
    "decode_payload": decode_payload,
    "flood_interactions": _flood(flood.interactions),
    "flood_ratios": _flood(flood.ratios),
    "flood_risk": _flood(flood.risk),
    "flood_flags": _flood(flood.flags),
    "flood_ml_dataset": flood_ml_dataset,
    "zonal_stats": zonal_statistics,
    "zonal_totals": zonal_totals,
    "fire_target": fire_target,
    "fire_features": fire_features,
    "flood_alerts": flood_alerts,
    "fire_alerts": fire_alerts,
    "high_alerts": high_alerts,
    "enrich_location": enrich,
    "points": points_wide,
    "fire_points": fire_points,
    "measured_predictions": measured_predictions,
    "stored_points": stored_points,
    "points_long": points_long,
    "points_dedup": points_dedup,
    "alert_map": alert_map,
    "time_range": time_range,
    "alert_map_range": alert_map_range,
    "latest_values": latest_values,
    "field_points": field_points,
    "prediction_count": prediction_count,
    "prediction_total": prediction_total,
    "mean_probability": mean_probability,
    "extreme_series": extreme_series,
    "level_distribution": level_distribution,
    "windowed_mean": windowed_mean,
    "series_legend": series_legend,
    "class_distribution": class_distribution,
    "target_distribution": target_distribution,
    "prediction_overview": prediction_overview,
    "alert_distribution": alert_distribution,
    "condition_stats": condition_stats,
    "console_summary": console_summary,
    "layer_counts": layer_counts,
    "top_risk": top_risk,
    "latest_predictions": latest_predictions,
    "latest_alerts": latest_alerts,
    "sample_rows": sample_rows,
    "sample_check": sample_check,
    "column_listing": column_listing,
    "split_three": split_three,
    "split_two": split_two,
    "standardize": standardize,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": classification_metrics,
    "auc": auc,
    "train_flood": train_flood,
    "training_rows": training_rows,
    "model_report": model_report,
    "report_sections": report_sections,
    "score_flood_batch": score_flood_batch,
    "score_all_rows": score_all_rows,
    "train_fire": train_fire,
    "fire_training_rows": fire_training_rows,
    "importance": importance,
    "importance_total": importance_total,
    "replay_flood": replay_flood,
    "replay_fire": replay_fire,
    "importance_ranks": importance_ranks,
    "layer_round_trip": layer_round_trip,
    "gold_csv": gold_csv,
    "csv_by_name": csv_by_name,
    "csv_unparsed": csv_unparsed,
    "multiline_csv": multiline_csv,
    "land_stream": land_stream,
    "score_flood_stream": score_flood_stream,
    "points_identity_stream": points_identity_stream,
    "rate_limited_stream": rate_limited_stream,
    "triggered_stream": triggered_stream,
    "restarted_stream": restarted_stream,
    "alerts_stream": alerts_stream,
    "alerts_once_stream": alerts_once_stream,
    "score_fire_stream": score_fire_stream,
    "windowed_mean_stream": windowed_mean_stream,
    "alert_map_stream": alert_map_stream,
    "points_compacted": points_compacted,
    "windowed_mean_rollup": windowed_mean_rollup,
}
