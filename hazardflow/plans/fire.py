"""Fire batch job: raw CSV to bronze, silver, gold, and a trained model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardflow.functions.fire import fire_features, fire_target
from hazardflow.operators.columns import drop_columns, feature_columns
from hazardflow.operators.forest import Fitted, evaluate, score, train_fire
from hazardflow.operators.quality import impute, keep_numeric_text
from hazardflow.operators.split import part, split_two
from hazardflow.sources.files import read_csv, read_layer, write_verified
from hazardflow.sources.schemas import (
    FIRE_DROPPED,
    FIRE_MEAN_FILL,
    FIRE_NOT_FEATURES,
    FIRE_TARGET,
    FIRE_ZERO_FILL,
    fire_csv_schema,
)

FIRE_FILLS = {**{c: 0 for c in FIRE_ZERO_FILL}, **{c: "mean" for c in FIRE_MEAN_FILL}}


def clean_fire(df: DataFrame) -> DataFrame:
    """Drop unused columns, fill weather, keep rows with a usable radiative power."""
    return keep_numeric_text(impute(drop_columns(df, FIRE_DROPPED), FIRE_FILLS), "frp")


def fire_gold(df: DataFrame) -> DataFrame:
    """Target and every derivable feature."""
    return fire_features(fire_target(df))


def train_fire_job(
    gold: DataFrame,
    key: str,
    params: dict | None = None,
    seed: int = 42,
    partitions: int | None = None,
) -> tuple[Fitted, DataFrame]:
    """Split 80/20 by row key, train on all feature columns, evaluate on the rest."""
    parts = split_two(gold, key, seed)
    features = feature_columns(gold, [*FIRE_NOT_FEATURES, key])
    fitted = train_fire(part(parts, "train"), features, params, partitions)
    return fitted, evaluate(score(part(parts, "test"), fitted), FIRE_TARGET)


def fire_layers(
    spark: SparkSession, raw_csv: str, root: str, partitions: int | None = None
) -> dict[str, str]:
    """Run ingest, clean and feature stages; each reads the layer before it."""
    paths = {n: f"{root}/fires_{n}" for n in ("ingested", "cleaned", "features")}
    raw = read_csv(spark, raw_csv, fire_csv_schema(), multiline=True, partitions=partitions)
    write_verified(raw, paths["ingested"])
    write_verified(clean_fire(read_layer(spark, paths["ingested"])), paths["cleaned"])
    write_verified(fire_gold(read_layer(spark, paths["cleaned"])), paths["features"])
    return paths
