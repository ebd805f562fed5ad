"""Console reports: distributions, overviews, top-k lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class, ordered by class."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy(target)


def _percent(part, whole):
    return F.try_divide(part * F.lit(100.0), whole)


def prediction_overview(df: DataFrame) -> DataFrame:
    """Totals and shares of positive predictions; everything else counts as negative."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("prediction") == 1).alias("positive")
    )
    negative = F.col("total") - F.col("positive")
    return row.select(
        "total",
        "positive",
        negative.alias("negative"),
        _percent(F.col("positive"), F.col("total")).alias("positive_pct"),
        _percent(negative, F.col("total")).alias("negative_pct"),
    )


def alert_distribution(df: DataFrame) -> DataFrame:
    """Rows and percent per alert level, most first. Only the level counts meet in one task."""
    counts = df.groupBy("alert_level").agg(F.count(F.lit(1)).alias("n"))
    share = _percent(F.col("n"), F.sum("n").over(Window.partitionBy(F.lit(0))))
    return counts.withColumn("pct", share).orderBy(F.desc("n"), "alert_level")


def _conditions() -> list[Column]:
    return [
        F.avg("rainfall_mm").alias("avg_rainfall"),
        F.max("rainfall_mm").alias("max_rainfall"),
        F.avg("water_level_m").alias("avg_water_level"),
        F.max("water_level_m").alias("max_water_level"),
        F.avg("temperature_c").alias("avg_temperature"),
    ]


def condition_stats(df: DataFrame) -> DataFrame:
    """Average and maximum rain and level, average temperature."""
    return df.agg(*_conditions())


def console_summary(df: DataFrame) -> DataFrame:
    """Overview and condition statistics in one pass over the predictions."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("prediction") == 1).alias("positive"),
        *_conditions(),
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, rows) of each layer; Parquet answers from footers."""
    parts = [
        df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"))
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def top_risk(df: DataFrame, n: int = 10, tie: str = "reading_id") -> DataFrame:
    """The n riskiest positive predictions; `tie` makes the order total."""
    return (
        df.where(F.col("prediction") == 1)
        .orderBy(F.desc("flood_risk_index"), tie)
        .select(
            tie, "location_id", "alert_level", "flood_risk_index", "rainfall_mm", "water_level_m"
        )
        .limit(n)
    )


def latest_predictions(df: DataFrame, n: int = 10, tie: str = "reading_id") -> DataFrame:
    """The n newest predictions."""
    return (
        df.orderBy(F.desc("processing_time"), tie)
        .select(
            tie, "location_id", "prediction", "alert_level", "flood_risk_index", "processing_time"
        )
        .limit(n)
    )


def latest_alerts(alerts: DataFrame, n: int = 5, tie: str = "reading_id") -> DataFrame:
    """The n newest alerts."""
    return (
        alerts.orderBy(F.desc("processing_time"), tie)
        .select(
            tie, "location_id", "alert_level", "rainfall_mm", "water_level_m", "processing_time"
        )
        .limit(n)
    )


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """Any n rows, unordered."""
    return df.limit(n)
