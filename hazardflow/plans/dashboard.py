"""The two monitoring views as sets of DataFrames."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from hazardflow.operators import points as P
from hazardflow.operators import reports as R


def console(predictions: DataFrame, alerts: DataFrame, tie: str) -> dict[str, DataFrame]:
    """Everything the console shows. Totals and conditions share one pass."""
    return {
        "summary": R.console_summary(predictions),
        "levels": R.alert_distribution(predictions),
        "top_risk": R.top_risk(predictions, 10, tie),
        "alerts": R.latest_alerts(alerts, 5, tie),
        "recent": R.latest_predictions(predictions, 10, tie),
    }


def panels(
    points_long: DataFrame,
    now: datetime,
    every: str = "1 minute",
    measurement: str = P.FLOOD_POINTS.measurement,
) -> dict[str, DataFrame]:
    """The six monitoring panels of a measurement at a given moment: map 1 h back, the rest 24 h."""
    hour = P.time_range(points_long, now - timedelta(hours=1), now)
    day = P.time_range(points_long, now - timedelta(hours=24), now)
    return {
        "map": P.alert_map(hour, measurement=measurement),
        "prediction_count": P.prediction_count(day, measurement=measurement),
        "mean_probability": P.mean_probability(day, measurement=measurement),
        "extreme_series": P.extreme_series(day, measurement=measurement),
        "probability_series": P.windowed_mean(day, every, measurement=measurement),
        "level_distribution": P.level_distribution(day, measurement=measurement),
    }
