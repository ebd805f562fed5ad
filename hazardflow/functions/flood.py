"""Flood features. Divisions by zero give null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def interactions() -> dict[str, Column]:
    rain, level, flow = F.col("rainfall_mm"), F.col("water_level_m"), F.col("river_discharge")
    return {
        "rain_water_interaction": rain * level,
        "discharge_waterlevel": flow * level,
        "rainfall_discharge": rain * flow,
    }


def ratios() -> dict[str, Column]:
    return {
        "discharge_per_rain": F.try_divide("river_discharge", F.col("rainfall_mm") + 1),
        "elevation_water_ratio": F.try_divide("elevation_m", F.col("water_level_m") + 0.1),
        "humidity_temp_ratio": F.try_divide("humidity_pct", F.col("temperature_c") + 1),
    }


def risk() -> dict[str, Column]:
    # Fixed values: (column, scale, weight) of the composite index.
    terms = [
        ("rainfall_mm", 100, 0.3),
        ("water_level_m", 10, 0.3),
        ("river_discharge", 1000, 0.2),
        ("historical_floods", 10, 0.2),
    ]
    parts = [F.col(name) / scale * weight for name, scale, weight in terms]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return {"flood_risk_index": total}


def flags() -> dict[str, Column]:
    # Alert thresholds. All bounds are strict.
    rain, level, flow = F.col("rainfall_mm"), F.col("water_level_m"), F.col("river_discharge")
    return {
        "critical_rainfall": _flag(rain > 150),
        "critical_water": _flag(level > 8),
        "low_elevation": _flag(F.col("elevation_m") < 50),
        "high_discharge": _flag(flow > 2000),
        "extreme_event": _flag((rain > 200) | (level > 10) | (flow > 3000)),
    }


def flood_features(df: DataFrame) -> DataFrame:
    """Add all twelve flood features in one projection; streaming names are accepted."""
    df = df.withColumnRenamed("river_discharge_m3s", "river_discharge")
    return df.withColumns({**interactions(), **ratios(), **risk(), **flags()})
