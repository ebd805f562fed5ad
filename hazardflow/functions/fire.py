"""Fire target and features over zonal statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.casts import known, to_numeric

# Variables with neighbour features, class bounds, ratio guard.
PAIRED_VARIABLES = ["ELEV", "SLP", "EVT", "EVH", "EVC", "CBD", "CBH", "CC"]
FRP_MEDIUM = 800
FRP_HIGH = 1500
RATIO_GUARD = 1e-6


def fire_target(df: DataFrame, source: str = "frp", output: str = "frp_class") -> DataFrame:
    """Class 0/1/2 by radiative power; unknown power has no class."""
    frp = known(to_numeric(source))
    label = F.when(frp < FRP_MEDIUM, 0).when(frp < FRP_HIGH, 1).when(frp >= FRP_HIGH, 2)
    return df.withColumn(output, label)


def _ratio(v: str) -> Column:
    return F.try_divide(f"{v}_mean", F.col(f"Neighbour_{v}_mean") + RATIO_GUARD)


def _diff(v: str) -> Column:
    return F.col(f"{v}_mean") - F.col(f"Neighbour_{v}_mean")


def _range(v: str) -> Column:
    return F.col(f"{v}_max") - F.col(f"{v}_min")


def fire_feature_columns(present: list[str], neighbour_sum: bool = False) -> dict[str, Column]:
    """Features whose inputs exist in `present`, in the order a model is trained on."""
    have = set(present)
    out: dict[str, Column] = {}

    def add(name: str, needs: list[str], expr) -> None:
        if have.issuperset(needs):
            out.setdefault(name, expr())

    def pair(v: str) -> list[str]:
        return [f"{v}_mean", f"Neighbour_{v}_mean"]

    def span(v: str) -> list[str]:
        return [f"{v}_max", f"{v}_min"]

    for v in ("ELEV", "SLP"):
        add(f"{v}_ratio", pair(v), lambda v=v: _ratio(v))
    for v in ("ELEV", "SLP"):
        add(f"{v}_range", span(v), lambda v=v: _range(v))
    wet = F.col("PRCP") + 1 if "PRCP" in have else None
    add(
        "fire_weather_index",
        ["TEMP_max", "WSPD_ave", "PRCP"],
        lambda: F.try_divide(F.col("TEMP_max") * F.col("WSPD_ave"), wet),
    )
    add("dryness_index", ["TEMP_ave", "PRCP"], lambda: F.try_divide("TEMP_ave", wet))
    add(
        "veg_temp_interaction",
        ["CH_median", "TEMP_max"],
        lambda: F.col("CH_median") * F.col("TEMP_max"),
    )
    add(
        "lat_lon_interaction",
        ["c_latitude", "c_longitude"],
        lambda: F.col("c_latitude") * F.col("c_longitude"),
    )
    for v in PAIRED_VARIABLES:
        add(f"{v}_diff", pair(v), lambda v=v: _diff(v))
        add(f"{v}_ratio", pair(v), lambda v=v: _ratio(v))
        if neighbour_sum:
            add(
                f"{v}_mean_sum",
                pair(v),
                lambda v=v: F.col(f"{v}_mean") + F.col(f"Neighbour_{v}_mean"),
            )
        add(f"{v}_range", span(v), lambda v=v: _range(v))
    return out


def fire_features(df: DataFrame, neighbour_sum: bool = False) -> DataFrame:
    """Add every derivable fire feature in one projection.

    `neighbour_sum` adds `{V}_mean_sum` (own + neighbour mean). The name differs from the
    zonal `{V}_sum` on purpose: the two are different quantities.
    """
    return df.withColumns(fire_feature_columns(df.columns, neighbour_sum))
