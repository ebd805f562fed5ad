"""Declared schemas. Nothing is inferred from data: inference costs a scan and drifts."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw flood CSV header (lower-cased, stripped) -> column name.
FLOOD_RENAMES = {
    "rainfall (mm)": "rainfall_mm",
    "temperature (°c)": "temperature_c",
    "humidity (%)": "humidity_pct",
    "river discharge (m³/s)": "river_discharge",
    "water level (m)": "water_level_m",
    "elevation (m)": "elevation_m",
    "population density": "population_density",
    "historical floods": "historical_floods",
    "infrastructure": "infrastructure",
    "land cover": "land_cover",
    "soil type": "soil_type",
    "flood occurred": "flood_occurred",
}

# Flood columns by role.
FLOOD_NUMERIC = [
    "rainfall_mm",
    "temperature_c",
    "humidity_pct",
    "river_discharge",
    "water_level_m",
    "elevation_m",
    "population_density",
    "historical_floods",
    "infrastructure",
]
FLOOD_CATEGORICAL = ["land_cover", "soil_type"]
FLOOD_MODEL_FEATURES = [
    "rainfall_mm",
    "water_level_m",
    "river_discharge",
    "elevation_m",
    "historical_floods",
    "rain_water_interaction",
    "discharge_per_rain",
    "flood_risk_index",
    "extreme_event",
]
FLOOD_TARGET = "flood_occurred"

# Fire zonal variables, their statistics, and weather columns.
ZONAL_VARIABLES = ["ELEV", "SLP", "EVT", "EVH", "EVC", "CBD", "CBH", "CC", "CH"]
ZONAL_STATS = ["max", "min", "median", "sum", "mode", "count", "mean"]
FIRE_WEATHER = [
    "TEMP_ave",
    "TEMP_min",
    "TEMP_max",
    "PRCP",
    "SNOW",
    "WDIR_ave",
    "WSPD_ave",
    "PRES_ave",
    "WCOMP",
]
FIRE_MEAN_FILL = ["WDIR_ave", "WCOMP", "TEMP_ave", "TEMP_min", "TEMP_max", "WSPD_ave", "PRES_ave"]
FIRE_ZERO_FILL = ["PRCP", "SNOW"]
# Columns that the fire job drops, its target, and what is no feature.
FIRE_DROPPED = [
    "Neighbour_c_longitude",
    "acq_date",
    "acq_time",
    "Polygon_ID",
    "Neighbour",
    "CH_mean",
    "Neighbour_CH_mean",
]
FIRE_TARGET = "frp_class"
FIRE_NOT_FEATURES = ["frp", "frp_class", "Neighbour_frp"]
# Names a target column may have, best first.
TARGET_CANDIDATES = ["Fire Occurred", "fire_occurred", "target", "label", "Fire", "frp"]


def _struct(**names_by_type: list[str]) -> list[T.StructField]:
    kinds = {
        "string": T.StringType(),
        "double": T.DoubleType(),
        "integer": T.IntegerType(),
        "long": T.LongType(),
    }
    return [T.StructField(n, kinds[kind]) for kind, names in names_by_type.items() for n in names]


def flood_csv_schema() -> T.StructType:
    """Raw flood CSV, by position; header text is normalised after the read."""
    integers = {"historical_floods", "infrastructure", "flood_occurred"}
    fields = []
    for raw, name in FLOOD_RENAMES.items():
        if name in FLOOD_CATEGORICAL:
            kind = T.StringType()
        elif name in integers:
            kind = T.IntegerType()
        else:
            kind = T.DoubleType()
        fields.append(T.StructField(raw, kind))
    return T.StructType(fields)


def flood_gold_schema() -> T.StructType:
    """Model table written after feature engineering."""
    integers = {"historical_floods", "extreme_event", FLOOD_TARGET}
    return T.StructType(
        [
            T.StructField(n, T.IntegerType() if n in integers else T.DoubleType())
            for n in [*FLOOD_MODEL_FEATURES, FLOOD_TARGET]
        ]
    )


def flood_message_schema(with_place: bool = True) -> T.StructType:
    """Flood sensor message; the landing job reads it without name and coordinates."""
    place = _struct(string=["location_name"], double=["latitude", "longitude"]) if with_place else []
    return T.StructType(
        [
            *_struct(string=["location_id"]),
            *place,
            *_struct(
                double=[
                    "temperature_c",
                    "rainfall_mm",
                    "humidity_pct",
                    "river_discharge_m3s",
                    "water_level_m",
                ],
                integer=["elevation_m", "population_density", "historical_floods"],
                string=["infrastructure", "soil_type", "land_cover", "timestamp"],
            ),
        ]
    )


def zonal_columns(prefix: str = "") -> list[str]:
    """All `{V}_{stat}` names of the zonal grammar, in training order."""
    return [f"{prefix}{v}_{s}" for v in ZONAL_VARIABLES for s in ZONAL_STATS]


def fire_csv_schema() -> T.StructType:
    """Wide raw fire table. `frp` stays text: it is validated before it is cast."""
    text = {"frp", "acq_date", "Polygon_ID", "Neighbour"}
    names = [
        "Polygon_ID",
        "Neighbour",
        "acq_date",
        "acq_time",
        "frp",
        "Neighbour_frp",
        "Neighbour_acq_time",
        *zonal_columns(),
        "Shape",
        "c_latitude",
        "c_longitude",
        *zonal_columns("Neighbour_"),
        "Neighbour_Shape",
        "Neighbour_c_latitude",
        "Neighbour_c_longitude",
        *FIRE_WEATHER,
    ]
    return T.StructType(
        [
            T.StructField(
                n,
                T.StringType()
                if n in text
                else T.LongType()
                if n.endswith("_count")
                else T.DoubleType(),
            )
            for n in names
        ]
    )


def fire_message_schema() -> T.StructType:
    """Fire sensor message: two strings and 29 doubles."""
    spread = [f"{v}_{s}" for v in ("ELEV", "SLP") for s in ("max", "min", "median", "mean")]
    means = [f"{v}_mean" for v in ("EVT", "EVH", "EVC", "CBD", "CBH", "CC")]
    neighbours = [f"Neighbour_{v}_mean" for v in ("ELEV", "SLP", "EVC")]
    return T.StructType(
        [
            *_struct(string=["location_id"], double=["c_latitude", "c_longitude"]),
            *_struct(string=["timestamp"]),
            *_struct(double=[*FIRE_WEATHER, *spread, *means, "CH_median", *neighbours]),
        ]
    )


def points_long_schema() -> T.StructType:
    """Long time-series form read by the monitoring panels."""
    return T.StructType(
        [
            *_struct(
                string=["measurement", "location_id", "location_name", "alert_level", "field"],
                double=["value"],
            ),
            T.StructField("time", T.TimestampNTZType()),
        ]
    )
