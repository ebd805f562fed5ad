"""Schema work: names, projections, column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions.casts import quoted


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case and strip every column name, by position."""
    return df.toDF(*[name.lower().strip() for name in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping; absent names are ignored."""
    return df.withColumnsRenamed(mapping)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*names)


def select_ml(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Model columns followed by the target."""
    return df.select(*features, target)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns; values that do not parse become null."""
    return df.withColumns({name: quoted(name).try_cast(kind) for name, kind in types.items()})


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, by declared type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def find_target(df: DataFrame, candidates: list[str]) -> str | None:
    """First candidate that is a column."""
    return next((name for name in candidates if name in df.columns), None)


def feature_columns(df: DataFrame, exclude: list[str]) -> list[str]:
    """Columns in order, without the excluded ones."""
    left_out = set(exclude)
    return [name for name in df.columns if name not in left_out]


def align_features(df: DataFrame, names: list[str], on_missing: str = "error") -> list[str]:
    """Trained feature names that may be assembled from `df`, in trained order.

    A forest reads its vector by position, so missing or non-numeric features raise.
    `on_missing="skip"` keeps the intersection instead, for models fitted on it.
    """
    numeric = set(numeric_columns(df))
    usable = [name for name in names if name in numeric]
    missing = [name for name in names if name not in numeric]
    if missing and on_missing == "error":
        text = [name for name in missing if name in df.columns]
        raise ValueError(
            f"{len(missing)} trained features absent or not numeric: {missing[:10]}"
            + (f"; not numeric: {text}" if text else "")
        )
    return usable


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def long_form(df: DataFrame, ids: list[str], names: list[str], key: str, value: str) -> DataFrame:
    """Numeric columns as (key, value) rows."""
    wide = df.select(*[quoted(i) for i in ids], *[quoted(n).cast("double").alias(n) for n in names])
    return wide.unpivot(ids, names, key, value)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with later filters kept above this point.

    Filters are otherwise pushed below projections and repeat their expressions there, which is
    costly when those run a model.
    """
    return df.select(F.inline(F.array(F.struct(*[quoted(c) for c in df.columns]))))


def entries(row: DataFrame, names: list[str], fields: dict) -> DataFrame:
    """Turn one aggregate row into one row per column name.

    `fields` maps an output field to a function from name to Column over `row`.
    """
    items = [
        F.struct(F.lit(n).alias("column"), *[make(n).alias(f) for f, make in fields.items()])
        for n in names
    ]
    return row.select(F.explode(F.array(*items)).alias("e")).select("e.*")
