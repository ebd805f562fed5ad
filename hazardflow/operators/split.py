"""Reproducible splits and standardisation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.casts import as_column, known, quoted

# The first 8 hex digits of the digest are the row's position in [0, 1).
DIGITS = 8


def digest(key: Column | str, seed: int = 42) -> Column:
    """Digest of a row's key: the same on every run, whatever the partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_column(key).cast("string")).cast("binary"))


def before(digested: Column, edge: float) -> Column:
    """Whether the position lies below `edge`, by comparing hex text: no conversion per row."""
    bound = math.ceil(edge * 16**DIGITS)
    if bound >= 16**DIGITS:
        return F.lit(True)
    return digested < F.lit(f"{bound:0{DIGITS}x}")


def split(
    df: DataFrame,
    key: str,
    weights: dict[str, float],
    seed: int = 42,
    output: str = "part",
) -> DataFrame:
    """Label every row with its part, in the given order and proportions. No shuffle."""
    total = sum(weights.values())
    place = digest(key, seed)
    names = list(weights)
    label, edge = None, 0.0
    for name in names[:-1]:
        edge += weights[name] / total
        test = before(place, edge)
        label = F.when(test, name) if label is None else label.when(test, name)
    last = F.lit(names[-1])
    return df.withColumn(output, last if label is None else label.otherwise(last))


def split_three(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """70 % train, 15 % validation, 15 % test."""
    return split(df, key, {"train": 70, "validation": 15, "test": 15}, seed)


def split_two(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """80 % train, 20 % test."""
    return split(df, key, {"train": 80, "test": 20}, seed)


def part(df: DataFrame, name: str, column: str = "part") -> DataFrame:
    """Rows of one part."""
    return df.where(F.col(column) == name).drop(column)


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation per column, from one pass."""
    aggs = []
    for i, c in enumerate(columns):
        x = known(c)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def apply_scaler(
    df: DataFrame, fitted: dict[str, tuple[float, float]], suffix: str = "_z"
) -> DataFrame:
    """Centre and scale; a constant column becomes 0."""
    new = {}
    for c, (mean, std) in fitted.items():
        x = quoted(c).cast("double")
        centred = x - F.lit(mean)
        new[c + suffix] = centred / F.lit(std) if std else centred * F.lit(0.0)
    return df.withColumns(new)


def standardize(df: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """Add standardised copies of numeric columns."""
    return apply_scaler(df, fit_scaler(df, columns), suffix)
