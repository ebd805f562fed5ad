"""Missing values, imputation, filters on validity, and summaries. One pass each."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions.casts import known, quoted
from hazardflow.operators.columns import entries, numeric_columns
from hazardflow.operators.order import exact_quantiles
from hazardflow.operators.selection import TRACKED, frequent, highest, leaders, settled

# Fixed value: text accepted as a number, unsigned, without exponent.
NUMERIC_TEXT = r"^[0-9]+(\.[0-9]+)?$"


def _fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN where the type can hold one."""
    c = quoted(name)
    return c.isNull() | F.isnan(c) if _fractional(df, name) else c.isNull()


def _missing_counts(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.count_if(is_missing(df, n)).alias(f"m{i}") for i, n in enumerate(names)]


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls, pct) of the columns with missing values, most first."""
    names = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("rows"), *_missing_counts(df, names))
    index = {n: i for i, n in enumerate(names)}
    counted = entries(
        row,
        names,
        {
            "nulls": lambda n: F.col(f"m{index[n]}"),
            "pct": lambda n: F.col(f"m{index[n]}") * F.lit(100.0) / F.col("rows"),
        },
    )
    return counted.where("nulls > 0").orderBy(F.desc("nulls"), "column")


def null_total(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values over all columns, as `null_total`."""
    names = columns or df.columns
    row = df.agg(*_missing_counts(df, names))
    total = sum((F.col(f"m{i}") for i in range(1, len(names))), F.col("m0"))
    return row.select(total.alias("null_total"))


def _null_columns(names: list[str]) -> Column:
    hits = [F.when(F.col(f"m{i}") > 0, 1).otherwise(0) for i in range(len(names))]
    return sum(hits[1:], hits[0])


def ingest_summary(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric columns, columns with missing values."""
    names = df.columns
    row = df.agg(F.count(F.lit(1)).alias("rows"), *_missing_counts(df, names))
    return row.select(
        "rows",
        F.lit(len(names)).alias("columns"),
        F.lit(len(numeric_columns(df))).alias("numeric_columns"),
        _null_columns(names).alias("null_columns"),
    )


def cleaning_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(stage, rows, columns, null_columns) before, after, and the amounts removed."""

    def side(df: DataFrame, stage: str) -> DataFrame:
        s = ingest_summary(df)
        return s.select(
            F.lit(stage).alias("stage"),
            "rows",
            F.col("columns").cast("bigint"),
            F.col("null_columns").cast("bigint"),
        )

    both = side(before, "before").unionByName(side(after, "after"))
    sign = F.when(F.col("stage") == "before", 1).otherwise(-1)
    removed = both.agg(
        F.lit("removed").alias("stage"),
        *[F.sum(F.col(c) * sign).alias(c) for c in ("rows", "columns", "null_columns")],
    )
    return both.unionByName(removed)


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n, mean, stddev, min, max) of the numeric columns, typed, from one pass."""
    names = columns if columns is not None else numeric_columns(df)
    aggs = []
    for i, n in enumerate(names):
        c = quoted(n).cast("double")
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"mean{i}"),
            F.stddev_samp(c).alias(f"sd{i}"),
            F.min(c).alias(f"min{i}"),
            F.max(c).alias(f"max{i}"),
        ]
    index = {n: i for i, n in enumerate(names)}
    parts = {"n": "n", "mean": "mean", "stddev": "sd", "min": "min", "max": "max"}
    return entries(
        df.agg(*aggs),
        names,
        {out: lambda n, p=p: F.col(f"{p}{index[n]}") for out, p in parts.items()},
    )


# --- imputation -------------------------------------------------------------------------------


LEARNT = ("median", "mode", "mean")


@dataclass
class Fills:
    """Fitted fill values, and the columns for which the data offered none."""

    values: dict[str, object] = field(default_factory=dict)
    unfilled: list[str] = field(default_factory=list)


def fit_imputer(
    df: DataFrame,
    strategies: dict[str, object],
    relative_error: float = 0.0,
    skip_whole: bool = False,
) -> Fills:
    """Learn fill values: "median", "mode", "mean" or a constant per column.

    Null and NaN never take part. Means and approximate medians share one pass, modes another;
    exact medians (`relative_error=0`) narrow a bracket over a few passes, in the column's own
    type. Only fitted scalars reach the driver. Fit on the training part to keep test rows out of
    the statistics. `skip_whole` leaves out medians of columns without missing values, for use on
    the fitted table itself.
    """
    present = {c: s for c, s in strategies.items() if c in df.columns}
    pick = {k: [c for c, s in present.items() if s == k] for k in LEARNT}
    constants = {c: s for c, s in present.items() if c not in sum(pick.values(), [])}
    found: dict[str, object] = dict(constants)

    aggs = [F.avg(known(c)).alias(f"mean{i}")
            for i, c in enumerate(pick["mean"])]
    if relative_error > 0:
        accuracy = max(1, round(1 / relative_error))
        aggs += [
            F.percentile_approx(known(c), 0.5, accuracy).alias(f"med{i}")
            for i, c in enumerate(pick["median"])
        ]
    if aggs:
        row = df.agg(*aggs).first()
        found.update({c: row[f"mean{i}"] for i, c in enumerate(pick["mean"])})
        if relative_error > 0:
            found.update({c: row[f"med{i}"] for i, c in enumerate(pick["median"])})
    if relative_error == 0:
        found.update(exact_quantiles(df, pick["median"], skip_whole=skip_whole))
    found.update(column_modes(df, pick["mode"]))

    values = {c: found[c] for c in present if found.get(c) is not None}
    return Fills(values, [c for c in present if c not in values])


def column_modes(df: DataFrame, columns: list[str], tracked: int = TRACKED) -> dict[str, object]:
    """Most frequent non-missing value per column, ties to the smallest text.

    One pass keeps a bounded table of frequent values per column. It settles columns of few values
    and those with one value well ahead. For near ties a second pass counts the leaders; a column
    without any frequent value is counted in full, the only case in which its values are shuffled.
    """
    if not columns:
        return {}
    plain = {c: f"c{i}" for i, c in enumerate(columns)}
    texts = df.select(
        *[F.when(~is_missing(df, c), quoted(c)).cast("string").alias(n) for c, n in plain.items()]
    )
    tables = texts.agg(
        *[F.count(n).alias(f"n_{n}") for n in plain.values()],
        *[frequent(n, tracked).alias(f"t_{n}") for n in plain.values()],
    )
    tables = tables.select("*", *[highest(F.col(f"t_{n}")).alias(f"b_{n}") for n in plain.values()])
    steps = []
    for n in plain.values():
        rows = F.col(f"n_{n}")
        near = leaders(F.col(f"t_{n}"), F.col(f"b_{n}"), rows, tracked)
        mode = settled(near, rows, tracked)
        steps.append(F.struct(rows.alias("rows"), mode.alias("mode"), F.when(mode.isNull(), near).alias("near")).alias(n))
    found = tables.select(*steps).first()
    modes = {c: found[n]["mode"] for c, n in plain.items() if found[n]["mode"] is not None}
    open_columns = {c: n for c, n in plain.items() if c not in modes and found[n]["rows"]}
    if open_columns:
        modes.update(_counted_modes(texts, {c: (n, found[n]["near"]) for c, n in open_columns.items()}))
    return {c: _of_type(modes[c], df.schema[c].dataType) for c in columns if c in modes}


def _counted_modes(texts: DataFrame, columns: dict[str, tuple[str, list[str] | None]]) -> dict[str, str]:
    """Modes by counts: of the given values, or of all where none are given; one pass."""

    def item(c: str, n: str, near: list[str] | None) -> Column:
        value = F.col(n) if near is None else F.when(F.col(n).isin(near), F.col(n))
        return F.struct(F.lit(c).alias("column"), value.alias("value"))

    items = F.array(*[item(c, n, near) for c, (n, near) in columns.items()])
    counted = (
        texts.select(F.explode(items).alias("e"))
        .where("e.value is not null")
        .groupBy("e.column", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The largest count first, then the smallest text: two bounded aggregates, no sort.
    best = counted.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("value")
    )
    return {row["column"]: row["value"] for row in best.collect()}


def _of_type(text: str, kind: T.DataType) -> object:
    if isinstance(kind, T.IntegralType):
        return int(text)
    if isinstance(kind, T.NumericType):
        return float(text)
    return text == "true" if isinstance(kind, T.BooleanType) else text


def apply_imputer(df: DataFrame, fills: Fills) -> DataFrame:
    """Replace null and NaN by the fitted values, cast to each column's type. Any column name
    works, dots included."""

    def filled(name: str) -> Column:
        if name not in fills.values:
            return quoted(name)
        value = F.lit(fills.values[name]).cast(df.schema[name].dataType)
        return F.when(is_missing(df, name), value).otherwise(quoted(name)).alias(name)

    return df.select(*[filled(c) for c in df.columns]) if fills.values else df


def impute(
    df: DataFrame, strategies: dict[str, object], relative_error: float = 0.0
) -> DataFrame:
    """Fit on the whole table and fill it.

    Exact medians of columns without missing values are not searched for: a pass of plain counts
    comes first. An exact median takes two or three more reads, of its column alone.
    """
    return apply_imputer(df, fit_imputer(df, strategies, relative_error, skip_whole=True))


# --- filters ----------------------------------------------------------------------------------


def is_numeric_text(name: str) -> Column:
    return F.coalesce(quoted(name).rlike(NUMERIC_TEXT), F.lit(False))


def keep_numeric_text(df: DataFrame, name: str) -> DataFrame:
    """Keep rows whose text is a plain unsigned number, and cast it to double."""
    if not isinstance(df.schema[name].dataType, T.StringType):
        raise TypeError(f"{name}: the filter reads text, not {df.schema[name].dataType}")
    return df.where(is_numeric_text(name)).withColumn(name, quoted(name).try_cast("double"))


def numeric_text_report(df: DataFrame, name: str) -> DataFrame:
    """(total, kept, removed) of the numeric-text filter, from one pass."""
    total, kept = F.count(F.lit(1)), F.count_if(is_numeric_text(name))
    return df.agg(total.alias("total"), kept.alias("kept"), (total - kept).alias("removed"))


def drop_invalid(df: DataFrame, features: list[str]) -> DataFrame:
    """Keep rows with every feature present and not NaN; all rows when no feature is named."""
    keep = F.lit(True)
    for f in features:
        keep = keep & ~is_missing(df, f)
    return df.where(keep)


