"""Zonal statistics: max, min, median, sum, mode, count, mean per zone and variable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.casts import known, quoted
from hazardflow.operators.selection import SKETCH, TRACKED, ordered_stats
from hazardflow.sources.schemas import ZONAL_STATS


def zonal_stats(
    df: DataFrame,
    zone: str,
    variables: dict[str, Column | str] | list[str],
    stats: list[str] | dict[str, list[str]] | None = None,
    size: int = SKETCH,
    tracked: int = TRACKED,
) -> DataFrame:
    """One row per zone with a column `{V}_{stat}` for each variable and statistic.

    `stats` lists the statistics of all variables, or maps each variable to its own.

    Null and NaN cells are ignored; a zone without cells has count 0 and nulls. -0.0 counts as
    0.0. The median averages the two middle cells, the mode takes the smallest of equally frequent
    values.

    Maximum, minimum, sum, count and mean are one partial aggregate. Median and mode come from the
    same pass by bounded summaries (`size`, `tracked`), which are exact for zones that fit; further
    passes over the cells of larger zones count what the summaries propose. No zone is sorted or
    shuffled whole, and neither size changes a result.
    """
    if not isinstance(variables, dict):
        variables = {v: v for v in variables}
    if not isinstance(stats, dict):
        stats = {v: stats or ZONAL_STATS for v in variables}
    names = {v: f"c{i}" for i, v in enumerate(variables)}
    cells = df.select(
        quoted(zone).alias("zone"),
        *[(known(c) + F.lit(0.0)).alias(names[v]) for v, c in variables.items()],
    )
    make = {"max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "mean": F.avg}
    plain = {(v, s): f"p{i}_{s}" for i, v in enumerate(names) for s in stats[v] if s in make}
    aggs = [make[s](names[v]).alias(c) for (v, s), c in plain.items()]
    ordered = {s: [v for v in names if s in stats[v]] for s in ("median", "mode")}
    if any(ordered.values()):
        medians, modes = ([names[v] for v in ordered[s]] for s in ("median", "mode"))
        out = ordered_stats(cells, "zone", medians, modes, aggs, size, tracked)
    else:
        out = cells.groupBy("zone").agg(*aggs, F.count(F.lit(1)).alias("_cells"))

    def column(v: str, s: str) -> Column:
        return F.col(plain[v, s]) if s in make else F.get(f"{s}s", F.lit(ordered[s].index(v)))

    listed = [column(v, s).alias(f"{v}_{s}") for v in names for s in stats[v]]
    return out.select(F.col("zone").alias(zone), *listed)


def with_neighbours(stats: DataFrame, zone: str, names: list[str], near: Column) -> DataFrame:
    """Add `Neighbour_{c}` for the listed columns, from a zone that has this one beside it.

    `near` is the zone that a row is the neighbour of. Each row is sent to its own zone and to
    that one, and both halves meet in one aggregate: joining the statistics to themselves would
    compute them twice. Of several neighbours the one with the smallest zone gives the whole row;
    of several rows of a zone, the smallest by all columns stands for it.
    """
    rest = [c for c in stats.columns if c != zone]
    body = [F.struct(*[quoted(c) for c in rest]).alias("row")]
    sent = F.array(
        F.struct(quoted(zone).alias("zone"), quoted(zone).alias("of"), F.lit(True).alias("own"), *body),
        F.struct(near.alias("zone"), quoted(zone).alias("of"), F.lit(False).alias("own"), *body),
    )
    halves = stats.select(F.explode(sent).alias("s")).select("s.zone", "s.of", "s.own", "s.row")
    met = halves.groupBy("zone").agg(
        F.min(F.when(F.col("own"), F.col("row"))).alias("_own"),
        F.min(F.when(~F.col("own"), F.struct("of", "row"))).alias("_near"),
    )
    return met.where("_own is not null").select(
        F.col("zone").alias(zone),
        *[F.col(f"_own.`{c}`").alias(c) for c in rest],
        *[F.col(f"_near.row.`{c}`").alias(f"Neighbour_{c}") for c in names],
    )
