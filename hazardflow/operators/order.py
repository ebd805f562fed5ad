"""Exact order statistics without holding a group in one task.

Global quantiles are found by narrowing a bracket: a bounded sketch proposes two values near
the wanted rank, one counting pass tells on which side the rank lies, and the interval between
them (a fraction of a percent of the rows) is searched next. The sketch only steers; the counts
decide, so the result is exact for any distribution.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions.casts import known, quoted
from hazardflow.sources.files import scratch_dir

Number = int | float | Decimal

SKETCH_ACCURACY = 10_000
FINISH_ROWS = 10_000


@dataclass
class _Search:
    """Open interval (low, high) still holding the wanted value, as rank `rank` of `rows`."""

    column: str
    own_type: bool = False
    low: Number | None = None
    high: Number | None = None
    rows: int = 0
    rank: int = 0
    answer: Number | None = None
    done: bool = False

    def plain(self) -> Column:
        """Whole numbers and decimals stay what they are: a double may not hold them."""
        return quoted(self.column) if self.own_type else known(self.column)

    def value(self) -> Column:
        keep = self.inside()
        return self.plain() if keep is None else F.when(keep, self.plain())

    def inside(self) -> Column | None:
        x = self.plain()
        tests = []
        if self.low is not None:
            tests.append(x > F.lit(self.low))
        if self.high is not None:
            tests.append(x < F.lit(self.high))
        if not tests:
            return None
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    def bracket(self, q: float) -> Column:
        """Two values near the rank, within the interval's own ends: the sketch works in doubles,
        and each count must find the value at one end at least."""
        margin = 3.0 / SKETCH_ACCURACY
        ends = [max(0.0, q - margin), min(1.0, q + margin)]
        near = F.percentile_approx(self.value(), ends, SKETCH_ACCURACY)
        lo, hi = F.min(self.value()), F.max(self.value())
        return F.transform(near, lambda x: F.least(F.greatest(x, lo), hi))

    def narrow(self, a: Number, b: Number, below: int, at_a: int, between: int, at_b: int) -> None:
        k = self.rank
        if k <= below:
            self.high, self.rows = a, below
        elif k <= below + at_a:
            self.answer, self.done = a, True
        elif k <= below + at_a + between:
            self.low, self.high = a, b
            self.rank, self.rows = k - below - at_a, between
        elif k <= below + at_a + between + at_b:
            self.answer, self.done = b, True
        else:
            passed = below + at_a + between + at_b
            self.low = b
            self.rank, self.rows = k - passed, self.rows - passed


def _prune(df: DataFrame, searches: list[_Search]) -> DataFrame:
    """Rows outside every interval need not be read."""
    tests = [s.inside() for s in searches]
    if any(t is None for t in tests):
        return df
    keep = tests[0]
    for t in tests[1:]:
        keep = keep | t
    return df.where(keep)


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    q: float = 0.5,
    finish_rows: int = FINISH_ROWS,
    skip_whole: bool = False,
) -> dict[str, Number | None]:
    """Smallest value whose cumulative share reaches `q`, per column; None without values.

    Null and NaN are ignored. Values keep their column's type. All columns share each pass, and
    each pass reads only rows that some interval still holds. Every pass keeps a sketch and a few
    counters per column, whatever the data size. `skip_whole` gives None for columns in which no
    value is missing.
    """
    if not columns:
        return {}
    df = df.select(*[quoted(c) for c in columns])
    if skip_whole:
        # a pass of plain counts is cheap beside a sketch of each column
        present = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(known(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        ).first()
        holed = [c for i, c in enumerate(columns) if present[f"n{i}"] < present["rows"]]
        return dict.fromkeys(columns) | exact_quantiles(df, holed, q, finish_rows)
    searches = [
        _Search(c, isinstance(df.schema[c].dataType, (T.IntegralType, T.DecimalType)))
        for c in columns
    ]
    row = df.agg(
        *[F.count(s.value()).alias(f"n{i}") for i, s in enumerate(searches)],
        *[s.bracket(q).alias(f"b{i}") for i, s in enumerate(searches)],
    ).first()
    brackets = {}
    for i, s in enumerate(searches):
        s.rows = row[f"n{i}"]
        s.rank = max(1, math.ceil(q * s.rows))
        s.done = s.rows == 0
        brackets[s.column] = row[f"b{i}"]

    while todo := [s for s in searches if not s.done]:
        if small := [s for s in todo if s.rows <= finish_rows]:
            _finish(df, small)
        if large := [s for s in todo if s.rows > finish_rows]:
            if fresh := [s for s in large if s.column not in brackets]:
                found = _prune(df, fresh).agg(
                    *[
                        s.bracket((s.rank - 0.5) / s.rows).alias(f"b{i}")
                        for i, s in enumerate(fresh)
                    ]
                ).first()
                brackets.update({s.column: found[f"b{i}"] for i, s in enumerate(fresh)})
            _count(df, large, brackets)
    return {s.column: s.answer for s in searches}


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Few rows are left in each interval: sort them in the aggregate."""
    found = _prune(df, searches).agg(
        *[
            F.sort_array(F.collect_list(s.value()))[s.rank - 1].alias(f"v{i}")
            for i, s in enumerate(searches)
        ]
    ).first()
    for i, s in enumerate(searches):
        s.answer, s.done = found[f"v{i}"], True


def _count(df: DataFrame, searches: list[_Search], brackets: dict) -> None:
    counts = []
    for i, s in enumerate(searches):
        a, b = brackets[s.column]
        x = s.value()
        counts += [
            F.count_if(x < a).alias(f"below{i}"),
            F.count_if(x == a).alias(f"a{i}"),
            F.count_if((x > a) & (x < b)).alias(f"mid{i}"),
            F.count_if((x == b) & F.lit(b > a)).alias(f"b{i}"),
        ]
    row = _prune(df, searches).agg(*counts).first()
    for i, s in enumerate(searches):
        a, b = brackets.pop(s.column)
        s.narrow(a, b, row[f"below{i}"], row[f"a{i}"], row[f"mid{i}"], row[f"b{i}"])


ROWS_PER_RANGE = 1_000_000


def ranged(df: DataFrame, by: list[str], rows: int, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`df` with a `bucket` that grows with the columns `by`, written once and read back.

    The number of ranges follows the number of rows (`rows`, an upper bound), so a hot group is
    cut into as many as its size asks for. Bounds are sampled and may differ between two runs of
    a plan, so the rows are stored under the ranges they got; nothing in a result depends on them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "ranged")
    cut = df.repartitionByRange(max(1, -(-rows // rows_per_range)), *by)
    cut.withColumn("bucket", F.spark_partition_id()).write.parquet(path)
    kept = T.StructType([*df.schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(kept).parquet(path)


def before_sums(
    df: DataFrame,
    keys: list[str],
    value: str,
    measures: list[str],
) -> DataFrame:
    """Add `before_<m>` and `all_<m>`: sums of m over smaller values and over the whole group.

    `df` holds one row per (keys, value) with a `bucket` that grows with the value. Sorting
    happens within a bucket, and bucket totals carry the running sum across buckets, so a hot
    group is spread over as many tasks as it has buckets.
    """
    totals = df.groupBy(*keys, "bucket").agg(*[F.sum(m).alias(f"t_{m}") for m in measures])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"k_{k}") for k in keys],
        F.col("bucket").alias("k_bucket"),
        *[F.coalesce(F.sum(f"t_{m}").over(earlier), F.lit(0)).alias(f"o_{m}") for m in measures],
        *[F.sum(f"t_{m}").over(group).alias(f"all_{m}") for m in measures],
    )
    match = F.col("bucket") == F.col("k_bucket")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"k_{k}"))
    within = (
        Window.partitionBy(*keys, "bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.join(offsets, match)
        .withColumns(
            {
                f"before_{m}": F.coalesce(F.sum(m).over(within), F.lit(0)) + F.col(f"o_{m}")
                for m in measures
            }
        )
        .drop("k_bucket", *[f"k_{k}" for k in keys], *[f"o_{m}" for m in measures])
    )
