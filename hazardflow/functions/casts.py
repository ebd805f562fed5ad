"""Casts that never fail a job, and names that need quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by exact name, also for headers with dots, blanks or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(c: Column | str) -> Column:
    return quoted(c) if isinstance(c, str) else c


def safe_int(c: Column | str) -> Column:
    """Truncate toward zero; unparsable, null, NaN and infinite values become 0."""
    whole = as_column(c).try_cast("double").try_cast("bigint")
    return F.coalesce(whole, F.lit(0).cast("bigint"))


def safe_double(c: Column | str) -> Column:
    """Unparsable and null values become 0.0; NaN stays NaN."""
    return F.coalesce(as_column(c).try_cast("double"), F.lit(0.0))


def to_numeric(c: Column | str) -> Column:
    """Text to double, null where the text is no number."""
    return as_column(c).try_cast("double")


def known(c: Column | str) -> Column:
    """Double value with NaN turned into null, so one null test covers both."""
    return F.nanvl(as_column(c).cast("double"), F.lit(None).cast("double"))


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_instant(name: str) -> Column:
    """Naive UTC wall time as an instant, whatever the session's zone."""
    return F.timestamp_seconds(F.lit(0)) + (quoted(name) - F.expr(EPOCH))


def utc_wall(name: str) -> Column:
    """Instant as naive UTC wall time, whatever the session's zone."""
    return F.expr(EPOCH) + (quoted(name) - F.timestamp_seconds(F.lit(0)))


def local_to_utc(df: DataFrame, name: str, zone: str, output: str | None = None) -> DataFrame:
    """Wall-clock time of `zone` to UTC wall-clock time.

    A zoned timestamp already is an instant, so it is only expressed in UTC.
    """
    kind = df.schema[name].dataType
    utc = F.lit("UTC")
    if isinstance(kind, T.TimestampType):
        converted = F.convert_timezone(None, utc, quoted(name))
    else:
        converted = F.convert_timezone(F.lit(zone), utc, quoted(name).cast("timestamp_ntz"))
    return df.withColumn(output or name, converted)
