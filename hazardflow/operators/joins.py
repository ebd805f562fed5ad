"""Dimension lookups that stay safe when the dimension or a key grows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions.casts import quoted

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


def one_per_key(dim: DataFrame, key: str) -> DataFrame:
    """One row per key of a dimension: the smallest by all other columns, nulls first. Rows
    without a key go; they match nothing."""
    others = [c for c in dim.columns if c != key]
    kept = dim.where(quoted(key).isNotNull()).groupBy(quoted(key).alias(key))
    best = kept.agg(F.min(F.struct(*[quoted(c) for c in others])).alias("_row"))
    return best.select(quoted(key), *[F.col(f"_row.`{c}`").alias(c) for c in others])


def fits_broadcast(dim: DataFrame, most_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast: rows times the size of a row, from one pass."""
    fixed = sum(16 for f in dim.schema.fields)
    text = [f.name for f in dim.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = F.lit(fixed)
    for name in text:
        width = width + F.coalesce(F.octet_length(quoted(name)), F.lit(0))
    size = dim.agg(F.sum(width)).first()[0] or 0
    return size <= most_bytes


@dataclass(frozen=True)
class Lookup:
    """A dimension made ready once: one row per key, and the way it is joined."""

    dim: DataFrame
    key: str
    small: bool
    salts: int = SALTS

    def join(self, fact: DataFrame) -> DataFrame:
        """Left join of a fact table, batch or micro-batch; its rows never multiply.

        A small dimension is broadcast and the fact table does not move. Otherwise both sides are
        shuffled on (key, salt), with the dimension copied once per salt. The salt numbers the
        rows of a task, so equal rows of one hot key go to many tasks too.
        """
        if self.small:
            return fact.join(F.broadcast(self.dim), self.key, "left")
        salt = (F.monotonically_increasing_id() % self.salts).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1)))
        return (
            fact.withColumn("_salt", salt)
            .join(self.dim.withColumn("_salt", copies), [self.key, "_salt"], "left")
            .drop("_salt")
        )


def lookup(
    dim: DataFrame, key: str, most_bytes: int = MAX_BROADCAST_BYTES, salts: int = SALTS
) -> Lookup:
    """Check a dimension's size once, for any number of joins."""
    single = one_per_key(dim, key)
    return Lookup(single, key, fits_broadcast(single, most_bytes), salts)


def location_lookup(dim: DataFrame, **options) -> Lookup:
    """The location dimension (location_id, lat, lon, name), made ready once."""
    return lookup(dim.select("location_id", "lat", "lon", "name"), "location_id", **options)


def enrich_location(df: DataFrame, dim: DataFrame | Lookup) -> DataFrame:
    """Add `latitude`, `longitude`, `location_name` of the location dimension.

    `dim` has (location_id, lat, lon, name), or is a `location_lookup` of it, as streams should
    pass: its size is then not checked per batch. Unknown locations get 0.0, 0.0 and "Unknown".
    Coordinates in the message are replaced by the dimension's.
    """
    ready = dim if isinstance(dim, Lookup) else location_lookup(dim)
    facts = df.drop("latitude", "longitude", "location_name")
    joined = ready.join(facts)
    return joined.select(
        *facts.columns,
        F.coalesce("lat", F.lit(0.0)).alias("latitude"),
        F.coalesce("lon", F.lit(0.0)).alias("longitude"),
        F.coalesce("name", F.lit("Unknown")).alias("location_name"),
    )
