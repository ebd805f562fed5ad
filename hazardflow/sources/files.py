"""File layers: CSV and Parquet reads, writes, verified writes."""

from __future__ import annotations

import csv
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.functions.casts import quoted
from hazardflow.operators.columns import entries


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line."""
    first = spark.read.option("wholetext", False).text(path).first()
    if first is None:
        raise ValueError(f"{path}: no header line")
    return next(csv.reader([first["value"].removeprefix("\ufeff")]))


def _plain(name: str) -> str:
    return name.strip().lower()


def read_csv_text(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Headered CSV with its columns found by name, in the declared order, as text.

    Names match without case and outer blanks. Doubled, missing and unknown names raise, and so
    do files of one folder whose headers differ.
    """
    header = _header(spark, path)
    found = [_plain(n) for n in header]
    wanted = {_plain(n): n for n in schema.names}
    faults = {
        "doubled": sorted({n for n in found if found.count(n) > 1}),
        "missing": [n for n in wanted if n not in found],
        "unknown": [n for n in found if n not in wanted],
    }
    if any(faults.values()):
        listed = "; ".join(f"{k}: {', '.join(v)}" for k, v in faults.items() if v)
        raise ValueError(f"{path}: header does not match ({listed})")
    given = T.StructType([T.StructField(n, T.StringType()) for n in header])
    # The header of every file is held against the first one's.
    reader = spark.read.schema(given).option("header", True).option("enforceSchema", False)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    df = reader.csv(path).toDF(*found)
    df = df.select(*[quoted(_plain(n)).alias(n) for n in schema.names])
    return df.repartition(partitions) if partitions else df


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the declared types; what does not parse becomes null."""
    return text.select(*[_parsed(f).alias(f.name) for f in schema.fields])


def _parsed(field: T.StructField) -> Column:
    text = quoted(field.name)
    return text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def unparsed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """(column, unparsed): values per column that hold text but do not parse; one pass."""
    names = schema.names
    row = text.agg(
        *[
            F.count_if(quoted(f.name).isNotNull() & _parsed(f).isNull()).alias(f"u{i}")
            for i, f in enumerate(schema.fields)
        ]
    )
    index = {n: i for i, n in enumerate(names)}
    return entries(row, names, {"unparsed": lambda n: F.col(f"u{index[n]}")})


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Headered CSV under a declared schema, columns bound by header name.

    Values that do not parse become null; `unparsed` counts them. `multiline` allows line breaks
    inside quoted fields and doubled quotes as escapes. Such a file cannot be split, so one task
    reads each file: deliver many files, and pass `partitions` to spread the rows of large ones
    before the next step.
    """
    return typed(read_csv_text(spark, path, schema, multiline, partitions), schema)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet layer; a declared schema saves the footer read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet layer."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_verified(
    df: DataFrame, path: str, partition_by: list[str] | None = None
) -> DataFrame:
    """Write a layer beside the old one, compare row counts, and only then replace it.

    The input is computed once: its rows are counted while they are written, and the new layer's
    count comes from Parquet footers. If they differ, it raises and the old layer stays.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    seen = Observation()
    write_layer(df.observe(seen, F.count(F.lit(1)).alias("rows")), beside, partition_by)
    expected = seen.get["rows"]
    read = spark.read.schema(df.schema).parquet(beside).count()
    if expected != read:
        raise RuntimeError(f"{path}: wrote {expected} rows, read back {read}; kept in {beside}")
    _replace(spark, beside, path)
    return spark.createDataFrame(
        [(expected, read, True)], "written bigint, read bigint, ok boolean"
    )


def _replace(spark: SparkSession, new: str, path: str) -> None:
    """Put a written folder in the place of another, which is set aside until the move is done."""
    jvm = spark.sparkContext._jvm
    target, source = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, new))
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    if had := store.exists(target):
        store.rename(target, aside)
    if not store.rename(source, target):
        if had:
            store.rename(aside, target)
        raise RuntimeError(f"{path}: the new layer could not be moved from {new}")
    if had:
        store.delete(aside, True)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders, wherever they are stored; those that are gone already are passed over."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def export_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Headered CSV export. `single` forces one file and so one task: small data only."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).csv(path)


def scratch_dir(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh folder for intermediate output, under `base` or the session's shared folder
    (`spark.checkpoint.dir`). Without either it raises: executors would not see a local folder."""
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
