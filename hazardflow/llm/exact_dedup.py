"""Exact duplicates by a tree of merges over sorted runs of digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import stored

_NO_ID = 2**63 - 1  # stands for a missing id within runs: after all others
RUN = "part bigint, digest string, size bigint, best bigint, copies bigint"


def _digests(id_column: str, text_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_column).cast(pa.binary())
            digest, size = [], []
            for i in range(len(texts)):
                # bytes.lower() changes A-Z only
                norm = (texts[i].as_py() or b"").lower()
                digest.append(hashlib.sha256(norm).hexdigest())
                size.append(len(norm))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(digest, pa.string()), pa.array(size, pa.int64())],
                names=["doc_id", "digest", "size"],
            )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a partition's runs in digest order: equal digests become one row.

    Holds one Arrow batch and one open row. Digests of different text sizes stay apart."""
    carry = None
    for batch in batches:
        rows = batch.to_pandas()
        if not len(rows):
            continue
        rows = pd.concat([carry, rows]) if carry is not None else rows
        keys = ["part", "digest", "size"]
        merged = rows.groupby(keys, sort=False, as_index=False).agg(best=("best", "min"), copies=("copies", "sum"))
        carry = merged.iloc[-1:]
        if len(merged) > 1:
            yield pa.RecordBatch.from_pandas(merged.iloc[:-1], preserve_index=False)
    if carry is not None:
        yield pa.RecordBatch.from_pandas(carry, preserve_index=False)


def tree_merge(runs: DataFrame, parts: int, fan: int = 8) -> DataFrame:
    """Distinct digests of the runs (part, digest, size, best, copies), with the smallest id of each.

    Binomial rounds over `parts` runs, `fan` at a time: parts are written in base `fan`, and in
    round r the parts that differ in digit r exchange slices, so that each keeps the digests whose
    own digit r is its. Every round merges the sorted slices it got and folds equal digests, so
    copies shrink before they travel again. After the last round a part holds one slice of the
    digest space, complete: no task ever gets all digests, and a digest reaches a task at most
    once from each of the other `fan` - 1 parts, however many rows share it. `parts` is raised to
    a power of `fan`.
    """
    rounds = 1
    while fan**rounds < parts:
        rounds += 1
    slots = fan**rounds
    own = F.conv(F.substring("digest", 1, 12), 16, 10).cast("bigint") % slots
    part = F.col("part") % slots
    for level in range(rounds):
        unit = fan**level
        digit = lambda c: F.floor(c / unit).cast("bigint") % fan
        runs = (
            runs.withColumn("part", part + (digit(own) - digit(part)) * unit)
            .repartition(slots, "part")
            .sortWithinPartitions("part", "digest", "size")
            .mapInArrow(_merge, RUN)
        )
        part = F.col("part")
    return runs


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest",
                rows_per_part: int = 100_000) -> DataFrame:
    """Groups of rows whose texts are equal after lower-casing A-Z.

    Returns one row per input row: doc_id, keep_id (the row that stays), group_size, kept,
    text_sha256. `keep`: "smallest" or "largest" id stays.

    Null text counts as empty, and all empty texts are one group. A null id never stays while the
    group has another id; in a group of null ids only, keep_id is null and kept is true. Repeated
    rows with one id count each in group_size and are all kept or all dropped. Empty input gives
    no rows; other columns are not read.

    Each input partition is one run: sorted digests with the best id so far. `tree_merge` folds
    the runs, and the winners return to each run by (part, digest), so a digest that a third of
    all rows share costs one row per run, in merging and in the join.
    """
    sign = 1 if keep == "smallest" else -1
    hashed = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    hashed = hashed.mapInArrow(_digests("doc_id", "text"), "doc_id bigint, digest string, size bigint")
    hashed = stored(hashed.withColumn("part", F.spark_partition_id().cast("bigint")), "digests")
    total, top = hashed.agg(F.count("*"), F.max("part")).first()
    parts = max(1, -(-total // rows_per_part))
    # Many small input partitions are one run: a run's size follows rows, not files.
    hashed = hashed.withColumn("part", F.col("part") % parts)
    runs = hashed.groupBy("part", "digest", "size").agg(
        F.coalesce(F.min(sign * F.col("doc_id")), F.lit(_NO_ID)).alias("best"), F.count("*").alias("copies")
    )
    runs = stored(runs, "runs")
    won = tree_merge(runs, parts).select(
        "digest", "size", F.when(F.col("best") != _NO_ID, F.col("best")).alias("win"), F.col("copies").alias("group_size")
    )
    back = runs.select("part", "digest", "size").join(won, ["digest", "size"])
    return hashed.join(back, ["part", "digest", "size"]).select(
        "doc_id",
        (sign * F.col("win")).alias("keep_id"),
        "group_size",
        F.coalesce(F.col("doc_id") == sign * F.col("win"), F.col("win").isNull()).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
