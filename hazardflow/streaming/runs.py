"""Rows that many micro-batches write and few files keep: runs per day, merged by identity.

A batch writes a run of its own in each part (a day and a measurement, say) that it touches. Compaction
merges a part's runs up to a batch into one sealed run, sorted by identity, and then notes the batch. A
reader takes, per part, the sealed run that is noted and the later batches, and merges them by
identity. What compaction writes is not read before the note, what it replaces not after, so a
reader sees each row once at any moment. Replaced runs are deleted apart, when no reader that began
earlier can still want them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.functions.casts import quoted
from hazardflow.operators.points import dedup_points
from hazardflow.sources.files import delete_folders

RUN = ["sealed", "run"]


def newest_wins(order: list[str] | None = None) -> Callable[[DataFrame, list[str]], DataFrame]:
    """Merge that keeps, of rows with one identity, that of the latest run; within a run the last by
    `order`, or by all other columns."""

    def merge(rows: DataFrame, keys: list[str]) -> DataFrame:
        rest = order or [c for c in rows.columns if c not in (*keys, *RUN)]
        return dedup_points(rows, keys, ["run", *rest])

    return merge


@dataclass(frozen=True)
class RunStore:
    """A folder of runs.

    `keys` is a row's identity and includes `parts`, the columns that rows are stored by. `merge`
    makes one row of those with equal keys. `replaces` says that later runs replace rows of earlier
    ones; otherwise (sums, say) both are needed. Null keys are equal to each other; parts hold no
    nulls. Batch numbers ascend, and a batch that is written again replaces itself.
    """

    spark: SparkSession
    root: str
    keys: list[str]
    parts: list[str]
    merge: Callable[[DataFrame, list[str]], DataFrame] = field(default_factory=newest_wins)
    replaces: bool = True

    def _data(self) -> str:
        return f"{self.root.rstrip('/')}/data"

    def _notes(self) -> str:
        return f"{self.root.rstrip('/')}/sealed"

    def _write(self, rows: DataFrame) -> None:
        laid_out = rows.hint("rebalance", *self.parts, *RUN)
        order = [k for k in self.keys if k not in self.parts]
        writer = laid_out.sortWithinPartitions(*self.parts, *RUN, *order).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*self.parts, *RUN).parquet(self._data())

    def write_batch(self, rows: DataFrame, batch_id: int | str) -> None:
        """Write a micro-batch, one row per identity. A name as `batch_id` is a column of batch numbers
        and writes many batches at once."""
        if isinstance(batch_id, str):
            rows = rows.withColumn("run", quoted(batch_id).cast("bigint")).drop(batch_id)
            rows = self.merge(rows.withColumn("sealed", F.lit(0)), [*self.keys, "run"])
        else:
            rows = self.merge(rows.withColumns({"sealed": F.lit(0), "run": F.lit(batch_id).cast("bigint")}), self.keys)
        self._write(rows)

    def sink(
        self, shape: Callable[[DataFrame], DataFrame], compact_every: int | None = None, keep: int = 240
    ) -> Callable[[DataFrame, int], None]:
        """A `foreachBatch` function: `shape` makes rows of the store from a micro-batch.

        With `compact_every`, each so many batches merge the runs of all earlier ones, and runs
        replaced by then go when they are `keep` batches old. The batch at hand may still be
        written again and is left out.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            self.write_batch(shape(batch), int(batch_id))
            if compact_every and batch_id and batch_id % compact_every == 0:
                self.compact(batch_id - 1)
                self.expire(batch_id - keep)

        return write

    # --- reading

    def _part(self) -> Column:
        return F.concat_ws("/", *[quoted(p).cast("string") for p in self.parts])

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._data())
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            return None

    def _sealed_up_to(self, where: Column | None) -> Column:
        """The last batch in a part's sealed run, -1 without one. The driver gets one number per part
        that `where` allows, and the test prunes folders."""
        try:
            notes = self.spark.read.parquet(self._notes())
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            return F.lit(-1)
        noted = (notes if where is None else notes.where(where)).groupBy(self._part().alias("part"))
        pairs = [F.lit(x) for row in noted.agg(F.max("upto").alias("upto")).collect() for x in row]
        return F.coalesce(F.create_map(*pairs)[self._part()], F.lit(-1)) if pairs else F.lit(-1)

    def read(self, where: Column | None = None) -> DataFrame:
        """The store's rows, one per identity. `where` may name `parts` only; it prunes what is read.

        Sealed rows do not move: only those of later batches are merged, and sealed rows whose
        identity came again go, by a join that broadcasts the later ones while they are few.
        """
        rows = self._stored()
        if rows is None:
            raise ValueError(f"{self.root}: nothing was written yet")
        upto = self._sealed_up_to(where)
        rows = rows if where is None else rows.where(where)
        sealed = rows.where((F.col("sealed") == 1) & (F.col("run") == upto))
        later = rows.where((F.col("sealed") == 0) & (F.col("run") > upto))
        if not self.replaces:
            return self.merge(sealed.unionByName(later), self.keys).drop(*RUN)
        later = self.merge(later, self.keys)
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(f"s.{_tick(k)}").eqNullSafe(F.col(f"l.{_tick(k)}"))
        left = sealed.alias("s").join(later.select(*[quoted(k) for k in self.keys]).alias("l"), same, "left_anti")
        return left.unionByName(later).drop(*RUN)

    # --- upkeep

    def runs(self) -> DataFrame:
        """(parts, sealed, run, live): all runs there are, and whether they are read now."""
        rows = self._stored()
        if rows is None:
            raise ValueError(f"{self.root}: nothing was written yet")
        upto = self._sealed_up_to(None)
        live = F.when(F.col("sealed") == 1, F.col("run") == upto).otherwise(F.col("run") > upto)
        return rows.select(*[quoted(p) for p in self.parts], *RUN).distinct().withColumn("live", live)

    def compact(self, upto: int, least: int = 2) -> int:
        """Merge the runs of batches up to `upto` in each part that has at least `least` of them;
        returns the number of parts merged. All batches up to `upto` must have ended.

        One job for all parts; parts that few late rows touched are left for another time. A
        compaction that broke off is not noted, is not read, and is replaced by the next.
        """
        wanted = self.runs().where((F.col("sealed") == 0) & F.col("live") & (F.col("run") <= upto))
        wanted = wanted.groupBy(*self.parts).agg(F.count("*").alias("n")).where(F.col("n") >= least)
        chosen = [tuple(row)[:-1] for row in wanted.collect()]
        if not chosen:
            return 0
        rows, sealed_to = self._stored(), self._sealed_up_to(None)
        names = ["/".join(str(v) for v in part) for part in chosen]
        live = F.when(F.col("sealed") == 1, F.col("run") == sealed_to).otherwise(F.col("run") > sealed_to)
        rows = rows.where(self._part().isin(names) & live & (F.col("run") <= upto))
        merged = self.merge(rows, self.keys).drop(*RUN).withColumns({"sealed": F.lit(1), "run": F.lit(upto).cast("bigint")})
        self._write(merged)
        kinds = self._stored().select(*[quoted(p) for p in self.parts]).schema
        notes = self.spark.createDataFrame(chosen, kinds).withColumn("upto", F.lit(upto).cast("bigint"))
        # one file, so all parts are noted at once
        notes.coalesce(1).write.mode("append").parquet(self._notes())
        return len(chosen)

    def expire(self, before: int) -> int:
        """Delete runs of batches before `before` that are no longer read; returns how many. Readers
        that planned earlier still want them, so leave as many batches as a reader may take."""
        gone = self.runs().where(~F.col("live") & (F.col("run") < before)).drop("live").collect()
        # values are plain in folder names but for what Spark escapes; the files themselves tell
        folders = sorted({f.rsplit("/", 1)[0] for f in self._files(gone)})
        delete_folders(self.spark, folders)
        return len(folders)

    def _files(self, runs: list) -> list[str]:
        if not runs:
            return []
        path = F.concat_ws("/", self._part(), F.col("sealed").cast("string"), F.col("run").cast("string"))
        rows = self._stored().where(path.isin(["/".join(str(v) for v in row) for row in runs]))
        return [r[0] for r in rows.select(F.input_file_name()).distinct().collect()]


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
