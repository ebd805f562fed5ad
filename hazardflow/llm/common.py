"""Shared parts of the text operators: stored tables, components of links, buckets of candidates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardflow.sources.files import delete_folders

# The bytes that end a word, and the sentence enders.
SPACE = b" \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that all executors share (`spark.checkpoint.dir`).

    Where the session names none, a local master gets a temporary folder; a cluster raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="hazardflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark's setting by which a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession):
    """Within it, what a write has shuffled is deleted when the write ends: its result is stored, so
    nothing reads those files again. Else they stay until the driver happens to collect garbage. The
    session's own setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back: lineage ends here, a lost
    executor loses nothing, and the next plan knows the size."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    with shuffles_end(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def stored_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """Rows written as a bucketed table in the shared folder: later aggregates and joins on the
    column find them in place, without another shuffle of wide rows."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    name = f"hazardflow_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path)
    with shuffles_end(spark):
        writer.bucketBy(parts, column).saveAsTable(name)
    out = spark.table(name)
    out.stored_at, out.stored_as = path, name
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what `stored` or `stored_by` wrote, once nothing reads it any more. Other DataFrames,
    such as selections of a stored one, are left alone."""
    for df in tables:
        if path := getattr(df, "stored_at", None):
            if name := getattr(df, "stored_as", None):
                df.sparkSession.sql(f"drop table if exists {name}")
            delete_folders(df.sparkSession, [path])


def by_number(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """The rows with columns c0, c1, ..., and the new names of the wanted ones: no name that a stage
    makes up can then meet one of the input's."""
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), [f"c{names.index(w)}" for w in wanted]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(column: str, modulus: int):
    """crc32 of an id written as text, modulo a number; decides which rows are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (id, component) per id that has a link,
    the component named by its smallest id.

    Distributed union-find: every root hooks to its smallest neighbour, pointers are halved until
    they reach a root, and links are renamed to roots and made distinct. Rounds end when no link
    joins two roots. Each round is stored, so nothing depends on a long lineage.
    """
    links = stored(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stored(
            both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("p"))
            .select("id", F.least("id", "p").alias("p")),
            "parents",
        )
        while True:
            once = _jump(parent, parent)
            jumped = stored(_jump(once, once).select("id", "p", "moved"), "parents")
            parent = jumped.select("id", "p")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select("id", F.col("p").alias("component"))
        else:
            step = parent.select(F.col("id").alias("component"), "p")
            labels = labels.join(step, "component", "left").select("id", F.coalesce("p", "component").alias("component"))
        of_a = parent.select(F.col("id").alias("a"), F.col("p").alias("pa"))
        of_b = parent.select(F.col("id").alias("b"), F.col("p").alias("pb"))
        links = stored(
            links.join(of_a, "a").join(of_b, "b")
            .where("pa != pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stored(labels, "labels")


def _jump(parent: DataFrame, other: DataFrame) -> DataFrame:
    """Pointers one jump on: to where the pointer's own pointer leads."""
    up = other.select(F.col("id").alias("p"), F.col("p").alias("pp"))
    return parent.select("id", "p").join(up, "p").select("id", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved"))


def active_buckets(buckets: DataFrame, once: bool = False) -> DataFrame:
    """Rows (bucket, id, n) of the buckets that hold two ids or more; n: how many.

    Buckets are aggregated before the shuffle, and the join back can split a hot bucket. `once` is
    for rows that are costly to make, hardly ever share a bucket, and are distinct ids: they are
    shuffled a single time, and both the aggregate and the join read that.
    """
    rows = buckets.repartition("bucket") if once else buckets
    sizes = (
        rows.groupBy("bucket")
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi")
        .select("bucket", "n")
    )
    return rows.join(sizes.hint("shuffle_hash") if once else sizes, "bucket")


def _with_pivot(rows: DataFrame) -> DataFrame:
    """Rows (bucket, id, weight) with their bucket's pivot: the id that meets most others in all
    buckets, which is likely the original of a group of copies; of several, the smallest."""
    best = rows.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("best"))
    return rows.join(best.select("bucket", (-F.col("best.minus")).alias("pivot")), "bucket")


#: Pairs looked at for each row of a bucket table before rounds of single ids go on instead.
LOOKS = 200


def linked_buckets(
    active: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    traits: DataFrame,
    close: Callable[[str, str], Column],
) -> DataFrame:
    """Components (id, component) of all links between ids that share a bucket.

    `active`: stored rows of `active_buckets`. `traits`: one row per id with all its buckets, in
    an order that is the same for all (`buckets`), and with what `close` compares between two
    aliases; it must hold for every link. `verify` takes candidate pairs (a, b) for which it holds
    and returns those that are links.

    First one id per bucket, the most central, is tested against the bucket's others and what is
    linked is joined; then the tested id goes, and so do buckets whose ids are all in one
    component, as no further link could change the result. What is left is compared within
    buckets: ids outside a bucket's largest component with those of all others. `close` decides inside the join, and a pair is
    made in the first bucket that both share, so that pairs are made of likely links alone, once.
    While that would look at more than `LOOKS` pairs for each row, rounds of single ids go on. So
    every pair that could join two components is tested, whatever the size of a bucket.
    """
    links, room = None, active.count()
    weights = active.groupBy("id").agg(F.sum("n").alias("weight"))
    rows = stored(_with_pivot(active.select("bucket", "id").join(weights, "id")), "pivots")
    while True:
        pairs = rows.where("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        x, y = traits.alias("x"), traits.alias("y")
        near = pairs.join(x, F.col("a") == F.col("x.id")).join(y, F.col("b") == F.col("y.id")).where(close("x", "y"))
        found = verify(stored(near.select("a", "b"), "candidates")).select("a", "b")
        links = stored(found if links is None else links.unionByName(found), "verified")
        named = components(links)
        rest = rows.where("id != pivot").select("bucket", "id", "weight")
        rest = rest.join(named, "id", "left").select("bucket", "id", "weight", F.coalesce("component", "id").alias("component"))
        rest = stored(rest, "rest")
        shares = rest.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        mixed = shares.groupBy("bucket").agg(
            F.max(F.struct("n", "component")).alias("major"), F.sum("n").alias("n"), F.count("*").alias("kinds")
        )
        mixed = stored(mixed.where("kinds > 1").select("bucket", "n", "major.component", (F.col("n") - F.col("major.n")).alias("minor")).withColumnRenamed("component", "major"), "mixed")
        looks = mixed.agg(F.sum(F.col("n").cast("double") * F.col("minor"))).first()[0]
        if not looks:
            return named
        rest = rest.join(mixed.select("bucket", "major"), "bucket")
        if looks <= LOOKS * room:
            break
        rows = stored(_with_pivot(rest.select("bucket", "id", "weight")), "pivots")
    full = rest.select("bucket", "id", "component", (F.col("component") != F.col("major")).alias("minor")).join(traits, "id")
    full = stored(full, "traits")
    # ids outside a bucket's largest component meet all others; two of them meet once
    x, y = full.where("minor").alias("x"), full.alias("y")
    unlike = (F.col("x.component") != F.col("y.component")) & (~F.col("y.minor") | (F.col("x.id") < F.col("y.id")))
    first = F.get(F.array_intersect("x.buckets", "y.buckets"), 0) == F.col("x.bucket")
    near = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & unlike & close("x", "y") & first)
    near = stored(near.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "candidates")
    return components(links.unionByName(verify(near).select("a", "b")))
