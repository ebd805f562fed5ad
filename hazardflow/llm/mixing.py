"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.llm.common import by_number, stored

WEIGHTS = (3.0, 1.0, 2.0)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(column):
    """Number of words in a text; null and blank texts have none."""
    text = F.coalesce(column, F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Targets of sources: input (source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn. They share `share` times the
    sum of sizes by weight; none gets over `most` times its size, and what it can't take goes to
    the others by weight. With all sources ordered by size over weight, the full ones are a
    prefix, so one running sum gives the level at which the rest share. One task handles one row
    per source.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"),
    )
    capped = sizes.withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    filling = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        capped.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("weights") - F.col("used")))
        # the first source, in this order, that is not full at the level left for it and the rest
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("final", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("used"))).over(everything))
    )
    target = F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap")))
    return levels.select("source", "source_size", F.greatest(target, F.lit(0.0)).alias("target"))


def _odds_rank(key, weight):
    """Place of a row in the Pareto order, between 0 and 1.

    The order is by random odds u / (1 - u) over inclusion odds. Within a source those are the
    source's odds times the row's weight; the source's factor is the same for all its rows and
    changes no order there, so it is left out, and x / (1 + x) brings the rest to (0, 1).
    """
    u = (F.shiftrightunsigned(key, 11).cast("double") + 0.5) / float(2**53)
    odds = u / (1 - u) / weight
    return odds / (1 + odds)


def _fill(rows):
    """Take whole units in order while they fit in what a source still needs (one source's last
    interval). Beside those, the smallest that does not fit, and what is left of the need."""
    need = float(rows["need"].iloc[0])
    units = rows.groupby(["rank", "key"], sort=True, as_index=False)["size"].sum()
    chosen, over = [], None
    for key, size in zip(units["key"], units["size"]):
        if size <= need:
            chosen.append((key, size, True))
            need -= size
        elif over is None or size < over[1]:
            over = (key, size, False)
    out = pd.DataFrame(chosen + ([over] if over else []), columns=["key", "size", "chosen"])
    return out.assign(source_no=rows["source_no"].iloc[0], rest=need)[["source_no", "key", "size", "chosen", "rest"]]


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a stored table only if its row count is within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def _narrow(open_rows: DataFrame, bounds: DataFrame, steps: int, last: int) -> DataFrame:
    """The interval of the order in which each source's running sum passes its need, with at most
    `last` rows, and what is needed there: (source_no, need, lo, hi)."""
    bounds = bounds.withColumns({"lo": F.lit(0.0), "hi": F.lit(1.0), "n": F.lit(None).cast("bigint")})
    for _ in range(6):
        width = (F.col("hi") - F.col("lo")) / steps
        place = F.least(F.floor((F.col("rank") - F.col("lo")) / width), F.lit(steps - 1))
        inside = open_rows.join(_small(bounds, 100_000), "source_no").where("rank >= lo and rank < hi and (n is null or n > %d)" % last)
        sums = inside.groupBy("source_no", place.alias("slice")).agg(
            F.sum("size").alias("slice_size"), F.count("*").alias("slice_n")
        )
        running = Window.partitionBy("source_no").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
        crossing = (
            sums.join(_small(bounds, 100_000), "source_no")
            .withColumn("upto", F.sum("slice_size").over(running))
            .withColumn("all_n", F.sum("slice_n").over(Window.partitionBy("source_no")))
            .where(F.col("upto") >= F.col("need"))
            .groupBy("source_no")
            .agg(F.min(F.struct("slice", "upto", "slice_size", "slice_n", "all_n", "need", "lo", "hi")).alias("x"))
            .select("source_no", "x.*")
        )
        small = F.col("all_n") <= last
        cut = crossing.select(
            "source_no",
            F.when(small, F.col("need")).otherwise(F.col("need") - F.col("upto") + F.col("slice_size")).alias("need"),
            F.when(small, F.col("lo")).otherwise(F.col("lo") + F.col("slice") * width).alias("lo"),
            F.when(small | (F.col("slice") == steps - 1), F.col("hi"))
            .otherwise(F.col("lo") + (F.col("slice") + 1) * width).alias("hi"),
            F.when(small, F.col("all_n")).otherwise(F.col("slice_n")).alias("n"),
        )
        settled = bounds.where(F.col("n") <= last)
        bounds = stored(cut.unionByName(settled), "bounds")
        if (bounds.agg(F.max("n")).first()[0] or 0) <= last:
            break
    return bounds.drop("n")


def mix_plan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             source_column: str = "source", weight_column: str | None = None,
             weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 17,
             steps: int = 1024, last: int = 4_000) -> DataFrame:
    """How often each document enters the mix: rows (doc_id, source, key, size, source_size,
    target, copies), one per input row, stored.

    Size is the number of words. `source_targets` gives the sources' targets in words. A document
    of a source with target t and size s gets floor(t / s) certain whole copies. The rest of the
    target is filled by Pareto order sampling: documents in order of random odds over inclusion
    odds, whole, until their words reach what is left. Where the sums pass that point is found by
    narrowing an interval of the order: sums of sizes over `steps` slices for all sources at once,
    then within the slice that crosses, until it holds at most `last` rows. Only those rows are
    taken one by one, first fit; with what is then left the order goes on behind them, among rows
    that may fit, until none does. Last, the smallest row that did not fit is taken if that ends
    nearer to the target. So the sample's words are fixed, within about one small document.

    `weight_column` multiplies a document's inclusion odds (null or not positive: 1). The random
    number is a hash of id and text, so reruns and recomputed tasks agree; rows equal in both are
    one unit. Null source is a source of its own, null or blank text has size 0, and sources of
    size 0 have target 0. Empty input gives no rows.
    """
    weight = F.lit(1.0)
    if weight_column:
        given = F.col(weight_column).cast("double")
        weight = F.when(given > 0, given).otherwise(1.0)
    light = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(source_column).alias("source"),
            F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)).alias("key"),
            word_count(F.col(text_column)).alias("size"),
            weight.alias("weight"),
        ),
        "sizes",
    )
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    ratio = F.col("target") / F.col("source_size")
    targets = stored(
        targets.withColumn("certain", F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(0))
        .withColumn("need", F.col("target") - F.col("certain") * F.col("source_size"))
        .withColumn("source_no", F.monotonically_increasing_id()),
        "targets",
    )
    known = _small(targets, 100_000)
    rows = stored(
        light.alias("d").join(known.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("doc_id", "d.source", "source_no", "key", "size", "source_size", "target", "certain",
                _odds_rank(F.col("key"), F.col("weight")).alias("rank")),
        "ranked",
    )
    bounds = targets.where("need > 0").select("source_no", "need")
    open_rows = rows.select("source_no", "rank", "size", "key")
    bounds = first = _narrow(open_rows, bounds, steps, last)
    taken, rests, overs = [], [], []
    while True:
        inside = open_rows.join(_small(bounds, 100_000), "source_no").where("rank >= lo and rank < hi")
        edge = stored(inside.groupBy("source_no").applyInPandas(_fill, "source_no bigint, key bigint, size bigint, chosen boolean, rest double"), "edge")
        taken.append(edge.where("chosen").select("source_no", "key"))
        overs.append(edge.where("not chosen").select("source_no", "key", "size"))
        rest = stored(edge.groupBy("source_no").agg(F.min("rest").alias("need")).join(bounds.select("source_no", "hi"), "source_no"), "rest")
        rests.append(rest.select("source_no", F.col("need").alias("rest")))
        # what did not fit is left out; the order goes on behind it with units that may fit
        behind = stored(
            open_rows.join(_small(rest, 100_000), "source_no").where("rank >= hi and size > 0 and size <= need")
            .groupBy("source_no", "rank", "key").agg(F.sum("size").alias("size"), F.first("need").alias("need")).where("size <= need"),
            "behind",
        )
        if behind.isEmpty():
            break
        sums = stored(behind.groupBy("source_no").agg(F.sum("size").alias("all"), F.first("need").alias("need")), "sums")
        whole = sums.where("all <= need")
        rests.append(whole.select("source_no", (F.col("need") - F.col("all")).alias("rest")))
        open_rows = behind.select("source_no", "rank", "size", "key")
        bounds = _narrow(open_rows, sums.where("all > need").select("source_no", "need"), steps, last)
        below = open_rows.join(_small(bounds, 100_000), "source_no").where("rank < lo")
        taken += [x.select("source_no", "key") for x in (below, open_rows.join(whole, "source_no", "left_semi"))]
    left = reduce(DataFrame.unionByName, rests).groupBy("source_no").agg(F.min("rest").alias("rest"))
    over = reduce(DataFrame.unionByName, overs).groupBy("source_no").agg(F.min(F.struct("size", "key")).alias("over"))
    nearer = over.join(left, "source_no").where("over.size - rest < rest").select("source_no", "over.key")
    edge = stored(reduce(DataFrame.unionByName, [*taken, nearer]).distinct().withColumn("chosen", F.lit(True)), "edge")
    return (
        rows.join(_small(first.select("source_no", "lo"), 100_000), "source_no", "left")
        .join(_small(edge, 500_000), ["source_no", "key"], "left")
        .select(
            "doc_id", "source", "key", "size", "source_size", "target",
            (F.col("certain") + (F.coalesce(F.col("rank") < F.col("lo"), F.lit(False)) | F.coalesce("chosen", F.lit(False))).cast("int"))
            .cast("int").alias("copies"),
        )
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
        seed: int = 17, **options) -> DataFrame:
    """The mixed rows themselves: each input row, with all its columns, as often as `mix_plan`
    says; rows with no copy go. A document may so appear twice. Same cases as `mix_plan`. Columns of any
    name are kept."""
    names = docs.columns
    docs, (id_column, text_column, source_column) = by_number(docs, id_column, text_column, source_column)
    plan = mix_plan(docs, id_column, text_column, source_column, seed=seed, **options)
    taken = stored(plan.where("copies > 0").select("key", F.col("copies").alias("_copies")).distinct(), "copies")
    key = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))
    columns = [F.col(f"d.{c}") for c in docs.columns]
    keyed = docs.withColumn("_mix_key", key).alias("d")
    return (
        keyed.join(taken.alias("t"), F.col("d._mix_key") == F.col("t.key"))
        .select(*columns, F.explode(F.sequence(F.lit(1), F.col("t._copies"))).alias("_mix_copy"))
        .drop("_mix_copy").toDF(*names)
    )
