"""Exact medians and modes of many groups at once, steered by bounded summaries.

One pass keeps two mergeable summaries per group and variable: a quantile sketch and a table of
frequent values. Neither grows with the group, so a hot group costs its tasks no more than their
summaries. They only steer. Groups no larger than a summary are in it whole and need nothing else. For
the others, further passes count the rows on each side of a bracket, or of a few candidates, and the
counts decide; what the summaries' error bounds cannot prove is counted in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.operators.joins import SALTS, Lookup
from hazardflow.sources.files import scratch_dir

#: Values that a quantile sketch holds before it drops any; its ranks are then off by half a
#: part in so many at most.
SKETCH = 1024
#: Values of a bracket that are gathered at most, as a multiple of the sketch.
GATHER = 8
#: Steps of the quantiles by which a bracket too wide to gather is narrowed.
STEPS = 256
#: Values that a table of frequent values holds before it takes anything off. A full table takes its
#: median count off all values; at this size the median is that of the whole table.
TRACKED = 768
#: What a table may have taken off a value, as a share of the rows: half the values lose each time,
#: which makes 2 / TRACKED; the rest is reserve.
TAKEN = 3 / TRACKED
#: Targets that are broadcast at most, of some hundred bytes each; more are joined by salted keys.
BROADCAST_TARGETS = 200_000


def kept(df: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- frequent values --------------------------------------------------------------------------


def frequent(name: str, tracked: int = TRACKED) -> Column:
    """Bounded table of the frequent values of a plain column, as (item, count); null is no value.
    Counts are at least the true ones."""
    return F.expr(f"approx_top_k({name}, {tracked}, {tracked}) filter (where {name} is not null)")


def highest(table: Column) -> Column:
    """The largest count in a table. `leaders` wants it as a column made before, as it looks at it for
    every value."""
    return F.array_max(F.transform(table, lambda t: t["count"]))


def leaders(table: Column, best: Column, rows: Column, tracked: int = TRACKED) -> Column:
    """The values among which the mode of `rows` values surely is, ties with it included; null where
    the table cannot prove it. `best` is the table's `highest`.

    A value's true count is at most its count in the table and at least that less what was taken
    off; a value not listed has at most twice what was taken off.
    """
    taken = F.when(rows <= tracked, 0).otherwise(F.ceil(rows * (TAKEN * TRACKED / tracked)))
    near = F.transform(F.filter(table, lambda t: t["count"] >= best - taken), lambda t: t["item"])
    return F.when(best - taken > 2 * taken, near)


def settled(near: Column, rows: Column, tracked: int = TRACKED) -> Column:
    """The mode where no count is needed: one leader, or a group that the table held whole."""
    return F.when((rows <= tracked) | (F.size(near) == 1), F.array_min(near))


# --- order ------------------------------------------------------------------------------------


def _sketch(c: Column, shares: list[float], size: int) -> Column:
    """Values at the given shares of a column's values, nulls left out; exact below `size` values."""
    return F.percentile_approx(c, shares, 2 * size)


def _halves(c: Column, size: int) -> Column:
    """Lower and upper middle value, and a value surely on either side of both. A rank is off by half
    of 1 / size at most, so ends one 1 / size away leave the middle between them."""
    return _sketch(c, [max(0.0, 0.5 - 1 / size), 0.5, 0.5 + 1e-9, min(1.0, 0.5 + 1 / size)], size)


def _middle(rows: Column) -> tuple[Column, Column]:
    """Ranks of the lower and the upper middle value."""
    return F.floor((rows + 1) / 2).cast("bigint"), (F.floor(rows / 2) + 1).cast("bigint")


def _meet(cells: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """Rows (key, t, value): each cell value with the targets of its group and variable.

    `wanted` has (key, variable, ...) rows, few per group. They come to the cells by broadcast while
    they are few; the cells of other groups go before anything is shuffled.
    """
    rest = [c for c in wanted.columns if c != "key"]
    per_key = wanted.groupBy("key").agg(F.collect_list(F.struct(*rest)).alias("targets"))
    small = wanted.count() <= BROADCAST_TARGETS
    met = Lookup(per_key, "key", small, SALTS).join(cells).where("targets is not null")
    met = met.select("key", F.array(*names).alias("v"), F.explode("targets").alias("t"))
    met = met.select("key", "t", F.get("v", F.col("t.variable")).alias("value"))
    return met.where("value is not null")


def _search(cells: DataFrame, names: list[str], targets: DataFrame, size: int) -> DataFrame | None:
    """Answers (key, variable, rank, answer) of targets (key, variable, rank, a, b, gather), exact.

    Each pass counts, for all targets, the rows below a, at a, between, and at b. A rank at an end is
    answered. Where the rows between are known to be few (`gather`) they are collected, and the rank
    is looked up; else quantiles of them give the next bracket, some hundredths as wide. A null end is open.
    """
    done: DataFrame | None = None
    targets = kept(targets, "targets")
    steps = min(STEPS, size)
    shares = [j / steps for j in range(steps + 1)]
    while not targets.isEmpty():
        x, a, b = F.col("value"), F.col("t.a"), F.col("t.b")
        between = (a.isNull() | (x > a)) & (b.isNull() | (x < b))
        seen = _meet(cells, targets, names).select(
            "key", "t.variable", "t.rank", a.alias("low"), b.alias("high"), "t.gather",
            (x < a).alias("is_below"), (x == a).alias("is_a"), between.alias("is_mid"),
            ((x == b) & ~F.coalesce(a == b, F.lit(False))).alias("is_b"),
            F.when(between & F.col("t.gather"), x).alias("few"), F.when(between & ~F.col("t.gather"), x).alias("many"),
        )
        counts = [F.count_if(f"is_{n}").alias(n) for n in ("below", "a", "mid", "b")]
        counted = seen.groupBy("key", "variable", "rank", "low", "high", "gather").agg(
            *counts, F.sort_array(F.collect_list("few")).alias("few"), _sketch(F.col("many"), shares, GATHER * size).alias("grid")
        )
        k, mid = F.col("rank"), F.col("mid")
        inner = k - F.col("below") - F.col("a")
        is_mid = (inner > 0) & (inner <= mid)
        answer = (
            F.when((k > F.col("below")) & (inner <= 0), F.col("low"))
            .when(is_mid, F.get("few", (inner - 1).cast("int")))
            .when((inner > mid) & (inner <= mid + F.col("b")), F.col("high"))
        )
        place = F.when(is_mid, F.floor(inner / mid * steps).cast("int"))
        # without a next step the bracket's own end stays; a rank outside, which the sketch's bound
        # rules out, would be searched on that side
        low = F.when(is_mid, F.coalesce(F.get("grid", place - 2), F.col("low"))).when(k > F.col("below"), F.col("high"))
        high = F.when(is_mid, F.coalesce(F.get("grid", place + 2), F.col("high"))).when(k <= F.col("below"), F.col("low"))
        few = is_mid & (mid * (4 / steps + 2 / (GATHER * size)) + 2 <= GATHER * size)
        counted = kept(
            counted.select("key", "variable", "rank", answer.alias("answer"), low.alias("a"), high.alias("b"), few.alias("gather")), "counted"
        )
        found = counted.where("answer is not null").select("key", "variable", "rank", "answer")
        done = found if done is None else done.unionByName(found)
        targets = counted.where("answer is null").drop("answer")
    return done


def _aggregated(cells: DataFrame, group: str, aggregates: list[Column], size: int) -> DataFrame:
    """`cells.groupBy(group).agg(...)` for summaries. A summary of a small group holds all its rows, so
    partial ones cost as much as the rows and more work: those rows are brought together first.
    Groups of `size` rows and more, told by a count of the group column alone, stay where they
    are and send partial summaries. So no group's shuffle exceeds `size` rows or its summaries."""
    key = F.struct(F.col(group)).alias("key")
    keyed = cells.select(key, "*")
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= size)
    large = kept(large.select("key", F.lit(True).alias("large")), "large")
    number = large.count()
    if not number:
        return cells.repartition(group).groupBy(group).agg(*aggregates)
    told = Lookup(large, "key", number <= BROADCAST_TARGETS, SALTS).join(keyed)
    small = told.where("large is null").repartition(group).groupBy(group).agg(*aggregates)
    return small.unionByName(told.where("large").groupBy(group).agg(*aggregates))


def ordered_stats(cells: DataFrame, group: str, medians: list[str], modes: list[str], plain: list[Column],
                  size: int = SKETCH, tracked: int = TRACKED) -> DataFrame:
    """One row per group: `group`, the aggregates `plain`, and the arrays `medians` and `modes` in
    the order of the lists. All columns are doubles under plain names; nulls take no part, NaN must be
    null already.

    The median averages the two middle values; the mode takes the smallest of equally frequent ones.
    Both are null without values. Besides a count of the groups, one pass makes the summaries of small
    groups and one those of large ones. The medians of large groups take one more (two beyond some
    three million rows a group), and so do modes that are tied or not proven. What is shuffled is bounded
    by groups times summaries, but for the values of groups without any frequent value, which are
    counted in full.
    """
    names = list(dict.fromkeys([*medians, *modes]))
    counts = [F.count(c).alias(f"_n_{c}") for c in names]
    sketches = [_halves(F.col(c), size).alias(f"_q_{c}") for c in medians]
    tables = [frequent(c, tracked).alias(f"_t_{c}") for c in modes]
    first = _aggregated(cells, group, [*plain, *counts, *sketches, *tables], size)
    shown = [c for c in first.columns if not c.startswith(("_n_", "_q_", "_t_"))]

    def of_median(x: Column) -> Column:
        n, q = x["n"], x["q"]
        ends = [q[0].alias("a"), q[3].alias("b"), (n * (3 / size) + 2 <= GATHER * size).alias("gather")]
        return F.struct(
            n.alias("n"),
            F.when(n < size, (q[1] + q[2]) / 2).alias("at_once"),
            F.when(n >= size, F.array(*[F.struct(rank.alias("rank"), *ends) for rank in _middle(n)])).alias("open"),
        )

    def of_mode(x: Column) -> Column:
        mode = settled(x["near"], x["n"], tracked)
        return F.struct(mode.alias("at_once"), ((x["n"] > 0) & mode.isNull()).alias("open"), F.when(mode.isNull(), x["near"]).alias("near"))

    # the variables of a group are elements of one array, so each step is one expression
    parts = {}
    if medians:
        made = F.array(*[F.struct(F.col(f"_n_{c}").alias("n"), F.col(f"_q_{c}").alias("q")) for c in medians])
        parts["_medians"] = F.transform(made, of_median)
    if modes:
        made = F.array(*[F.struct(F.col(f"_n_{c}").alias("n"), F.col(f"_t_{c}").alias("table")) for c in modes])
        made = F.transform(made, lambda x: F.struct(x["n"].alias("n"), x["table"].alias("table"), highest(x["table"]).alias("best")))
        near = F.transform(made, lambda x: F.struct(x["n"].alias("n"), leaders(x["table"], x["best"], x["n"], tracked).alias("near")))
        parts["_modes"] = F.transform(near, of_mode)
    first = kept(first.select(*shown, *[c.alias(n) for n, c in parts.items()]), "summaries")

    # groups may be null, so they are compared as structs
    key = F.struct(F.col(group)).alias("key")
    keyed, wide = cells.select(key, *names), first.select("*", key)

    def place(of: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(names.index(c)) for c in of]), F.col("pos") + 1).alias("variable")

    if medians:
        targets = first.select(key, F.posexplode("_medians")).where("col.open is not null")
        targets = targets.select("key", place(medians), F.inline("col.open")).distinct()
        found = _search(keyed, names, targets, size)
        if found is not None:
            wide = _join_map(wide, found.select("key", "variable", F.col("rank").cast("string").alias("what"), "answer"), "_ranks")
    if modes:
        undecided = first.select(key, F.posexplode("_modes")).where("col.open")
        undecided = kept(undecided.select("key", place(modes), "col.near"), "undecided")
        if not undecided.isEmpty():
            met = _meet(keyed, undecided, names).where("t.near is null or array_contains(t.near, value)")
            counted = met.groupBy("key", "t.variable", "value").agg(F.count("*").alias("n"))
            best = F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("answer")
            best = counted.groupBy("key", "variable").agg(best).select("key", "variable", F.lit("mode").alias("what"), "answer")
            wide = _join_map(wide, kept(best, "modes"), "_counted")

    def looked_up(name: str, of: list[str], i: Column, what: Column) -> Column:
        variable = F.element_at(F.array(*[F.lit(str(names.index(c))) for c in of]), i + 1)
        return F.col(name)[F.concat_ws(" ", variable, what)]

    def median(x: Column, i: Column) -> Column:
        both = [looked_up("_ranks", medians, i, rank.cast("string")) for rank in _middle(x["n"])]
        return F.coalesce(x["at_once"], (both[0] + both[1]) / 2)

    def mode(x: Column, i: Column) -> Column:
        return F.coalesce(x["at_once"], looked_up("_counted", modes, i, F.lit("mode")))

    none = F.array().cast("array<double>")
    at_once = lambda x: x["at_once"]
    return wide.select(
        *shown,
        (F.transform("_medians", median if "_ranks" in wide.columns else at_once) if medians else none).alias("medians"),
        (F.transform("_modes", mode if "_counted" in wide.columns else at_once) if modes else none).alias("modes"),
    )


def _join_map(wide: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Answers as a map beside their group; they are a few per group that had open questions."""
    entry = F.struct(F.concat_ws(" ", F.col("variable").cast("string"), "what").alias("k"), F.col("answer").alias("v"))
    per_key = found.groupBy("key").agg(F.map_from_entries(F.collect_list(entry)).alias(name))
    return wide.join(per_key, "key", "left")
