"""Merkle manifest of a dataset: a tree per group, a tree over their roots, a proof per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.functions.casts import quoted
from hazardflow.llm.common import stored

ROWS_PER_RANGE = 500_000
#: A proof: the digests beside the node, level by level from below, as hex text to its left and right.
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other, as UTF-8."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """A value in its own length, so that no two rows of values read alike; null is `-`."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, group: str, order: list[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """`rows` with `place`, the position within the group from 0, and `n`, the group's size.

    Rows are laid out in ranges of (group, order) and numbered where they lie; a group's numbers go
    on from range to range, so a hot group spreads over as many ranges as it fills. Rows equal in
    all keys are dealt out too. The running counts hold one row per group and range.
    """
    spark, names = rows.sparkSession, [quoted(c) for c in rows.columns]
    total = rows.count()
    ranges = max(-(-total // rows_per_range), int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [group, *order, "_tie"]
    cut = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    cut = stored(cut.select(*names, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")), "ranges")
    counts = cut.groupBy(group, "_range").agg(F.min("_at").alias("_low"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        group, "_range", (F.coalesce(before, F.lit(0)) - F.col("_low")).alias("_shift"), F.sum("_rows").over(whole).alias("n")
    )
    return cut.join(counts, [group, "_range"]).select(*names, (F.col("_at") + F.col("_shift")).alias("place"), "n")


def _beside(own: DataFrame, nodes: DataFrame, arity: int) -> DataFrame:
    """`own` (some of the nodes) with `left` and `right`: the digests of each one's siblings.

    A node's run is its place div `arity`, its slot the rest. The self-join shifts by slot offsets:
    each node computes the index of every sibling it can have and meets the node of that index.
    The join's key is the run, so nodes travel once and a run's at most `arity` nodes meet in one
    task; the computed index decides within the run. A node without siblings stays.
    """
    shifts = F.explode(F.sequence(F.lit(1), F.lit(arity - 1)))
    kept = own.columns
    x = own.repartition("tree", "run").select("*", shifts.alias("shift"))
    x = x.select("*", (F.col("run") * arity + (F.col("slot") + F.col("shift")) % arity).alias("sibling")).alias("x")
    y = nodes.select("tree", "run", "slot", "digest").repartition("tree", "run").alias("y")
    meet = (F.col("x.tree") == F.col("y.tree")) & (F.col("x.run") == F.col("y.run"))
    # written as a difference, so that the index does not become part of the shuffled key
    meet = meet & (F.col("y.run") * arity + F.col("y.slot") - F.col("x.sibling") == 0)
    found = F.when(F.col("y.slot").isNotNull(), F.struct("y.slot", "y.digest"))
    met = x.join(y.hint("shuffle_hash"), meet, "left").groupBy(*[F.col(f"x.{quote(c)}") for c in kept])
    met = met.agg(F.sort_array(F.collect_list(found)).alias("_beside"))

    def text(keep) -> Column:
        return F.concat_ws("", F.transform(F.filter("_beside", keep), lambda z: z["digest"]))

    return met.select(
        *[quoted(c) for c in kept],
        text(lambda z: z["slot"] < F.col("slot")).alias("left"),
        text(lambda z: z["slot"] > F.col("slot")).alias("right"),
    )


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def climb(leaves: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees, from the leaves up, and their roots (tree, digest).

    `leaves`: stored rows (tree, run, slot, n, digest, ...), n being the tree's number of nodes on the
    level. On each level the rows of slot zero meet their siblings and emit the parents; a tree
    that is down to one node has its root. A level is stored, with a node for `arity` below it.
    """
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        nodes = levels[-1].where("n > 1").select("tree", "run", "slot", "n", "digest")
        first = _beside(nodes.where("slot = 0"), nodes, arity)
        levels.append(stored(
            first.select(
                "tree",
                F.floor(F.col("run") / arity).cast("bigint").alias("run"),
                (F.col("run") % arity).alias("slot"),
                F.ceil(F.col("n") / arity).cast("bigint").alias("n"),
                digest(F.col("digest"), F.col("right")).alias("digest"),
            ),
            "nodes",
        ))
        most = -(-most // arity)
    roots = [level.where("n = 1").select("tree", "digest") for level in levels]
    for more in roots[1:]:
        roots[0] = roots[0].unionByName(more)
    return levels, stored(roots[0], "roots")


def descend(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """Leaves with `path`, the proof up to the trees' roots and on by `above` (tree, path, ...),
    whose other columns they get as well.

    From the top level down, each node puts its siblings before its parent's path. A path is
    stored once for a run, never for a leaf: leaves meet it in the task that found their siblings.
    """
    rest = [c for c in above.columns if c not in ("tree", "path")]
    for height in range(len(levels) - 1, -1, -1):
        nodes = levels[height]
        names = [quoted(c) for c in nodes.columns]
        out = nodes.where("n = 1").join(above, "tree").select(*names, "path", *rest)
        if height + 1 < len(levels):
            many = nodes.where("n > 1")
            own = F.array(F.struct("left", "right"))
            many = _beside(many, many, arity).join(upper.hint("shuffle_hash"), ["tree", "run"])  # noqa: F821
            out = out.unionByName(many.select(*names, F.concat(own, "path").alias("path"), *rest))
        if height:
            index = (F.col("run") * arity + F.col("slot")).alias("run")
            upper = stored(out.select("tree", index, "path", *rest), "paths")  # noqa: F841
    return out


def fold(start: Column, path: Column) -> Column:
    """The root that a digest and a proof lead to."""
    return F.aggregate(path, start, lambda d, beside: digest(beside["left"], d, beside["right"]))


def proof_text(path: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])))


def _placed(rows: DataFrame, order: list[str], arity: int) -> DataFrame:
    names = [quoted(c) for c in rows.columns]
    rows = numbered(rows, "tree", order)
    return rows.select(*names, F.floor(F.col("place") / arity).cast("bigint").alias("run"), (F.col("place") % arity).alias("slot"), "n")


def manifest(docs: DataFrame, fields: list[str], group_column: str = "source", id_column: str = "doc_id",
             arity: int = 16, claimed: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, leaf, claimed, subroot, root, path.

    A leaf is the digest of the row's `fields`. Leaves of a group ascend by id, and every `arity`
    consecutive nodes become the digest of theirs until one remains, the group's subroot; subroots
    in the groups' order (null first, else bytewise) become the root in the same way. `path` proves the
    leaf: `fold(leaf, path)` is the root. `claimed` is a second digest to be held against it, null
    where there is none; it takes no part in the tree.

    Null ids come first, equal ids by leaf; equal leaves of one id may change places, which changes
    no row's digests but lets them swap paths. A null group is a group. Null and empty fields differ.
    Repeated rows are a leaf each. An empty table gives no rows. Columns other than those named are
    not read, whatever their names.

    Digests are stored once; then every step moves digests only. Leaves are numbered in ranges, each
    level is a self-join by run, and paths are stored per run, so no group, level or path is ever in
    one task. The driver gets two counts.
    """
    given = claimed if claimed is not None else F.lit(None).cast("string")
    source = quoted(group_column).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        quoted(id_column).alias("doc_id"),
        digest(*[field(quoted(c)) for c in fields]).alias("digest"),
        given.alias("claimed"),
    )
    leaves = stored(_placed(stored(leaves, "digests"), ["doc_id", "digest"], arity), "leaves")
    levels, subroots = climb(leaves, arity)
    # the upper tree: its leaves are the subroots, in the order of their groups
    upper = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    upper_levels, roots = climb(stored(_placed(upper, ["group"], arity), "subroots"), arity)
    top = roots.select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    above = descend(upper_levels, top, arity).select(F.col("group").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    proved = descend(levels, stored(above, "above"), arity)
    return proved.select("doc_id", F.col("digest").alias("leaf"), "claimed", "subroot", "root", "path")


#: What the catalogue's leaves hold, in this order.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def tamper_check(docs: DataFrame, fields: list[str] = LEAF_FIELDS, modulus: int = 5, **options) -> DataFrame:
    """The manifest's digests, and what comes of altered rows: doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified.

    Where `modulus` divides the crc32 of the id as text, A-Z of `text` is lower-cased before the
    leaf is made again, and that leaf is folded with the untouched proof; elsewhere the leaf itself
    is. Null ids are not altered. See `manifest` for nulls, repeats and empty tables.
    """
    small = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = digest(*[field(small if c == "text" else quoted(c)) for c in fields])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 0
    proved = manifest(docs, fields, claimed=F.when(chosen, altered), **options)
    start = F.coalesce("claimed", "leaf")
    proved = proved.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold(start, F.col("path")).alias("folded_root"),
    )
    return proved.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))
