"""The Merkle manifest against a tree built in a loop."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hazardflow.llm.merkle import LEAF_FIELDS, fold, manifest, numbered, tamper_check

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def path(levels, i, arity):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // arity * arity : i // arity * arity + arity]
        out.append(("".join(run[: i % arity]), "".join(run[i % arity + 1 :])))
        i //= arity
    return out


def expected(rows, arity=16):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        order = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[name] = order, tree([leaf(r) for r in order], arity)
    top = tree([made[name][1][-1][0] for name in names], arity)
    out = []
    for k, name in enumerate(names):
        order, levels = made[name]
        for i, row in enumerate(order):
            proof = path(levels, i, arity) + path(top, k, arity)
            folded = leaf(row)
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                folded = leaf((*row[:4], row[4].encode().lower().decode()))
            for a, b in proof:
                folded = digest(a + folded + b)
            root = top[-1][0]
            out.append((row[0], leaf(row), levels[-1][0], root, digest("".join(a + b for a, b in proof)), folded, folded == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_rows():
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i} É") for i in range(700)]
    rows += [(i, "one" + str(i), "de", None, "Alone") for i in range(1000, 1040)]
    rows += [(5000 + i, None, None, i, None) for i in range(17)]
    rows += [(None, "nulls", "fr", 1, "A"), (None, "nulls", "fr", 1, "B"), (None, None, None, None, None)]
    rows += [(7, "twice", "en", 2, "Same")] * 40 + [(7, "twice", "en", 2, "Other"), (8, "", "", 0, "")]
    rows += [(9000, "émile", "fr", 10**6, "Long Text " * 100_000), (9001, "Z\U0001f600", "x", 1, "a"), (9002, "Z￿", "x", 1, "a")]
    return rows


def test_equals_loop(spark):
    rows = made_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    result = tamper_check(df)
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got(result) == expected(rows)


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    rows = [(i, f"s{i % 2}", "en", i, f"Text {i}") for i in range(75)] + [(99, "lone", "en", 1, "x")]
    assert got(tamper_check(spark.createDataFrame(rows, SCHEMA), arity=arity)) == expected(rows, arity)


def test_proofs_fold_to_root(spark):
    df = spark.createDataFrame(made_rows(), SCHEMA)
    proved = manifest(df, LEAF_FIELDS)
    assert proved.where(fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert proved.where("claimed is not null").count() == 0


def test_one_row_and_none(spark):
    rows = [(5, "a", "en", 3, "ABC")]
    assert got(tamper_check(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    assert expected(rows)[0][4] == digest("")
    empty = tamper_check(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


def test_clashing_names_are_not_read(spark):
    rows = made_rows()[:60]
    extra = "tree string, digest string, claimed string, place long, n long, _at long, _tie long, run long, slot long, path string, root string, `a.b` string"
    df = spark.createDataFrame([(*r, *["x"] * 3, *[1] * 6, *["y"] * 3) for r in rows], f"{SCHEMA}, {extra}")
    assert got(tamper_check(df)) == expected(rows)


def test_numbers_of_a_hot_group_of_equal_rows(spark):
    df = spark.range(4000).select(F.lit("g").alias("tree"), F.lit(1).alias("k"))
    df = df.unionByName(spark.range(10).select(F.lit("h").alias("tree"), F.col("id").cast("int").alias("k")))
    out = numbered(df, "tree", ["k"], rows_per_range=100).collect()
    assert sorted(r["place"] for r in out if r["tree"] == "g") == list(range(4000))
    assert sorted((r["k"], r["place"], r["n"]) for r in out if r["tree"] == "h") == [(i, i, 10) for i in range(10)]


def test_nodes_travel_by_run_once(spark):
    """A level is dealt out by run, and the join and its aggregate need no other exchange."""
    from hazardflow.llm.merkle import _beside

    nodes = spark.range(100).selectExpr("concat('t', id div 64) as tree", "id % 64 div 16 as run", "id % 16 as slot", "100L as n", "cast(id as string) as digest")
    plan = _beside(nodes, nodes, 16)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hash" in x]
    assert exchanges and all("hashpartitioning(tree" in x and "run" in x and "slot" not in x for x in exchanges)
