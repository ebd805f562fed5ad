"""Exact order statistics and zonal statistics against brute force."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hazardflow.operators import order, selection, zonal
from hazardflow.operators.evaluate import auc

SHAPES = {
    "spread": lambda r: r.random() * 1000,
    "few": lambda r: float(r.choice([1, 2, 2, 2, 3])),
    "two": lambda r: float(r.choice([0, 1])),
    "tails": lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-8, 12),
    "holes": lambda r: r.choice([None, float("nan"), r.random()]),
    "constant": lambda r: 7.5,
}


def disc(values, q):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(q * len(kept))) - 1] if kept else None


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_quantiles(spark, monkeypatch, q):
    # A coarse sketch and a tiny finish make every step of the search run.
    monkeypatch.setattr(order, "SKETCH_ACCURACY", 20)
    r = random.Random(11)
    data = [tuple(make(r) for make in SHAPES.values()) for _ in range(3000)]
    schema = ", ".join(f"{n} double" for n in SHAPES)
    df = spark.createDataFrame(data, schema).repartition(7)
    got = order.exact_quantiles(df, list(SHAPES), q, finish_rows=5)
    for i, name in enumerate(SHAPES):
        assert got[name] == disc([row[i] for row in data], q), name


def test_exact_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, float("nan"))], "a double, b double")
    assert order.exact_quantiles(df, ["a", "b"]) == {"a": None, "b": None}
    assert order.exact_quantiles(df, []) == {}


def test_quantiles_keep_their_type(spark):
    big = 2**53 + 1
    rows = [(big, Decimal(f"{big}.25"))] * 5 + [(big - 1, Decimal("0.01"))] * 4 + [(big + 1, Decimal("9e20"))] * 4 + [(None, None)]
    df = spark.createDataFrame(rows, "a long, b decimal(38,2)").repartition(3)
    for finish in (0, 3, 100):
        got = order.exact_quantiles(df, ["a", "b"], finish_rows=finish)
        assert got == {"a": big, "b": Decimal(f"{big}.25")}
    assert order.exact_quantiles(df.dropna(), ["a"], skip_whole=True) == {"a": None}


def test_ranges_grow_with_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    cut = order.ranged(df, ["k", "v"], 1000, 100)
    assert cut.count() == 1000 and cut.select("bucket").distinct().count() >= 8
    summed = order.before_sums(cut.withColumn("n", F.lit(1)), ["k"], "v", ["n"])
    assert summed.where("before_n != floor(v / 7)").count() == 0


def zone_rows(hot=4000, cold=30):
    r = random.Random(3)
    out = [(1, r.choice([None, float(r.randrange(700))]), float(r.randrange(3))) for _ in range(hot)]
    # Cells outside every zone form a large group of their own.
    out += [(None, float(r.randrange(90)), r.random()) for _ in range(hot // 2)]
    for z in range(2, 2 + cold):
        out += [(z, float(r.randrange(5)), float("nan")) for _ in range(r.randrange(1, 9))]
    return out


def brute(data, zone, i):
    values = [row[i] for row in data if row[0] == zone]
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return (None, None, None, None, None, 0, None)
    mode = min(v, key=lambda x: (-v.count(x), x))
    return (v[-1], v[0], statistics.median(v), sum(v), mode, len(v), sum(v) / len(v))


def same(x, y):
    return x == y if x is None or y is None else math.isclose(x, y, rel_tol=1e-12)


@pytest.mark.parametrize("size,tracked", [(10, 6), (300, 60), (1024, 768)])
def test_zonal_stats(spark, size, tracked):
    data = zone_rows()
    df = spark.createDataFrame(data, "zone int, a double, b double").repartition(5)
    got = zonal.zonal_stats(df, "zone", {"A": "a", "B": "b"}, size=size, tracked=tracked).collect()
    assert len(got) == len({row[0] for row in data})
    for row in got:
        for i, v in ((1, "A"), (2, "B")):
            want = brute(data, row.zone, i)
            have = tuple(row[f"{v}_{s}"] for s in zonal.ZONAL_STATS)
            assert all(map(same, have, want)), (row.zone, v, have, want)


def test_zonal_totals_use_one_shuffle(spark):
    df = spark.createDataFrame(zone_rows(10), "zone int, a double, b double")
    plan = zonal.zonal_stats(df, "zone", ["a"], ["max", "mean"])._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange") == 1


def test_the_size_of_summaries_changes_no_bit(spark, rows):
    r = random.Random(5)
    data = [(r.randrange(3), r.random()) for _ in range(3000)] + [(7, -0.0), (7, 0.0), (7, -0.0)]
    df = spark.createDataFrame(data, "zone int, a double").repartition(6).cache()
    wanted = ["median", "mode", "max", "min", "count"]
    one, many = (rows(zonal.zonal_stats(df, "zone", ["a"], wanted, size=n, tracked=n)) for n in (4096, 8))
    assert one == many
    assert str(one[-1][1:5]) == str((0.0, 0.0, 0.0, 0.0))


def test_a_hot_zone_sends_summaries(spark, monkeypatch):
    """A third of all cells in one zone, all values distinct: its cells are not shuffled, and its
    median takes counts of a bracket."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 700).alias("zone"),
        F.pmod(F.col("id") * 7919, F.lit(60_007)).cast("double").alias("v"),
    )
    met = []
    meet = selection._meet
    monkeypatch.setattr(selection, "_meet", lambda cells, wanted, names: met.append(wanted.count()) or meet(cells, wanted, names))
    out = {r["zone"]: (r["v_median"], r["v_mode"], r["v_count"]) for r in zonal.zonal_stats(df, "zone", ["v"]).collect()}
    cells = {}
    for r in df.collect():
        cells.setdefault(r["zone"], []).append(r["v"])
    assert out == {z: (statistics.median(v), min(v), len(v)) for z, v in cells.items()}
    assert met == [2, 1]
    first = selection._aggregated(df, "zone", [selection._halves(F.col("v"), 1024).alias("q")], 1024)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "partial_percentile_approx" in plan


def test_medians_of_hard_shapes(spark):
    """Small summaries, so that every step of the search runs; many ties, and values at the ends."""
    r = random.Random(2)
    shapes = {
        1: [float(r.choice([1, 1, 1, 2])) for _ in range(2000)],
        2: [r.random() for _ in range(3001)],
        3: [1.0] * 1000 + [2.0] * 1000,
        4: [r.choice([-1, 1]) * 10 ** r.uniform(-8, 12) for _ in range(2500)],
        5: [float(i // 7) for i in range(4000)],
        6: [7.5],
        7: [float("inf")] * 600 + [float("-inf")] * 600 + [0.0],
    }
    df = spark.createDataFrame([(z, v) for z, values in shapes.items() for v in values], "zone int, v double").repartition(6)
    for size in (8, 100):
        got = {x["zone"]: (x["v_median"], x["v_mode"]) for x in zonal.zonal_stats(df, "zone", ["v"], ["median", "mode"], size=size, tracked=20).collect()}
        for z, values in shapes.items():
            assert got[z] == (statistics.median(values), min(set(values), key=lambda x: (-values.count(x), x))), (size, z)


@pytest.mark.parametrize("tracked", [64, 768])
def test_leaders_hold_the_mode(spark, tracked):
    """Whatever the table took off, the mode and its ties are among the leaders, or none are told."""
    r = random.Random(4)
    told = 0
    for share in (0.02, 0.1, 0.3, 0.6, 0.9):
        values = [f"v{r.randrange(5000)}" if r.random() > share else "often" for _ in range(6000)] + ["b"] * 40 + ["a"] * 40
        df = spark.createDataFrame([(v,) for v in values], "c string").repartition(5)
        row = df.agg(F.count("c").alias("n"), selection.frequent("c", tracked).alias("t"))
        row = row.select("*", selection.highest(F.col("t")).alias("best"))
        near = row.select(selection.leaders(F.col("t"), F.col("best"), F.col("n"), tracked)).first()[0]
        counts = {v: values.count(v) for v in set(values)}
        if near is not None:
            told += 1
            assert {v for v, n in counts.items() if n == max(counts.values())} <= set(near)
    assert told >= 1


def test_several_neighbours_give_one_whole_row(spark, rows):
    df = spark.createDataFrame([(3, 30.0, 1.0, 1), (2, 5.0, 100.0, 1), (1, 0.0, 0.0, 0)], "z int, a double, b double, n int")
    got = zonal.with_neighbours(df, "z", ["a", "b"], F.col("n")).where("z = 1")
    assert rows(got, "Neighbour_a", "Neighbour_b") == [(5.0, 100.0)]


def test_neighbours_without_a_join(spark, rows):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (4, 4.0, None)], "z int, x double, t string")
    got = zonal.with_neighbours(df, "z", ["x"], F.col("z") - 1)
    assert rows(got) == [(1, 1.0, "a", 2.0), (2, 2.0, "b", None), (4, 4.0, None, None)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_statistics_per_variable(spark):
    df = spark.createDataFrame(zone_rows(10), "zone int, a double, b double")
    wanted = {"A": ["max"], "B": ["median", "count"]}
    got = zonal.zonal_stats(df, "zone", {"A": "a", "B": "b"}, wanted)
    assert got.columns == ["zone", "A_max", "B_median", "B_count"]


def pair_auc(data):
    pos = [s for s, y in data if y == 1 and s is not None]
    neg = [s for s, y in data if y == 0 and s is not None]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("size", [50, 10**6])
@pytest.mark.parametrize("digits", [1, 6])
def test_auc_equals_pair_counting(spark, digits, size):
    r = random.Random(9)
    data = [(round(r.random(), digits), int(r.random() < 0.3)) for _ in range(600)]
    data += [(None, 1), (None, 0)]
    df = spark.createDataFrame(data, "s double, y int").repartition(6)
    assert auc(df, "s", "y", size).first()[0] == pytest.approx(pair_auc(data), abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1)], "s double, y int")
    assert auc(df, "s", "y").first()[0] is None
