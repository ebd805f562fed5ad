"""Mixing against the rule read plainly."""

import re
from collections import defaultdict

import pytest

from hazardflow.llm.mixing import mix, mix_plan, source_targets
from tests.conftest import SF_DIR


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: 0.0 for s in names}
    open_, left = set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        over = set()
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                over.add(s)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 5, "d": 40, None: 7}, {"x": 0, "y": 9}, {"only": 4},
    {"z": 3, "Z": 1000, "é": 17, "": 2, "aa": 60, "ab": 61, "ac": 62},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)


def check(rows, plan, slack):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    taken = defaultdict(int)
    assert len(plan) == len(rows)
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack(s), (s, taken[s], want[s])


@pytest.mark.parametrize("last", [4000, 3])
def test_documents(spark, last):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    a = mix_plan(docs, last=last, steps=4).collect()
    b = mix_plan(docs.repartition(7), last=last, steps=4).collect()
    key = lambda r: r["doc_id"]
    assert [r["copies"] for r in sorted(a, key=key)] == [r["copies"] for r in sorted(b, key=key)]
    biggest = defaultdict(int)
    for r in a:
        biggest[r["source"]] = max(biggest[r["source"]], r["size"])
    check(rows, a, lambda s: biggest[s] / 2 + 1)


def test_cases(spark):
    rows = [(None, "a b", "s"), (None, "a b", "s"), (1, None, "s"), (2, "", None), (3, "x\x0by z w v u", None), (3, "k", "t"), (4, "same words here", "t"), (4, "same words here", "t")]
    df = spark.createDataFrame([(*r, 1, 2.5) for r in rows], "doc_id long, text string, source string, copies int, w double")
    plan = mix_plan(df, weight_column="w").collect()
    check(rows, plan, lambda s: 7)
    out = mix(df).collect()
    assert len(out) == sum(r["copies"] for r in mix_plan(df).collect())
    assert mix(df).columns == df.columns
    empty = df.limit(0)
    assert mix_plan(empty).count() == 0 and mix(empty).count() == 0


def test_weights_change_who_is_taken(spark):
    rows = [(i, "one two three four", "s", 50.0 if i < 100 else 0.02) for i in range(200)] + [(900 + i, "x y", "t", 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    plan = [r for r in mix_plan(df, weights=(1, 3), share=0.5, most=2.0, weight_column="w").collect() if r["source"] == "s"]
    heavy, light = (sum(r["copies"] for r in plan if (r["doc_id"] < 100) == h) for h in (True, False))
    assert heavy > 3 * light and heavy + light > 0


def test_long_documents_at_the_cut(spark):
    rows = [(1000 * s + i, "w " * (150 if i % 100 == 0 else 7 + i % 4), f"s{s:02}") for s in range(30) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, mix_plan(df, last=3, steps=8).collect(), lambda s: 10)
