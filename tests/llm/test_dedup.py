"""Exact, line and near duplicates against brute force."""

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardflow.llm import common, line_dedup
from hazardflow.llm.common import active_buckets, components, linked_buckets
from hazardflow.llm.exact_dedup import exact_dedup
from hazardflow.llm.hashing import words
from hazardflow.llm.line_dedup import drop_repeated_lines, line_components
from hazardflow.llm.near_dedup import keep_one_of_each, near_dedup, shingles


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def classes(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_search(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 230)]
    links += [(300, 301 + i) for i in range(40)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes(400, links)
    assert got == {i: want[i] for i in {x for p in links if p[0] != p[1] for x in p}}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("looks", [0, 10**9])
def test_buckets_lose_no_link(spark, looks, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(b), int(i)) for b in range(5) for i in rng.choice(24, 6, replace=False)]
    wanted = {(a, b) for a, b in itertools.combinations(range(24), 2) if (a * 7 + b * 3) % 11 == 0}
    together = {tuple(sorted(p)) for b in range(5) for p in itertools.combinations([i for x, i in rows if x == b], 2)}
    df = spark.createDataFrame(rows, "bucket long, id long")
    good = spark.createDataFrame(sorted(wanted), "a long, b long")
    traits = df.groupBy("id").agg(F.array_sort(F.collect_list("bucket")).alias("buckets"), (F.first("id") % 11).alias("t"))
    sums = lambda x, y: (F.least(f"{x}.id", f"{y}.id") * 7 + F.greatest(f"{x}.id", f"{y}.id") * 3) % 11
    close = lambda x, y: (sums(x, y) == 0) & F.col(f"{x}.t").isNotNull()
    monkeypatch.setattr(common, "LOOKS", looks)  # without looks: rounds of one tested id per bucket
    active = active_buckets(df, once=bool(looks))
    ordered = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = linked_buckets(active, lambda pairs: ordered(pairs).join(good, ["a", "b"]), traits, close)
    got = {r["id"]: r["component"] for r in found.collect()}
    want = classes(24, wanted & together)
    assert got == {i: want[i] for p in wanted & together for i in p}


TEXTS = [(5, "Same Text"), (3, "same text"), (9, "SAME TEXT"), (1, "other"), (7, "É"), (8, "é"), (2, None), (4, ""), (None, "lone"), (None, "x"), (6, "x"), (3, "same text")]


@pytest.mark.parametrize("rows_per_part", [3, 1000])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(spark, rows_per_part, keep):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumnRenamed("text", "digest").repartition(4)
    got = exact_dedup(df, text_column="digest", keep=keep, rows_per_part=rows_per_part).collect()
    pick = min if keep == "smallest" else max
    assert len(got) == len(TEXTS)
    for r in got:
        group = [(i, t) for i, t in TEXTS if hashlib.sha256(lowered(t).encode()).hexdigest() == r["text_sha256"]]
        ids = [i for i, _ in group if i is not None]
        assert r["group_size"] == len(group)
        assert r["keep_id"] == (pick(ids) if ids else None)
        assert r["kept"] == (r["doc_id"] == r["keep_id"] if ids else True)


def test_exact_empty(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_word_hashes_are_by_word():
    h = words("one two ONE\x0btwo\x0cthree\xa0x é".encode())[2]
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 4


def near_rows():
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 5000, 120)]
    rows, doc = [], 0
    for change in (0, 0, 1, 2, 3, 4, 6, 8, 12, 30):
        t = list(base)
        for at in rng.choice(120, change, replace=False):
            t[at] = f"z{rng.integers(10**6)}"
        rows.append((doc, " ".join(t)))
        doc += 1
    for _ in range(6):  # a chain of small changes: far ends are linked over the middle only
        t = t[:-8] + [f"q{rng.integers(10**6)}" for _ in range(8)]
        t = t[8:] + t[:8]
        rows.append((doc, " ".join(t)))
        doc += 1
    rows += [(100, "A b C"), (101, "a\tB\nc"), (102, "a b"), (103, ""), (104, None), (105, "  \n"), (106, " ".join(base).upper()), (107, "é È"), (108, "é è")]
    return rows


def brute_near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = lowered(t).split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    linked = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    root = classes(len(rows), linked)
    return {(rows[i][0], len(sets[i]), min(rows[j][0] for j in range(len(rows)) if root[j] == root[i])) for i in range(len(rows))}


@pytest.mark.parametrize("width", [4, 5])
def test_near_equals_brute_force(spark, width):
    rows = near_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kept string, pivot int")
    got = near_dedup(df, width=width).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute_near(rows, width, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = keep_one_of_each(df, width=width)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}


def test_near_on_documents(spark):
    from tests.conftest import SF_DIR

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = near_dedup(docs, width=4).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == brute_near(rows, 4, 80)


def test_near_cases(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup(df).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(3, 3, True)] * 2 + [(9, 3, False)], key=str)
    assert keep_one_of_each(df).count() == 4
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup(empty).count() == 0


def test_shingles_of_long_text():
    text = ("word " * 300_000).encode()
    assert len(shingles(text, 5)) == 1


def line_rows():
    rng = np.random.default_rng(2)
    base = ["".join(rng.choice(list("abcdefgh "), 90)) for _ in range(6)]
    rows = []
    for i in range(12):
        lines = []
        for b in base:
            b = list(b)
            for at in rng.choice(90, i % 3, replace=False):
                b[at] = "X"
            lines.append("".join(b))
        rows.append((i, "\n".join(lines[i % 6 :] + ["", "  short ", "only %d" % i, "short\t"])))
    return rows + [(50, None), (51, ""), (52, "\n \n"), (53, "x\U0001f600y" * 10), (54, "x\U0001f600y" * 10)]


def brute_lines(rows, width=8, percent=80):
    lines = [(d, p, x.strip(" \t\x0b\x0c\r")) for d, t in rows for p, x in enumerate((t or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]
    sets = []
    for _, _, x in lines:
        u = x.encode("utf-16-be")
        sets.append({u[2 * i : 2 * (i + width)] for i in range(max(1, len(u) // 2 - width + 1))})
    linked = [(i, j) for i, j in itertools.combinations(range(len(lines)), 2) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    root = classes(len(lines), linked)
    order = sorted(range(len(lines)), key=lambda i: lines[i][:2])
    first = {}
    for i in order:
        first.setdefault(root[i], i)
    return {(lines[i][0], lines[i][1], *lines[first[root[i]]][:2], root.count(root[i]), first[root[i]] == i) for i in range(len(lines))}


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, line int")
    got = line_components(df).collect()
    found = {(r["doc_id"], r["pos"], r["keep_doc"], r["keep_pos"], r["copies"], r["kept"]) for r in got}
    assert found == brute_lines(rows)
    clean = {r["doc_id"]: r["text"] for r in drop_repeated_lines(df).collect()}
    gone = {(r["doc_id"], r["pos"]) for r in got if not r["kept"]}
    for i, t in rows:
        left = None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone)
        if any(d == i for d, _ in gone) and not left.strip():
            assert i not in clean
        else:
            assert clean[i] == left


def test_lines_cases(spark):
    df = spark.createDataFrame([(None, "a line here"), (None, "a line here"), (4, "a line here"), (4, "a line here")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["keep_doc"], r["copies"], r["kept"]) for r in line_components(df).collect()), key=str)
    assert got == sorted([(None, 4, 4, False)] * 2 + [(4, 4, 4, True)] * 2, key=str)
    assert line_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lines_run_without_python(spark):
    df = spark.createDataFrame(line_rows(), "doc_id long, text string")
    plan = line_components(df)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_rows_with_one_id_lose_their_own_lines(spark):
    one = lambda i: f"{i * 7919 % 1000003} only line {'abcdefghij'[i] * 12} stands here"
    same = "this line stands in several documents"
    rows = [(1, f"{same}\n{one(0)}"), (None, f"{same}\n{one(1)}"), (None, f"{one(2)}\n{one(3)}"), (None, f"{one(4)}\n{same}"),
            (5, f"{same}\n{one(5)}"), (5, f"{one(6)}\n{one(7)}"), (5, f"{one(6)}\n{one(7)}"), (None, None)]
    got = sorted(drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    left = [(i, t and "\n".join(x for x in t.split("\n") if x != same or i == 1)) for i, t in rows]
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted(spark.createDataFrame(left, "doc_id long, text string").collect(), key=str)]


@pytest.mark.parametrize("both, either", [(4, 5), (8, 10)])
def test_short_near_copies_are_linked(spark, both, either):
    rng = np.random.default_rng(either)
    rows = []
    for i in range(4000):
        w = [f"w{x}" for x in rng.integers(0, 10**9, either + 3)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[: both + 3]))]
    got = near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), width=4).where("not kept").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1, 8000, 2))
    assert all(r["component_id"] == r["doc_id"] - 1 for r in got)


def test_short_lines_are_linked(spark):
    rng = np.random.default_rng(6)
    rows, sizes = [], [(4, 5), (5, 6), (8, 10), (12, 15)]
    for kind, (both, either) in enumerate(sizes):
        for i in range(2000):
            line = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), either + 7))
            rows.append((10_000 * kind + i, f"{line}\n{line[:both + 7]}"))
    missed = line_components(spark.createDataFrame(rows, "doc_id long, text string")).where("copies = 1")
    counts = {r["kind"]: r["count"] / 2 for r in missed.groupBy(F.floor(F.col("doc_id") / 10_000).alias("kind")).count().collect()}
    assert all(n <= 0.006 * 2000 for n in counts.values()), counts


def test_stored_tables_go_when_discarded(spark):
    import os

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    made = common.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "x")
    table = common.stored_by(made, "k", "y")
    assert spark.conf.get(key) == before and table.count() == made.count() == 7
    names = {r["tableName"] for r in spark.sql("show tables").collect()}
    common.discard(made, table, made.select("k"))
    left = {r["tableName"] for r in spark.sql("show tables").collect()}
    assert names - left == {table.stored_as}
    assert not any(os.path.exists(df.stored_at.removeprefix("file:")) for df in (made, table))


def test_line_check_loses_no_link(spark, monkeypatch):
    """Links by outlines and portions are those of all pairs, near the bound too."""
    rng = np.random.default_rng(12)
    rows = []
    for g in range(12):
        base = "".join(rng.choice(list("abcdefghijklmnop "), 400))
        for change in (0, 1, 2, 3, 4, 5, 7, 9, 14):
            t = list(base)
            for at in rng.choice(400, change, replace=False):
                t[at] = "#"
            rows.append((len(rows), "".join(t).strip()))
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} for _, t in rows]
    joined = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    # links far above the bound are found for sure, so components of those must not come apart
    sure = [(a, b) for a, b in joined if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    outcomes = []
    for portion in (10**6, 5):
        monkeypatch.setattr(line_dedup, "PORTION", portion)
        got = {r["doc_id"]: r["component"] for r in line_components(df).collect()}
        outcomes.append(got)
        assert all(got[a] == got[b] for a, b in sure)
        want = classes(len(rows), joined)
        assert all(want[a] == want[b] for a, b in itertools.combinations(range(len(rows)), 2) if got[a] == got[b])
    assert outcomes[0] == outcomes[1]


def test_outlines_leave_every_pair_of_the_similarity(spark):
    """Repeated shingles count in n, and must not make a pair look less like than it is."""
    texts = ["ab" * 60, "ab" * 50, "x" * 90, "x" * 8, "abc" * 40 + "q", "abc" * 30, "", "short", "the quick brown fox jumps over it", "the quick brown fox jumps over it."]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string").select("id", F.encode("line", "UTF-16BE").alias("u"))
    full = line_dedup._minima(lines, 1, 8, outline=True).join(lines.select("id", (line_dedup._last(8) + 1).alias("n")), "id")
    x, y = full.alias("x"), full.alias("y")
    left = {(r[0], r[1]) for r in x.crossJoin(y).where(line_dedup._within_reach(80)).select("x.id", "y.id").collect()}
    sets = [{t[i : i + 8] for i in range(max(1, len(t) - 7))} for t in texts]
    for a, b in itertools.product(range(len(texts)), repeat=2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            assert (a, b) in left
    # lines without repeated shingles are told apart
    assert (8, 2) not in left and (8, 4) not in left
