"""Repeated passages against a plain reading of the rule."""

import re

import numpy as np
import pytest

from hazardflow.llm.substring_dedup import spans, substring_dedup


def words_of(n, seed):
    return [f"w{seed}x{i}" for i in range(n)]


def test_runs_do_not_depend_on_place():
    passage = ("Alpha beta gamma delta. Epsilon zeta eta theta iota kappa. Lambda mu nu xi omicron pi rho. " * 1).encode()
    a = spans(passage * 2, 3, 16, 10)
    b = spans(b"Something else stands before. " + passage, 3, 16, 10)
    assert set(b.run_hash) & set(a.run_hash)
    upper = spans(passage.upper(), 3, 16, 10)
    assert set(upper.run_hash) == set(spans(passage, 3, 16, 10).run_hash)


def test_words_and_sentences_match_split():
    text = "One two  three.\nfour \"five!\" six? seven\x0beight é.\n\n".encode()
    x = spans(text, 3, 2, 2**62)
    assert len(x.starts) == len(text.split())
    sentences = [s.split() for s in re.split(rb"(?<=[.!?])\s|(?<=!\")\s|\n", text) if s.split()]
    assert [int(b - a) for a, b in zip(x.first, x.stop)] == [len(s) for s in sentences]


def test_long_words_cross_blocks():
    import hazardflow.llm.hashing as m

    text = b"ab " + b"x" * 50 + b" cd ef gh " + b"y" * 33
    whole = m.words(text)
    old, m._BLOCK = m._BLOCK, 8
    try:
        cut = m.words(text)
    finally:
        m._BLOCK = old
    for a, b in zip(whole, cut):
        assert a.tolist() == b.tolist()


def test_passage_goes_everywhere_but_first(spark):
    passage = " ".join(words_of(60, "p"))
    rows = [(i, " ".join(words_of(40, f"a{i}")) + " " + passage + " " + " ".join(words_of(40, f"b{i}")), "x") for i in range(4)]
    rows += [(10, None, "x"), (11, "", "x"), (None, passage, "x"), (12, "short. text.", "x"), (13, "Short. text.", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in substring_dedup(df).collect()}
    assert len(got) == 9
    assert got[0]["n_removed"] == 0 and got[0]["text"] == rows[0][1]
    for i in (1, 2, 3, None):
        text = rows[i][1] if i else passage
        kept = got[i]["text"].split()
        assert [w for w in kept if "p" not in w[1:2]] == [w for w in text.split() if "p" not in w[1:2]]
        assert sum("wp" in w for w in kept) <= 30
        back, at = b"", 0
        for s in got[i]["spans"]:
            back += text.encode()[at : s["start"]]
            at = s["end"]
        assert (back + text.encode()[at:]).decode() == got[i]["text"]
    assert got[10]["text"] is None and got[11]["text"] == "" and got[13]["n_removed"] == 0


def test_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    pool = [" ".join(f"t{rng.integers(50)}" for _ in range(rng.integers(3, 9))) + "." for _ in range(60)]
    docs = [(int(i), " ".join(pool[j] for j in rng.integers(0, 60, rng.integers(0, 30)))) for i in range(40)]
    docs[7] = (7, docs[3][1])
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(spark.createDataFrame(docs, "doc_id long, text string"), cut=2**62).collect()}
    first, seen = {}, {}
    for i, text in docs:
        sents = [s.split() for s in re.findall(r"[^.]+\.", text)]
        for a in range(len(sents)):
            b = a
            while b < len(sents) and (b - a < 3 or sum(map(len, sents[a:b])) < 16):
                b += 1
            if b - a >= 3 and sum(map(len, sents[a:b])) >= 16:
                key = tuple(w for s in sents[a:b] for w in s)
                seen.setdefault(i, []).append((a, b, key))
                first.setdefault(key, (i, a))
    for i, _ in docs:
        out = {k for a, b, key in seen.get(i, []) if first[key] != (i, a) for k in range(a, b)}
        assert got[i] == len(out)


def test_empty(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("punctuated", [True, False])
@pytest.mark.parametrize("size", [51, 60, 80])
def test_passages_inside_other_text(spark, size, punctuated):
    rng = np.random.default_rng(size)

    def text(n):
        ends = rng.random(n) < (0.1 if punctuated else 0)
        return " ".join(f"t{rng.integers(10**6)}" + "." * int(e) for e in ends)

    docs = []
    for i in range(150):
        passage = text(size)
        docs += [(2 * i + k, f"{text(rng.integers(1, 40))} {passage} {text(rng.integers(1, 40))}") for k in range(2)]
    got = {r["doc_id"]: r["words_removed"] for r in substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[2 * i] == 0 and size / 2 < got[2 * i + 1] <= size for i in range(150))
    assert sum(got.values()) >= 0.9 * 150 * size
