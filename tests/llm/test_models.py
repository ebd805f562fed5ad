"""Learned scores: held-out accuracy, brute force where there is one, and odd rows."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from hazardflow.llm import langid
from hazardflow.llm.lm_score import Lattice, lm_score, marked
from hazardflow.llm.quality import calibrate, difference, quality, train
from hazardflow.llm.vocabulary import load_vocabulary
from tests.conftest import SF_DIR

SF_MORE = SF_DIR.replace("sf0.001", "sf0.01")


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_MORE}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.predict(docs).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_numeric_signs_are_no_letters(spark):
    rows = [(i, ("der die und nicht " if i % 2 else "the and with that ") * 20, "de" if i % 2 else "en") for i in range(20)]
    rows += [(100, "½ ²", "en"), (101, "Ⅷ ① 12", "en"), (102, "ж ½", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df).collect()}
    assert got[100] == got[101] == "und" and got[102] != "und"


def test_language_cases(spark):
    rows = [(i, ("der die und nicht " if i % 2 else "the and with that ") * 40, "de" if i % 2 else "en", "s") for i in range(60)]
    rows += [(100, None, "de", "s"), (101, "", "en", "s"), (102, "123 ... \n", "en", "s"), (None, "the and with " * 9, None, None), (104, "und der nicht " * 9000, None, "s")]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, source string, LANG_SCORE double, _text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["held_out"]) for r in langid.predict(df).collect()}
    assert [got[i][0] for i in (100, 101, 102)] == ["und"] * 3 and got[100][1] == 0
    assert got[None][0] == "en" and got[None][2] is False and got[104][0] == "de"
    told = langid.identify(df, langid.fit(df))
    assert told.columns == ["doc_id", "text", "lang", "source", "_text", "lang_pred", "lang_score"]
    assert {r["lang_pred"] for r in langid.predict(df.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}
    assert langid.predict(df.limit(0)).count() == 0


def test_network_answers_equal_convolution():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 256, (3, 40)).astype(np.uint8)
    net = langid.train(rows, np.array([0, 1, 0]), ["a", "b"], epochs=1)
    pooled, _ = net.pooled(net.tables(), rows)
    at = 0
    for f in net.filters:
        w = len(f)
        for r in range(3):
            answers = [sum(net.embed[rows[r, p + k]] @ f[k] for k in range(w)) for p in range(40 - w + 1)]
            assert np.allclose(pooled[r, at : at + langid.FILTERS], np.max(answers, axis=0), atol=1e-4)
        at += langid.FILTERS


def test_windows_cover_the_text():
    text = "Ab9é" * 100
    assert langid.windows(text, 64).tobytes().decode().rstrip().split() == text.lower().replace("9", " ").split()


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.where("doc_id < 4000")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality(some, labels).collect()
    assert len(got) == 4000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.93 * len(held)


def test_quality_cases(spark):
    rows = [(i, ("Some good running text about things, number %d. " % i if i % 3 else "xx | yy | zz %d | " % i) * 20) for i in range(200)]
    rows += [(300, None), (301, ""), (None, "Some good running text about things."), (301, "")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)] + [(5, 0), (None, 1), (300, 1), (400, None)], "doc_id long, quality int")
    got = quality(docs, labels).collect()
    assert len(got) == len(rows)
    assert sum(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 200) > 180
    assert {r["score"] for r in quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality(docs.limit(0), labels).count() == 0


def test_calibration_rises():
    rng = np.random.default_rng(1)
    x = rng.normal(size=500)
    y = (x + rng.normal(size=500) > 0).astype(int)
    at, chance = calibrate(x, y, np.ones(500))
    assert (np.diff(at) > 0).all() and (np.diff(chance) >= 0).all() and 0 < chance[0] < 0.3 < 0.7 < chance[-1] < 1
    model = train([b"good text here " * 9, b"bad | bad | "] * 30, [1, 0] * 30)
    assert difference(b"", *model.compressors()) == 0.0


def brute_log(lattice, word):
    """Log of the sum over all segmentations, spelled out."""
    def ways(rest):
        if not rest:
            yield 0.0
            return
        for j in range(1, len(rest) + 1):
            piece = lattice.value.get(rest[:j])
            if piece is None and j == 1:
                piece = sum(lattice.logs[b] for b in lattice.vocabulary.fallback(rest[0]))
            if piece is not None:
                for s in ways(rest[j:]):
                    yield piece + s
    return math.log(sum(math.exp(s) for s in ways(word)))


def test_marginal_is_the_sum_over_segmentations():
    vocabulary = load_vocabulary()
    lattice = Lattice(vocabulary, vocabulary.logs)
    for word in ("a", "the", "thereof", "ñandú", "xqzj", "日本", "in▁to", "\U0001f600x"):
        assert lattice.forward(marked(word))[-1] == pytest.approx(brute_log(lattice, marked(word)))
    uses = [0.0] * len(vocabulary.logs)
    lattice.expect(marked("there"), 3.0, uses)
    spelled = sum(u * len(t) for u, t in zip(uses, vocabulary.texts) if t)
    assert spelled == pytest.approx(3 * len(" there"))


def test_scores_against_plain_reading(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + [(5000, None), (5001, ""), (None, "the x\x0bTHE")]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, chunk int, word string")
    got = lm_score(df, chunk_bytes=100_000).collect()
    split = lambda t: (t or "").encode().lower().decode().replace("\x1c", "?").split()
    words = {i: [w.decode() for w in (t or "").encode().lower().split()] for i, t in rows}
    train_ids = [i for i, _ in rows if i is None or crc(i, 7) != 2]
    counts = Counter(w for i in train_ids for w in words[i])
    counts[None] = len(train_ids)
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    del split
    for r in got:
        tokens = words[r["doc_id"]] + [None]
        assert r["held_out"] == (r["doc_id"] is not None and crc(r["doc_id"], 7) == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total)
        want = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        assert r["base_score"] == pytest.approx(want, rel=1e-9)
    # the score is that of the words under one set of piece probabilities
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[5000] == by[5001] < 0
    again = {r["doc_id"]: r["score"] for r in lm_score(df, chunk_bytes=10**9).collect()}
    assert all(again[i] == pytest.approx(by[i], rel=1e-9) for i in by)
    untrained = lm_score(df.where("doc_id = 9"), rounds=1)
    assert untrained.count() == 1


def test_score_without_training_rounds(spark):
    vocabulary = load_vocabulary()
    lattice = Lattice(vocabulary, vocabulary.logs)
    df = spark.createDataFrame([(1, "There and there"), (2, "There and there")], "doc_id long, text string")
    got = lm_score(df, rounds=0).collect()
    want = (sum(lattice.forward(marked(w))[-1] for w in ("there", "and", "there")) - math.log(len(vocabulary.logs))) / math.log(10)
    assert [r["score"] for r in got] == [pytest.approx(want)] * 2
    assert lm_score(df.limit(0)).count() == 0


def test_more_rounds_fit_better(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = [sum(r["score"] for r in lm_score(docs, rounds=n).collect() if r["held_out"]) for n in (0, 1, 2)]
    assert held[0] < held[1] < held[2]
