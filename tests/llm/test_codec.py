"""Segmentation against all segmentations, chunks against whole texts, and round trips."""

import itertools
import random

import numpy as np
import pytest

from hazardflow.llm.sentencepiece_codec import Chunk, Lattice, decode, encode, max_plus, scan
from hazardflow.llm.vocabulary import Vocabulary, load_vocabulary
from tests.conftest import SF_DIR


def small(cuts=True):
    """A vocabulary with many ties and overlapping pieces."""
    pieces = ["a", "b", "ab", "ba", "aa", "aba", "abab", "▁", "▁a", "▁ab", "▁▁", "c"] + ([] if cuts else ["a▁b"])
    logs = [-2.0, -2.0, -3.0, -3.0, -4.0, -4.5, -5.0, -1.0, -2.5, -3.0, -2.0, -6.0, -3.0][: len(pieces)]
    size = len(pieces)
    return Vocabulary(
        {p: i for i, p in enumerate(pieces)}, logs + [-9.0] * 256, [size + b for b in range(256)],
        [p.replace("▁", " ").encode() for p in pieces] + [bytes([b]) for b in range(256)], 4, cuts,
    )


def all_ways(lattice, text):
    """Every segmentation of a marked text with its score."""
    if not text:
        return [(0, [])]
    out = []
    for j in range(1, min(len(text), lattice.reach) + 1):
        piece = lattice.ids.get(text[:j])
        ids = [piece] if piece is not None else lattice.vocabulary.fallback(text[0]) if j == 1 else None
        if ids is not None:
            score = sum(lattice.score[i] for i in ids)
            out += [(score + s, ids + rest) for s, rest in all_ways(lattice, text[j:])]
    return out


@pytest.mark.parametrize("cuts", [True, False])
def test_best_of_all_segmentations(cuts):
    lattice = Lattice(small(cuts))
    for n in range(1, 6):
        for text in map("".join, itertools.product("abcé ", repeat=n)):
            ids = lattice.encode(text)
            best = max(all_ways(lattice, lattice.vocabulary.mark(text)))[0]
            assert sum(lattice.score[i] for i in ids) == best
            assert lattice.vocabulary.decode(ids) == text


def chunked(lattice, text, size):
    """The parallel scan by hand, as the operator does it over rows."""
    marked, reach = lattice.vocabulary.mark(text), lattice.reach
    starts = list(range(0, len(marked), size))
    if len(starts) > 1 and len(marked) - starts[-1] < reach:
        starts.pop()
    chunks = []
    for no, at in enumerate(starts):
        end = starts[no + 1] if no + 1 < len(starts) else len(marked)
        front = max(0, at - reach + 1)
        chunks.append(Chunk(lattice, marked[front:end], at - front))
    entries = [m[0].tolist() for m in scan([c.matrix() for c in chunks])]
    state, exits = 0, []
    for c, e in reversed(list(zip(chunks, entries))):
        exits.append(state)
        state = c.came_from(e)[state]
    assert state == 0
    return [i for c, e, x in zip(chunks, entries, reversed(exits)) for i in c.ids(e, x)]


@pytest.mark.parametrize("cuts", [True, False])
@pytest.mark.parametrize("size", [4, 5, 7, 16])
def test_chunks_change_nothing(cuts, size):
    lattice, rng = Lattice(small(cuts)), random.Random(size)
    for _ in range(150):
        text = "".join(rng.choice("aabbb c\né" if rng.random() < 0.5 else "ab") for _ in range(rng.randrange(1, 60)))
        assert chunked(lattice, text, size) == lattice.encode(text)


def test_chunks_with_the_real_vocabulary():
    lattice = Lattice(load_vocabulary())
    text = "the quick brown fox\njumps over ▁ the lazy dog " + "x" * 200 + "supercalifragilistic" * 12 + "   wide   gaps é日本語 "
    for size in (16, 33, 100):
        assert chunked(lattice, text, size) == lattice.encode(text)


def test_max_plus_is_associative():
    rng = np.random.default_rng(0)
    a, b, c = (rng.integers(-50, 0, (5, 5)) for _ in range(3))
    assert (max_plus(max_plus(a, b), c) == max_plus(a, max_plus(b, c))).all()
    assert [m.tolist() for m in scan([a, b, c])][2] == max_plus(a, b).tolist()


def test_scores_equal_the_library(tmp_path):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    from hazardflow.llm.vocabulary import MODEL

    vocabulary = load_vocabulary()
    proto = pb.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = 1
    for i, p in enumerate(proto.pieces):
        if p.type == 1:
            p.score = vocabulary.logs[i]
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    lattice = Lattice(vocabulary)
    for text in ("Hello world", "internationalisation of   spaces", "das Gemüse schmeckt", "la cióna ñasga osmente", "thndreti hesh erblean"):
        ours, theirs = lattice.encode(text), model.encode(text)
        total = lambda ids: sum(vocabulary.logs[i] for i in ids)
        assert total(ours) == pytest.approx(total(theirs), abs=1e-3)


def test_operator_on_long_and_odd_texts(spark):
    rng = random.Random(4)
    long = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12))) for _ in range(400))
    texts = [long, long, "z" * 900, "", None, " ", "\n\n", "▁a ▁", "  two  gaps ", "日本語 \U0001f600\x00 é", long + "end"]
    df = spark.createDataFrame([(i, t, [1], "k") for i, t in enumerate(texts)], "doc_id long, text string, IDS array<int>, key string")
    whole = {r["doc_id"]: r["ids"] for r in encode(df).collect()}
    parts = encode(df, chunk=100, check_column="Key")
    assert parts.columns == ["doc_id", "text", "ids", "Key"]
    assert parts.where("not Key").count() == 0
    assert {r["doc_id"]: r["ids"] for r in parts.collect()} == whole
    back = {r["doc_id"]: (r["text"], r["decoded"]) for r in decode(parts).collect()}
    assert all(a == b for a, b in back.values()) and len(back) == len(texts)
    assert whole[3] == [] and whole[4] is None
    assert encode(df.limit(0)).count() == 0


def test_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = decode(encode(docs, chunk=3000))
    assert out.where("not (decoded <=> text)").count() == 0 and out.count() == docs.count()
