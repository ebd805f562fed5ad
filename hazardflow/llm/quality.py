"""Quality scores from compression against dictionaries of good and bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import remainder

#: Most labelled documents per class that the fit draws, and bytes it takes from each of them.
PER_CLASS, PER_DOCUMENT = 2000, 2048
DICTIONARY, BLOCK, LEVEL = 112_640, 1024, 3
#: Text sizes at which the calibration changes: a few bytes compress to much the same either way.
LENGTHS = (64, 256)


@dataclass
class Model:
    """Two dictionaries, and for each class of text sizes a rising line that turns a size
    difference into a probability."""

    good: bytes
    bad: bytes
    lines: list[tuple[np.ndarray, np.ndarray]]

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for data in (self.good, self.bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))
        return tuple(out)

    def score(self, difference: float, size: int) -> float:
        return float(np.interp(difference, *self.lines[np.searchsorted(LENGTHS, size, side="right")]))


def difference(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor, block: int = BLOCK) -> float:
    """How much smaller the whole text gets with the good dictionary than with the bad one, over
    its own size; 0 for an empty text. Blocks are compressed apart, so that the dictionaries decide
    and not what a long text has said before. Text that compresses by itself, as it repeats, gets
    a difference near 0 and so far from good text."""
    a = b = 0
    for i in range(0, len(text), block):
        part = text[i : i + block]
        a += len(good.compress(part))
        b += len(bad.compress(part))
    return (b - a) / len(text) if text else 0.0


def train(texts: list[bytes], labels: list[int], weights: tuple[float, float] = (1.0, 1.0), seed: int = 3) -> Model:
    """Dictionaries from one half of the sample, calibration on the other half. `weights`: how many
    labelled rows one of the sample stands for, for label 0 and label 1."""
    first = np.random.default_rng(seed).random(len(texts)) < 0.5
    parts = {}
    for label in (0, 1):
        own = [t[i : i + BLOCK] for t, y, f in zip(texts, labels, first) if y == label and f for i in range(0, len(t), BLOCK)]
        parts[label] = _dictionary(own)
    even = (np.zeros(1), np.full(1, 0.5))
    model = Model(parts[1], parts[0], [even] * (len(LENGTHS) + 1))
    good, bad = model.compressors()
    rest = [(t, y) for t, y, f in zip(texts, labels, first) if not f]
    if rest:
        x = np.array([difference(t, good, bad) for t, _ in rest])
        y = np.array([v for _, v in rest])
        share = np.array(weights)
        overall = float((share[y] * y).sum() / share[y].sum())
        kind = np.searchsorted(LENGTHS, [len(t) for t, _ in rest], side="right")
        for k in range(len(model.lines)):
            # the other sizes' differences say nothing about this size: without rows, the share of good
            own = kind == k
            model.lines[k] = calibrate(x[own], y[own], share[y[own]]) if own.sum() >= 10 else (np.zeros(1), np.full(1, overall))
    return model


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        # too little text to train on: the text itself serves
        return b"".join(samples)[-DICTIONARY:] or b" " * 8


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, least: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of labels on differences: groups of `least` neighbours and more, merged
    until their shares of good rise, each with one pseudo-row at the overall share; the line
    between the groups' means."""
    order = np.argsort(x, kind="stable")
    overall = float((weight * y).sum() / weight.sum())
    groups = [[weight[p].sum(), (weight * x)[p].sum(), (weight * y)[p].sum()] for p in np.array_split(order, max(1, len(order) // least))]
    rising: list[list[float]] = []
    for g in groups:
        rising.append(g)
        while len(rising) > 1 and rising[-2][2] / rising[-2][0] >= rising[-1][2] / rising[-1][0]:
            last = rising.pop()
            rising[-1] = [a + b for a, b in zip(rising[-1], last)]
    n, total, good = (np.array(c, float) for c in zip(*rising))
    return total / n, np.maximum.accumulate((good + overall) / (n + 1))


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bounded stretch of each sampled text, from its middle, for the dictionaries."""
    for batch in batches:
        out = []
        for text in batch.column("text").cast(pa.binary()):
            data = text.as_py()
            at = max(0, len(data) - PER_DOCUMENT) // 2
            out.append(data[at : at + PER_DOCUMENT])
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.binary())], names=["label", "part"])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
        modulus: int = 5, held: int = 0) -> Model | None:
    """Train on labelled rows whose crc32(id as text) % `modulus` is not `held`.

    Ids are drawn by a hash at one rate per label, so that about `PER_CLASS` of each are expected,
    and only they are looked up in the documents: at most some 2 x `PER_CLASS` ids are broadcast,
    and the documents don't shuffle. Labels other than 0 and 1, and ids with both, are left out.
    None without labelled text of both kinds."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label_column).cast("int").alias("label")).where(
        "label in (0, 1) and id is not null"
    )
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    known = known.where((F.crc32(F.col("id").cast("string").cast("binary")) % modulus) != held).select("id", "label")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(1_000_000))
    rates = {label: min(1_000_000, -(-PER_CLASS * 1_000_000 // n)) for label, n in counts.items()}
    drawn = known.where(draw < F.when(F.col("label") == 1, rates[1]).otherwise(rates[0])).limit(4 * PER_CLASS)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where("text is not null")
    found = rows.join(F.broadcast(drawn), "id").select("label", "text").mapInArrow(_heads, "label int, part binary")
    sample = sorted((r["label"], bytes(r["part"])) for r in found.limit(8 * PER_CLASS).collect())
    if len({label for label, _ in sample}) < 2:
        return None
    weights = (1e6 / rates[0], 1e6 / rates[1])
    return train([t for _, t in sample], [label for label, _ in sample], weights)


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors() if model else None
        for batch in batches:
            scores = []
            for text in batch.column("text").cast(pa.binary()):
                data = text.as_py() or b""
                scores.append(model.score(difference(data, *pair), len(data)) if pair else 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
            threshold: float = 0.3, modulus: int = 5, held: int = 0) -> DataFrame:
    """Score every whole text: doc_id, held_out, score (chance of label 1), predicted (1 from
    `threshold` on), one row per input row.

    A dictionary is trained on good and one on bad text. Each block of a text is compressed with
    both; the difference of the summed sizes over the text's size is calibrated against labels on
    the half of the sample that the dictionaries have not seen. Only labelled rows that are not
    held out teach; language, source, labels and id are no inputs of a score.

    Null counts as empty; empty texts get the calibrated score of no difference. Without labels of
    both kinds all scores are 0.5. Rows with a null id are not held out; repeated rows are each
    scored. Empty input gives no rows; other columns are not read.
    """
    model = fit(docs, labels, id_column, text_column, label_column, modulus, held)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    scored = rows.mapInArrow(_score(model), "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
