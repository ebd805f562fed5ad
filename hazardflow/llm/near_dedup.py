"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import active_buckets, by_number, linked_buckets, stored
from hazardflow.llm.hashing import scramble, words

BANDS, ROWS = 32, 4
#: Minima of a candidate's signature.
FUNCTIONS = 1024
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z count as lower case. A text with
    fewer words than the width is one shingle; a text without words has none."""
    h = words(text)[2] if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = scramble(out + h[i : len(h) - n + 1 + i] * _MULTIPLY)
    return np.unique(out)


def _constants(count: int) -> np.ndarray:
    return scramble(np.arange(1, count + 1, dtype=np.uint64) * _MULTIPLY)


def minima(items: np.ndarray, constants: np.ndarray, step: int = 2048) -> np.ndarray:
    """The minimum of each hash function over a shingle set, in blocks of bounded size. The
    functions multiply the mixed hashes by odd constants."""
    best = np.full(len(constants), np.iinfo(np.uint64).max, np.uint64)
    odd = (constants | np.uint64(1))[:, None]
    for i in range(0, len(items), step):
        np.minimum(best, (items[None, i : i + step] * odd).min(axis=1), out=best)
    return best


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        constants = _constants(BANDS * ROWS)
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
        for batch in batches:
            texts, rows = batch.column("text").cast(pa.binary()), []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts):
                s = shingles(text.as_py(), width)
                if not len(s):
                    rows.append((doc, 0, None, None, None))
                    continue
                digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                band = np.arange(1, BANDS + 1, dtype=np.uint64)
                for r in minima(s, constants).reshape(BANDS, ROWS).T:
                    band = scramble(band * _MULTIPLY + r)
                rows.append((doc, len(s), int(digest[0]), int(digest[1]), band.view(np.int64)))
            for low in range(0, len(rows), 2000):
                columns = zip(*rows[low : low + 2000])
                names = ["doc_id", "n_shingles", "d1", "d2", "bands"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


FEATURES = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>"


def signature(items: np.ndarray) -> np.ndarray:
    """Two bits of each of `FUNCTIONS` minima, 32 of them to a word. The minima are mixed first: low
    bits of a product depend on low bits only, and would agree by chance in all functions at once."""
    low = scramble(minima(items, _constants(FUNCTIONS))) & np.uint64(3)
    packed = low.reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(packed, axis=1).view(np.int64)


def _sets(width: int):
    """Whole shingle sets and packed signatures of candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for low in range(0, batch.num_rows, 500):
                found = [shingles(t.as_py(), width) for t in texts.slice(low, 500)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(low, 500),
                        pa.array([len(s) for s in found], pa.int64()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                        pa.array([signature(s) for s in found], pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "items", "packed"],
                )

    return run


def _overlaps(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, good = batch.column("left"), batch.column("right"), []
            for i in range(batch.num_rows):
                x, y = np.frombuffer(left[i].as_py(), np.uint64), np.frombuffer(right[i].as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def estimate(left: str, right: str):
    """Similarity from packed 2-bit signatures: positions whose bits are equal, by bit counts,
    corrected for the quarter that agrees by chance."""
    differ = F.lit(0)
    for i in range(FUNCTIONS // 32):
        x = F.get(F.col(f"{left}.packed"), i).bitwiseXOR(F.get(F.col(f"{right}.packed"), i))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(either)
    return (1 - differ / FUNCTIONS - 0.25) / 0.75


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5,
               percent: int = 80, slack: float = 0.08) -> DataFrame:
    """Components of documents whose word shingle sets have a Jaccard similarity of at least
    `percent` / 100: rows (doc_id, n_shingles, component_id, kept), one per input row.

    Words are what stands between bytes 0x09-0x0D and 0x20, with A-Z lower-cased. A document's set
    holds its distinct shingles of `width` words; with fewer words, the whole sequence as one.

    Equal sets are one class with its smallest id. For each class 32 bands of 4 minima give
    candidate buckets (a pair at 0.8 is missed once in twenty million). Documents that share a
    bucket get a signature: two bits of each of 1,024 mixed minima, packed into 32 integers. Candidates
    whose corrected estimate from bit counts is more than `slack` below the limit (five standard
    deviations), or whose set sizes alone rule a link out, go; all others are confirmed on full
    sets. `linked_buckets` keeps the pairs per bucket few and loses no link that could join two
    components.

    Texts that are null or have no word are linked with nothing: component_id is their own id. Rows
    without an id get no component and are kept. Rows that share an id count as one document in
    links. Empty input gives no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    features = stored(texts.mapInArrow(_features(width), FEATURES), "features")
    usable = features.where("n_shingles > 0 and doc_id is not null")
    classes = stored(usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("class")), "classes")
    heads = features.join(classes.select(F.col("class").alias("doc_id")).distinct(), "doc_id", "left_semi").where("n_shingles > 0")
    active = stored(active_buckets(heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))), "buckets")
    wanted = active.select("id").distinct()
    bands = features.where("n_shingles > 0").select(F.col("doc_id").alias("id"), F.col("bands").alias("buckets"))
    sets = stored(
        texts.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")
        .mapInArrow(_sets(width), "id bigint, n_shingles bigint, items binary, packed array<bigint>"),
        "sets",
    )
    signatures = stored(
        sets.select("id", "n_shingles", "packed").where("n_shingles > 0").join(bands.join(wanted, "id", "left_semi"), "id"), "signatures"
    )

    def close(x: str, y: str):
        a, b = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        return (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (estimate(x, y) >= percent / 100 - slack)

    def verify(near: DataFrame) -> DataFrame:
        full = (
            near.join(sets.select(F.col("id").alias("b"), F.col("items").alias("right")), "b")
            .join(sets.select(F.col("id").alias("a"), F.col("items").alias("left")), "a")
        )
        return full.mapInArrow(_overlaps(percent), "a bigint, b bigint").distinct()

    of_class = linked_buckets(active, verify, signatures, close)
    # Rows without a set get a key of their own, so that they meet in no one task.
    spread = F.xxhash64("doc_id", F.lit(1))
    named = features.select("doc_id", "n_shingles", F.coalesce("d1", spread).alias("d1"), F.coalesce("d2", F.lit(0)).alias("d2"))
    final = classes.join(of_class.select(F.col("id").alias("class"), "component"), "class", "left").select(
        "d1", "d2", F.coalesce("component", "class").alias("component")
    )
    out = named.join(final, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The input rows, all columns kept, without the documents that `near_dedup` drops. An id goes
    only if no row with it is kept; rows with a null id stay. Null and blank texts are like no other
    and stay. An empty table gives no rows. Columns of any name are kept."""
    names = docs.columns
    docs, (id_column, text_column) = by_number(docs, id_column, text_column)
    decided = near_dedup(docs, id_column, text_column, **options)
    gone = decided.groupBy(F.col("doc_id").alias("_gone_id")).agg(F.max("kept").alias("_kept")).where("not _kept").select("_gone_id")
    return docs.join(gone, F.col(id_column) == F.col("_gone_id"), "left_anti").toDF(*names)
