"""Repeated passages: sliding spans of sentences, hashed and joined over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import stored
from hazardflow.llm.hashing import powers, scramble
from hazardflow.llm.hashing import words as word_hashes

_WORD_BASE = 0xD6E8FEB86659FD93
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True
_QUOTES = b"\"')]"
#: Longest part of a long sentence, in words.
CUT = 5


@dataclass
class Spans:
    """Sentences of a text as word ranges, and a hash for each run of sentences that fits."""

    starts: np.ndarray  # first byte of each word
    first: np.ndarray  # first word of each sentence
    stop: np.ndarray  # word after each sentence
    run_stop: np.ndarray  # sentence after the run that starts at sentence i
    run_hash: np.ndarray  # signed, one per run


def _smallest(hashes: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash (the last of equals) of every `window` words that stand in one
    sentence; `ends` marks the sentences' last words."""
    n = len(hashes) - window + 1
    if n < 1:
        return np.empty(0, np.int64)
    low, at = hashes[:n], np.arange(n)
    for k in range(1, window):
        x = hashes[k : n + k]
        at = np.where(x <= low, np.arange(k, n + k), at)
        low = np.minimum(low, x)
    before = np.concatenate([[0], np.cumsum(ends)])
    return at[before[window - 1 : n + window - 1] == before[:n]]


def spans(text: bytes, sentences: int, words: int, cut: int) -> Spans:
    starts, ends, hashes = word_hashes(text)
    n = len(starts)
    if not n:
        none = np.empty(0, np.int64)
        return Spans(starts, none, none, none, none)
    data = np.frombuffer(text, np.uint8)
    tail = ends - 1
    for _ in range(2):  # closing quotes and brackets after the sentence end
        closing = np.isin(data[tail], list(_QUOTES)) & (tail > starts)
        if not closing.any():
            break
        tail = np.where(closing, tail - 1, tail)
    boundary = _ENDS[data[tail]]
    lines = np.flatnonzero(data == 10)
    boundary[np.searchsorted(starts, lines[lines > starts[0]]) - 1] = True
    boundary[-1] = True
    boundary[_smallest(hashes, boundary, cut)] = True
    stop = np.flatnonzero(boundary) + 1
    first = np.concatenate([[0], stop[:-1]])
    up, down = powers(_WORD_BASE, n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)])
    run_stop = np.maximum(np.arange(len(first)) + sentences, np.searchsorted(stop, first + words) + 1)
    run_stop = run_stop[run_stop <= len(stop)]
    a, b = first[: len(run_stop)], stop[run_stop - 1]
    run_hash = scramble((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)).view(np.int64)
    return Spans(starts, first, stop, run_stop, run_hash)


def _emit(sentences: int, words: int, cut: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").cast(pa.binary())
            hashes, owners, held = [], [], 0
            for i, doc in enumerate(ids):
                h = np.unique(spans(texts[i].as_py() or b"", sentences, words, cut).run_hash)
                hashes.append(h)
                owners.append(np.full(len(h), doc, np.int64))
                held += len(h)
                if held > 100_000 or i == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(hashes), pa.int64()), pa.array(np.concatenate(owners), pa.int64())], names=["hash", "id"]
                    )
                    hashes, owners, held = [], [], 0

    return run


def _remove(sentences: int, words: int, cut: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = batch.column("text").cast(pa.binary()), batch.column("gone")
            cleaned, total, removed, all_words, gone_words, ranges = [], [], [], [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                x = spans(text or b"", sentences, words, cut)
                drop = np.zeros(len(x.first) + 1, np.int64)
                again = np.ones(len(x.run_hash), bool)
                again[np.unique(x.run_hash, return_index=True)[1]] = False
                if gone[i].is_valid:
                    again |= np.isin(x.run_hash, gone[i].values.to_numpy(zero_copy_only=False))
                hit = np.flatnonzero(again)
                np.add.at(drop, hit, 1)
                np.add.at(drop, x.run_stop[hit], -1)
                out = np.cumsum(drop[:-1]) > 0
                edge = np.diff(np.concatenate([[0], out.view(np.int8), [0]]))
                a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                size = len(text or b"")
                begin = x.starts[x.first[a]] if len(a) else np.empty(0, np.int64)
                after = np.concatenate([x.starts, [size]])
                end = after[x.stop[b - 1]] if len(b) else np.empty(0, np.int64)
                if len(a):
                    keep, at = [], 0
                    for s, e in zip(begin, end):
                        keep.append(text[at:s])
                        at = e
                    keep.append(text[at:])
                    text = b"".join(keep)
                cleaned.append(text)
                total.append(len(x.first))
                removed.append(int(out.sum()))
                all_words.append(len(x.starts))
                gone_words.append(int((x.stop - x.first)[out].sum()) if len(out) else 0)
                ranges.append([{"start": int(s), "end": int(e)} for s, e in zip(begin, end)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cleaned, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(all_words, pa.int64()), pa.array(gone_words, pa.int64()), pa.array(ranges, schema.field("spans").type)],
                schema=schema,
            )

    return run


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("n_words", pa.int64()),
    ("words_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
_DDL = "doc_id bigint, text string, n_sentences bigint, n_removed bigint, n_words bigint, words_removed bigint, spans array<struct<start: bigint, end: bigint>>"


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sentences: int = 3,
                    words: int = 16, cut: int = CUT) -> DataFrame:
    """Remove passages that came before: one row per input row with doc_id, text (without them),
    n_sentences, n_removed, n_words, words_removed, spans (byte ranges of the input that went).

    Sentences end at . ! ?, at a line end, and inside long ones after the word with the smallest
    hash of every `cut` words in a row: that depends on those words alone, so but for `cut` - 1 words
    at either end a passage falls into the same sentences wherever it stands, even in the middle
    of another sentence. With the defaults every passage of 40 words or more holds a whole run,
    with or without punctuation. A run starts at each sentence and
    has `sentences` sentences, or more until it has `words` words. Runs are compared by their words
    (A-Z lower-cased) through a 64-bit hash. A run's first place is the smallest doc_id that holds
    it and its first position there; sentences under any other run with that hash go.

    Later places within a document are known from the document alone, so only one row (hash, id)
    per document and run is shuffled. The smallest id of a hash is aggregated before the shuffle,
    and the rows join those of hashes with several ids, where a hot hash can be split.

    Null text stays null, empty text empty. Rows with a null id come after all others and are no
    copies of each other, nor are rows that share an id. Texts shorter than a run have none. Empty
    input gives no rows; other columns are not read.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    keyed = plain.withColumn("id", F.coalesce("doc_id", F.lit(2**63 - 1)))
    runs = keyed.select("id", "text").mapInArrow(_emit(sentences, words, cut), "hash bigint, id bigint")
    firsts = runs.groupBy("hash").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("hash", "lo")
    firsts = stored(firsts, "repeats")
    gone = runs.join(firsts, "hash").where("id > lo").groupBy("id").agg(F.collect_set("hash").alias("gone"))
    return keyed.join(gone, "id", "left").select("doc_id", "text", "gone").mapInArrow(_remove(sentences, words, cut, _SCHEMA), _DDL)
