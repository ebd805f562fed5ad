"""Likelihood of texts over all subword segmentations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import remainder, stored
from hazardflow.llm.vocabulary import LITERAL, MARK, MODEL, Vocabulary, load_vocabulary

_LN10 = math.log(10)
CHUNK_BYTES = 32 << 20


class Lattice:
    """All segmentations of marked words under piece log probabilities."""

    def __init__(self, vocabulary: Vocabulary, logs: list[float]):
        self.vocabulary, self.logs = vocabulary, logs
        self.value = {piece: logs[i] for piece, i in vocabulary.ids.items()}
        # the longest piece that starts with two characters bounds the look-up there
        self.reach: dict[str, int] = {}
        for piece in vocabulary.ids:
            self.reach[piece[:2]] = max(self.reach.get(piece[:2], 1), len(piece))

    def forward(self, word: str, edges: list | None = None) -> list[float]:
        """Log probability of reaching each position, summed over all segmentations before it, by
        one pass in log space; `edges` gets (start, end, log score) of every piece that fits."""
        n, value, reach = len(word), self.value, self.reach
        exp, log = math.exp, math.log
        arriving: list[list[float]] = [[] for _ in range(n + 1)]
        arriving[0].append(0.0)
        alpha = []
        for i in range(n + 1):
            terms = arriving[i]
            here = terms[0]
            if len(terms) > 1:
                here = max(terms)
                total = 0.0
                for x in terms:
                    total += exp(x - here)
                here += log(total)
            alpha.append(here)
            if i == n:
                break
            s = value.get(word[i])
            if s is None:
                s = sum(self.logs[b] for b in self.vocabulary.fallback(word[i]))
            arriving[i + 1].append(here + s)
            if edges is not None:
                edges.append((i, i + 1, s))
            for j in range(i + 2, min(n, i + reach.get(word[i : i + 2], 1)) + 1):
                s = value.get(word[i:j])
                if s is not None:
                    arriving[j].append(here + s)
                    if edges is not None:
                        edges.append((i, j, s))
        return alpha

    def expect(self, word: str, count: float, uses: list[float]) -> None:
        """Add the expected uses of each piece in `count` times the word: the share of all
        probability that goes through a position, carried back over the edges."""
        edges: list[tuple[int, int, float]] = []
        alpha = self.forward(word, edges)
        share = [0.0] * len(alpha)
        share[-1] = count
        ids, exp = self.vocabulary.ids, math.exp
        # backwards by start: whatever starts at a position is done before what ends there
        for i, j, s in reversed(edges):
            if share[j] > 0.0:
                part = share[j] * exp(alpha[i] + s - alpha[j])
                share[i] += part
                piece = ids.get(word[i:j])
                if piece is not None:
                    uses[piece] += part
                else:
                    for b in self.vocabulary.fallback(word[i]):
                        uses[b] += part


def marked(word: str) -> str:
    return MARK + word.replace(MARK, LITERAL)


def _expected(vocabulary: Vocabulary, logs: list[float]):
    """Expected uses of each piece in words (word, c), one row per piece and partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, uses = Lattice(vocabulary, logs), [0.0] * len(logs)
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist()):
                if c:
                    lattice.expect(marked(word), float(c), uses)
        used = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(np.array(uses)[used])], names=["piece", "uses"])

    return run


def _marginals(vocabulary: Vocabulary, logs: list[float]):
    """Natural log probability of each word, over all its segmentations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, logs)
        for batch in batches:
            values = [lattice.forward(marked(w))[-1] for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("c"), pa.array(values, pa.float64())], names=["word", "c", "lp"])

    return run


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _count(table: pa.Table) -> pa.Table:
    """Distinct words of one chunk of documents, with their counts in training documents."""
    seen: Counter = Counter()
    known: Counter = Counter()
    texts = table.column("text").cast(pa.binary())
    for text, held in zip(texts, table.column("held_out")):
        (seen if held.as_py() else known).update(_words(text.as_py()))
    words = list(known) + [w for w in seen if w not in known]
    counts = [known[w] for w in words]
    chunk = table.column("chunk")[0].as_py()
    return pa.table({"chunk": pa.array([chunk] * len(words), pa.int64()), "word": pa.array(words, pa.binary()).cast(pa.string()), "c": pa.array(counts, pa.int64())})


def _score(vocabulary_end: float, end_known: bool):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        index = {w: i for i, w in enumerate(words.column("word").cast(pa.binary()).to_pylist())}
        counts = words.column("c").to_numpy()
        base, lp = np.log10(counts + 1.0), words.column("lp").to_numpy()
        columns: dict[str, list] = {k: [] for k in ("doc_id", "held_out", "n_tokens", "n_known", "log_counts", "score")}
        ids, held, texts = docs.column("doc_id"), docs.column("held_out"), docs.column("text").cast(pa.binary())
        for i in range(len(docs)):
            at = np.array([index[w] for w in _words(texts[i].as_py())], np.int64)
            columns["doc_id"].append(ids[i].as_py())
            columns["held_out"].append(held[i].as_py())
            columns["n_tokens"].append(len(at) + 1)
            columns["n_known"].append(int((counts[at] > 0).sum()) + end_known)
            columns["log_counts"].append(float(base[at].sum()))
            columns["score"].append((float(lp[at].sum()) + vocabulary_end) / _LN10)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), kinds)})

    return run


def lm_score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", modulus: int = 7, held: int = 2,
             rounds: int = 1, model: str = MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Score each whole text under a subword lattice: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (both log10), one row per input row.

    A-Z are lower-cased, words are what ASCII white space parts, and an end follows each text.
    Rows with crc32(id as text) % `modulus` = `held` are held out, the others train. `base_score`
    is the add-one unigram model of whole words.

    `score` is the log10 probability of the words' spellings and the end under a unigram model of
    the vocabulary file's pieces, summed over all segmentations: per word a forward recursion in
    log space, and as no piece crosses a space, the sum of words' logs is the text's. The file's
    own scores weight the segmentations at first; `rounds` passes over all training words (each
    distinct word once, times its count) then set a piece's probability to its expected share of
    uses, with the file's probabilities as one pseudo-count per piece.

    Null text is empty: its score is that of the end. Rows with a null id train. Without training
    rows the file's scores stand. Repeated rows count and are scored each. Empty input gives no
    rows; other columns are not read.

    Documents are dealt into chunks of about `chunk_bytes` by a hash. A chunk sends each distinct
    word once, so a word in every document costs one row per chunk; the words' counts and logs
    come back to the chunk, and its documents are scored against them. Only sums per piece of the
    vocabulary reach the driver.
    """
    vocabulary = load_vocabulary(model)
    if not vocabulary.cuts:
        raise ValueError("this vocabulary has pieces that cross words")
    held_out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn("held_out", held_out)
    size, rows, training = plain.agg(F.sum(F.octet_length("text")), F.count("*"), F.sum((~F.col("held_out")).cast("long"))).first()
    training = training or 0
    chunks = max(1, -(-(size or 0) // chunk_bytes))
    dealt = plain.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    words = stored(dealt.groupBy("chunk").applyInArrow(_count, "chunk bigint, word string, c bigint"), "chunk-words")
    counted = stored(words.groupBy("word").agg(F.sum("c").alias("c")), "words")
    total, distinct = counted.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long"))).first()
    train_tokens = (total or 0) + training
    v = (distinct or 0) + (training > 0)

    logs, end = list(vocabulary.logs), -math.log(len(vocabulary.logs))
    prior = np.exp(np.array([x if x > float("-inf") else -1e9 for x in logs]))
    for _ in range(rounds if training else 0):
        used = counted.mapInArrow(_expected(vocabulary, logs), "piece bigint, uses double")
        found = used.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses = prior * len(prior)
        for row in found:
            uses[row["piece"]] += row["uses"]
        whole = uses.sum() + training
        with np.errstate(divide="ignore"):
            logs = np.log(uses / whole).tolist()
        end = math.log(training / whole)

    looked_up = counted.mapInArrow(_marginals(vocabulary, logs), "word string, c bigint, lp double")
    back = words.select("chunk", "word").join(looked_up, "word")
    scored = (
        dealt.groupBy("chunk").cogroup(back.groupBy("chunk"))
        .applyInArrow(_score(end, training > 0), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, score double")
    )
    log_all = math.log10(train_tokens + v + 1)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + F.lit(math.log10(training + 1)) - F.col("n_tokens") * F.lit(log_all)).alias("base_score"),
        "score",
    )
