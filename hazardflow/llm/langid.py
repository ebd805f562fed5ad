"""Language identification by a small byte convolutional network, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.llm.common import remainder

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
#: Most training documents per language, and windows per document: the bound of the fit's sample.
PER_LANGUAGE, PER_DOCUMENT = 1500, 2
# numeric signs such as fractions and Roman numerals are no letters
_LETTER = regex.compile(r"\p{L}")
# lower-case letters and all bytes over 127 as they are, the rest as a blank
_FOLD = np.array([b if b > 127 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def windows(text: str, size: int = WINDOW) -> np.ndarray:
    """All windows of a text's lower-cased bytes, one row each; the last is filled with blanks."""
    data = _FOLD[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)]
    count = max(1, -(-len(data) // size))
    out = np.full(count * size, 32, np.uint8)
    out[: len(data)] = data
    return out.reshape(count, size)


@dataclass
class Network:
    """Byte embedding, filters of several widths, max pooling, softmax.

    A filter's answer at a place is a sum of one table entry per byte of its width (embedding
    times filter weights), so applying it needs lookups and sums only."""

    embed: np.ndarray
    filters: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray
    languages: list[str]

    def tables(self) -> list[np.ndarray]:
        return [np.einsum("be,kef->kbf", self.embed, k).astype(np.float32) for k in self.filters]

    @staticmethod
    def pooled(tables: list[np.ndarray], rows: np.ndarray, places: bool = False):
        """Largest answer of each filter in each window, and where it is."""
        rows = rows.astype(np.intp)
        best, where = [], []
        for table in tables:
            span = rows.shape[1] - len(table) + 1
            answer = np.take(table[0], rows[:, :span], axis=0)
            for k in range(1, len(table)):
                answer += np.take(table[k], rows[:, k : span + k], axis=0)
            if places:
                at = answer.argmax(axis=1)
                where.append(at)
                best.append(np.take_along_axis(answer, at[:, None, :], axis=1)[:, 0, :])
            else:
                best.append(answer.max(axis=1))
        return np.concatenate(best, axis=1), where

    def predict(self, rows: np.ndarray, tables: list[np.ndarray], step: int = 64) -> np.ndarray:
        """Probabilities of the languages for each window, in blocks of bounded size."""
        out = []
        for i in range(0, len(rows), step):
            x = np.maximum(self.pooled(tables, rows[i : i + step])[0], 0) @ self.weights + self.bias
            x = np.exp(x - x.max(axis=1, keepdims=True))
            out.append(x / x.sum(axis=1, keepdims=True))
        return np.concatenate(out)


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 12, step: int = 64,
          rate: float = 0.004, seed: int = 5, least: int = 600) -> Network:
    """Fit by Adam on cross entropy; the gradient of a pooled filter goes to its best place only. A
    small sample is gone through more often, until `least` steps are made."""
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = Network(
        rng.normal(0, 0.5, (256, EMBED)),
        [rng.normal(0, 0.5 / np.sqrt(w), (w, EMBED, FILTERS)) for w in WIDTHS],
        rng.normal(0, 0.2, (total, len(languages))),
        np.zeros(len(languages)),
        languages,
    )
    params = [net.embed, *net.filters, net.weights, net.bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(max(epochs, -(-least * step // len(rows)) if epochs > 1 else 1)):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), step):
            take = order[i : i + step]
            x, y = rows[take], labels[take]
            raw, where = net.pooled(net.tables(), x, places=True)
            hidden = np.maximum(raw, 0)
            logits = hidden @ net.weights + net.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            up = (p @ net.weights.T) * (raw > 0)
            grad_embed, grads = np.zeros_like(net.embed), []
            for w, at in enumerate(where):
                part = up[:, w * FILTERS : (w + 1) * FILTERS]
                grad = np.zeros_like(net.filters[w])
                for k in range(len(net.filters[w])):
                    table = np.zeros((256, FILTERS))
                    np.add.at(table, (np.take_along_axis(x, at + k, axis=1), np.arange(FILTERS)[None, :]), part)
                    grad[k] = net.embed.T @ table
                    grad_embed += table @ net.filters[w][k].T
                grads.append(grad)
            t += 1
            for j, g in enumerate([grad_embed, *grads, hidden.T @ p, p.sum(axis=0)]):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                params[j] -= rate * (first[j] / (1 - 0.9**t)) / (np.sqrt(second[j] / (1 - 0.999**t)) + 1e-8)
    return net


def _trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bounded number of windows of each sampled document, spread over its whole length."""
    for batch in batches:
        langs, found = [], []
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if not _LETTER.search(text):
                continue
            rows = windows(text)
            for i in np.unique(np.linspace(0, len(rows) - 1, PER_DOCUMENT).astype(int)):
                langs.append(lang)
                found.append(rows[i].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "row"])


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        modulus: int = 3, held: int = 1) -> Network | None:
    """Train on rows whose crc32(id as text) % `modulus` is not `held`, with a text and a language.

    Rows are drawn by a hash of the id at one rate per language, so that about `PER_LANGUAGE`
    documents of each are expected; `PER_DOCUMENT` windows of each go to the driver. Null without
    any labelled text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.coalesce(remainder("doc_id", modulus) != held, F.lit(True)))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    # rows without an id are drawn by their text, each on its own
    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", own), F.lit(1_000_000))
    rate = F.lit(0)
    for lang, n in counts.items():
        rate = F.when(F.col("lang") == lang, min(1_000_000, -(-PER_LANGUAGE * 1_000_000 // n))).otherwise(rate)
    found = rows.where(draw < rate).mapInArrow(_trimmed, "lang string, row binary")
    sample = sorted((r["lang"], bytes(r["row"])) for r in found.limit(4 * PER_LANGUAGE * PER_DOCUMENT * len(counts)).collect())
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    x = np.frombuffer(b"".join(row for _, row in sample), np.uint8).reshape(len(sample), WINDOW)
    y = np.array([languages.index(lang) for lang, _ in sample])
    return train(x, y, languages)


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else None
        for batch in batches:
            texts = batch.column(0)
            lang, score = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            held: list[tuple[int, np.ndarray]] = []

            def flush():
                sums = np.zeros((batch.num_rows, len(net.languages)))
                owner = np.concatenate([np.full(len(r), i) for i, r in held])
                rows = np.concatenate([r for _, r in held])
                p = net.predict(rows, tables)
                share = (rows != 32).sum(axis=1)[:, None]
                np.add.at(sums, owner, p * share)
                for i, _ in held:
                    x = sums[i] / sums[i].sum()
                    lang[i], score[i] = net.languages[int(x.argmax())], float(x.max())

            size = 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                if net is None or text is None or not _LETTER.search(text):
                    continue
                held.append((i, windows(text)))
                size += len(held[-1][1])
                if size >= 4096:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[1:], "lang_pred", "lang_score"],
            )

    return run


def identify(docs: DataFrame, net: Network | None, text_column: str = "text", pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """All input columns and rows with the predicted language and its probability: the mean over
    all windows of the whole text, weighted by letters.

    Null texts and texts without a letter are `und` with score 0, as are all without a network.
    Input columns named like the two new ones, in any case, are replaced. Language, source and id
    are no inputs. Empty input gives no rows."""
    names = [c for c in docs.columns if c.lower() not in (pred.lower(), score.lower())]
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in names]
    slim = docs.select(F.col(text_column).alias("_text"), *[q.alias(f"c{i}") for i, q in enumerate(quoted)])
    schema = slim.schema
    out = slim.mapInArrow(_predict(net), type(schema)(schema.fields[1:]).add("lang_pred", "string").add("lang_score", "double"))
    return out.toDF(*names, pred, score)


def predict(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
            modulus: int = 3, held: int = 1) -> DataFrame:
    """Fit on the rows not held out and predict every row: doc_id, held_out, lang_pred, score. Rows
    with a null id train and are not held out; repeated rows are each predicted."""
    net = fit(docs, id_column, text_column, lang_column, modulus, held)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    out = identify(rows, net)
    held_out = F.coalesce(remainder("doc_id", modulus) == held, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
