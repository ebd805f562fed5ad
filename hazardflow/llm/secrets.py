"""Secrets in text: fixed patterns, and strings that a character model takes for random."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.casts import quoted

# The patterns, what they need, and the order of kinds.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

#: What the models read: letters, digits and signs of keys; all else ends a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Shortest string that is tested, in characters.
LEAST_RANDOM = 16
#: A string is taken for random where that is likelier by so many nats. The odds before looking are
#: taken as one in a million strings, of which the logarithm is 13.8.
MARGIN = 13.8
#: Share of random strings taken to be even over the alphabet, as keys in base 64 are; the labelled
#: ones make up the rest. And the share of any model that is even, for steps never seen.
EVEN, UNSEEN = 0.5, 0.01

_SYMBOLS = len(ALPHABET) + 1
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, _SYMBOLS)
_TOKEN = re.compile(f"[{re.escape(ALPHABET)}]{{{LEAST_RANDOM},}}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the fixed patterns, leftmost without overlap per kind, by start,
    then kind. Hex digits and letters of an access key stand in one run each, so a least length
    in the pattern drops what is too short."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _steps(data: bytes, ends: bool = False) -> np.ndarray:
    """Steps between characters as numbers: state times symbols plus next; the state before a
    string, and after what is no character of a key, is 0. Steps to 0, the ends of strings, are
    given only if asked for."""
    code = _CODE[np.frombuffer(data, np.uint8)]
    before = np.concatenate([[0], code[:-1]])
    return (before * _SYMBOLS + code)[code + before * ends > 0]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps seen in random strings (what the fixed patterns find) and in all else, per partition."""
    seen = np.zeros((2, _SYMBOLS * _SYMBOLS), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if not text:
                continue
            spans, rest, at = base_spans(text), [], 0
            for start, kind, end in spans:
                # of an assignment its value is the secret, the name before it is not
                value = ASSIGN.match(text, start).start(2) if kind == 0 else start
                rest.append(text[at:value])
                if end > at:
                    seen[1] += np.bincount(_steps(text[max(at, value) : end].encode()), minlength=seen.shape[1])
                at = max(at, end)
            rest.append(text[at:])
            seen[0] += np.bincount(_steps("\n".join(rest).encode(), ends=True), minlength=seen.shape[1])
    label, step = np.nonzero(seen)
    if len(label):
        yield pa.RecordBatch.from_arrays(
            [pa.array(label == 1), pa.array(step, pa.int32()), pa.array(seen[label, step], pa.int64())], names=["random", "step", "n"]
        )


@dataclass(frozen=True)
class Models:
    """First-order character models of random strings and of ordinary identifiers, as the
    difference of their log-probabilities for each step."""

    gain: np.ndarray

    def ratio(self, token: str) -> float:
        """Log-likelihood ratio of a string: above 0 where it is likelier random."""
        return float(self.gain[_steps(token.encode())].sum())


def fit_models(docs: DataFrame, text_column: str = "text") -> Models:
    """Both models from the whole table, labelled by the fixed patterns: what they find is random,
    all else is ordinary. Counts of steps are summed in Spark; the driver gets at most two numbers
    for each of the steps there are, whatever the table. Without any text the ratio is 0 for all
    strings."""
    counted = docs.select(quoted(text_column).cast("string").alias("text")).mapInArrow(_counts, "random boolean, step int, n bigint")
    rows = counted.groupBy("random", "step").agg(F.sum("n").alias("n")).collect()
    return models_of([(r["random"], r["step"], r["n"]) for r in rows])


def _as_identifiers(words: np.ndarray) -> np.ndarray:
    """Steps of ordinary words as identifiers have them: besides the words as they are, in capitals,
    and joined by signs or by a capital. Also lines drawn with one sign."""
    upper = np.arange(_SYMBOLS)
    upper[27:53] -= 26
    signs = np.arange(_SYMBOLS - len("+/_=-"), _SYMBOLS)
    out = words.copy()
    capital = np.zeros_like(words)
    np.add.at(capital, (upper[:, None], upper[None, :]), words)
    out += capital
    ends, starts = words[1:, 0], words[0, 1:]
    share = starts / max(1.0, starts.sum())
    for sign in signs:
        for case in (np.arange(_SYMBOLS), upper):
            np.add.at(out, (case[1:], sign), ends / 2)
            np.add.at(out, (sign, case[1:]), starts / 2)
        out[sign, sign] += starts.sum()
    np.add.at(out, (np.arange(1, _SYMBOLS)[:, None], upper[None, 1:]), ends[:, None] * share[None, :])
    return out


def models_of(counts: list[tuple[bool, int, int]]) -> Models:
    """Models from counts of steps: (whether from a random string, step, how often)."""
    seen = np.zeros((2, _SYMBOLS, _SYMBOLS))
    for random, step, n in counts:
        seen[int(random), step // _SYMBOLS, step % _SYMBOLS] += n
    seen[0] = _as_identifiers(seen[0])
    if not seen[0].any():
        return Models(np.zeros(_SYMBOLS * _SYMBOLS))
    even = np.full((_SYMBOLS, _SYMBOLS), 1 / (_SYMBOLS - 1))
    even[:, 0] = seen[:, :, 0] = 0
    total = seen.sum(axis=2, keepdims=True)
    share = np.where(total > 0, seen / np.maximum(total, 1), even)
    random = (1 - EVEN) * share[1] + EVEN * even
    ordinary = (1 - UNSEEN) * share[0] + UNSEEN * even
    gain = np.zeros_like(even)
    gain[:, 1:] = np.log(random[:, 1:]) - np.log(ordinary[:, 1:])
    return Models(gain.ravel())


def random_spans(text: str, models: Models, margin: float) -> list[tuple[int, int, int]]:
    """Strings of at least `LEAST_RANDOM` characters that the models take for random."""
    return [(m.start(), 3, m.end()) for m in _TOKEN.finditer(text) if models.ratio(m.group()) > margin]


def _scan(models: Models, margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, list, list] = ([], [], [])
            offsets = [0]
            for text in batch.column(1).to_pylist():
                spans = base_spans(text) if text else []
                held = {(a, b) for a, _, b in spans}
                added = random_spans(text, models, margin) if text else []
                # a base span within the string already tells of it
                added = [x for x in added if not any(a < x[2] and x[0] < b for a, b in held)]
                for start, kind, end in sorted(spans + added):
                    for column, v in zip(columns, (start, end, KINDS[kind])):
                        column.append(v)
                offsets.append(len(columns[0]))
            spans = pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["start", "end", "kind"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)], names=["doc_id", "spans"]
            )

    return run


def find_secrets(docs: DataFrame, models: Models, id_column: str = "doc_id", text_column: str = "text",
                 margin: float = MARGIN) -> DataFrame:
    """One row per input row: doc_id, spans (start, end, kind; by start, then kind), in code points of
    the whole text, end exclusive.

    Kinds `assign`, `access` and `hex` are the fixed patterns. Kind `random` is what the models add:
    strings that meet none of those and whose log-likelihood ratio exceeds `margin`. Null and empty
    texts have no spans; null, equal and repeated ids are rows like others. An empty table gives
    no rows. Other columns are not read. No shuffle; memory is a batch of texts.
    """
    slim = docs.select(quoted(id_column).cast("bigint").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return slim.mapInArrow(_scan(models, margin), "doc_id bigint, spans array<struct<start:bigint,end:bigint,kind:string>>")


def scan_digests(found: DataFrame) -> DataFrame:
    """Rows of `find_secrets` as text: doc_id, n_assign, n_access, n_hex, base_sha256, spans,
    n_random. A span is `kind:start:end`, spans are joined by commas."""
    told = lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[number(k) for k in KINDS[:3]],
        F.sha2(F.concat_ws(",", F.transform(base, told)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", told)).alias("spans"),
        number(KINDS[3]),
    )
