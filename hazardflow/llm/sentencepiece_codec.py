"""SentencePiece encoding as a max-plus parallel scan, and decoding."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardflow.llm.common import stored
from hazardflow.llm.vocabulary import MODEL, Vocabulary, load_vocabulary

_SCALE = 1_000_000  # scores are whole millionths, so that sums don't depend on their order
_CACHE = 150_000
_NONE = -(1 << 60)  # no path


class Lattice:
    """Best segmentations under a vocabulary, in whole numbers.

    Of equal segmentations the one whose last piece starts first wins, then the piece before it,
    and so on. A position's best score and start depend on what stands before it alone."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = vocabulary.ids
        self.score = [round(x * _SCALE) if x > float("-inf") else _NONE for x in vocabulary.logs]
        self.reach = vocabulary.longest
        self.value = {piece: self.score[i] for piece, i in self.ids.items()}
        # every beginning of a piece, with the score if it is one: a look-up ends where none goes on
        self.starts: dict[str, int | None] = {}
        for piece, value in self.value.items():
            for n in range(2, len(piece)):
                self.starts.setdefault(piece[:n])
            self.starts[piece] = value
        # parts seen lately, and those seen before them: full, the older ones go
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def forward(self, text: str, best: list[int], start: int) -> list[int]:
        """Fill `best`, the scores of positions of `text`, from what it holds up to `start`;
        returns for each position after it where its last piece starts."""
        n, value, starts = len(text), self.value.get, self.starts.get
        back = [-1] * (n + 1)
        for i in range(max(0, start - self.reach + 1), n):
            here = best[i]
            if here <= _NONE:
                continue
            if i >= start:
                s = value(text[i])
                if s is None:
                    s = sum([self.score[b] for b in self.vocabulary.fallback(text[i])])
                s += here
                if s > best[i + 1]:
                    best[i + 1], back[i + 1] = s, i
                low = i + 2
            else:
                low = max(i + 2, start + 1)
            for j in range(low, n + 1):
                s = starts(text[i:j], _NONE)
                if s is not None:
                    if s <= _NONE:
                        break
                    s += here
                    if s > best[j]:
                        best[j] = s
                        back[j] = i
        return back

    def pieces(self, text: str, back: list[int], end: int, start: int) -> tuple[list[int], int]:
        """Ids of the best path to `end`, back to its last position up to `start`; that position."""
        out = []
        while end > start:
            begin = back[end]
            piece = self.ids.get(text[begin:end])
            out.extend([piece] if piece is not None else self.vocabulary.fallback(text[begin])[::-1])
            end = begin
        return out[::-1], end

    def part(self, text: str) -> tuple[int, ...]:
        """Ids of a part on its own; frequent parts are remembered, within a bound."""
        found = self.known.get(text) or self.older.get(text)
        if found is None:
            best = [0] + [_NONE] * len(text)
            back = self.forward(text, best, 0)
            found = tuple(self.pieces(text, back, len(text), 0)[0])
        if len(text) <= 64:
            if len(self.known) >= _CACHE:
                self.older, self.known = self.known, {}
            self.known[text] = found
        return found

    def total(self, ids: tuple[int, ...]) -> int:
        return sum([self.score[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.known
        for part in self.vocabulary.parts(self.vocabulary.mark(text)) if text else ():
            out.extend(known.get(part) or self.part(part))
            known = self.known
        return out


class Chunk:
    """A chunk of a marked text, with up to `reach` - 1 characters before it.

    State s at a border: the last piece ends s characters before it, and the next one, unless s is
    0, goes over the border. With cuts, all paths meet at the first cut in the chunk, so only the
    stretch before it is computed once per state."""

    def __init__(self, lattice: Lattice, text: str, context: int):
        self.lattice, self.text, self.context = lattice, text, context
        self.states = lattice.reach
        self.first_cut = self.last_cut = None
        if lattice.vocabulary.cuts:
            cuts, at = [], 0
            for part in lattice.vocabulary.parts(text):
                cuts.append(at)
                at += len(part)
            # the split is not sure before the first part that starts inside the chunk
            cuts = [c for c in cuts if c >= max(context, 1) and _is_cut(text, c)]
            if cuts:
                self.first_cut, self.last_cut = cuts[0], cuts[-1]
                self.cuts = cuts

    def _from(self, entry: list[int], stop: int) -> tuple[list[int], list[int]]:
        """Best scores and starts of the positions up to `stop`, given the border's states."""
        best = [_NONE] * (stop + 1)
        for s, value in enumerate(entry):
            if s <= self.context:
                best[self.context - s] = value
        back = self.lattice.forward(self.text[:stop], best, self.context)
        return best, back

    def matrix(self) -> np.ndarray:
        """Best scores from each state at the front border to each at the rear border."""
        n, k = len(self.text), self.states
        out = np.full((k, k), _NONE, np.int64)
        stop = n if self.first_cut is None else self.first_cut
        heads = []
        for s in range(min(k, self.context + 1)):
            entry = [_NONE] * k
            entry[s] = 0
            heads.append((s, self._from(entry, stop)[0]))
        if self.first_cut is None:
            for s, best in heads:
                for t in range(k):
                    if n - t > self.context or (t == 0 and n == self.context):
                        out[s, t] = max(_NONE, best[n - t])
            return out
        middle = sum(self.lattice.total(self.lattice.part(self.text[a:b])) for a, b in zip(self.cuts, self.cuts[1:]))
        tail = self.text[self.last_cut :]
        best = [0] + [_NONE] * len(tail)
        self.lattice.forward(tail, best, 0)
        for s, head in heads:
            if head[stop] <= _NONE:
                continue
            for t in range(min(k, len(tail) + 1)):
                if best[len(tail) - t] > _NONE:
                    out[s, t] = head[stop] + middle + best[len(tail) - t]
        return out

    def came_from(self, entry: list[int]) -> list[int]:
        """For each state at the rear border the state at the front border on its best path."""
        best, back = self._front(entry)
        out = []
        for t in range(self.states):
            end = len(self.text) - t
            if self.last_cut is not None and end >= self.last_cut:
                end = self.first_cut
            if end < self.context or end >= len(best) or best[end] <= _NONE:
                out.append(-1)
                continue
            out.append(self.context - self.lattice.pieces(self.text, back, end, self.context)[1])
        return out

    def _front(self, entry: list[int]) -> tuple[list[int], list[int]]:
        return self._from(entry, len(self.text) if self.first_cut is None else self.first_cut)

    def ids(self, entry: list[int], state: int) -> list[int]:
        """Ids of the pieces that end inside the chunk on the best path to `state` at its rear."""
        _, back = self._front(entry)
        end = len(self.text) - state
        if self.first_cut is None:
            return self.lattice.pieces(self.text, back, end, self.context)[0]
        out = self.lattice.pieces(self.text, back, self.first_cut, self.context)[0]
        for a, b in zip(self.cuts, self.cuts[1:]):
            out.extend(self.lattice.part(self.text[a:b]))
        tail = self.text[self.last_cut : end]
        if tail:
            # all of the tail's positions up to `end` are on their own best paths
            best = [0] + [_NONE] * len(tail)
            starts = self.lattice.forward(tail, best, 0)
            out.extend(self.lattice.pieces(tail, starts, len(tail), 0)[0])
        return out


def _is_cut(text: str, at: int) -> bool:
    mark, line = "▁", "\n"
    return (text[at] == mark and text[at - 1] != mark) or text[at] == line or text[at - 1] == line


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of transfer matrices: best over the state between them. Associative."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), _NONE)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the matrices before each one, by halving: neighbours are combined, the
    half-long list is scanned, and its products are spread back."""
    if len(matrices) == 1:
        k = len(matrices[0])
        unit = np.full((k, k), _NONE, np.int64)
        np.fill_diagonal(unit, 0)
        return [unit]
    pairs = [max_plus(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)]
    upper = scan(pairs + (matrices[-1:] if len(matrices) % 2 else []))
    out = []
    for i in range(len(matrices)):
        out.append(upper[i // 2] if i % 2 == 0 else max_plus(upper[i // 2], matrices[i - 1]))
    return out


def _borders(rows):
    """Entry scores of every chunk of one document, from its transfer matrices."""
    rows = rows.drop_duplicates("no").sort_values("no")
    k = int(len(rows["matrix"].iloc[0]) ** 0.5 / 8**0.5 + 0.5)
    before = scan([np.frombuffer(m, np.int64).reshape(k, k) for m in rows["matrix"]])
    return pd.DataFrame({"key": rows["key"].iloc[0], "key2": rows["key2"].iloc[0], "no": rows["no"].to_numpy(), "entry": [p[0].tobytes() for p in before]})


def _exits(rows):
    """Rear state of every chunk of one document: the end is state 0, and each chunk's map leads
    to the chunk before. Maps compose, so this is a scan over short lists."""
    rows = rows.drop_duplicates("no").sort_values("no", ascending=False)
    state, out = 0, []
    for came in rows["came"]:
        out.append(state)
        state = struct.unpack(f"{len(came) // 2}h", came)[state]
    return pd.DataFrame({"key": rows["key"].iloc[0], "key2": rows["key2"].iloc[0], "no": rows["no"].to_numpy(), "state": out})


def _cut_up(vocabulary: Vocabulary, size: int):
    """Rows (key, key2, no, context, text): a marked text in chunks of `size` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "key2", "no", "context", "text"]
        for batch in batches:
            for row in batch.to_pylist():
                marked, out = vocabulary.mark(row["text"]), []
                starts = list(range(0, len(marked), size))
                # a last chunk shorter than a piece joins the one before
                if len(starts) > 1 and len(marked) - starts[-1] < vocabulary.longest:
                    starts.pop()
                for no, at in enumerate(starts):
                    end = starts[no + 1] if no + 1 < len(starts) else len(marked)
                    front = max(0, at - vocabulary.longest + 1)
                    # surrogates pass as bytes
                    out.append((row["key"], row["key2"], no, at - front, marked[front:end].encode("utf-8", "surrogatepass")))
                    if len(out) == 64:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return run


def _per_chunk(vocabulary: Vocabulary, what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary)
        for batch in batches:
            values = []
            for row in batch.to_pylist():
                chunk = Chunk(lattice, row["text"].decode("utf-8", "surrogatepass"), row["context"])
                entry = np.frombuffer(row["entry"], np.int64).tolist() if "entry" in row else None
                if what == "matrix":
                    values.append(chunk.matrix().tobytes())
                elif what == "came":
                    came = chunk.came_from(entry)
                    values.append(struct.pack(f"{len(came)}h", *came))
                else:
                    values.append(chunk.ids(entry, row["state"]))
            kind = pa.list_(pa.int32()) if what == "ids" else pa.binary()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "key2", "no")), pa.array(values, kind)], names=["key", "key2", "no", what])

    return run


def _small(vocabulary: Vocabulary, text_at: int, check: bool):
    """Texts of one chunk: the ids at the end of each row, and whether they give the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary)
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                texts = part.column(text_at).to_pylist()
                ids = [None if t is None else lattice.encode(t) for t in texts]
                new = [pa.array([None if x is None else np.array(x, np.int32) for x in ids], pa.list_(pa.int32()))]
                if check:
                    new.append(pa.array([x is None or vocabulary.decode(x) == t for x, t in zip(ids, texts)], pa.bool_()))
                names = [f"c{i}" for i in range(batch.num_columns + len(new))]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return run


def _checked(vocabulary: Vocabulary, text_at: int):
    """Whether the ids at the end of each row give its text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i in range(batch.num_rows):
                good.append(vocabulary.decode(batch.column(batch.num_columns - 1)[i].as_py()) == batch.column(text_at)[i].as_py())
            names = [f"c{i}" for i in range(batch.num_columns + 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good, pa.bool_())], names=names)

    return run


def encode(docs: DataFrame, text_column: str = "text", ids_column: str = "ids", model: str = MODEL,
           chunk: int = 50_000, check_column: str | None = None) -> DataFrame:
    """All input columns and rows, and `ids_column` (array<int>): the best segmentation of each
    whole text into the pieces of the vocabulary file `model`, by sum of scores. `check_column`
    adds whether decoding gave the text back, found in the same pass; true for null texts.

    A space mark stands in front of the text and for each space; a character without a piece is
    its UTF-8 bytes; the mark's own character is bytes too, so decoding always gives the text
    back. Null text has null ids, empty text none. Input columns named like the new ones (in any
    case) are replaced. Empty input gives no rows; repeated rows get equal ids.

    Texts up to `chunk` characters are one chunk. Longer ones are cut, and only they shuffle:
    each chunk gives a matrix of best scores between the states of its two borders; a document's
    matrices are combined by the associative max-plus product into scores at every border; each
    chunk then maps its rear state to its front state, the maps give every chunk its rear state
    from the end, and each chunk is traced back on its own. A document's matrices take 2 KB for
    each chunk, and a text is at most 2 GB. Scores are whole numbers and ties have a fixed order,
    so the cuts never change a result.
    """
    vocabulary = load_vocabulary(model)
    docs = docs.select(*[f"`{c.replace('`', '``')}`" for c in docs.columns if c.lower() not in (ids_column.lower(), (check_column or "").lower())])
    names = docs.columns
    added = [ids_column] + ([check_column] if check_column else [])
    length = F.length(F.col(text_column))
    big = length > chunk
    checked = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    checked.add(f"c{len(names)}", T.ArrayType(T.IntegerType()))
    if check_column:
        checked.add(f"c{len(names) + 1}", T.BooleanType())
    plain = docs.where(~big | length.isNull()).toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index(text_column)
    small = plain.mapInArrow(_small(vocabulary, at, bool(check_column)), checked).toDF(*names, *added)
    key = [F.xxhash64(text_column).alias("key"), F.xxhash64(F.lit(5), text_column).alias("key2")]
    large = docs.where(big).select(*key, F.col(text_column).alias("text"))
    if large.isEmpty():
        return small
    chunks = stored(
        large.dropDuplicates(["key", "key2"])
        .mapInArrow(_cut_up(vocabulary, chunk), "key bigint, key2 bigint, no bigint, context bigint, text binary")
        .repartition("key", "key2", "no"),
        "chunks",
    )
    by = ["key", "key2", "no"]
    head = "key bigint, key2 bigint, no bigint, "
    matrices = chunks.mapInArrow(_per_chunk(vocabulary, "matrix"), head + "matrix binary")
    entries = stored(matrices.groupBy("key", "key2").applyInPandas(_borders, head + "entry binary"), "entries")
    came = chunks.join(entries, by).mapInArrow(_per_chunk(vocabulary, "came"), head + "came binary")
    states = stored(came.groupBy("key", "key2").applyInPandas(_exits, head + "state bigint"), "exits")
    pieces = chunks.join(entries, by).join(states, by).mapInArrow(_per_chunk(vocabulary, "ids"), head + "ids array<int>")
    whole = (
        pieces.groupBy("key", "key2").agg(F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("all"))
        .select("key", "key2", F.flatten(F.transform("all", lambda x: x["ids"])).alias("_ids"))
    )
    marked = docs.where(big).withColumns({"_key": F.xxhash64(text_column), "_key2": F.xxhash64(F.lit(5), text_column)}).alias("d")
    joined = marked.join(whole.alias("w"), (F.col("d._key") == F.col("w.key")) & (F.col("d._key2") == F.col("w.key2")))
    columns = [F.col("d.`" + c.replace("`", "``") + "`") for c in names]
    out = joined.select(*columns, F.col("w._ids").alias(ids_column))
    if check_column:
        out = out.toDF(*[f"c{i}" for i in range(len(names) + 1)]).mapInArrow(_checked(vocabulary, at), checked).toDF(*names, *added)
    return small.unionByName(out)


def decode(rows: DataFrame, ids_column: str = "ids", text_column: str = "decoded", model: str = MODEL) -> DataFrame:
    """All input columns, and `text_column`: the text of the ids. Null ids give null, no ids an
    empty text; ids outside the vocabulary raise. An input column of that name is replaced."""
    vocabulary = load_vocabulary(model)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else vocabulary.decode(x) for x in ids])

    keep = [f"`{c.replace('`', '``')}`" for c in rows.columns if c.lower() != text_column.lower()]
    return rows.select(*keep, text(F.col(ids_column)).alias(text_column))
