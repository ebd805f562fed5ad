"""Runs of repeated words, found from Lyndon arrays that grouping of suffixes yields."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardflow.functions.casts import quoted

FOUND = "array<struct<start:bigint,length:bigint,period:bigint>>"
GRAM = 3
ROUNDS = 8


def lyndon_lengths(words: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position; a text's end is least.

    Phase one of Baier's suffix sorter: suffixes are in groups, at first by their first word. Groups
    are taken from the highest down. The members of one are final: what their group stands for is
    their longest Lyndon word. Each position that is the nearest unfinished one to the left of k
    members takes their words on, k times the group's length; those that came from one group and
    took on equally much are a new group, right above the one they leave, the larger k the higher.
    Every position is a member once and gives to one other, so the work is linear but for
    following the shortened ways to the left.
    """
    n = len(words)
    first = defaultdict(list)
    for i, w in enumerate(words):
        first[w].append(i)
    names = sorted(first)
    members = [first[w] for w in names]
    rank = {w: g for g, w in enumerate(names)}
    group = [rank[w] for w in words]
    size = [1] * len(names)
    below = list(range(-1, len(names) - 1))
    above = [*range(1, len(names)), -1]
    length = [0] * n
    # nearest unfinished position at or left of i - 1, for i from 1; 0 stands for none
    left = list(range(n + 1))
    g = len(names) - 1
    while g >= 0:
        mine = [s for s in members[g] if group[s] == g]
        u = size[g]
        for s in mine:
            length[s] = u
            left[s + 1] = s
        takes: dict[int, int] = {}
        for s in mine:
            x = s
            while left[x] != x:
                left[x] = x = left[left[x]]
            if x:
                takes[x - 1] = takes.get(x - 1, 0) + 1
        moved = defaultdict(list)
        for p, k in takes.items():
            moved[k, group[p]].append(p)
        for k, h in sorted(moved, reverse=True):
            new = len(size)
            size.append(size[h] + k * u)
            members.append(moved[k, h])
            for p in moved[k, h]:
                group[p] = new
            top = above[h]
            below.append(h)
            above.append(top)
            above[h] = new
            below[top] = new
        g = below[g]
    return length


def _same_ahead(words: np.ndarray, i: int, j: int) -> int:
    """How many words agree from i and from j > i on."""
    done, step, n = 0, 16, len(words)
    while j + done < n:
        m = min(step, n - j - done)
        differ = np.flatnonzero(words[i + done : i + done + m] != words[j + done : j + done + m])
        if len(differ):
            return done + int(differ[0])
        done, step = done + m, step * 2
    return done


def runs_of(words: np.ndarray, start: int, stop: int, min_exponent: int, min_length: int) -> set[tuple[int, int, int]]:
    """Runs (start, length, period) that have a Lyndon root within [start, stop).

    By the runs theorem a run's Lyndon roots are longest Lyndon words of their positions under one of
    the two orders of words. Each root is extended to both sides as far as words a period apart
    agree, over the whole text; a root inside a stretch already extended is not tried again.
    """
    found: set[tuple[int, int, int]] = set()
    back = words[::-1]
    n = len(words)
    piece = words[start:stop]
    for signed in (piece, -piece):
        periods = np.array(lyndon_lengths(signed.tolist()), dtype=np.int64)
        at = np.arange(len(piece))
        # the words of a root come back after each period of the shortest run there can be
        for times in sorted({1, min_exponent - 1}):
            at = at[at + times * periods[at] < len(piece)]
            at = at[piece[at] == piece[at + times * periods[at]]]
        reached: dict[int, int] = {}
        for i, p in zip((at + start).tolist(), periods[at].tolist()):
            if i + p <= reached.get(p, 0):
                continue
            ahead = p + _same_ahead(words, i, i + p)
            behind = _same_ahead(back, n - i - p, n - i)
            if ahead + behind >= 2 * p:
                reached[p] = i + ahead
            if ahead + behind >= max(min_length, min_exponent * p):
                found.add((i - behind, ahead + behind, p))
    return found


def _stretches(words: np.ndarray, min_exponent: int, min_length: int) -> list[tuple[int, int]]:
    """The parts of a text that can hold a run: each `GRAM` words of them occur there often enough.

    Words of a run come back, so it holds each of its grams a number of times that follows from the
    shortest run. Grams rarer than that cut the text, and the parts are counted again. A part that
    still shrinks after `ROUNDS` is kept as it is, which costs time and changes no result.
    """
    longest = [max(min_length, min_exponent * p) for p in range(1, max(min_length, GRAM) + 1)]
    least = min([(x - GRAM + 1) // p for p, x in enumerate(longest, 1)] + [min_exponent - 1])
    if least < 2:
        return [(0, len(words))]
    done, todo = [], [(0, len(words), 0)]
    while todo:
        a, b, rounds = todo.pop()
        if b - a < max(min_length, GRAM):
            continue
        if rounds == ROUNDS:
            done.append((a, b))
            continue
        grams = words[a:b]
        for k in range(1, GRAM):
            # names stay below the number of places, so a pair of names fits a long
            grams = np.unique(grams[:-1] * len(words) + words[a + k : b], return_inverse=True)[1]
        common = np.bincount(grams)[grams] >= least
        if common.all():
            done.append((a, b))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], common, [False]]).astype(np.int8)))
        todo += [(a + x, a + y + GRAM - 1, rounds + 1) for x, y in edges.reshape(-1, 2).tolist()]
    return done


def _find(min_exponent: int, min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept, offsets = [], [], [0]
            parts: tuple[list, list, list] = ([], [], [])
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                # bytes split at the same six characters that end a word here
                words = (text or b"").split()
                number = defaultdict(count().__next__)
                ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                found = set()
                for a, b in _stretches(ids, min_exponent, min_length):
                    found |= runs_of(ids, a, b, min_exponent, min_length)
                rows = sorted((s, p, x) for s, x, p in found)
                if rows:
                    drop = np.zeros(len(words) + 1, np.int64)
                    for s, p, x in rows:
                        drop[s + p] += 1
                        drop[s + x] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
                sizes.append(len(ids))
                kept.append(b" ".join(words))
                for s, p, x in rows:
                    for part, v in zip(parts, (s, x, p)):
                        part.append(v)
                offsets.append(len(parts[0]))
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in parts], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  min_exponent: int = 4, min_length: int = 6) -> DataFrame:
    r"""One row per input row: doc_id, n_words, runs (start, length, period; by start, then period),
    collapsed.

    Words are what `[^\x20\x09-\x0D]+` matches. A run is a stretch of consecutive words, of smallest
    period `period`, as long as it can be, with at least `min_exponent` (2 or more) periods and
    `min_length` words. `collapsed` is the text without what follows a run's first period, words
    joined by one blank.

    Null and blank texts have no words, no runs and an empty collapsed text. Null, equal and
    repeated ids are rows like others. An empty table gives no rows. Other columns are not read.

    No shuffle: a text is one row of work, linear in its words but for names (sorted). Memory is a
    batch of texts and some numbers per word of the longest. Texts are cut where three words are too
    rare to be in a run; what is left goes through `lyndon_lengths` under both orders.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    slim = docs.select(quoted(id_column).cast("bigint").alias("doc_id"), quoted(text_column).cast("string").alias("text"))
    return slim.mapInArrow(_find(min_exponent, min_length), f"doc_id bigint, n_words bigint, runs {FOUND}, collapsed string")


def with_planted_period(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and text, where every tenth text by the crc32 h of its id as text ends in a period.

    With g = h div 10 and n words, each word i from a = g % n on becomes word a + (i - a) % p of the
    original, p = 1 + (n - a) div (3 + g % 8); words are then joined by one blank. Null ids stay.
    """
    h = F.crc32(quoted(id_column).cast("string").cast("binary"))
    words = F.regexp_extract_all(quoted(text_column), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select(
        quoted(id_column).alias("doc_id"), quoted(text_column).alias("text"),
        F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).cast("bigint").alias("_g"),
    )
    n = F.size("_words").cast("bigint")
    rows = rows.select("*", n.alias("_n"), F.when(n > 0, F.col("_g") % n).alias("_a"))
    rest = F.col("_n") - F.col("_a")
    rows = rows.select("*", rest.alias("_rest"), (F.floor(rest / (3 + F.col("_g") % 8)) + 1).cast("bigint").alias("_p"))
    to_int = lambda c: F.col(c).cast("int")
    root = F.slice("_words", to_int("_a") + 1, to_int("_p"))
    tail = F.slice(F.flatten(F.array_repeat(root, F.ceil(F.col("_rest") / F.col("_p")).cast("int"))), F.lit(1), to_int("_rest"))
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), to_int("_a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))


def greatest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of several, the first."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    more = lambda a, r: r["length"] * a["period"] > a["length"] * r["period"]
    return F.aggregate(runs, none, lambda a, r: F.when(a.isNull() | more(a, r), r).otherwise(a))


def run_digests(found: DataFrame) -> DataFrame:
    """Rows of `periodic_runs` as digests: doc_id, n_runs; start, length, period and exponent_milli
    of the greatest run; runs_sha256, collapsed_sha256."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    rows = found.select("*", greatest(F.col("runs")).alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
