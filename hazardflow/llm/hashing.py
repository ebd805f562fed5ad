"""Hashes of a text's words and word sequences, all words at once."""

from __future__ import annotations

import numpy as np

from hazardflow.llm.common import SPACE

_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE)] = True


def powers(base: int, count: int, kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if base not in kept or len(kept[base][0]) < count:
        size = max(4096, 1 << (count - 1).bit_length())
        with np.errstate(over="ignore"):
            kept[base] = tuple(
                np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]).cumprod(dtype=np.uint64)
                for b in (base, pow(base, -1, 2**64))
            )
    return kept[base]


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of a text's words, with A-Z as lower case. Hashes are
    differences of running polynomial sums, made in blocks that end between words."""
    lowered = text.lower()
    starts, ends, hashes, at = [], [], [], 0
    while at < len(lowered):
        stop = min(len(lowered), at + _BLOCK)
        data = np.frombuffer(lowered, np.uint8, stop - at, at)
        if stop < len(lowered):
            gaps = np.flatnonzero(_IS_SPACE[data])
            # a word longer than a block is hashed whole
            while not len(gaps) and stop < len(lowered):
                stop = min(len(lowered), stop + _BLOCK)
                data = np.frombuffer(lowered, np.uint8, stop - at, at)
                gaps = np.flatnonzero(_IS_SPACE[data])
            if stop < len(lowered) and len(gaps):
                data = data[: gaps[-1] + 1]
        edge = np.diff(np.concatenate([[1], _IS_SPACE[data].view(np.int8), [1]]))
        s, e = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = powers(_BASE, len(data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
        hashes.append(scramble((total[e] - total[s]) * down[s]))
        starts.append(s + at)
        ends.append(e + at)
        at += len(data)
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
