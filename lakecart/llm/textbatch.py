"""Vectorised word hashing of Arrow batches (NumPy inside tasks, no per-word Python).

A word is a maximal run of UTF-8 bytes outside ``[\\x20\\x09-\\x0D]``.  Word and shingle identity is a mixed
64-bit hash of the whole word (or of all words of the shingle, in order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**64 - 1, 64, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Bytes hashed at once: keeps the working arrays small whatever the batch holds.
CHUNK_BYTES = 1 << 20


# Rows turned into Python strings at once: an Arrow batch may hold ten thousand long texts.
SLICE_ROWS = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of SLICE_ROWS rows, so a task's working memory does not follow the batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: list[str | None], lower: bool = False) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as UTF-8 (null as empty) in runs of about CHUNK_BYTES, each with the index of its first text."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").encode("utf-8", "surrogatepass")
        if held and size + len(b) > CHUNK_BYTES:
            yield first, held
            first, held, size = i, [], 0
        held.append(b.translate(ASCII_LOWER) if lower else b)
        size += len(b)
    if held:
        yield first, held


def word_hashes(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all parts in order, and each part's first word index (one more at the end)."""
    joined = b" ".join(parts) + b" "
    data = np.frombuffer(joined, np.uint8)
    at = np.cumsum([0] + [len(p) + 1 for p in parts])
    solid = ~IS_SPACE[data]
    edge = np.diff(np.concatenate(([0], solid.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(parts) + 1, np.int64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(first, lens)
    longest = int(lens.max())
    powers = np.cumprod(np.full(longest, _STEP, np.uint64), dtype=np.uint64)
    hashes = np.add.reduceat(_BYTE[data[solid]] * powers[place], first)
    return mix(hashes + lens.astype(np.uint64)), np.searchsorted(starts, at)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive words, boundaries between texts not considered."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        total += words[j : len(words) - k + 1 + j] * _PLACE[j]
    return mix(total)


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """Per text, in order: the sorted distinct k-word shingles of the A-Z lower-cased text.

    A text with fewer than k words is one shingle, its whole sequence; without words the set is empty.
    """
    for _, parts in chunks(texts, lower=True):
        words, at = word_hashes(parts)
        runs = windows(words, k)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                yield np.unique(runs[a : b - k + 1])
            elif b > a:
                yield mix((words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
