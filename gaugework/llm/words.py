"""Vectorised word hashes of whole texts: one pass of numpy over the bytes of a batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_PRIME, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on uint64 (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, number of words of each text); a word is a run of bytes other than ASCII white space."""
    joined = b" ".join(texts) + b" "
    buf = np.frombuffer(joined, dtype=np.uint8)
    power, inverse = _power_tables(len(buf))
    space = _SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    ends = ends[: len(starts)]
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[: len(buf)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, bounds)
    return hashes, np.diff(upto, prepend=0)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word n-grams of each text with their counts: (text index, shingle hash, count), sorted.

    A text of 1 to ``width - 1`` words has one shingle, all its words; a text without a word has none.
    """
    offsets = np.concatenate(([0], np.cumsum(counts)))
    n = len(hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n == 0:
        return owner, hashes, owner
    rolled = np.zeros(n, dtype=np.uint64)
    left = offsets[owner + 1] - np.arange(n)
    for j in range(width):
        part = np.zeros(n, dtype=np.uint64)
        part[: n - j] = hashes[j:]
        rolled = np.where(left > j, mix(rolled * np.uint64(_PRIME) + part), rolled)
    first = np.arange(n) == offsets[owner]
    keep = (left >= width) | ((counts[owner] < width) & first)
    owner, rolled = owner[keep], rolled[keep]
    order = np.lexsort((rolled, owner))
    owner, rolled = owner[order], rolled[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (rolled[1:] != rolled[:-1])
    at = np.flatnonzero(new)
    return owner[at], rolled[at], np.diff(np.append(at, len(owner)))


def text_ranges(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, texts as bytes) of a string column, whole texts of about ``size`` bytes at a time (a longer one alone); NULL is empty.

    Only one range is turned into Python objects at a time, so a worker's memory does not follow the Arrow batch.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(lengths):
        end, held = at, 0
        while end < len(lengths) and (end == at or held + lengths[end] <= size):
            held += int(lengths[end])
            end += 1
        yield at, end, [t or b"" for t in column.slice(at, end - at).cast(pa.binary()).to_pylist()]
        at = end
    pa.default_memory_pool().release_unused()
