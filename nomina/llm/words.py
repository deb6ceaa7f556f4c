"""Vectorised words and hashes over Arrow text columns.

A word is a run of bytes other than space and 0x09-0x0D. Word hashes are
polynomials over random byte values modulo 2**64: prefix sums over the whole
buffer give every word's hash without a loop, and case folding is a matter of
the byte table. Nothing here knows about Spark; the functions run inside tasks
on slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Text bytes worked on at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Texts(NamedTuple):
    """Rows ``first`` to ``last`` of a batch: their bytes and text offsets."""

    first: int
    last: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts


class Words(NamedTuple):
    starts: np.ndarray  # int64 byte positions
    ends: np.ndarray
    bounds: np.ndarray  # int64, first word of each text, one more than texts


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """A string column in slices of at most ``limit`` bytes; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    whole = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        data = whole[bounds[first] : bounds[last]]
        yield Texts(first, last, data, bounds[first : last + 1] - bounds[first])
        first = last


def split_words(texts: Texts) -> Words:
    data, offsets = texts.data, texts.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offsets), np.int64))
    word = ~_SPACE[data]
    begins = np.zeros(len(data), bool)
    begins[0] = True
    begins[1:] = ~word[:-1]
    inner = offsets[1:-1]
    begins[inner[inner < len(data)]] = True
    starts = np.flatnonzero(word & begins)
    ends_here = np.zeros(len(data), bool)
    ends_here[:-1] = begins[1:]
    ends_here[:-1] |= ~word[1:]
    ends_here[-1] = True
    ends = np.flatnonzero(word & ends_here) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@cache
def _byte_values(fold: bool, seed: int) -> np.ndarray:
    values = np.random.default_rng(1_000 + seed).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    """At least ``n`` powers of ``base`` modulo 2**64."""
    found = _powers.get(name)
    if found is None or len(found) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, U64)
        steps[0] = 1
        found = np.cumprod(steps, dtype=U64)
        # A text longer than a slice must not leave its table behind.
        if n <= SLICE_BYTES + 1:
            _powers[name] = found
    return found


def hash_words(data: np.ndarray, words: Words, fold: bool = False, seed: int = 0) -> np.ndarray:
    """A 64-bit hash per word; ``fold`` makes A-Z equal to a-z."""
    if not len(words.starts):
        return np.zeros(0, U64)
    terms = _byte_values(fold, seed)[data]
    terms *= _power(_BASE, len(data), "base")[: len(data)]
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(terms, out=sums[1:])
    inverse = _power(pow(_BASE, -1, 1 << 64), len(data), "inverse")
    found = (sums[words.ends] - sums[words.starts]) * inverse[words.starts]
    return mix(found + (words.ends - words.starts).astype(U64))


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of ranges given by start and length, one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def pack_planes(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences; the high
    planes are mostly zero, so block compression removes them."""
    steps = np.diff(values.astype(U64), prepend=U64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_planes(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).ravel(), dtype=U64)


def pack_small(values: np.ndarray) -> bytes:
    """32-bit numbers as byte planes."""
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_small(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def list_column(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive values as an Arrow list column."""
    bounds = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
