"""Words and shingle hashes of whole texts, straight on the bytes of an Arrow column.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased: digits,
ASCII letters and everything beyond ASCII. All characters that end a word are single bytes in
UTF-8, so the runs can be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bytes of text worked on at once; a longer text is still taken whole.
CHUNK_BYTES = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False

_U = np.uint64
_random = np.random.default_rng(20240607)
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_WORD_STEP = _U(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


@dataclass(frozen=True)
class Words:
    """The words of some texts: ``lower[start[i]:end[i]]`` are the bytes of word ``i``, and the
    words of text ``t`` are ``first[t] .. first[t + 1] - 1``."""

    lower: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def text(self, start: int, end: int) -> str:
        """Words ``start .. end - 1`` with a space between them."""
        return " ".join(
            self.lower[a:b].tobytes().decode("utf-8", "replace")
            for a, b in zip(self.start[start:end], self.end[start:end], strict=True)
        )

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of every run of ``size`` words within one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j, power in enumerate(_powers(_WORD_STEP, size)):
                total += self.hashes[j : j + n] * power
        owner = self.owner()
        at = np.flatnonzero(owner[:n] == owner[size - 1 :])
        return mixed(total[at]), at


def words(column: pa.StringArray) -> Words:
    column = column.fill_null("")
    column = pa.concat_arrays([column])  # without an offset into shared buffers
    _, offsets_buffer, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets_buffer, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    lower = _LOWER[raw]
    inside = np.concatenate([_IS_WORD[lower], [False]])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][inside[offsets[:-1]]]
    begins[cuts] = True
    start = np.flatnonzero(begins)
    # A word ends before the first byte outside, or where the next text begins.
    outside = np.flatnonzero(~inside)
    stop = outside[np.searchsorted(outside, start)] if len(start) else start
    end = np.minimum(stop, np.concatenate([start[1:], [len(raw)]])) if len(start) else start
    first = np.searchsorted(start, offsets)
    if len(start):
        size = end - start
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        of_bytes = lower[np.repeat(start, size) + place]
        with np.errstate(over="ignore"):
            values = _BYTE_VALUE[of_bytes] * _powers(_STEP, int(size.max()))[place]
            sums = np.add.reduceat(values, np.cumsum(size) - size)
            hashes = mixed(sums + size.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(lower, start, end, first, hashes)


def chunks(column: pa.StringArray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text, one row at least."""
    lengths = np.array([x or 0 for x in pa.compute.binary_length(column).to_pylist()], np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        limit = (ends[start - 1] if start else 0) + size
        stop = max(int(np.searchsorted(ends, limit, side="right")), start + 1)
        yield start, stop
        start = stop
