"""Words and word runs of Arrow text columns, hashed with numpy.

A word is a maximal run of bytes of one class. Both classes in use contain every byte
of a multi-byte character, so working on UTF-8 bytes finds the same words as working
on code points. Hashes are 64 bits wide and the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a single longer text is handled alone.
PIECE_BYTES = 1 << 20
PIECE_ROWS = 1 << 10

U = np.uint64


def _odd(rng) -> int:
    return int(rng.integers(0, 2**63, dtype=np.uint64)) * 2 + 1


_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(0, 2**64, size=256, dtype=np.uint64)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BASE_BYTE, _BASE_WORD = _odd(_rng), _odd(_rng)

BLANKS = np.ones(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.ones(256, dtype=bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
# Letters A-Z count as their lower-case forms wherever ALNUM is used.
ALNUM[65:91] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, dtype=U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=U))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(_BASE_BYTE), _Powers(_BASE_WORD)


def _run_sums(values: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end], the same wherever the run stands."""
    up, down = powers.take(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Words:
    """The words of some texts, one after another."""

    hashes: np.ndarray
    starts: np.ndarray  # byte positions in data
    ends: np.ndarray
    first: np.ndarray  # per text, and one more: its first word
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each position on, and whether one text has them all."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(n, dtype=U), np.zeros(n, dtype=bool)
        at = np.arange(n - k + 1)
        found = np.zeros(n, dtype=U)
        found[: n - k + 1] = _run_sums(self.hashes, _word_powers, at, at + k)
        last = np.repeat(self.first[1:], self.counts())
        return found, np.arange(n) + k <= last

    def stretch(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words from each start to its end."""
        return _run_sums(self.hashes, _word_powers, starts, ends)

    def whole(self) -> np.ndarray:
        """Hash of all words of each text; equals the run hash of as many words."""
        return _run_sums(self.hashes, _word_powers, self.first[:-1], self.first[1:])


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = BLANKS, lower: bool = True) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; offsets start at 0."""
    n = len(data)
    inside = kind[data]
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    codes = _LOWER if lower else _BYTE
    hashes = np.empty(len(starts), dtype=U)
    at = 0
    while at < len(starts):
        # Whole words of about PIECE_BYTES at a time keep the 64-bit arrays small.
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE_BYTES)))
        low, high = starts[at], ends[stop - 1]
        hashes[at:stop] = _run_sums(
            codes[data[low:high]], _byte_powers, starts[at:stop] - low, ends[at:stop] - low
        )
        at = stop
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), data)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, chars = column.buffers()
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(chars, dtype=np.uint8) if chars is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi of a text column with their bytes and offsets, PIECE_BYTES or ``size`` at a time."""
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + (size or PIECE_BYTES), side="right")) - 1
        hi = min(n, lo + PIECE_ROWS, max(lo + 1, hi))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def signed(x: np.ndarray) -> np.ndarray:
    """Hashes as Spark's bigint."""
    return x.view(np.int64)
