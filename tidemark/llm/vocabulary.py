"""Tokenizing by distinct chunks.

Words repeat, so texts are cut into chunks whose tokens do not depend on what stands
around them, and a task has each distinct chunk tokenized once. The places to cut are
chosen per tokenizer; what is remembered is bounded.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct chunks that a task remembers, and the bytes that they may have together.
MEMO_CHUNKS = 600_000
MEMO_BYTES = 32 << 20
# Bytes of text, and chunks, that are looked up at once.
LOOKUP_BYTES = 4 << 20
LOOKUP = 1 << 20


def resolve(vocabulary: str) -> str:
    """The file of a vocabulary: a path, or the name of a public tokenizer."""
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... of each range, one range after another."""
    ends = np.cumsum(lengths)
    return np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Lists:
    """Lists of numbers, one after another in one growing array."""

    def __init__(self, dtype=np.int64):
        self.values = np.zeros(1 << 12, dtype=dtype)
        self.firsts = np.zeros(1 << 10, dtype=np.int64)
        self.n = 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        held = int(self.firsts[self.n])
        for name, need in (("values", held + len(values)), ("firsts", self.n + len(lengths) + 1)):
            now = getattr(self, name)
            if need > len(now):
                grown = np.zeros(max(need, 2 * len(now)), dtype=now.dtype)
                grown[: len(now)] = now
                setattr(self, name, grown)
        self.values[held : held + len(values)] = values
        self.firsts[self.n + 1 : self.n + 1 + len(lengths)] = held + np.cumsum(lengths)
        self.n += len(lengths)

    def lengths(self, slots: np.ndarray) -> np.ndarray:
        return self.firsts[slots + 1] - self.firsts[slots]

    def take(self, slots: np.ndarray) -> np.ndarray:
        return self.values[ranges(self.firsts[slots], self.lengths(slots))]


class Memo:
    """Slots of distinct chunks; ``learn`` is told the chunks that are new, in order of slot.

    ``reset`` is called before the first chunk, and whenever the memo is full and starts anew.
    Chunks are held as one Arrow array, so that none of them becomes an object but to be learned.
    """

    def __init__(self, learn: Callable[[pa.Array], None], reset: Callable[[], None]):
        self.learn, self.reset = learn, reset
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.reset()

    def look_up(self, data: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """Chunks lo to hi of data[cuts[i]:cuts[i + 1]] with the slot of each; use them before the next."""
        for lo in range(0, len(cuts) - 1, LOOKUP):
            hi = min(lo + LOOKUP, len(cuts) - 1)
            part = np.ascontiguousarray(data[cuts[lo] : cuts[hi]])
            offsets = (cuts[lo : hi + 1] - cuts[lo]).astype(np.int64)
            chunks = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(offsets), pa.py_buffer(part))
            coded = chunks.dictionary_encode()
            found = pc.index_in(coded.dictionary, value_set=self.known)
            new = coded.dictionary.filter(found.is_null()) if found.null_count else None
            if new is not None:
                if len(self.known) + len(new) > MEMO_CHUNKS or self.known.nbytes + new.nbytes > MEMO_BYTES:
                    self._clear()
                    new = coded.dictionary
                self.known = pa.concat_arrays([self.known, new])
                self.learn(new)
                found = pc.index_in(coded.dictionary, value_set=self.known)
            yield lo, hi, found.to_numpy().astype(np.int64)[coded.indices.to_numpy()]
