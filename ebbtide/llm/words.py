"""Words of Arrow text columns as NumPy arrays: positions and 64-bit hashes.

Texts are cut on their UTF-8 bytes. All separators used here are ASCII, so cutting
bytes and cutting characters give the same words. Work goes in blocks of about
``BLOCK`` bytes, whatever the length of one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_table(*separators: int) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


# Words are runs of anything but space and the five ASCII space controls.
SPACED = byte_table(0x20, *range(0x09, 0x0E))
# Words are runs of ASCII digits, lower-case ASCII letters and everything beyond ASCII.
ALNUM = byte_table(*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))
SAME = np.arange(256, dtype=np.uint8)
LOWERED = SAME.copy()
LOWERED[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Some rows of a batch: bytes, word bounds, and where each row's words begin."""

    first: int
    rows: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_words: np.ndarray  # rows + 1 offsets into starts

    def words_of(self, row: int) -> slice:
        return slice(self.row_words[row], self.row_words[row + 1])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null has no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks(column: pa.Array, letters: np.ndarray, fold: np.ndarray = SAME, block: int = BLOCK) -> Iterator[Chunk]:
    """Rows of ``column`` in runs of at most ``block`` bytes, one row at least."""
    offsets, data = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, "right")) - 1)
        part = fold[data[offsets[first] : offsets[last]]] if fold is not SAME else data[offsets[first] : offsets[last]]
        bounds = offsets[first : last + 1] - offsets[first]
        inside = letters[part]
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(part))]
        begins[edges] = inside[edges]
        finishes[edges - 1] = inside[edges - 1]
        starts = np.flatnonzero(begins)
        yield Chunk(first, last - first, part, starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, bounds))
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        _powers[:] = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def word_hashes(chunk: Chunk) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    out = np.empty(len(chunk.starts), np.uint64)
    i = 0
    while i < len(out):
        origin = chunk.starts[i]
        j = max(i + 1, int(np.searchsorted(chunk.ends, origin + BLOCK, "right")))
        part = chunk.data[origin : chunk.ends[j - 1]]
        power, inverse = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        a, b = chunk.starts[i:j] - origin, chunk.ends[i:j] - origin
        out[i:j] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words, by its first word; runs cross row ends."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total += words[k : len(words) - n + 1 + k] * np.uint64(factor)
    return mix(total)


def sequence_hash(words: np.ndarray) -> int:
    """Hash of a whole short sequence; differs from that of any run of another length."""
    h = np.array([len(words)], np.uint64)
    for w in words:
        h = mix(h * np.uint64(0xD1342543DE82EF95) + w)
    return int(h[0])
