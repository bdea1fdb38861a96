"""Words of whole Arrow batches as 64-bit hashes, computed with numpy over the UTF-8 bytes.

Tasks work on slices of a few megabytes, so memory does not depend on the size of a batch.
Hashes are the same in every process: they depend only on the bytes of a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 4 << 20
_BYTE_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; salts give independent families."""
    x = x ^ U((salt * 0xD1342543DE82EF95) & (2**64 - 1))
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_POWERS: dict[int, np.ndarray] = {}
#: Tables of powers grow by so many entries, so that they hold little beyond what the longest slice needs.
STEP = 1 << 18


def _table(base: int, n: int) -> np.ndarray:
    """Powers of ``base``, n at least; one table per base and process, as long as its longest slice needed."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        steps = np.full(-(-max(n, 1) // STEP) * STEP, base, U)
        steps[0] = 1
        held = _POWERS[base] = np.multiply.accumulate(steps)
    return held


def slices(batch: pa.RecordBatch, column: str | int = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows of at most ``size`` bytes of text (one row at least)."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(batch):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a text column: hash, row and place of each, and the words of each row.

    ``hashes[i]`` is word i's, ``rows[i]`` its row, ``places[i]`` its number in that row; row r has
    the words ``first[r]`` to ``first[r + 1]``. A null text has none.
    """

    def __init__(self, texts: pa.Array, lower: bool):
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(offsets[-1] - offsets[0])
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[0] + size]
        offsets = offsets - offsets[0]
        if lower:
            data = _LOWER[data]
        space = _SPACE[data]
        starts_row, ends_row = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        starts_row[offsets[:-1]] = True
        ends_row[offsets[1:]] = True
        before = np.concatenate([[True], space])[:size] | starts_row[:size]
        after = np.concatenate([space[1:], [True]])[:size] | ends_row[1:]
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        self.data = data
        sums = np.zeros(size + 1, U)
        np.cumsum(_BYTE_VALUES[data] * _table(_BASE, size)[:size], out=sums[1:])
        inverse = _table(pow(_BASE, -1, 2**64), size)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])
        self.rows = np.searchsorted(offsets, self.starts, side="right") - 1
        self.first = np.searchsorted(self.rows, np.arange(len(texts) + 1))
        self.places = np.arange(len(self.hashes)) - self.first[self.rows]
        self.counts = np.diff(self.first)

    def windows(self, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of n words inside a row, and the index of each one's first word."""
        if len(self.hashes) < n:
            return np.empty(0, U), np.empty(0, np.int64)
        total = len(self.hashes) - n + 1
        value = np.zeros(total, U)
        step = U(_BASE ^ (salt * 0x5851F42D4C957F2D & (2**64 - 2)))
        for j in range(n):
            value = value * step + self.hashes[j : j + total]
        inside = np.flatnonzero(self.places[:total] + n <= self.counts[self.rows[:total]])
        return mix(value[inside], salt), inside
