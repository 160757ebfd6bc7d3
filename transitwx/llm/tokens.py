"""Words and word windows as numpy hash arrays, straight from Arrow text.

A slice of rows is hashed at once. Words are read eight bytes at a time, each
block mixed before the next one is added, so that no pattern of bytes (such as
Thue-Morse words, on which every polynomial hash modulo a power of two fails)
makes different words equal. A running sum of ``hash * R**i`` over the words gives
every window as a difference of two entries. No Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: What the hashes of words begin with, by hash number.
WORD_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: Odd multipliers of the running sums over words, by hash number.
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SLICE_BYTES = 1 << 20

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def plain_table() -> np.ndarray:
    """Words as they stand: runs of bytes other than space and 0x09-0x0D."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


def folded_table() -> np.ndarray:
    """Words of letters and digits, A-Z lower-cased; other ASCII separates."""
    table = np.zeros(256, dtype=np.uint16)
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.isalnum():
            table[b] = (ord(c.lower()) if b < 128 else b) + 1
    return table


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _powers[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Keeps the first n of eight bytes.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of byte spans; ``data`` has eight bytes more than the spans."""
    length = ends - starts
    h = mix(length.astype(np.uint64) ^ np.uint64(seed))
    blocks = np.ndarray(max(len(data) - 7, 0), np.dtype("<u8"), data, strides=(1,))
    active, done = np.flatnonzero((length > 0) & (length <= LONG_WORD)), 0
    while len(active):
        left = np.minimum(length[active] - done, 8)
        h[active] = mix(h[active] ^ (blocks[starts[active] + done] & _KEEP[left]))
        done += 8
        active = active[length[active] > done]
    for i in np.flatnonzero(length > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return h


@dataclass
class Words:
    """The words of some rows, in order."""

    first: np.ndarray  # row -> index of its first word; one more entry at the end
    row: np.ndarray  # word -> row
    start: np.ndarray  # word -> byte offset in its slice
    end: np.ndarray
    hashes: list[np.ndarray]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of rows of about ``limit`` bytes, never splitting a text; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, column.slice(at, to - at)
        at = to


def words_of(column: pa.Array, table: np.ndarray, hashes: int = 1) -> Words:
    """Find and hash all words of a slice."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    bounds = offsets - lo
    values = table[raw]
    inside = np.zeros(len(values) + 2, bool)
    inside[1:-1] = values != 0
    edge = inside[1:] != inside[:-1]
    # a word also ends where its row ends
    cut = bounds[(bounds > 0) & (bounds < len(values))]
    joined = np.unique(cut[inside[cut] & inside[cut + 1]]) if len(cut) else cut
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    if len(joined):
        starts = np.sort(np.concatenate([starts, joined]))
        ends = np.sort(np.concatenate([ends, joined]))
    row = (np.searchsorted(bounds, starts, side="right") - 1).astype(np.int64)
    first = np.searchsorted(row, np.arange(n + 1)).astype(np.int64)
    data = np.zeros(len(values) + 8, np.uint8)
    data[: len(values)] = values - 1
    return Words(first, row, starts, ends, [span_hashes(data, starts, ends, WORD_SEEDS[k]) for k in range(hashes)])


def windows(words: Words, size: int, k: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each word on; see ``valid_windows``."""
    h = words.hashes[k]
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(WORD_BASES[k], len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:-1], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n] + np.uint64(size))


def valid_windows(words: Words, size: int) -> np.ndarray:
    """Whether the ``size`` words from each word on lie in one row."""
    n = len(words.row) - size + 1
    return words.row[:n] == words.row[size - 1 :] if n > 0 else np.zeros(0, bool)
