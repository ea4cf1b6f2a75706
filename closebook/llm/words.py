"""Vectorised words and hashes of whole texts.

A batch of texts is one byte buffer. Words are runs of bytes of a class, and
every word gets a 64-bit hash from prefix sums of a polynomial over the
buffer, so no Python code runs per word. Buffers are cut at word ends into
slices of ``SLICE`` bytes, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 21
BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8: powers differ in their low bits as late as possible
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Kept(dict):
    """Tables that each process makes for itself: shipped empty."""

    def __reduce__(self):
        return _Kept, ()


_TABLES = _Kept()


def _tables(n: int) -> dict[str, np.ndarray]:
    """Powers of BASE and of its inverse, and a random value per byte (kept by each worker)."""
    if len(_TABLES.get("up", ())) < n:
        n = max(n, SLICE + 1)
        _TABLES["up"], _TABLES["down"] = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
        _TABLES["byte"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return _TABLES


def byte_class(separators: str) -> np.ndarray:
    """True for bytes that belong to words. ``separators``: 'space' ([\\x20\\x09-\\x0D]) or
    'punct' ([\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F], after lower-casing)."""
    word = np.ones(256, bool)
    if separators == "space":
        word[0x20] = False
        word[0x09:0x0E] = False
    else:
        word[0x00:0x30] = False
        word[0x3A:0x61] = False
        word[0x7B:0x80] = False
        word[0x41:0x5B] = True  # these are lower-cased
    return word


def lower_table() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[0x41:0x5B] += 32
    return low


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the n + 1 offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def row_slices(offs: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes each, or one row."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def _word_hashes(data: np.ndarray, inner: np.ndarray, word: np.ndarray, low: np.ndarray):
    """Starts, ends and hashes of the words of a buffer; ``inner`` holds offsets where texts begin."""
    is_word = np.concatenate(([False], word[data], [False]))
    begins = is_word[1:-1] & ~is_word[:-2]
    ends = is_word[1:-1] & ~is_word[2:]
    if len(inner):
        begins[inner] = is_word[inner + 1]
        ends[inner - 1] = is_word[inner]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    t = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(t["byte"][low[data]] * t["up"][:len(data)], out=sums[1:])
    return starts, stops, mix((sums[stops] - sums[starts]) * t["down"][starts])


def words_of(data: np.ndarray, offs: np.ndarray, separators: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint64) of all words, and the n + 1 offsets of the texts' words.

    A-Z are lower-cased. Texts beyond ``SLICE`` bytes are hashed slice by
    slice, cut where a word ends.
    """
    word, low = byte_class(separators), lower_table()
    if len(data) <= SLICE:
        inner = np.unique(offs[1:-1])
        starts, _, hashes = _word_hashes(data, inner[(inner > 0) & (inner < len(data))], word, low)
        return hashes, np.searchsorted(starts, offs)
    counts, out = [], []
    for lo, hi in zip(offs[:-1], offs[1:]):
        n = 0
        while lo < hi:
            cut = min(hi, lo + SLICE)
            while cut < hi and word[data[cut - 1]] and word[data[cut]]:
                cut += 1
            _, _, hashes = _word_hashes(data[lo:cut], np.zeros(0, np.int64), word, low)
            out.append(hashes)
            n, lo = n + len(hashes), cut
        counts.append(n)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate(([0], np.cumsum(counts)))


def gram_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words (empty with fewer words)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, (k * 0xA24BAED4963EE407 + seed) & MASK, np.uint64)
    for j in range(k):
        total *= np.uint64(BASE)
        total += hashes[j:j + n]
    return mix(total)
