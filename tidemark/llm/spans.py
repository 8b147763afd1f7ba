"""Words of whole Arrow text columns as numpy arrays.

Texts stay UTF-8 bytes: the separators of every contract are ASCII, so byte-wise work
is exact.  A word's hash is a polynomial over random odd byte values modulo 2**64,
read off prefix sums, and then mixed with the word's length.  Such polynomials collide
on long words of a certain build (Thue-Morse), so words over LONG bytes get a
cryptographic hash instead.
"""

from __future__ import annotations

import ctypes
import hashlib
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_UP: np.ndarray = np.ones(1, np.uint64)
_DOWN: np.ndarray = np.ones(1, np.uint64)
SLICE = 1 << 19
#: Bytes up to which a word's hash is the polynomial.
LONG = 64


def byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: ASCII white space: the separators of words for shingles and language models.
SPACE = byte_table(b" \t\n\x0b\x0c\r")
#: Everything ASCII but letters and digits: the separators of decontamination words.
NOT_ALNUM = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Everything ASCII but letters.
NOT_LETTER = byte_table(bytes(b for b in range(128) if not chr(b).isalpha()))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUE = (np.random.default_rng(20250101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_FOLDED = _VALUE[LOWER]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) >= n:
        return _UP, _DOWN
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= 16 * SLICE:
        _UP, _DOWN = out
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back: workers are reused, and other stages stand beside them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: nothing to give back by hand
        pass


def releasing(run):
    """An iterator function for mapInArrow that gives memory back when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


_released = 0.0


def releasing_groups(run):
    """A function of one table for applyInArrow that gives memory back, once a second at most."""

    def wrapped(table: pa.Table) -> pa.Table:
        global _released
        out = run(table)
        if time.monotonic() - _released > 1:
            release()
            _released = time.monotonic()
        return out

    return wrapped


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def same_spans(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which spans of equal sizes hold the same bytes, eight bytes at a time."""
    equal = np.ones(len(size), bool)
    for i in np.flatnonzero(size > 8 * LONG).tolist():
        equal[i] = bool((a[a_at[i] : a_at[i] + size[i]] == b[b_at[i] : b_at[i] + size[i]]).all())
    rest, done = np.flatnonzero(size <= 8 * LONG), 0
    if not len(rest):
        return equal
    a8, b8 = _eights(a), _eights(b)
    while len(rest):
        left = size[rest] - done
        differ = a8[a_at[rest] + done] ^ b8[b_at[rest] + done]
        short = left < 8
        differ[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        equal[rest[differ != 0]] = False
        rest = rest[(left > 8) & (differ == 0)]
        done += 8
    return equal


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes (a longer text stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_edges(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends."""
    n = len(data)
    sep = separators[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0], after[-1] = True, True
        before[1:] = sep[:-1]
        after[:-1] = sep[1:]
    word = ~sep
    return np.flatnonzero(word & (before | edge[:-1])), np.flatnonzero(word & (after | edge[1:])) + 1


class Words:
    """Words (or other spans in order, none over a text's end) of some texts: row of each, byte start and end, hash; rows' first words.

    With `fold`, hashes take A-Z for a-z.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = True):
        self.data, self.start, self.end = data, start, end
        n = len(data)
        up, self._down = _powers(n + 1)
        self._fold = fold
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _VALUE)[data] * up[:n], out=self._sums[1:])
        #: index of each row's first word, and one past the last row
        self.first = np.searchsorted(start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = self.prefix_hash(None)

    def prefix_hash(self, length: int | None) -> np.ndarray:
        """Hash of each word's first bytes, or of the word."""
        end = self.end if length is None else np.minimum(self.end, self.start + length)
        raw = (self._sums[end] - self._sums[self.start]) * self._down[self.start]
        out = mix(raw + (end - self.start).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        for i in np.flatnonzero(end - self.start > LONG).tolist():
            word = self.data[self.start[i] : end[i]]
            digest = hashlib.blake2b((LOWER[word] if self._fold else word).tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, "<u8")[0]
        return out


def words_of(column: pa.Array, separators: np.ndarray, limit: int = SLICE, fold: bool = True) -> Iterator[tuple[int, int, Words]]:
    """Slices of a column with their words."""
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets, limit):
        at = offsets[lo : hi + 1]
        own, at = data[at[0] : at[-1]], at - at[0]
        yield lo, hi, Words(own, at, *word_edges(own, at, separators), fold)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; runs over a row's end are for the caller to drop."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(_BASE) + words[i : n + i])
    return out
