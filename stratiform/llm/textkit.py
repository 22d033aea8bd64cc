"""Vectorised text scanning over Arrow string columns.

A string column is cut into chunks of whole texts (about a megabyte of UTF-8
each, or one longer text), and every chunk is scanned with numpy: word
boundaries, a 64-bit hash for each word, per-text sums. Nothing is truncated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` (or its inverse) modulo 2**64 for i < n."""
    key = "inv" if inverse else "base"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, _INV if inverse else _BASE, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size > 16 * CHUNK_BYTES:      # an exceptional text: don't keep its table
            return have[:n]
        _powers[key] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective, so it adds no collisions)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lookup(chars: str | bytes) -> np.ndarray:
    """Boolean table over byte values."""
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(chars.encode() if isinstance(chars, str) else chars, dtype=np.uint8)] = True
    return out


#: Bytes of words ``[^\x20\x09-\x0D]+``.
NON_SPACE = ~lookup(b" \t\n\x0b\x0c\r")
#: Bytes that lower A-Z and leave the rest.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Chunk:
    """Whole texts lying one after another in ``data``.

    ``lo``/``hi`` are the row range in the column, ``begin``/``end`` the byte
    range of each text in ``data``."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, lo: int):
        self.data, self.begin, self.end = data, begin, end
        self.lo, self.hi = lo, lo + len(begin)

    def __len__(self) -> int:
        return len(self.begin)

    def raw(self, i: int) -> bytes:
        return self.data[self.begin[i]:self.end[i]].tobytes()

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        total = np.zeros(len(x) + 1, dtype=np.float64 if x.dtype.kind == "f" else np.int64)
        np.cumsum(x, out=total[1:])
        return total[self.end] - total[self.begin]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Chunks of a string column; null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        base = at[lo]
        yield Chunk(data[base:at[hi]], at[lo:hi] - base, at[lo + 1:hi + 1] - base, lo)
        lo = hi


class Words:
    """Words of a chunk: byte ranges, text index and a 64-bit hash of each."""

    def __init__(self, chunk: Chunk, is_word: np.ndarray = NON_SPACE, fold: np.ndarray | None = None):
        data = chunk.data if fold is None else fold[chunk.data]
        n = len(data)
        inside = np.zeros(n + 1, dtype=bool)
        inside[:n] = is_word[data]
        first = inside[:n].copy()
        first[1:] &= ~inside[:n - 1]
        last = inside[:n] & ~inside[1:]
        full = chunk.end > chunk.begin
        head, tail = chunk.begin[full], chunk.end[full] - 1
        first[head] = inside[head]
        last[tail] = inside[tail]
        self.data = data
        self.start = np.flatnonzero(first)
        self.stop = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(chunk.end, self.start, side="right")
        #: First word of each text, and the one after its last.
        self.begin = np.searchsorted(self.start, chunk.begin, side="left")
        self.end = np.searchsorted(self.start, chunk.end, side="left")
        self.count = self.end - self.begin

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.start, self.stop)


_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_ROUNDS = 32


def byte_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span: eight at a time, over all spans at once."""
    size = stop - start
    out = mix(size.astype(np.uint64))
    if not len(start):
        return out
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    todo, at, left = np.arange(len(start)), start, size
    for _ in range(_ROUNDS):
        out[todo] = mix(out[todo] * _BASE ^ (eight[at] & _MASKS[np.minimum(left, 8)]))
        more = left > 8
        if not more.any():
            return out
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    # Spans of more than 256 bytes: the rest by the polynomial.
    rest = span_hashes(data[at[0]:], at - at[0], at + left - at[0])
    out[todo] = mix(out[todo] * _BASE ^ rest)
    return out


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial modulo 2**64, with a leading zero."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=out[1:])
    return out


def span_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:stop]`` for each span, by contents and length alone."""
    if len(start) == 0:
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_hash(values)
    got = (sums[stop] - sums[start]) * powers(int(start.max()) + 1, inverse=True)[start]
    return mix(got + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(word_hash: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, in order; may cross text borders."""
    n = len(word_hash) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    start = np.arange(n)
    return span_hashes(word_hash, start, start + width)
