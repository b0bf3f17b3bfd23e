"""Words of Arrow string columns as numpy arrays: bounds and 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Separators of the word pattern [^\x20\x09-\x0D]+ as bytes of UTF-8.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Texts are taken together up to this many bytes, so that working arrays stay bounded; a longer text is taken alone.
SLICE = 1 << 20

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
#: The same, with A-Z as a-z.
LOWER = BYTES.copy()
LOWER[65:91] = BYTES[97:123]
BASE = 0x9E3779B97F4A7C55 | 1
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 2 * len(_powers)), U(BASE), U)
        more[0] = U(1)
        _powers = np.multiply.accumulate(more)
    return _powers


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and len + 1 offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    _, offsets, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


class Words:
    """Words of texts first..last-1 of a column: starts and ends (bytes in buf), hashes, and bounds of each text's words."""

    __slots__ = ("buf", "ends", "first", "hashes", "of", "starts")

    def __init__(self, buf, first, starts, ends, hashes, of):
        self.buf, self.first, self.starts, self.ends, self.hashes, self.of = buf, first, starts, ends, hashes, of

    def __len__(self) -> int:
        return len(self.of) - 1

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; the last k - 1 of a text are void (use each())."""
        return chain(self.hashes, k)

    def each(self) -> Iterator[tuple[int, int, int]]:
        """(text, first word, end) of every text."""
        of = self.of.tolist()
        for i in range(len(of) - 1):
            yield self.first + i, of[i], of[i + 1]


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive values, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.full(n, U(k), U)
    for j in range(k):
        out = out * U(0xD6E8FEB86659FD93) + hashes[j : j + n]
        out ^= out >> U(32)
    return mix(out)


def slices(col: pa.Array, sep: np.ndarray = SPACE, table: np.ndarray = BYTES) -> Iterator[Words]:
    """All words of a column, some texts at a time."""
    buf, at = buffers(col)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + SLICE, "right")) - 1)
        yield _words(buf[at[i] : at[j]], at[i : j + 1] - at[i], i, sep, table)
        i = j


def _words(buf: np.ndarray, at: np.ndarray, first: int, sep: np.ndarray, table: np.ndarray) -> Words:
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(buf, first, z, z, np.zeros(0, U), np.zeros(len(at), np.int64))
    word = ~sep[buf]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | cut[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | cut[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    of = np.searchsorted(starts, at)
    if not len(starts):
        return Words(buf, first, starts, ends, np.zeros(0, U), of)
    lengths = ends - starts
    inside = np.flatnonzero(word)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(inside)) - np.repeat(firsts, lengths)
    values = table[buf[inside]] * powers(int(lengths.max()))[place]
    return Words(buf, first, starts, ends, mix(np.add.reduceat(values, firsts) + lengths.astype(U)), of)
