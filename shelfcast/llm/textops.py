"""Vectorised text primitives shared by the corpus operators.

Everything here works on one slice of an Arrow batch inside a Spark task: numpy over the
UTF-8 bytes, no per-word Python. Words are the runs of ``[^\\x20\\x09-\\x0D]``; a null text
has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_RE = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at a time inside a task; bounds the temporaries to some 20 MB.
SLICE_BYTES = 1 << 19

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_IS_ALNUM = np.zeros(256, bool)
_IS_ALNUM[128:] = True
for _a, _z in (("a", "z"), ("A", "Z"), ("0", "9")):
    _IS_ALNUM[ord(_a):ord(_z) + 1] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(self.inverse, k, 1 << 64))])
        return self.up, self.down


_BYTES, _GRAMS, _GRAMS2 = _Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F)


class Ranges:
    """Hashes of any range of a sequence of 64-bit codes, in constant time each."""

    def __init__(self, codes: np.ndarray, second: bool = False):
        self.powers = _GRAMS2 if second else _GRAMS
        up, self.down = self.powers.to(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, _U)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(_U))


class Slice:
    """A few texts: bytes, offsets and words.

    ``data``: all bytes; ``off``: byte offset of each text, and the end; ``start``/``end``: bytes
    of each word; ``woff``: first word of each text, and the end; ``first``: position of the
    slice's first row in its batch.
    """

    def __init__(self, texts: pa.Array, first: int):
        n = len(texts)
        self.first, self.n = first, n
        width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        buffers = texts.buffers()
        off = np.frombuffer(buffers[1], width)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(buffers[2], np.uint8) if n and buffers[2] is not None else np.zeros(0, np.uint8)
        self.data, self.off = raw[off[0] : off[-1]], off - off[0]
        self._words()

    def folded(self) -> Slice:
        """Lower-case the ASCII and Latin-1 letters and cut words at everything but letters and digits."""
        d = _FOLD[self.data]
        accent = np.flatnonzero(d[:-1] == 0xC3) + 1 if len(d) else np.zeros(0, np.int64)
        accent = accent[(d[accent] >= 0x80) & (d[accent] <= 0x9E) & (d[accent] != 0x97)]
        d[accent] += 0x20
        self.data = d
        self._words(_IS_ALNUM)
        return self

    def _words(self, kinds: np.ndarray = _IS_WORD) -> None:
        word = kinds[self.data]
        m = len(word)
        begin, stop = word.copy(), word.copy()
        if m:
            begin[1:] &= ~word[:-1]
            stop[:-1] &= ~word[1:]
            edge = self.off[1:-1]
            edge = edge[(edge > 0) & (edge < m)]
            begin[edge] = word[edge]
            stop[edge - 1] = word[edge - 1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.woff = np.searchsorted(self.start, self.off)

    def range_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each range."""
        if not hasattr(self, "_sums"):
            up, self._down = _BYTES.to(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, _U)
            np.cumsum(_BYTE_CODE[self.data] * up[: len(self.data)], out=self._sums[1:])
        return mix64((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(_U))

    def word_hash(self) -> np.ndarray:
        return self.range_hash(self.start, self.end)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.woff))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value of each byte over each text."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.off[1:]] - sums[self.off[:-1]]

    def words(self, i: int) -> list[bytes]:
        return self.data[self.off[i] : self.off[i + 1]].tobytes().split()


def lower_words(s: Slice) -> Slice:
    """Lower-case A-Z alone and cut words at everything but letters, digits and bytes above ASCII."""
    s.data = _FOLD[s.data]
    s._words(_IS_ALNUM)
    return s


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of texts into slices of about ``limit`` bytes; a text is never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    size = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))]) if len(texts) else np.zeros(1)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(size, size[i] + limit, "right")) - 1)
        yield Slice(texts.slice(i, j - i), i)
        i = j


def grams(s: Slice, codes: np.ndarray, k: int, ranges: Ranges | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every ``k`` consecutive words that lie in one text."""
    count = np.maximum(np.diff(s.woff) - k + 1, 0)
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(s.woff[:-1], count)
    ranges = ranges or Ranges(codes)
    return at, ranges(at, at + k)
