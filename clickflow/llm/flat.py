"""Text as flat arrays: one pass of numpy over many documents at a time.

A batch of texts becomes one byte array in which documents are separated by a
blank, so words, counts and hashes of all of them come from vector
operations. Word hashes come from prefix sums of a polynomial in 64-bit
arithmetic; a word's hash does not depend on where it stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18   # texts are taken in chunks of about this many bytes

_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        m = max(n, CHUNK_BYTES + CHUNK_BYTES // 2)
        inv = pow(int(_BASE), -1, 1 << 64)
        for name, b in (("up", int(_BASE)), ("down", inv)):
            p = np.full(m, b, dtype=np.uint64)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts add up to about ``limit`` bytes; a longer text
    is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


BLANK = byte_table(b" \t\n\x0b\x0c\r")
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


class Flat:
    """``texts`` (bytes) as arrays. ``data``: all bytes; ``doc_start`` and
    ``doc_end``: each document's range; ``start``, ``end``, ``doc``: each
    word's range and document, in order."""

    def __init__(self, texts: list[bytes], fold: bool = True):
        self.n = len(texts)
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        self.doc_start = np.concatenate(([0], np.cumsum(sizes + 1)))[:self.n]
        self.doc_end = self.doc_start + sizes
        self.raw = raw
        self.data = FOLD[raw] if fold else raw
        blank = BLANK[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1
        self.doc_words = np.bincount(self.doc, minlength=self.n)
        self.first_word = np.concatenate(([0], np.cumsum(self.doc_words)))
        self._prefix: np.ndarray | None = None

    def hash_range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        up, down = _power(len(self.data) + 1)
        with np.errstate(over="ignore"):
            if self._prefix is None:
                p = np.empty(len(self.data) + 1, dtype=np.uint64)
                p[0] = 0
                np.cumsum(BYTE_CODE[self.data] * up[:len(self.data)], out=p[1:])
                self._prefix = p
            h = (self._prefix[end] - self._prefix[start]) * down[start]
            return mix(h + (end - start).astype(np.uint64))

    def word_hash(self) -> np.ndarray:
        return self.hash_range(self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of every run of ``k`` words, in order; a document
        of fewer words, but not none, has its whole sequence as one."""
        h, n = self.word_hash(), len(self.start)
        out_d, out_h = [], []
        if n >= k:
            s = h[:n - k + 1]
            for j in range(1, k):
                with np.errstate(over="ignore"):
                    s = mix(s * _U(3) + h[j:n - k + 1 + j])
            whole = self.doc[:n - k + 1] == self.doc[k - 1:]
            out_d.append(self.doc[:n - k + 1][whole])
            out_h.append(s[whole])
        short = np.flatnonzero((self.doc_words > 0) & (self.doc_words < k))
        if len(short):
            hs = []
            for d in short:
                s = h[self.first_word[d]]
                for j in range(self.first_word[d] + 1, self.first_word[d + 1]):
                    with np.errstate(over="ignore"):
                        s = mix(np.array([s * _U(3) + h[j]]))[0]
                hs.append(mix(np.array([s ^ _U(int(self.doc_words[d]))]))[0])
            out_d.append(short)
            out_h.append(np.array(hs, dtype=np.uint64))
        if not out_d:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        d, s = np.concatenate(out_d), np.concatenate(out_h)
        if len(out_d) > 1:
            o = np.argsort(d, kind="stable")
            d, s = d[o], s[o]
        return d, s

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of ``flags`` (one per byte) over each document's bytes."""
        c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return c[self.doc_end] - c[self.doc_start]

    def per_word_sum(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=values, minlength=self.n)


def release_memory() -> None:
    """Give freed memory back to the system: workers are reused and stay, and
    an executor runs several of them beside its heap."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # not this C library
        pass


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; NULL is empty."""
    import pyarrow as pa
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]
