"""Vectorised word, shingle and character work on Arrow string arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RANDOM = np.random.default_rng(20_231)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _POWERS:
        if size <= 4 * BLOCK_BYTES:
            _POWERS.clear()
        up = np.full(size, _BASE, np.uint64)
        down = np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 4 * BLOCK_BYTES:
            return made
        _POWERS[size] = made
    return _POWERS[size]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and each text's end points (nulls are empty)."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each make about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(lengths)])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words (runs of bytes that are not white space) of a block of texts.

    start, end: byte places; hash: 64-bit hash of the word with A-Z lower-cased; doc: the text's index; count: words of each text.
    """

    def __init__(self, texts: pa.Array):
        self.data, self.ends = data, ends = text_bytes(texts)
        n = len(data)
        inside = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[ends] = True  # a text's end also ends its last word
        first = inside.copy()
        if n:
            first[1:] &= ~inside[:-1] | edge[1:n]
        self.start = np.flatnonzero(first)
        last = inside.copy()
        if n:
            last[:-1] &= ~inside[1:] | edge[1:n]
        self.end = np.flatnonzero(last) + 1
        up, down = _powers(max(n, 1))
        summed = np.zeros(n + 1, np.uint64)
        np.cumsum(_LOWER[data] * up[:n], out=summed[1:])
        self.hash = mix((summed[self.end] - summed[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        bounds = np.searchsorted(self.start, ends)
        self.count = np.diff(bounds)
        self.bounds = bounds
        self.doc = np.repeat(np.arange(len(ends) - 1), self.count)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles on end, and each text's end points.

    A text of fewer than ``width`` words, but one at least, has its whole sequence as its only shingle.
    """
    w = Words(texts)
    n_docs, n = len(w.ends) - 1, len(w.hash)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    last_of_doc = w.bounds[1:][w.doc]
    at = np.arange(n)
    whole = at + width <= last_of_doc
    short = (at == w.bounds[:-1][w.doc]) & ~whole
    total = np.zeros(n, np.uint64)
    for k in range(width):
        reach = np.minimum(at + k, n - 1)
        part = mix(w.hash[reach] * _PLACE[k])
        part[at + k >= last_of_doc] = 0
        total += part
    keep = whole | short
    hashes, docs = mix(total[keep]), w.doc[keep]
    # sort by (doc, hash) within each text, then drop repeats
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[new], docs[new]
    return hashes, np.searchsorted(docs, np.arange(n_docs + 1))
