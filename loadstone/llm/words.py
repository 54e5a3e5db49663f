"""Words of texts as hashes, computed over whole Arrow columns inside a task.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. The hash
of a word is a random linear form over its bytes; the hash of a window a random
linear form over its words. Both are mixed afterwards and fit 64 bits; where
equality of windows decides about a result, a second independent form is used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes hashed at a time; bounds the scratch memory, not the texts.
SLICE_BYTES = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    out = values ^ (values >> np.uint64(30))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def _keys(count: int, stream: int) -> np.ndarray:
    steps = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(stream << 40)
    return mix(steps * GOLDEN) | np.uint64(1)


class Words:
    """Words of a column of texts, document after document.

    ``hashes``: one per word. ``bounds``: word index where each document begins, one more at the end.
    ``starts``, ``ends``: byte range of each word in ``data``.
    """

    def __init__(self, hashes, bounds, starts, ends, data):
        self.hashes, self.bounds, self.starts, self.ends, self.data = hashes, bounds, starts, ends, data

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def documents(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def places(self) -> np.ndarray:
        """Position of each word in its document."""
        return np.arange(len(self.hashes)) - np.repeat(self.bounds[:-1], self.counts)

    def windows(self, size: int, stream: int = 1) -> np.ndarray:
        """Hash of the ``size`` words from each word on; runs over document ends, see ``complete``."""
        total = len(self.hashes) - size + 1
        if total <= 0:
            return np.empty(0, dtype=np.uint64)
        out = np.full(total, np.uint64(size), dtype=np.uint64)
        for k, key in enumerate(_keys(size, stream)):
            out += self.hashes[k : k + total] * key
        return mix(out)

    def complete(self, size: int) -> np.ndarray:
        """Word indexes where a window of ``size`` words lies in one document."""
        room = np.repeat(self.bounds[1:], self.counts) - np.arange(len(self.hashes))
        return np.flatnonzero(room >= size)


def read_words(texts, lower: bool = False, blank: np.ndarray = _BLANK) -> Words:
    """Words of an Arrow string column; a null text has none. ``lower`` folds A-Z only.

    ``blank`` says of each byte value whether it separates words.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # no chunks at all
        texts = pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    count = len(texts)
    if not count:
        empty = np.empty(0, dtype=np.int64)
        return Words(np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64), empty, empty, np.empty(0, dtype=np.uint8))
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + count + 1]
    body = texts.buffers()[2]
    raw = np.frombuffer(body, dtype=np.uint8) if body is not None else np.empty(0, dtype=np.uint8)
    data, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    solid = ~blank[data]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = edges[edges > 0] - 1
    last[inner] = solid[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = np.empty(len(starts), dtype=np.uint64)
    longest = int((ends - starts).max()) if len(starts) else 0
    keys = _keys(longest, 0)
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(starts, starts[at] + SLICE_BYTES)), at + 1)
        low, high = starts[at], ends[to - 1]
        chosen = np.flatnonzero(solid[low:high])
        piece = data[low:high][chosen]
        sizes = ends[at:to] - starts[at:to]
        begins = np.cumsum(sizes) - sizes
        inside = np.arange(len(piece)) - np.repeat(begins, sizes)
        terms = ((_LOWER[piece] if lower else piece).astype(np.uint64) + np.uint64(1)) * keys[inside]
        hashes[at:to] = mix(np.add.reduceat(terms, begins) + sizes.astype(np.uint64) * GOLDEN)
        at = to
    return Words(hashes, bounds, starts, ends, data)


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    sizes = np.where(keep, words.ends - words.starts + 1, 0)
    marks = np.zeros(len(words.data) + 1, dtype=np.int8)
    np.add.at(marks, words.starts[keep], 1)
    np.add.at(marks, words.ends[keep], -1)
    inside = np.cumsum(marks[:-1], dtype=np.int8).astype(bool)
    letters = words.data[inside]
    out = np.full(int(sizes.sum()), 32, dtype=np.uint8)
    kept = sizes[keep]
    spaces = np.zeros(len(out), dtype=bool)
    if len(kept):
        spaces[np.cumsum(kept) - 1] = True
    out[~spaces] = letters
    totals = np.concatenate([[0], np.cumsum(sizes)])[words.bounds]
    # The space after a document's last word goes.
    filled = np.diff(totals) > 0
    drop = np.ones(len(out), dtype=bool)
    drop[totals[1:][filled] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(np.diff(totals) - filled)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(words.bounds) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[drop].tobytes())
    ).cast(pa.string())
