"""Documents in blocks of bounded size, and messages between blocks and key ranges.

Counting something over all windows of all texts would shuffle one row per
window, and a frequent window would be a hot key. Here each block of documents
first reduces its own windows to distinct sorted keys and sends them, packed,
to key ranges; a key reaches its range once per block, however many documents
hold it. The range answers each block in the order the block sent its keys.
Blocks and key ranges grow in number with the input, not in size.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 << 20
# What one key range reads at once.
RANGE_BYTES = 16 << 20
# Blocks whose messages a range folds at a time.
MESSAGE = "range long, block long, keys binary, extra binary"
ANSWER = "block long, range long, payload binary"


class Blocks:
    """``frame``: (block, id, text). ``count`` blocks over ``size`` bytes of text in ``rows`` documents."""

    def __init__(self, frame: DataFrame, count: int, size: int, rows: int):
        self.frame, self.count, self.size, self.rows = frame, count, size, rows

    def ranges(self, bytes_per_text_byte: float) -> int:
        """Number of key ranges for messages of so many bytes for each byte of text."""
        return max(1, ceil(self.size * bytes_per_text_byte / RANGE_BYTES))


def into_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Spread documents over blocks by a hash of id and text. A document is never split."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    size, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = max(1, ceil(max(size or 0, count * 64) / block_bytes))
    key = F.xxhash64("id", "text")
    frame = rows.select(F.pmod(key, F.lit(blocks)).alias("block"), "id", "text")
    return Blocks(frame, blocks, size or 0, count)


def ids_of(column) -> np.ndarray:
    """Ids as numbers; a null id comes after all others."""
    return column.combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each 64-bit key; sorted keys come out in order of ranges."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def squeeze(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each key and, below it, 32 bits of its place inside the range; keeps the order of the keys."""
    low = np.uint64(0xFFFFFFFF)
    product = (keys >> np.uint64(32)) * np.uint64(ranges)
    inside = (product & low) + (((keys & low) * np.uint64(ranges)) >> np.uint64(32))
    return (product & ~low) | np.minimum(inside, low)


def split_sorted(keys: np.ndarray, ranges: int) -> list[tuple[int, int, int]]:
    """(range, from, to) of the parts of sorted ``keys``."""
    where = range_of(keys, ranges)
    cuts = np.flatnonzero(np.diff(where)) + 1 if len(keys) else np.empty(0, dtype=np.int64)
    edges = [0, *cuts.tolist(), len(keys)] if len(keys) else [0]
    return [(int(where[a]), a, b) for a, b in zip(edges[:-1], edges[1:])]
