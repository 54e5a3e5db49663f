"""Near duplicates by SimHash fingerprints, found exactly by vantage-point trees over Hamming distance.

1. A fingerprint has a bit set if more than half of the document's shingle
   hashes have it. Documents with equal fingerprints are one entry from then on.
2. A vantage-point tree, grown from a bounded sample of entries, deals all
   entries to shards: at each node those within the node's distance of its vantage
   point go inside, the others outside. By the triangle inequality the
   distances of two linked entries to a vantage point differ by at most the radius, so
   a pair can only be parted where the outer one lies in the ring just beyond the
   border; entries of that ring go to both sides. So every linked pair meets in a shard,
   whatever the sample is; the sample only decides how evenly entries are dealt.
3. Inside a shard the same split goes on until a node is small or stops shrinking, and
   what is left is compared in full. A shard hands over a spanning forest of
   its links, never all pairs. A shard of many entries is cut into chunks, and
   each pair of chunks is a task of its own.
4. Components of the links give the classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm.components import components
from loadstone.session import settle

SEED = 42
# Shingles whose bits are counted at a time; texts may be of any length.
SLICE = 1 << 15
# Entries a shard should hold, sampled entries a shard is planned from, and the most that are sampled.
SHARD_ROWS = 2048
SHARD_SAMPLE = 32
MOST_SAMPLED = 1 << 18
# Entries compared in full.
BRUTE = 256
TRIES = 6
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- fingerprints ----------------------------------------------------------------


def _shingles(text: bytes, size: int) -> Iterator[list[int]]:
    """Hashes of the shingles of a text, some at a time; their order does not matter."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    size = min(size, len(words))
    firsts, lasts = starts[: len(words) - size + 1], ends[size - 1 :]
    for at in range(0, len(firsts), SLICE):
        yield [digest(line[a:b], SEED) for a, b in zip(firsts[at : at + SLICE].tolist(), lasts[at : at + SLICE].tolist())]


def fingerprint(text: str | None, size: int = 3) -> int:
    """64 bits; bit i is set if more than half of the shingle hashes have it. 0 without words."""
    total, ones = 0, np.zeros(64, dtype=np.int64)
    for hashes in _shingles((text or "").encode("utf-8", "surrogatepass"), size):
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(``id``, ``print``) of each row; ``print`` is the fingerprint as a signed number."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "print"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(read, "id long, print long")


# --- vantage points ---------------------------------------------------------------


def _split(prints: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and border that leave least work on both sides, or None where no split shrinks the node."""
    probe = prints[:: max(1, len(prints) // 1024)]
    whole, best = len(probe) ** 1.5, None
    for point in probe[np.linspace(0, len(probe) - 1, TRIES).astype(np.int64)]:
        upto = np.cumsum(np.bincount(np.bitwise_count(probe ^ point), minlength=65))
        inner, outer = np.append(upto[radius:], [len(probe)] * radius), len(probe) - upto
        work = inner**1.5 + outer**1.5
        border = int(np.argmin(np.where((inner < len(probe)) & (outer < len(probe)), work, np.inf)))
        if work[border] < 0.95 * whole and (best is None or work[border] < best[0]):
            best = (work[border], point, border)
    return best and best[1:]


class Tree:
    """Vantage points and borders; ``inner`` and ``outer`` name the next node, or shard -1 - s."""

    def __init__(self, sample: np.ndarray, radius: int, leaf: int):
        self.radius, self.shards = radius, 0
        nodes: list[list] = []
        todo = [(sample, None, 0)]
        while todo:
            prints, parent, side = todo.pop()
            cut = _split(prints, radius) if len(prints) > leaf else None
            if cut is None:
                name, self.shards = -1 - self.shards, self.shards + 1
            else:
                name = len(nodes)
                nodes.append([cut[0], cut[1], 0, 0])
                far = np.bitwise_count(prints ^ cut[0])
                todo += [(prints[far <= cut[1] + radius], name, 2), (prints[far > cut[1]], name, 3)]
            if parent is not None:
                nodes[parent][side] = name
        self.points = np.array([n[0] for n in nodes], dtype=np.uint64)
        self.borders, self.inner, self.outer = (np.array([n[k] for n in nodes], dtype=np.int64) for k in (1, 2, 3))

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the print, shard) for every shard a print belongs to."""
        at = np.arange(len(prints))
        node = np.zeros(len(prints), dtype=np.int64) if len(self.points) else np.full(len(prints), -1)
        done = []
        while len(at):
            leaf = node < 0
            done.append((at[leaf], -1 - node[leaf]))
            at, node = at[~leaf], node[~leaf]
            far = np.bitwise_count(prints[at] ^ self.points[node]).astype(np.int64)
            inside, outside = far <= self.borders[node] + self.radius, far > self.borders[node]
            at, node = np.concatenate([at[inside], at[outside]]), np.concatenate([self.inner[node[inside]], self.outer[node[outside]]])
        return np.concatenate([d[0] for d in done] or [at]), np.concatenate([d[1] for d in done] or [at])


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """Smallest index reachable from each of ``count`` nodes."""
    label = np.arange(count)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def forest_links(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within ``radius`` connect: (print, another one of its component)."""
    left, right = [], []
    todo = [prints]
    while todo:
        node = todo.pop()
        cut = _split(node, radius) if len(node) > BRUTE else None
        if cut is not None:
            far = np.bitwise_count(node ^ cut[0])
            todo += [node[far <= cut[1] + radius], node[far > cut[1]]]
            continue
        for at in range(0, len(node), BRUTE):
            # Every entry with those from its own block on.
            x, y = np.nonzero(np.bitwise_count(node[at : at + BRUTE, None] ^ node[None, at:]) <= radius)
            x, y = x[x < y], y[x < y]
            label = _forest(x, y, len(node) - at)
            linked = np.flatnonzero(label != np.arange(len(label)))
            left.append(node[at:][linked])
            right.append(node[at:][label[linked]])
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def links(prints: DataFrame, radius: int, shard_rows: int = SHARD_ROWS, most_sampled: int = MOST_SAMPLED) -> DataFrame:
    """(a, b) of the distinct numbers in column ``print``; the links connect what pairs within ``radius`` connect.

    ``most_sampled`` bounds what the tree is grown from, and thereby what the driver holds.
    """
    spark, count = prints.sparkSession, prints.count()
    share = max(1, ceil(shard_rows / SHARD_SAMPLE), ceil(count / most_sampled))
    sample = prints.filter(F.pmod(F.xxhash64("print"), F.lit(share)) == 0).toPandas()["print"].to_numpy(dtype=np.int64)
    tree = spark.sparkContext.broadcast(Tree(np.sort(sample).view(np.uint64), radius, SHARD_SAMPLE))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            at, shard = tree.value.route(numbers.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(numbers[at]), pa.array(shard)], names=["print", "shard"])

    dealt = settle(prints.select("print").mapInArrow(deal, "print long, shard long"))
    # One task reads at most about twice this; larger shards are cut, and their chunks meet in pairs.
    most = 4 * SHARD_SAMPLE * share
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("chunks"))
    placed = dealt.join(settle(sizes), "shard").withColumn("mine", F.pmod(F.xxhash64("print", F.lit(1)), F.col("chunks")))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "print", "shard", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    )

    def connect(table: pa.Table) -> pa.Table:
        numbers = np.sort(table["print"].to_numpy())
        a, b = forest_links(numbers.view(np.uint64), radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return pairs.groupBy("shard", "low", "high").applyInArrow(connect, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Per row: ``id_col``, ``fingerprint`` (16 lowercase hex digits) and ``component_id``.

    Shingles are ``size`` words, A-Z in lower case; repeated ones count as often as they
    occur, a shorter text is one shingle. Fingerprints that differ in at most ``radius`` bits
    link. ``component_id`` is the smallest id reachable over links, the row's own included.

    Null, empty or blank text: fingerprint zero, linked like any other. Rows that repeat
    an id are rows of their own. Null id: such a row links, but gives no id; the id is null only
    where no row of the component has one. Other columns are not read, so their names cannot clash.
    An empty table gives no rows. One document has to fit into a task.
    """
    if size < 1 or radius < 0:
        raise ValueError("size must be at least 1 and radius at least 0")
    rows = settle(fingerprints(docs, id_col, text_col, size))
    entries = settle(rows.groupBy("print").agg(F.min("id").alias("first")))
    roots = settle(components(links(entries, radius, shard_rows)).withColumnRenamed("node", "print"))
    linked = entries.join(roots, "print")
    lowest = settle(linked.groupBy("root").agg(F.min("first").alias("lowest")))
    of_linked = settle(roots.join(lowest, "root").select("print", "lowest"))
    classes = settle(entries.join(of_linked, "print", "left").select("print", F.coalesce("lowest", "first").alias("component_id")))
    return rows.join(classes, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
