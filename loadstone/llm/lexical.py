"""Ranked lexical search by the Best Position Algorithm over impact lists.

Index. Documents are dealt to shards of bounded size as they are read, without
a shuffle; a shard holds the postings of its documents, and no posting list
spans shards. Documents, terms and document frequencies are counted over all shards.

Search. Inside a shard each term of an item has its postings in order of falling
impact. The lists are read downwards together; a document met for the first time is
looked up in all other lists (direct access), which gives its whole score and marks
its position in every list. The best position of a list is the end of its
unbroken run of marked positions. What is not yet met lies below the best position
of every list, so its score is at most the sum of the impacts there; reading ends
once that sum is strictly below the k-th score, so ties are never lost. The k
best of a task's earlier shards count towards the k-th score.

A term is held as a 64-bit hash of its bytes (``words``); two terms of a query and a
corpus of 10**8 terms agree by chance with a probability of about 10**-8 per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadstone.llm.words import read_words
from loadstone.session import settle

SHARD_BYTES = 16 << 20
# Terms of the items that are searched in one pass over the index; an item is never split.
BLOCK_TERMS = 1_000_000
# Positions read in the first round; each round reads twice as many.
FIRST_READ = 16
# Partial results of an item are merged in so many groups before the last merge.
MERGE_GROUPS = 1024
NO_ID = np.iinfo(np.int64).max

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

INDEX = "ids binary, lengths binary, terms binary, bounds binary, places binary, counts binary, n_docs long, n_terms long"
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def _terms(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, index of its document), in order."""
    words = read_words(texts, lower=True, blank=_BETWEEN)
    return words.hashes, words.documents()


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes, or of a single longer row."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _shard(ids: np.ndarray, texts: pa.Array) -> list:
    hashes, owner = _terms(texts)
    lengths = np.bincount(owner, minlength=len(ids)).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order].astype(np.uint32)
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(hashes))).astype(np.uint32)
    hashes, owner = hashes[first], owner[first]
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = hashes[1:] != hashes[:-1]
    bounds = np.append(np.flatnonzero(head), len(hashes)).astype(np.int64)
    arrays = ids, lengths, hashes[head], bounds, owner, counts
    return [*(a.tobytes() for a in arrays), int(np.count_nonzero(lengths)), int(lengths.sum())]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: ids and lengths of its documents, its terms and their postings. Written once, read by any search."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64() if n.startswith("n_") else pa.binary()) for n in _INDEX_NAMES])
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for a, b in _slices(batch.column(1), shard_bytes):
                row = _shard(ids[a:b], batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return settle(rows.mapInArrow(build, INDEX))


class Shard:
    """Impact lists of the wanted terms (sorted hashes) of one shard."""

    def __init__(self, row: dict, wanted: np.ndarray, n_docs: int, n_terms: int):
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.ids, lengths = read("ids", np.int64), read("lengths", np.int64)
        terms, bounds, places, counts = read("terms", np.uint64), read("bounds", np.int64), read("places", np.uint32), read("counts", np.uint32)
        at = np.searchsorted(terms, wanted)
        found = (at < len(terms)) & (terms[np.minimum(at, max(len(terms) - 1, 0))] == wanted if len(terms) else False)
        sizes = np.zeros(len(wanted), dtype=np.int64)
        sizes[found] = bounds[at[found] + 1] - bounds[at[found]]
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(wanted)), sizes)
        begins = np.zeros(len(wanted), dtype=np.int64)
        begins[found] = bounds[at[found]]
        chosen = np.arange(len(owner)) - self.bounds[owner] + begins[owner]
        docs, tf = places[chosen].astype(np.int64), counts[chosen].astype(np.int64)
        norm = 50 + (50 * lengths * n_docs) // max(n_terms, 1)
        impacts = (1_000_000_000 * tf) // (1000 * tf + 20 * norm[docs])
        order = np.lexsort((docs, -impacts, owner))
        self.docs, self.impacts = docs[order], impacts[order]

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents met, their scores): all that may be among the k best, given that a score below ``floor`` is not."""
        starts, sizes = self.bounds[terms], self.bounds[terms + 1] - self.bounds[terms]
        some = sizes > 0
        starts, sizes, weights = starts[some], sizes[some], weights[some]
        lists = len(sizes)
        # Direct access: where a document stands in each list.
        position = np.full((lists, len(self.ids)), -1, dtype=np.int32)
        marked = []
        for n, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
            position[n, self.docs[start : start + size]] = np.arange(size, dtype=np.int32)
            marked.append(np.zeros(size, dtype=bool))
        met = np.zeros(len(self.ids), dtype=bool)
        scores = np.zeros(len(self.ids), dtype=np.int64)
        best = [0] * lists
        depth, step = 0, FIRST_READ
        while depth < (sizes.max() if lists else 0):
            read = np.concatenate([self.docs[s + depth : s + min(depth + step, size)] for s, size in zip(starts.tolist(), sizes.tolist())])
            new = np.unique(read[~met[read]])
            met[new] = True
            bound = 0
            for n, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
                at = position[n, new]
                here = at >= 0
                at = at[here]
                scores[new[here]] += weights[n] * self.impacts[start + at]
                marked[n][at] = True
                rest = marked[n][best[n] :]
                gap = int(np.argmin(rest)) if len(rest) else 0
                best[n] = best[n] + gap if len(rest) and not rest[gap] else size
                if best[n] < size:
                    bound += int(weights[n]) * int(self.impacts[start + best[n] - 1] if best[n] else self.impacts[start])
            depth, step = depth + step, 2 * step
            here = np.flatnonzero(met)
            kth = int(np.partition(scores[here], len(here) - k)[len(here) - k]) if len(here) >= k else -1
            if bound < max(kth, floor):
                break
        here = np.flatnonzero(met)
        return here, scores[here]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _count_block(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """Documents that hold each wanted term; summed per task, then per term."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for terms, bounds in zip(batch.column(0), batch.column(1)):
                terms, bounds = np.frombuffer(terms.as_py(), dtype=np.uint64), np.frombuffer(bounds.as_py(), dtype=np.int64)
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                    total += np.where(terms[at] == wanted, np.diff(bounds)[at], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    rows = index.select("terms", "bounds").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(len(wanted), dtype=np.int64)
    out[rows["term"].to_numpy(dtype=np.int64)] = rows["df"].to_numpy(dtype=np.int64)
    return out


def _search_block(index: DataFrame, block: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, id, score): the k best of each task for each item of the block."""
    wanted = np.unique(np.concatenate([np.frombuffer(r.terms, dtype=np.uint64) for r in block]))
    df = _count_block(index, wanted)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    # A term that no document or nearly every one holds adds nothing.
    useful = (df > 0) & (weights > 0)
    items = [(r.item, np.searchsorted(wanted, np.frombuffer(r.terms, dtype=np.uint64))) for r in block]
    shared = index.sparkSession.sparkContext.broadcast((wanted, weights, [(i, t[useful[t]]) for i, t in items]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights, items = shared.value
        nothing = np.empty(0, dtype=np.int64)
        kept = {item: (nothing, nothing) for item, _ in items}
        for batch in batches:
            for n in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[n].as_py() for c in _INDEX_NAMES[:6]}, wanted, n_docs, n_terms)
                for item, terms in items:
                    ids, scores = kept[item]
                    floor = int(scores[-1]) if len(scores) == k else 0
                    at, found = shard.search(terms, weights[terms], k, floor)
                    kept[item] = _best(np.concatenate([ids, shard.ids[at]]), np.concatenate([scores, found]), k)
        rows = [np.concatenate([[nothing], *parts], axis=None) for parts in zip(*((np.full(len(i), item), i, s) for item, (i, s) in kept.items()))]
        task = TaskContext.get().partitionId()
        rows = rows or [nothing, nothing, nothing]
        arrays = [pa.array(r.astype(np.int64)) for r in rows]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(rows[0]), task % MERGE_GROUPS))], names=["item", "id", "score", "part"])

    return settle(index.select(*_INDEX_NAMES[:6]).mapInArrow(search, "item long, id long, score long, part long").filter("score > 0"))


def _first(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id"))
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 50,
    *,
    item_col: str = "item_id",
    item_text: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for each row of ``items``: ``item_col``, ``rank``, ``id_col``, ``score``.

    Terms are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z
    in lower case. Scores are integers, weighted by document frequency and normed by length; only
    scores above 0 are returned, equal ones by rising id.

    Null or empty text: no terms; such documents are not counted and such items have no
    rows. Null document ids come last among equal scores and stay null. Rows that
    repeat an id are documents of their own, rows that repeat an item are searched each by itself.
    Other columns are not read, so their names cannot clash. Empty tables give no rows. One
    document and one item have to fit into a task; items are searched in blocks of ``block_terms`` terms.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owner = _terms(batch.column(1))
            parts = [np.unique(p) for p in np.split(hashes, np.searchsorted(owner, np.arange(1, batch.num_rows)))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([len(p) for p in parts], pa.int64())],
                names=["key", "terms", "size"],
            )

    texts = items.select(F.col(f"`{item_col}`").alias("key"), F.col(f"`{item_text}`").cast("string").alias("text"))
    key_type = texts.schema["key"].dataType.simpleString()
    asked = texts.mapInArrow(read, f"key {key_type}, terms binary, size long").filter("size > 0")
    asked = settle(asked.withColumn("item", F.monotonically_increasing_id()))
    index = build_index(docs, id_col, text_col, shard_bytes)
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    total = asked.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    found = []
    for at in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == at).select("item", "terms").collect()
        if block and n_docs:
            found.append(_search_block(index, block, n_docs, n_terms, k))
    if not found:
        return asked.selectExpr(f"key AS `{item_col}`", "1 AS rank", f"0L AS `{id_col}`", "0L AS score").limit(0)
    rows = _first(reduce(DataFrame.unionByName, found), ["item", "part"], k, "place").drop("place", "part")
    ranked = _first(rows, ["item"], k, "rank")
    return ranked.join(asked.select("item", "key"), "item").select(
        F.col("key").alias(item_col), F.col("rank").cast("int").alias("rank"),
        F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score",
    )
