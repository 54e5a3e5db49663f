"""Exact near-duplicate classes by Jaccard similarity of word shingles, with rare-first prefix filtering.

1. Documents with equal shingle sets are one *text*, named by a 128-bit
   fingerprint of its set. Copies cost one row each and nothing after that.
2. Each block (see ``blocks``) sends its distinct shingles to key ranges and gets
   their document frequencies back. Shingles are ordered by rising frequency, so
   two texts that link share a shingle among their first n - ceil(t n) + 1
   (prefix filter). Shingles that only one block and text holds are left out of the index.
3. Texts that share a prefix shingle are joined, but not with each other: each
   goes with the smallest text of the shingle only. Length, positional and suffix
   filters drop pairs, every other pair is verified once, on whole sets.
   Links give components.
4. What is still open are pairs of one shingle in different components. Per
   shingle the component with most texts is the hub, the others attach to it. All
   texts attached to one hub are compared with the hub's and with each other, in
   chunks of bounded size inside tasks; only links that merge components come out.
   Any two texts that share a shingle lie in one component or at one hub, so no link is lost.

The same frequency is used for a shingle everywhere, so that a rounding or a
collision of frequencies costs time, never a link.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm import blocks as B
from loadstone.llm.components import components
from loadstone.llm.words import Words, mix, read_words
from loadstone.session import settle

# Shingles that one chunk of a hub's texts holds.
CHUNK_SHINGLES = 60_000
ROWS = "kind int, id long, n long, text binary, shingle long, place int, members binary"
_ARROW = pa.schema([
    ("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("text", pa.binary()),
    ("shingle", pa.int64()), ("place", pa.int32()), ("members", pa.binary()),
])
DOCUMENT, ENTRY, SET = 0, 1, 2


class Sets:
    """Distinct shingles of each document: ``hashes`` in ascending order inside ``bounds``."""

    def __init__(self, words: Words, size: int):
        at = words.complete(size)
        hashes, owner = words.windows(size)[at], words.documents()[at]
        for short in range(1, size):
            docs = np.flatnonzero(words.counts == short)
            if len(docs):
                first = words.windows(short)[words.bounds[docs]]
                hashes, owner = np.concatenate([hashes, first]), np.concatenate([owner, docs])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.hashes = hashes[new]
        self.bounds = np.searchsorted(owner[new], np.arange(len(words.counts) + 1))

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def names(self) -> list[bytes]:
        """128-bit fingerprint of each set; of sets that differ, equal ones are not to be expected."""
        out = np.zeros((len(self.bounds) - 1, 2), dtype=np.uint64)
        full = np.flatnonzero(self.sizes())
        if len(full):
            for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                out[full, k] = np.add.reduceat(mix(self.hashes ^ np.uint64(salt)), self.bounds[:-1][full])
        raw = out.tobytes()
        return [raw[16 * i : 16 * i + 16] for i in range(len(out))]


def _level(counts: np.ndarray) -> np.ndarray:
    """Frequency in one byte: exact below 128, in steps of an eighth of a doubling above."""
    steps = 128 + np.floor(8 * np.log2(np.maximum(counts, 128) / 128))
    return np.where(counts < 128, counts, np.minimum(steps, 255)).astype(np.uint8)


def _first_of_text(sets: Sets, known: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Names, and the documents of the block that stand for their text."""
    names, seen, chosen = sets.names(), set(), []
    for i in np.flatnonzero(known & (sets.sizes() > 0)):
        if names[i] not in seen:
            seen.add(names[i])
            chosen.append(i)
    return names, np.array(chosen, dtype=np.int64)


def _inside(sets: Sets, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner) of the chosen documents."""
    flags = np.zeros(len(sets.bounds) - 1, dtype=bool)
    flags[chosen] = True
    keep = np.repeat(flags, sets.sizes())
    return sets.hashes[keep], np.repeat(np.arange(len(flags)), sets.sizes())[keep]


def _index(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, block_bytes: int) -> DataFrame:
    """Rows of three kinds: documents, prefix entries, and sets of the texts that have entries."""
    blocks = B.into_blocks(docs, id_col, text_col, block_bytes)
    # About 6 bytes a word, 5 bytes a shingle.
    ranges = blocks.ranges(0.8)

    def read(table: pa.Table):
        sets = Sets(read_words(table["text"], lower=True), size)
        known = table["id"].combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        return sets, *_first_of_text(sets, known)

    def send(table: pa.Table) -> pa.Table:
        sets, _, chosen = read(table)
        keys, counts = np.unique(B.squeeze(_inside(sets, chosen)[0], ranges), return_counts=True)
        where = (keys >> np.uint64(32)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(keys)] if len(keys) else [0]
        parts = list(zip(cuts[:-1], cuts[1:]))
        inside, counts = keys.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
        return pa.table({
            "range": pa.array([int(where[a]) for a, _ in parts], pa.int64()),
            "block": pa.array([table["block"][0].as_py()] * len(parts), pa.int64()),
            "keys": pa.array([inside[a:b].tobytes() for a, b in parts], pa.binary()),
            "extra": pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary()),
        })

    def count(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k.as_py(), dtype=np.uint32) for k in table["keys"]]
        counts = np.concatenate([np.frombuffer(e.as_py(), dtype=np.uint8) for e in table["extra"]])
        keys, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        levels = _level(np.bincount(inverse, weights=counts, minlength=len(keys)).astype(np.int64))[inverse]
        payload, at = [], 0
        for part in parts:
            payload.append(levels[at : at + len(part)].tobytes())
            at += len(part)
        return pa.table({"block": table["block"], "range": table["range"], "payload": pa.array(payload, pa.binary())})

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _ARROW.empty_table()
        sets, names, chosen = read(left)
        sizes = sets.sizes()
        hashes, owner = _inside(sets, chosen)
        squeezed = B.squeeze(hashes, ranges)
        keys = np.unique(squeezed)
        answers = sorted(zip(right["range"].to_pylist(), right["payload"].to_pylist()))
        levels = np.frombuffer(b"".join(p for _, p in answers), dtype=np.uint8)
        level = levels[np.searchsorted(keys, squeezed)] if len(keys) else np.empty(0, dtype=np.uint8)
        order = np.lexsort((hashes, level, owner))
        begins = np.searchsorted(owner, owner)
        place = np.arange(len(owner)) - begins
        reach = sizes - (-(-percent * sizes // 100)) + 1
        entry = np.flatnonzero((place < reach[owner]) & (level[order] > 1))
        docs_of = owner[entry]
        stored = np.unique(docs_of)
        n_docs, n_entries = len(sizes), len(entry)
        text = [*names, *[names[i] for i in docs_of], *[names[i] for i in stored]]
        raw = sets.hashes
        total = len(text)
        nulls = lambda count: [None] * count
        return pa.table({
            "kind": pa.array(np.repeat([DOCUMENT, ENTRY, SET], [n_docs, n_entries, len(stored)]), pa.int32()),
            "id": pa.array([*left["id"].to_pylist(), *nulls(total - n_docs)], pa.int64()),
            "n": pa.array(np.concatenate([sizes, sizes[docs_of], sizes[stored]]), pa.int64()),
            "text": pa.array(text, pa.binary()),
            "shingle": pa.array([*nulls(n_docs), *hashes[order][entry].view(np.int64).tolist(), *nulls(len(stored))], pa.int64()),
            "place": pa.array([*nulls(n_docs), *place[entry].tolist(), *nulls(len(stored))], pa.int32()),
            "members": pa.array([
                *nulls(n_docs + n_entries), *[raw[sets.bounds[i] : sets.bounds[i + 1]].tobytes() for i in stored],
            ], pa.binary()),
        }, schema=_ARROW)

    by_block = blocks.frame.groupBy("block")
    answers = by_block.applyInArrow(send, B.MESSAGE).groupBy("range").applyInArrow(count, B.ANSWER)
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(rows, ROWS)


def _overlap(x: np.ndarray, y: np.ndarray, need: int) -> int:
    """Size of the intersection, or -1 where the suffix filter shows that it is below ``need``."""
    probes = x[len(x) // 8 :: max(1, len(x) // 4)]
    cells = np.diff(np.concatenate([[0], np.searchsorted(x, probes), [len(x)]]))
    other = np.diff(np.concatenate([[0], np.searchsorted(y, probes), [len(y)]]))
    if np.minimum(cells, other).sum() < need:
        return -1
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _verify(percent: int):
    @F.pandas_udf("boolean")
    def verified(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left), dtype=bool)
        for i, (a, b) in enumerate(zip(left, right)):
            x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
            both = len(x) + len(y)
            out[i] = (100 + percent) * _overlap(x, y, -(-percent * both // (100 + percent))) >= percent * both
        return pd.Series(out)

    return verified


def _star_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) of each text with the smallest text of one of its shingles."""
    # Settled, here and below: a join of two plain sides is broadcast by measured size or splits a hot key at run time.
    lowest = settle(entries.groupBy("shingle").agg(
        F.min(F.struct("text", "n", "place")).alias("first"), F.count(F.lit(1)).alias("texts")
    ).filter("texts > 1"))
    both = F.col("n") + F.col("first.n")
    need = F.ceil(F.lit(percent) * both / F.lit(100 + percent))
    bound = (
        F.least("place", "first.place") + 1
        + F.least(F.col("n") - F.col("place") - 1, F.col("first.n") - F.col("first.place") - 1)
    )
    pairs = (
        entries.join(lowest, "shingle")
        .filter(F.col("text") != F.col("first.text"))
        .filter(F.least("n", "first.n") * 100 >= F.greatest("n", "first.n") * percent)
        .groupBy(F.col("first.text").alias("a"), F.col("text").alias("b"))
        .agg(F.min(bound - need).alias("slack"))
        .filter("slack >= 0")
        .select("a", "b")
    )
    left = sets.select(F.col("text").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("text").alias("b"), F.col("members").alias("y"))
    return pairs.join(right, "b").join(left, "a").filter(_verify(percent)("x", "y")).select("a", "b")


def _compare(percent: int):
    """Links between the texts of two chunks that merge components of the chunks."""

    def compare(table: pa.Table) -> pa.Table:
        names, comps = table["text"].to_pylist(), table["comp"].to_pylist()
        side = table["side"].to_numpy()
        members = [np.frombuffer(m, dtype=np.uint64) for m in table["members"].to_pylist()]
        parent: dict[bytes, bytes] = {}

        def root(node: bytes) -> bytes:
            while parent.get(node, node) != node:
                parent[node] = parent.get(parent[node], parent[node])
                node = parent[node]
            return node

        # Rows of side 0 are compared with side 1, or with those after them where both are one chunk (side 2).
        left = np.flatnonzero(side != 1)
        right = np.flatnonzero(side != 0)
        links: list[tuple[bytes, bytes]] = []
        if len(left) and len(right):
            sizes = np.array([len(members[i]) for i in right])
            offsets = np.cumsum(sizes) - sizes
            values = np.concatenate([members[i] for i in right])
            cell = (np.repeat(np.arange(len(right)), sizes) * 8 + (values >> np.uint64(61)).astype(np.int64))
            cells = np.bincount(cell, minlength=8 * len(right)).reshape(-1, 8)
            keys, inverse = np.unique(values, return_inverse=True)
            mark = np.zeros(len(keys), dtype=np.int64)
            for i in left:
                x = members[i]
                both = sizes + len(x)
                need = -(-percent * both // (100 + percent))
                own = np.bincount((x >> np.uint64(61)).astype(np.int64), minlength=8)
                fits = (100 * np.minimum(sizes, len(x)) >= percent * np.maximum(sizes, len(x))) & (
                    np.minimum(cells, own).sum(axis=1) >= need
                )
                if side[i] == 2:
                    fits &= right > i
                if not fits.any():
                    continue
                at = np.searchsorted(keys, x)
                at[at == len(keys)] = 0
                at = at[keys[at] == x]
                mark[at] = 1
                overlap = np.add.reduceat(mark[inverse], offsets)
                mark[at] = 0
                for j in np.flatnonzero(fits & (overlap >= need)):
                    a, b = root(comps[i]), root(comps[right[j]])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        links.append((comps[i], comps[right[j]]))
        return pa.table({
            "a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary()),
        })

    return compare


def _hub_links(entries: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links between components whose texts share a shingle, each text compared at the hubs of its shingles."""
    placed = settle(entries.select("shingle", "text", "n").join(
        roots.select(F.col("node").alias("text"), "root"), "text", "left"
    ).select("shingle", "text", "n", F.coalesce("root", "text").alias("comp")))
    parts = placed.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("texts"))
    hubs = settle(
        parts.groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("texts", "comp")).alias("most"))
        .filter("comps > 1")
        .select("shingle", F.col("most.comp").alias("hub"))
    )
    attached = settle(placed.join(hubs, "shingle").groupBy("hub", "text", "comp").agg(F.max("n").alias("n")))
    inner = F.col("comp") == F.col("hub")
    pieces = settle(attached.groupBy("hub").agg(
        F.ceil(F.sum(F.when(inner, F.col("n"))) / CHUNK_SHINGLES).cast("int").alias("own"),
        F.ceil(F.sum(F.when(~inner, F.col("n"))) / CHUNK_SHINGLES).cast("int").alias("other"),
    ))
    chunked = attached.join(pieces, "hub").withColumn("inner", inner)
    chunk = F.pmod(F.xxhash64("text"), F.when(F.col("inner"), F.col("own")).otherwise(F.col("other"))).cast("int")
    chunked = chunked.withColumn("chunk", chunk)
    numbers = F.sequence(F.lit(0), F.col("other") - 1)
    own = F.sequence(F.lit(0), F.col("own") - 1)
    task = lambda row, inside, column, side: F.struct(
        row.alias("row"), F.lit(inside).alias("with_hub"), column.alias("column"), side.alias("side")
    )
    # Texts of the hub: right side of every attached chunk. Attached texts: left side of all
    # chunks of the hub, and one side of each pair of attached chunks.
    from_hub = F.transform(numbers, lambda k: task(k, True, F.col("chunk"), F.lit(1)))
    attached_tasks = F.concat(
        F.transform(own, lambda k: task(F.col("chunk"), True, k, F.lit(0))),
        F.transform(numbers, lambda k: task(
            F.least(F.col("chunk"), k), False, F.greatest(F.col("chunk"), k),
            F.when(k == F.col("chunk"), 2).when(k > F.col("chunk"), 0).otherwise(1),
        )),
    )
    tasks = chunked.select("hub", "text", "comp", F.explode(F.when(F.col("inner"), from_hub).otherwise(attached_tasks)).alias("task"))
    return (
        tasks.select("hub", "text", "comp", "task.*")
        .join(sets.select("text", "members"), "text")
        .groupBy("hub", "row", "with_hub", "column")
        .applyInArrow(_compare(percent), "a binary, b binary")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
    block_bytes: int = B.BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``id_col``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are folded to lower case (A-Z) and grouped into sets of ``size``-word
    shingles; a text of fewer words is one shingle. Two documents link when
    100 * |intersection| >= ``percent`` * |union|.

    Null text and text without words: no shingles, linked with nothing. Null id:
    linked with nothing, component null. Rows are judged one by one: an id that
    occurs with several texts gives one row for each, with its text's component;
    repeated rows are repeated in the result. Other columns are not read. An
    empty table gives no rows.
    """
    rows = settle(_index(docs, id_col, text_col, size, percent, block_bytes))
    sets = rows.filter(F.col("kind") == SET).groupBy("text").agg(F.first("members").alias("members"))
    sets = settle(sets)
    entries = rows.filter(F.col("kind") == ENTRY).select("shingle", "text", "n", "place").distinct()
    entries = settle(entries)
    roots = components(_star_links(entries, sets, percent))
    merged = components(_hub_links(entries, sets, roots, percent))
    merged = merged.select(F.col("node").alias("root"), F.col("root").alias("final"))

    found = rows.filter(F.col("kind") == DOCUMENT).select("id", "n", "text")
    texts = found.filter("n > 0 AND id IS NOT NULL").groupBy("text").agg(F.min("id").alias("lowest"))
    placed = settle(
        texts.join(roots.withColumnRenamed("node", "text"), "text", "left")
        .withColumn("root", F.coalesce("root", "text"))
        .join(merged, "root", "left")
        .select("text", "lowest", F.coalesce("final", "root").alias("comp"))
    )
    lowest = settle(placed.groupBy("comp").agg(F.min("lowest").alias("component")))
    named = placed.join(lowest, "comp").select("text", "component")
    component = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component"))
    return found.join(named, "text", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")
    )
