"""Removal of word windows that repeat from an earlier document, by difference-cover anchors.

Method. The residues 1, 2, 4 modulo 7 are a difference cover: for any two
positions there is a shift below 7 that moves both onto cover residues. So two
equal windows of w words share an equal anchor, a window of w - 6 words that
starts at a cover position in both documents, and only 3 of 7 positions are
hashed. Anchors that occur more than once mark where a match may lie; they are
extended to the full windows around them, whose exact 96-bit identity decides.

Distribution. Documents lie in blocks (see ``blocks``). A block sends each of
its distinct anchors once to a key range and gets one bit back (also elsewhere?);
it sends each distinct full window around a shared anchor with the smallest id
that holds it and gets one bit back (smaller id elsewhere?). No pairs of documents
are made, and a passage that a third of all documents hold costs one key per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loadstone.llm import blocks as B
from loadstone.llm.words import Words, joined, read_words

PERIOD = 7
COVER = (1, 2, 4)
ENTRY = np.dtype([("low", "<u4"), ("id", "<i8")])


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the anchors at cover positions."""
    size = window - PERIOD + 1
    at = words.complete(size)
    at = at[np.isin(words.places()[at] % PERIOD, COVER)]
    return at, words.windows(size, stream=2)[at]


def _shared_keys(keys: np.ndarray, answers: pa.Table, ranges: int) -> np.ndarray:
    """One flag per sorted key of the block, from the answers of the ranges."""
    got = {r.as_py(): p.as_py() for r, p in zip(answers["range"], answers["payload"])}
    out = np.zeros(len(keys), dtype=bool)
    for place, a, b in B.split_sorted(keys, ranges):
        if place in got:
            out[a:b] = np.unpackbits(np.frombuffer(got[place], dtype=np.uint8), count=b - a)
    return out


def _messages(block: int, keys: np.ndarray, extra: np.ndarray | None, ranges: int) -> pa.Table:
    parts = B.split_sorted(keys, ranges)
    return pa.table({
        "range": pa.array([p for p, _, _ in parts], pa.int64()),
        "block": pa.array([block] * len(parts), pa.int64()),
        "keys": pa.array([keys[a:b].tobytes() for _, a, b in parts], pa.binary()),
        "extra": pa.array([b"" if extra is None else extra[a:b].tobytes() for _, a, b in parts], pa.binary()),
    })


def _answers(table: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    payload, at = [], 0
    for size in sizes:
        payload.append(np.packbits(flags[at : at + size]).tobytes())
        at += size
    return pa.table({"block": table["block"], "range": table["range"], "payload": pa.array(payload, pa.binary())})


def _candidates(words: Words, window: int, answers: pa.Table, ranges: int) -> np.ndarray:
    """Starts of the full windows that hold an anchor found more than once."""
    at, hashes = _anchors(words, window)
    keys, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = (_shared_keys(keys, answers, ranges) | (counts > 1))[inverse]
    marks = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    marks[at[shared] + 1] = 1
    upto = np.cumsum(marks)
    starts = words.complete(window)
    return starts[upto[starts + PERIOD] > upto[starts]]


def _full(words: Words, starts: np.ndarray, ids: np.ndarray, window: int):
    """Distinct windows at ``starts``, sorted: (keys, low parts, smallest ids, index of each start's window)."""
    high = words.windows(window, stream=3)[starts]
    low = (words.windows(window, stream=4)[starts] >> np.uint64(32)).astype(np.uint32)
    owner = ids[np.searchsorted(words.bounds, starts, side="right") - 1]
    order = np.lexsort((owner, low, high))
    h, lo = high[order], low[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = np.cumsum(new) - 1
    return h[new], lo[new], owner[order][new], inverse, owner


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, block_bytes: int = B.BLOCK_BYTES
) -> DataFrame:
    """Per document: ``id_col``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space).

    A word goes if a window of ``window`` consecutive words that covers it also
    starts in a document with a smaller id. Windows are judged on the input.

    Null or empty text: no words, kept_text is empty. Null id: sorts after all
    ids, and such documents do not remove words from each other. Rows that
    repeat an id are judged one by one and do not remove words from each other.
    Texts shorter than the window stay whole. Other columns are not read, so
    their names cannot clash. An empty table gives no rows. One document has to
    fit into a task, whatever its length.
    """
    if window < 2 * PERIOD - 1:
        raise ValueError(f"window must be at least {2 * PERIOD - 1} words")
    blocks = B.into_blocks(docs, id_col, text_col, block_bytes)
    # About 6 bytes a word: 3 / 7 of the words are anchors of 8 bytes; windows take 20 bytes.
    anchor_ranges, window_ranges = blocks.ranges(0.6), blocks.ranges(2)

    def send_anchors(table: pa.Table) -> pa.Table:
        _, hashes = _anchors(read_words(table["text"]), window)
        return _messages(table["block"][0].as_py(), np.unique(hashes), None, anchor_ranges)

    def match_anchors(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k.as_py(), dtype=np.uint64) for k in table["keys"]]
        _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        return _answers(table, (counts > 1)[inverse], [len(p) for p in parts])

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _messages(0, np.empty(0, dtype=np.uint64), None, window_ranges)
        words = read_words(left["text"])
        starts = _candidates(words, window, right, anchor_ranges)
        keys, low, smallest, _, _ = _full(words, starts, B.ids_of(left["id"]), window)
        extra = np.empty(len(keys), dtype=ENTRY)
        extra["low"], extra["id"] = low, smallest
        return _messages(left["block"][0].as_py(), keys, extra, window_ranges)

    def match_windows(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k.as_py(), dtype=np.uint64) for k in table["keys"]]
        high = np.concatenate(parts)
        extra = np.concatenate([np.frombuffer(e.as_py(), dtype=ENTRY) for e in table["extra"]])
        order = np.lexsort((extra["id"], extra["low"], high))
        h, low, ids = high[order], extra["low"][order], extra["id"][order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
        first = ids[new][np.cumsum(new) - 1]
        flags = np.empty(len(order), dtype=bool)
        flags[order] = first < ids
        return _answers(table, flags, [len(p) for p in parts])

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            ids, n, gone, text = left["id"], [], [], pa.array([], pa.string())
        else:
            words = read_words(left["text"])
            ids = left["id"]
            anchors = right.filter(pc.equal(right["step"], 0))
            full = right.filter(pc.equal(right["step"], 1))
            starts = _candidates(words, window, anchors, anchor_ranges)
            keys, _, smallest, inverse, owner = _full(words, starts, B.ids_of(ids), window)
            elsewhere = _shared_keys(keys, full, window_ranges)
            repeated = starts[elsewhere[inverse] | (smallest[inverse] < owner)]
            cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
            cover[repeated] += 1
            cover[repeated + window] -= 1
            keep = np.cumsum(cover[:-1]) == 0
            n = words.counts
            gone = n - np.diff(np.concatenate([[0], np.cumsum(keep)])[words.bounds])
            text = joined(words, keep)
        return pa.table({
            id_col: ids, "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_text": text,
        })

    by_block = blocks.frame.groupBy("block")
    anchor_answers = (
        by_block.applyInArrow(send_anchors, B.MESSAGE).groupBy("range").applyInArrow(match_anchors, B.ANSWER)
    )
    window_answers = (
        by_block.cogroup(anchor_answers.groupBy("block")).applyInArrow(send_windows, B.MESSAGE)
        .groupBy("range").applyInArrow(match_windows, B.ANSWER)
    )
    answers = anchor_answers.selectExpr("*", "0 AS step").unionByName(window_answers.selectExpr("*", "1 AS step"))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(
        remove, f"`{id_col}` long, n_words long, n_removed long, kept_text string"
    )
