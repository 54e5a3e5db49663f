"""Tokens against the tokenizers library, packing as a gapless cover, the plan against best fit piece by piece."""

import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import numpy as np
from loadstone.llm import packing, tokens


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(tokens.JSON_FILE))


PATHS = public_tokenizers.path(tokens.RANK_FILE), public_tokenizers.path(tokens.JSON_FILE)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    expected = tokens._json_encoder(PATHS[1]).encode(text, add_special_tokens=False).ids
    assert list(tokens.encode(text, *PATHS)) == expected


@pytest.mark.parametrize("text", ["<|endoftext|> a <|endoftext|>b", " " * 70_000 + "x", "a" * 30_000, "\r\n\t ' don't 12३"])
def test_ids_of_odd_texts(tokenizer, text):
    assert list(tokens.encode(text, *PATHS)) == tokenizer.encode(text, add_special_tokens=False).ids


def check_cover(rows, texts, tokenizer, most):
    """rows: (doc_id, piece, start, length, ids, sequence_id, offset)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, piece, start, length, ids, sequence, offset in rows:
        by_doc[doc].append((piece, start, length, np.frombuffer(ids, "<u4").tolist()))
        by_sequence[sequence].append((offset, length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most
    for doc, text in texts:
        whole = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(by_doc[doc])
        assert [p for p, *_ in pieces] == list(range(len(pieces)))
        assert [x for *_, ids in pieces for x in ids] == whole
        assert all(length == most for _, _, length, _ in pieces[1:]) and (len(whole) > most or len(pieces) == 1)
        at = 0
        for _, start, length, _ in pieces:
            assert start == at
            at += length


@pytest.mark.parametrize("most", [16, 2048])
def test_round_trip(frame, documents, tokenizer, most):
    pieces = tokens.token_pieces(frame, most=most)
    packed = packing.pack(pieces, ["doc_id", "piece"], capacity=most)
    check_cover([tuple(r) for r in packed.collect()], [(i, t) for i, t, *_ in documents], tokenizer, most)


def best_fit(lengths, capacity):
    """Number of sequences when pieces go one by one, longest first, to the fullest one that holds them."""
    free = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, space in enumerate(free) if space >= length]
        if fitting:
            free[min(fitting, key=lambda k: free[k])] -= length
        else:
            free.append(capacity - length)
    return len(free)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_plan_is_best_fit(lengths):
    slots = packing.plan(Counter(lengths), 30)
    fill, used = defaultdict(list), set()
    for length, low, high, first, offset in slots:
        for k in range(high - low):
            fill[first + k].append((offset, length))
            used.add((length, low + k))
    assert used == {(n, k) for n, count in Counter(lengths).items() for k in range(count)}
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 30
    assert len(fill) == best_fit(lengths, 30)


def test_plan_does_not_grow_with_the_counts():
    rng = random.Random(1)
    shape = {n: rng.randrange(1, 50) for n in range(1, 2049)}
    assert len(packing.plan({n: c * 10**6 for n, c in shape.items()}, 2048)) < 60_000


def test_odd_rows(odd, tokenizer):
    packed = packing.pack(tokens.token_pieces(odd), ["doc_id", "piece"])
    rows = packed.collect()
    assert len(rows) == odd.count()
    assert sorted((r.length for r in rows), reverse=True)[-1] == 1
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    assert all(sum(n for _, n in parts) == max(o + n for o, n in parts) for parts in ends.values())


def test_empty_table(frame):
    packed = packing.pack(tokens.token_pieces(frame.filter("doc_id < 0")), ["doc_id", "piece"])
    assert packed.count() == 0 and packed.columns[-2:] == ["sequence_id", "offset"]


def test_a_piece_has_to_fit(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 9)], "doc_id long, length long"), ["doc_id"], capacity=8)


def test_columns_called_like_the_inner_ones(spark):
    names = ["_rank", "_part", "_len", "_base", "part", "at", "low", "count", "rank", "size", "len", "from", "to", "first", "base", "order_0"]
    rows = spark.createDataFrame([(i, 1 + i % 7) for i in range(60)], "doc_id long, length long")
    from pyspark.sql import functions as F

    got = packing.pack(rows.select("*", *[F.lit(n).alias(n) for n in names]), ["doc_id"], capacity=16).collect()
    assert len(got) == 60 and all(r[n] == n for r in got for n in names)
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for (s, o, n), (t, p, _) in zip(places, places[1:]):
        assert (t == s and p == o + n) or (t > s and p == 0)
