"""Words and window hashes against plain Python; block messages keep key order."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from loadstone.llm import blocks, words

TEXT = st.text(alphabet=st.sampled_from("ab AÉ\t\n\x0b\x0c\r\x1c\x85\xa0#字"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.booleans())
def test_words_are_those_of_a_split(texts, lower):
    found = words.read_words(pa.array(texts, pa.string()), lower=lower)
    split = [(t or "").encode().split() for t in texts]
    assert found.counts.tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert [bytes(found.data[a:b]) for a, b in zip(found.starts, found.ends)] == flat
    fold = (lambda w: bytes(c + 32 if 65 <= c <= 90 else c for c in w)) if lower else (lambda w: w)
    by_hash = {}
    for word, value in zip(flat, found.hashes.tolist()):
        assert by_hash.setdefault(value, fold(word)) == fold(word)
    assert len(by_hash) == len({fold(w) for w in flat})
    keep = np.array([i % 3 != 0 for i in range(len(flat))], dtype=bool)
    kept, at = [], 0
    for s in split:
        kept.append(b" ".join(w for k, w in enumerate(s, at) if keep[k]).decode())
        at += len(s)
    assert words.joined(found, keep).to_pylist() == kept


def test_windows_do_not_cross_documents():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(50)]
    found = words.read_words(pa.array(texts))
    at = found.complete(3)
    hashes, owner = found.windows(3)[at], found.documents()[at]
    seen = {}
    for place, value, doc in zip(found.places()[at], hashes.tolist(), owner):
        window = tuple(texts[doc].split()[place : place + 3])
        assert len(window) == 3 and seen.setdefault(value, window) == window
    assert len(at) == sum(max(0, len(t.split()) - 2) for t in texts)


def test_slices_of_a_column():
    whole = pa.array(["a b", None, "c  d e", "", "f"])
    assert words.read_words(whole.slice(2, 3)).counts.tolist() == [3, 0, 1]


def test_ranges_keep_the_order_of_keys():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    for ranges in (1, 7, 1000):
        parts = blocks.split_sorted(keys, ranges)
        assert [a for _, a, _ in parts][1:] == [b for _, _, b in parts][:-1] and parts[-1][2] == len(keys)
        assert (np.diff(blocks.squeeze(keys, ranges).astype(object)) >= 0).all()
        assert (blocks.squeeze(keys, ranges) >> np.uint64(32) == blocks.range_of(keys, ranges)).all()
    assert blocks.split_sorted(keys[:0], 5) == []
