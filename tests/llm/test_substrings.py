"""Removal of repeated windows against a plain dictionary of windows."""

import pytest

from loadstone.llm.substrings import remove_repeats


def plain(rows, window=13):
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    last = 2**63
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1):
            seq = tuple(words[k : k + window])
            first[seq] = min(first.get(seq, last), last if i is None else i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < (last if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 10, 1 << 20])
def test_equals_plain(frame, documents, block_bytes):
    got = remove_repeats(frame, block_bytes=block_bytes)
    expected = plain(documents)
    assert sum(r[2] for r in expected) > 1000
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_shifted_matches(spark):
    """A match is found wherever it lies in either document."""
    words = [f"w{i}" for i in range(13)]
    rows = [(0, " ".join(words))] + [
        (1 + k, " ".join([f"p{k}{j}" for j in range(k)] + words + [f"q{k}{j}" for j in range(3)])) for k in range(15)
    ]
    got = {r.doc_id: r.n_removed for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, **{1 + k: 13 for k in range(15)}}


def test_odd_rows(odd):
    got = remove_repeats(odd)
    rows = [tuple(r)[:2] for r in odd.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain(rows)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]


def test_empty_table(frame):
    assert remove_repeats(frame.filter("doc_id < 0")).count() == 0


def test_window_has_to_hold_anchors(frame):
    with pytest.raises(ValueError):
        remove_repeats(frame, window=9)
