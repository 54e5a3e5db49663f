"""Near-duplicate classes against all pairs, also with hubs cut into many chunks."""

import random

import pytest

from loadstone.llm import ngram_join
from loadstone.llm.components import components


def shingles(text, size=5):
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (text or "").encode().split()]
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def plain(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    usable = [k for k, (i, *_) in enumerate(rows) if i is not None and sets[k]]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for n, a in enumerate(usable):
        for b in usable[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    lowest = {}
    for k in usable:
        lowest[root(k)] = min(lowest.get(root(k), 2**63), rows[k][0])
    return sorted(
        ((i, len(sets[k]), lowest[root(k)] if k in set(usable) else i) for k, (i, *_) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize("block_bytes, chunk", [(1 << 10, 300), (1 << 20, 400_000)])
def test_equals_all_pairs(frame, documents, monkeypatch, block_bytes, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", chunk)
    got = ngram_join.near_duplicates(frame, block_bytes=block_bytes)
    expected = plain(documents)
    assert len({c for _, _, c in expected}) < len(expected) - 20
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_chains_of_near_copies(spark, monkeypatch):
    """Neighbours of a chain link, its ends do not; the smallest ids sit in the middle."""
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", 200)
    rng = random.Random(9)
    rows = []
    for chain in range(6):
        words = [f"c{chain}w{k}" for k in range(60)]
        for step in range(14):
            rows.append((rng.randrange(10**6), " ".join(words)))
            at = (step * 4) % 60
            words = words[:at] + [f"n{chain}s{step}"] + words[at + 1 :]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in ngram_join.near_duplicates(frame).collect()], key=repr) == plain(rows)


def test_odd_rows(odd):
    got = ngram_join.near_duplicates(odd)
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain(rows)


def test_empty_table(frame):
    assert ngram_join.near_duplicates(frame.filter("doc_id < 0")).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, k) for k in range(501, 700)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(7, 7), (None, 3), (3, None)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: root(k) for k in parent}
