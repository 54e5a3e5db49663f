"""Fingerprints against a plain count of bits, classes against all pairs of fingerprints."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from loadstone.llm import simhash
from loadstone.llm.catalog import QUERIES


def plain_print(text, size=3):
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in (text or "").encode().split()]
    parts = [words[k : k + size] for k in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []
    hashes = [xxhash.xxh64(b" ".join(p), seed=42).intdigest() for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius=2):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    distinct = np.array(sorted(parent), dtype=np.uint64)
    for k, p in enumerate(distinct):
        for q in distinct[:k][np.bitwise_count(distinct[:k] ^ p) <= radius]:
            parent[root(int(p))] = root(int(q))
    return {p: root(p) for p in parent}


def plain(rows, size=3, radius=2):
    prints = [plain_print(t, size) for _, t, *_ in rows]
    root = plain_classes(prints, radius)
    lowest = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            lowest[root[p]] = min(lowest.get(root[p], i), i)
    return sorted(((i, f"{p:016x}", lowest.get(root[p])) for (i, *_), p in zip(rows, prints)), key=repr)


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


@pytest.mark.parametrize("size, radius", [(3, 2), (2, 6), (1, 0)])
def test_equals_all_pairs(frame, documents, size, radius):
    assert rows_of(simhash.near_duplicates(frame, size=size, radius=radius, shard_rows=64)) == plain(documents, size, radius)


def clustered(count, seed):
    """Chains and clouds of prints, among them one dense cloud with a third of all."""
    rng = random.Random(seed)
    out = set()
    hub = rng.getrandbits(64)
    while len(out) < count:
        at = hub if rng.random() < 0.4 else rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            out.add(at)
            for _ in range(rng.randrange(1, 4)):
                at ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_a_shard_connects_what_all_pairs_connect(radius):
    prints = np.array(clustered(3000, radius), dtype=np.uint64)
    a, b = simhash.forest_links(prints, radius)
    assert (np.bitwise_count(a ^ b) <= 64).all()
    parent = {int(p): int(p) for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for x, y in zip(a.tolist(), b.tolist()):
        parent[root(x)] = root(y)
    expected = plain_classes(parent.copy(), radius)
    names = {}
    for p in expected:
        assert names.setdefault(expected[p], root(p)) == root(p)
    assert len(set(names.values())) == len(names)


def test_every_linked_pair_meets_in_a_shard():
    prints = np.array(clustered(1500, 8), dtype=np.uint64)
    tree = simhash.Tree(prints[::3], 2, 16)
    assert tree.shards > 20
    at, shard = tree.route(prints)
    assert set(at.tolist()) == set(range(len(prints)))
    homes = {}
    for k, s in zip(at.tolist(), shard.tolist()):
        homes.setdefault(k, set()).add(s)
    for x, y in combinations(range(len(prints)), 2):
        if int(prints[x] ^ prints[y]).bit_count() <= 2:
            assert homes[x] & homes[y]


def test_shards_cut_into_chunks(spark):
    """Numbers so close that no vantage point parts them: one large shard, compared in pairs of chunks."""
    near = [((1 << a) | (1 << b) | (1 << c)) - 2**63 for a in range(16) for b in range(16, 30) for c in range(30, 40)]
    far = [((1 << 20) - 1) << k for k in range(0, 40, 9)]
    frame = spark.createDataFrame([(n,) for n in near + far], "print long")
    got = simhash.components(simhash.links(frame, 2, shard_rows=32, most_sampled=1 << 10)).collect()
    assert {r.node for r in got} == set(near) and {r.root for r in got} == {min(near)}


def test_odd_rows(odd):
    rows = [tuple(r)[:2] for r in odd.collect()]
    assert rows_of(simhash.near_duplicates(odd)) == plain(rows)


def test_nothing_and_only_nulls(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, print long, first long")
    assert simhash.near_duplicates(empty).collect() == []
    frame = spark.createDataFrame([(None, None), (None, ""), (None, "a b c d")], "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(frame)) == plain([(None, None), (None, ""), (None, "a b c d")])
    zero = spark.createDataFrame([(9, None), (4, " \n"), (7, "a")], "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(zero))[:2] == [(4, "0" * 16, 4), (7, f"{plain_print('a'):016x}", 7)]


def test_very_long_text_and_a_third_of_equal_rows(spark):
    long = " ".join(f"w{k % 977}" for k in range(200_000))
    rows = [(k, long if k == 3 else "the same text again and again") if k % 3 == 0 else (k, f"text number {k} of its own kind {k * 7}") for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(frame)) == plain(rows)


def test_query_on_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(QUERIES["op12_simhash_near_dedup"](spark, sf_dir)) == plain(docs)
