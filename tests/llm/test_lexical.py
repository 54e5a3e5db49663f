"""Ranked search against scores of all documents, with shards and blocks of every size."""

import math
import random
import re

import numpy as np
import pytest

from loadstone.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(items, docs, k=50):
    bags = [terms(t) for _, t in docs]
    n_docs, total = sum(1 for b in bags if b), sum(map(len, bags))
    out = []
    for item, text in items:
        asked = {t: sum(1 for b in bags if t in b) for t in set(terms(text))}
        scored = []
        for (doc, _), bag in zip(docs, bags):
            m = 50 + (50 * len(bag) * n_docs) // max(total, 1)
            score = 0
            for t, df in asked.items():
                tf = bag.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted([tuple(r) for r in frame.collect()], key=repr)


def made(spark, items, docs):
    return spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")


@pytest.mark.parametrize("shard_bytes, block_terms, k", [(1 << 24, 10**6, 50), (700, 25, 5), (1, 10**6, 3)])
def test_equals_all_scores(spark, documents, shard_bytes, block_terms, k):
    docs = [(i, t) for i, t, *_ in documents]
    rng = random.Random(4)
    texts = [t for _, t in docs if t and len(t) > 60]
    items = [(n, " ".join(rng.sample(rng.choice(texts).split(), 9))) for n in range(12)]
    got = lexical.search(*made(spark, items, docs), k, shard_bytes=shard_bytes, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert rows_of(got) == plain(items, docs, k)


def test_reading_stops_before_the_end_and_is_right(spark):
    """A rare term decides; the common one's list need not be read to its end."""
    rng = random.Random(1)
    docs = [(i, " ".join(["common"] * rng.randrange(1, 4) + ["rare"] * (5 if i % 40 == 0 else 0) + ["x%d" % i])) for i in range(1200)]
    row = lexical._shard(np.array([i for i, _ in docs]), lexical.pa.array([t for _, t in docs]))
    hashes = {w: lexical._terms(lexical.pa.array([w]))[0][0] for w in ("common", "rare")}
    wanted = np.array(sorted(hashes.values()), dtype=np.uint64)
    shard = lexical.Shard(dict(zip(lexical._INDEX_NAMES, row)), wanted, row[6], row[7])
    weights = np.array([3000 if w == hashes["rare"] else 100 for w in wanted])
    met, scores = shard.search(np.arange(2), weights, 10, 0)
    assert 10 <= len(met) < 1200
    everything, all_scores = shard.search(np.arange(2), weights, 5000, 0)
    assert len(everything) == 1200
    assert [x.tolist() for x in lexical._best(shard.ids[met], scores, 10)] == [x.tolist() for x in lexical._best(shard.ids[everything], all_scores, 10)]
    assert len(shard.search(np.arange(2), weights, 10, int(all_scores.max()) + 1)[0]) < len(met) + 1


def test_ties_repeats_and_nulls(spark):
    docs = [(i % 30 if i % 7 else None, "same words here" if i % 3 else "same") for i in range(120)]
    docs += [(1, None), (2, ""), (None, None), (3, " .,; "), (4, "Ünïcode ÄB äb ab1_ab1")]
    items = [(1, "SAME words"), (1, "same words"), (None, "words, ÄB"), (2, None), (3, "--"), (4, "absent")]
    got = lexical.search(*made(spark, items, docs), 50, shard_bytes=64)
    assert rows_of(got) == plain(items, docs)


def test_nothing(spark):
    items, docs = made(spark, [(1, "a b")], [(1, "a b")])
    assert lexical.search(items.limit(0), docs).collect() == []
    assert lexical.search(items, docs.limit(0)).collect() == []
    assert lexical.search(items, docs.selectExpr("doc_id", "CAST(NULL AS string) AS text")).collect() == []


def test_clashing_columns_and_a_very_long_text(spark):
    long = " ".join(f"w{k % 5003}" for k in range(150_000))
    items, docs = made(spark, [(1, "w7 w9 q1"), (2, long)], [(k, long if k == 5 else f"q{k} w{k}") for k in range(60)])
    more = docs.selectExpr("*", "1 AS item", "2 AS id", "3 AS score", "4 AS part", "5 AS rank")
    got = lexical.search(items.selectExpr("*", "1 AS key", "2 AS terms", "3 AS size"), more)
    assert rows_of(got) == plain([(r.item_id, r.text) for r in items.collect()], [(r.doc_id, r.text) for r in docs.collect()])
