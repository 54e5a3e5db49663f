"""Deltas against a recount, replays, and races of one batch."""

import random
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loadstone.llm import token_rollup, tokens
from loadstone.session import scratch_path

CHANGE = "source string, lang string, version string, op string, tokens long, old_tokens long"


@pytest.fixture
def rollup(spark):
    return token_rollup.TokenRollup(spark, scratch_path(spark, "rollup"))


def totals(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def test_batches_equal_a_recount(spark, rollup):
    rng = random.Random(4)
    live, batches = {}, []
    for number in range(5):
        changes = []
        for _ in range(60):
            doc = rng.randrange(80)
            if doc not in live:
                live[doc] = (rng.choice(["s0", "s1", None]), rng.choice(["en", None]), "v1", rng.randrange(100))
                changes.append((*live[doc][:3], "insert", live[doc][3], None))
            elif rng.random() < 0.4:
                changes.append((*live[doc][:3], "delete", None, live.pop(doc)[3]))
            else:
                new = rng.randrange(100)
                changes.append((*live[doc][:3], "revise", new, live[doc][3]))
                live[doc] = (*live[doc][:3], new)
        batches.append(spark.createDataFrame(changes, CHANGE))
    for number, changes in enumerate(batches):
        assert rollup.apply(f"day {number}/x", changes)
        assert not rollup.apply(f"day {number}/x", changes)
    assert not rollup.apply("day 0/x", batches[3])
    expected = defaultdict(lambda: (0, 0))
    for *key, tokens in live.values():
        docs, total = expected[tuple(key)]
        expected[tuple(key)] = (docs + 1, total + tokens)
    assert totals(rollup) == dict(expected)


def test_a_batch_committed_meanwhile(spark, rollup, monkeypatch):
    changes = spark.createDataFrame([("s", "en", "v", "insert", 5, None)], CHANGE)
    other = token_rollup.TokenRollup(spark, rollup.root)
    real = token_rollup.signed
    monkeypatch.setattr(token_rollup, "signed", lambda rows: (monkeypatch.setattr(token_rollup, "signed", real), other.apply("b", changes), real(rows))[-1])
    assert rollup.apply("b", changes) is False
    assert totals(rollup) == {("s", "en", "v"): (1, 5)}


def test_nulls_and_unknown_changes(spark, rollup):
    rollup.apply("a", spark.createDataFrame([(None, None, None, "insert", None, None)] * 2, CHANGE))
    assert totals(rollup) == {(None, None, None): (2, 0)}
    with pytest.raises(Exception, match="rename"):
        rollup.apply("c", spark.createDataFrame([("s", "en", "v", "rename", 1, 1)], CHANGE))
    assert rollup.batches() == ["batch=a"]


def test_nothing_and_empty_batches(spark, rollup):
    assert totals(rollup) == {}
    assert rollup.apply("empty", spark.createDataFrame([], CHANGE))
    assert totals(rollup) == {} and not rollup.apply("empty", spark.createDataFrame([], CHANGE))


def test_counts(odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder = tokens._rank_encoder(path, ())
    got = token_rollup.count_tokens(odd.select("doc_id", "text", "block"), {"a": path, "b c": path})
    assert got.columns == ["doc_id", "block", "a", "b c"]
    expected = sorted(((r.doc_id, len(encoder.encode_ordinary(r.text or ""))) for r in odd.collect()), key=repr)
    assert sorted([(r.doc_id, r.a) for r in got.collect()], key=repr) == expected
    assert got.filter(F.col("a") != F.col("b c")).count() == 0


@pytest.mark.parametrize("text", ["\n" * 2_000_000, " " * 2_000_000, "a" + " \t" * 700_000 + "b"])
def test_long_runs_of_blanks(spark, text):
    """The library panics on them; the count is that of a shorter run, scaled, as the vocabulary joins blanks in runs."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    frame = spark.createDataFrame([(1, text), (2, "x"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.n for r in token_rollup.count_tokens(frame, {"n": path}).collect()}
    assert got[2] == 1 and got[3] == 0 and 0 < got[1] <= len(text)


def test_fallback_equals_the_fast_way(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoder = tokens._rank_encoder(path, ())
    texts = ["Plain words, 12 of them?\n\n  And  more…", "<|endoftext|> is text", "日本 ünï " * 50, " \n" * 400, "a" * 900]
    expected = [len(encoder.encode_ordinary(t)) for t in texts]

    class Refusing:
        _encode_single_piece = staticmethod(encoder._encode_single_piece)

        def encode_ordinary(self, text):
            raise BaseException("refused")

    monkeypatch.setattr(tokens, "_rank_encoder", lambda path, special: Refusing())
    assert [tokens.count_ordinary(t, path) for t in texts] == expected


def test_folded_batches_count_once(spark):
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "rollup"), fold_after=3)
    row = lambda n: spark.createDataFrame([("s", "en", "v", "insert", n, None)], CHANGE)
    for n in range(8):
        assert rollup.apply(f"b{n}", row(n))
        assert totals(rollup) == {("s", "en", "v"): (n + 1, n * (n + 1) // 2)}
    base, held = rollup._base()
    assert len(held) == 6 and base.endswith("/1")
    assert not rollup.apply("b0", row(0)) and rollup.fold() and not rollup.fold()
    assert totals(rollup) == {("s", "en", "v"): (8, 28)}
