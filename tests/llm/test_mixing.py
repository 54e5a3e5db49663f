"""Raking against numpy, bounds, and the draw."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loadstone.llm import mixing
from made_prose import prose


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        source = rng.choice(["big", "big", "big", "s1", "s2", "s3"])
        rows.append((i, " ".join(prose(rng, rng.randrange(1, 80))), rng.choice(["en", "en", "en", "de"]), source))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def raked(have, targets, rounds):
    weights = dict(have)
    for _ in range(rounds):
        for axis in range(3):
            now = defaultdict(float)
            for cell, w in weights.items():
                now[cell[axis]] += w
            weights = {
                c: min(have[c], w * targets[axis].get(c[axis], None) / now[c[axis]]) if now[c[axis]] else 0.0 for c, w in weights.items()
            }
    return weights


def test_equals_plain_raking(corpus):
    rows = mixing.mix(corpus).collect()
    assert len(rows) == 900
    have, total = defaultdict(float), sum(r.tokens for r in rows)
    for r in rows:
        assert r.tokens == len(r.text.split())
        have[r.source, r.lang, r.topic] += r.tokens
    targets = []
    for axis in range(3):
        sums = defaultdict(float)
        for cell, n in have.items():
            sums[cell[axis]] += n
        shares = {v: n**mixing.EVENNESS for v, n in sums.items()}
        targets.append({v: s / sum(shares.values()) * mixing.BUDGET * total for v, s in shares.items()})
    weights = raked(have, targets, mixing.ROUNDS)
    for r in rows:
        cell = r.source, r.lang, r.topic
        assert r.probability == pytest.approx(weights[cell] / have[cell], rel=1e-9)
        draw = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert r.sampled == (draw < r.probability)
    assert max(r.probability for r in rows) <= 1
    kept = sum(r.tokens for r in rows if r.sampled)
    assert kept == pytest.approx(sum(weights.values()), rel=0.1)


def test_reachable_targets_are_met(spark):
    cells = [(s, l, t, 100.0 + 10 * i) for i, (s, l, t) in enumerate((s, l, t) for s in "ab" for l in "xy" for t in "pq")]
    frame = spark.createDataFrame(cells, "source string, lang string, topic string, have double")
    target = lambda **values: spark.createDataFrame(list(values.items()), "value string, target double")
    weights = mixing.rake(frame, {"source": target(a=150.0, b=250.0), "lang": target(x=180.0, y=220.0), "topic": target(p=240.0, q=160.0)}, 30)
    for column, value, expected in (("source", "a", 150), ("lang", "y", 220), ("topic", "p", 240)):
        assert weights.filter(F.col(column) == value).agg(F.sum("weight")).first()[0] == pytest.approx(expected, rel=1e-6)


def test_odd_rows(odd):
    got = mixing.mix(odd.withColumn("tokens", F.lit("clash")).withColumn("value", F.lit(1)).withColumn("have", F.lit(2)))
    rows = got.collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.probability <= 1 for r in rows)
    assert len({(r.doc_id, r.text, r.sampled) for r in rows if r.doc_id == 1}) == 1


def test_empty_table(corpus):
    assert mixing.mix(corpus.filter("doc_id < 0")).count() == 0


def test_given_topics_and_values_without_a_target(spark):
    rng = random.Random(7)
    rows = [
        (i, " ".join(prose(rng, 20)), "de" if i % 3 else "en", rng.choice(["s1", "s2"]), rng.choice(["law", "art", None, "news"])) for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, topic string")
    target = lambda **values: spark.createDataFrame(list(values.items()), "value string, target double")
    topics = spark.createDataFrame([("law", 1000.0), ("art", 500.0), (None, 300.0)], "value string, target double")
    targets = {"source": target(s1=900.0, s2=900.0), "lang": target(en=600.0, de=1200.0), "topic": topics}
    got = {r.doc_id: r for r in mixing.mix(frame, targets=targets, topic_col="topic", rounds=30).collect()}
    assert {i: r.topic for i, r in got.items()} == {i: t for i, *_, t in rows}
    assert all(r.probability == 0 and not r.sampled for r in got.values() if r.topic == "news")
    for topic, expected in (("law", 1000), ("art", 500), (None, 300)):
        assert sum(r.tokens * r.probability for r in got.values() if r.topic == topic) == pytest.approx(expected, rel=1e-3)
    plain = mixing.mix(frame.withColumnRenamed("topic", "kind"), targets=targets | {"source": target(s1=900.0)}, topic_col="kind").collect()
    assert len(plain) == 400 and all((r.probability == 0) == (r.source == "s2" or r.kind == "news") for r in plain)


def test_topic_comes_from_the_whole_text(spark):
    """Texts that differ in their last lines only; a word in the middle of a long text decides."""
    start = "a line that all of them begin with\n" * 3
    rows = [(1, start + "harbour harbour"), (2, start + "mountain mountain"), (3, start + "x " * 5000 + "orchard orchard" + " y" * 5000)]
    got = {r.doc_id: r.topic for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'s' source")).collect()}
    expected = {i: f"topic{int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % mixing.TOPICS}" for i, w in ((1, "harbour"), (2, "mountain"), (3, "orchard"))}
    assert got == expected


def test_marginals_meet_their_targets_after_settling(corpus, spark):
    """Raked weights against the targets themselves, not against another run of the loop."""
    rows = mixing.mix(corpus)
    cells = rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").cast("double").alias("have"))
    targets = {m: rows.groupBy(F.col(m).alias("value")).agg((F.sum("tokens") * 0.5).alias("target")) for m in mixing.MARGINS}
    tilted = targets | {"source": rows.groupBy(F.col("source").alias("value")).agg((F.sum("tokens") * F.when(F.col("source") == "big", 0.4).otherwise(0.6)).alias("target"))}
    total = rows.agg(F.sum("tokens")).first()[0]
    scale = tilted["source"].agg(F.sum("target")).first()[0] / (0.5 * total)
    tilted["source"] = tilted["source"].withColumn("target", F.col("target") / scale)
    left = mixing.misses(mixing.rake(cells, tilted, 100), tilted).collect()
    assert {r.margin for r in left} == set(mixing.MARGINS)
    assert all(r.weight == pytest.approx(r.target, rel=1e-6) for r in left)


def test_raking_stops_when_nothing_moves(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "x", "p", 10.0), ("b", "x", "p", 30.0)], "source string, lang string, topic string, have double")
    half = lambda **v: spark.createDataFrame(list(v.items()), "value string, target double")
    settled = []
    real = mixing.settle
    monkeypatch.setattr(mixing, "settle", lambda df: settled.append(1) or real(df))
    mixing.rake(cells, {"source": half(a=5.0, b=15.0), "lang": half(x=20.0), "topic": half(p=20.0)}, 50)
    assert len(settled) <= 7


def test_columns_called_like_the_inner_ones(corpus):
    names = ["_source", "_lang", "_topic", "doc", "given", "id", "step", "words", "long", "begins", "cell_topic", "_given"]
    frame = corpus.limit(40).select("*", *[F.lit(n).alias(n) for n in names], F.lit("law").alias("kind"))
    for topic_col in (None, "kind"):
        rows = mixing.mix(frame, topic_col=topic_col).collect()
        assert len(rows) == 40 and all(r[n] == n for r in rows for n in names)
        assert topic_col is None or all(r.topic == r.kind == "law" for r in rows)
