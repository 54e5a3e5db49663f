"""Held-out accuracy of the combined classifier, use of pseudo-labels, and odd inputs."""

import random

import numpy as np
import pytest

from loadstone.llm import cotraining
from made_prose import prose


@pytest.fixture(scope="module")
def corpus():
    """Bad documents hold one of a few words or symbols; bad pages lie on a few hosts, mostly with bad documents."""
    rng = random.Random(7)
    docs, labels, pages, truth = [], [], [], {}
    for i in range(1200):
        good = rng.random() < 0.75
        words = prose(rng, rng.randrange(15, 120))
        if not good:
            kind = rng.random()
            if kind < 0.5:
                words[rng.randrange(len(words))] = rng.choice(["nasty", "vile"])
            elif kind < 0.8:
                words = [w + "###" for w in words]
            else:
                words = words[:4] * 20
        truth[i] = good
        docs.append((i, " ".join(words), "en", f"s{i % 5}", len(" ".join(words))))
        host = "spam-farm.example" if (not good and rng.random() < 0.7) else rng.choice(["a.example", "b.example"])
        if i % 3:
            pages.append((i, f"https://{host}/en/{i}"))
        if i % 4 == 0:
            labels.append((i, int(good), 0))
    return docs, labels, pages, truth


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS, PAGES = "doc_id long, quality int, toxic int", "doc_id long, url string"


def frames(spark, docs, labels, pages):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), spark.createDataFrame(pages, PAGES)


def test_held_out_accuracy(spark, corpus):
    docs, labels, pages, truth = corpus
    rows = cotraining.quality_scores(*frames(spark, docs, labels, pages)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(1200))
    unseen = [r for r in rows if r.doc_id % 4]
    assert np.mean([r.kept == truth[r.doc_id] for r in unseen]) > 0.93
    assert np.mean([r.kept for r in unseen if truth[r.doc_id]]) > 0.96
    paged = [r for r in unseen if r.doc_id % 3]
    spam = [r.page_score for r in paged if "spam" in dict(pages)[r.doc_id]]
    assert np.mean(spam) < 0.4 < np.mean([r.page_score for r in paged if "spam" not in dict(pages)[r.doc_id]])


def test_scores_are_calibrated(spark, corpus):
    docs, labels, pages, truth = corpus
    rows = [r for r in cotraining.quality_scores(*frames(spark, docs, labels, pages)).collect() if r.doc_id % 4]
    assert np.mean([r.score for r in rows]) == pytest.approx(np.mean([truth[r.doc_id] for r in rows]), abs=0.05)


def check_exchange(trace, truth, rounds):
    """Both views hand over rows in every round, and their targets say how many of them are good."""
    for number in range(rounds):
        assert {t["view"] for t in trace if t["round"] == number and t["rows"]} == {"text_logit", "page_logit"}
    for view in ("text_logit", "page_logit"):
        parts = [t for t in trace if t["view"] == view]
        ids = [[r.id for r in t["ids"].collect()] for t in parts]
        known = [(t["target"], truth[i]) for t, rows in zip(parts, ids) for i in rows if i in truth]
        if len(known) >= 30:
            assert np.mean([k[0] for k in known]) == pytest.approx(np.mean([k[1] for k in known]), abs=0.15)
    every = [r.id for t in trace for r in t["ids"].collect() if t["view"] == "text_logit"]
    assert len(every) == len(set(every))


def test_both_views_teach_each_other(spark, corpus, monkeypatch):
    docs, labels, pages, truth = corpus
    trace, models = [], []
    real = cotraining._View.train
    monkeypatch.setattr(cotraining._View, "train", lambda self: (real(self), models.append((len(self.features), self.model.weights.copy())))[0])
    cotraining.quality_scores(*frames(spark, docs, labels, pages), trace=trace).collect()
    check_exchange(trace, truth, cotraining.ROUNDS)
    text, page = models[::2], models[1::2]
    for steps in (text, page):
        assert all(a < b for (a, _), (b, _) in zip(steps, steps[1:]))
        assert all(len(v) != len(w) or not np.allclose(v, w) for (_, v), (_, w) in zip(steps, steps[1:]))


def test_exchange_on_the_tables(spark, sf_dir):
    """Held-out labels (all but every third) against targets; the page view hands over rows too."""
    folder = sf_dir.replace("sf0.001", "sf0.01")  # the smallest tables have too few labels to measure anything
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    labels = read("labels")
    pages = read("pages").selectExpr("try_cast(regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([0-9]+)', 1) AS bigint) AS doc_id", "url")
    trace = []
    some = labels.filter("doc_id % 3 <> 0")
    truth = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.filter("doc_id % 3 = 0").collect()}
    rows = cotraining.quality_scores(read("documents"), some, pages, trace=trace).collect()
    check_exchange(trace, truth, cotraining.ROUNDS)
    kept = {r.doc_id: r.kept for r in rows}
    good = [kept[i] for i, g in truth.items() if g]
    assert np.mean(good) >= 0.9


def test_copies_do_not_use_up_a_round(spark, corpus):
    docs, labels, pages, _ = corpus
    copies = [(10_000 + k, "sure and very good prose of one kind", "en", "s1", 30) for k in range(600)]
    trace = []
    cotraining.quality_scores(*frames(spark, docs + copies, labels, pages), rounds=1, trace=trace).collect()
    taken = [r.id for t in trace for r in t["ids"].collect() if t["view"] == "text_logit"]
    assert sum(i >= 10_000 for i in taken) <= 1


def test_same_result_twice(spark, corpus):
    docs, labels, pages, _ = corpus
    run = lambda n: {r.doc_id: r.score for r in cotraining.quality_scores(*(f.repartition(n) for f in frames(spark, docs, labels, pages)), rounds=1).collect()}
    assert run(1) == pytest.approx(run(3), abs=1e-9)


def test_one_class_and_no_labels(spark, corpus):
    docs, labels, pages, _ = corpus
    only = [(i, 1, 0) for i, *_ in labels]
    for chosen in (only, []):
        rows = cotraining.quality_scores(*frames(spark, docs[:50], chosen, pages), rounds=1).collect()
        assert len(rows) == 50 and all(r.kept for r in rows)


def test_odd_rows_and_empty_table(spark, odd, corpus):
    _, labels, pages, _ = corpus
    _, marks, known = frames(spark, [], [*labels, (None, 1, None), (1, None, None), (2, 1, 0), (2, 0, 0)], [*pages, (None, "x"), (1, None), (1, "http://h")])
    rows = cotraining.quality_scores(odd, marks, known, rounds=1).collect()
    assert len(rows) == odd.count()
    assert cotraining.quality_scores(odd.filter("doc_id < 0"), marks, known, rounds=1).count() == 0


def test_features_of_texts():
    import pyarrow as pa

    features = cotraining.text_features(pa.array(["Idiot, that", "idiot that that", None, ""]))
    words = [set(f[f < 1 << 18]) for f in features]
    assert words[0] == words[1] and len(words[0]) == 2 and not words[2] and not words[3]
    assert cotraining.text_features(pa.array([], pa.string())) == []
