"""Statistics against plain Python, the estimate against numpy, the verdict on planted outliers."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadstone.llm import quality_rules
from made_prose import prose


def plain(text):
    words = re.findall("[^ \t-\r]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 3))
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics(spark, documents, frame):
    got = quality_rules.statistics(frame).select("doc_id", "text", *NAMES).collect()
    assert len(got) == len(documents)
    assert all(tuple(r)[2:] == plain(r.text) for r in got)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t#é字\x0b\x85"), max_size=40), min_size=1, max_size=30))
def test_statistics_of_any_text(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert all(tuple(r)[1:] == plain(r.text) for r in quality_rules.statistics(frame).select("text", *NAMES).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(700):
        words = prose(rng, rng.randrange(60, 900))
        if i % 10 == 0 and i % 20:
            words = [w + rng.choice(["###", "$$", "%%%"]) for w in words]
        elif i % 20 == 0:
            words = [x for w in words for x in (w, "|")]
        text = " ".join(words[:20]) + "\n" + " ".join(words[20:])
        source = "big" if i % 3 else f"small{i % 40}"
        rows.append((i, text, "en" if i % 7 > 2 else "de", source))
    rows += [(1000, " ".join(prose(rng, 15000)), "en", "big"), (1001, "too short", "en", "big"), (1002, None, None, None)]
    return rows


def test_planted_outliers_go_and_clean_documents_stay(spark, corpus):
    frame = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame).collect()}
    assert len(kept) == len(corpus)
    assert not any(kept[i] for i in range(0, 700, 10)) and not kept[1001] and not kept[1002]
    assert all(kept[i] for i in range(700) if i % 10) and kept[1000]


def reference(rows):
    """The same estimate of one group in numpy."""
    stats = np.array([plain(t)[:5] for t in rows], dtype=float)
    n = stats[:, 0]
    x = np.stack([np.log(1 + n), np.log(stats[:, 1] / n), *[np.sqrt(stats[:, k] / n) for k in (2, 3, 4)]], axis=1)
    floors = np.array(quality_rules.FLOORS) ** 2
    cut = np.floor(1000 * x) / 1000
    mean = np.median(cut, axis=0)
    cov = np.diag((1.4826 * np.median(np.abs(cut - mean), axis=0)) ** 2 + floors)
    for _ in range(quality_rules.STEPS):
        z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
        bins = np.floor(16 * np.log2((z**2).sum(axis=0) + 1e-6))
        order = np.sort(bins)
        edge = order[int(np.ceil(quality_rules.SHARE * len(x))) - 1]
        near = x[bins <= edge]
        mean = near.mean(axis=0)
        cov = quality_rules.CONSISTENCY * (near.T @ near / len(near) - np.outer(mean, mean)) + np.diag(floors)
    z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
    return np.sqrt((z[1:] ** 2).sum(axis=0))


def test_distance_equals_numpy(spark):
    rng = random.Random(12)
    texts = [" ".join(prose(rng, rng.randrange(55, 300)) + ["#"] * rng.choice([0, 0, 0, 1, 9])) for _ in range(150)]
    frame = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.distance for r in quality_rules.judge(frame).collect()}
    assert [got[i] for i in range(150)] == pytest.approx(reference(texts).tolist(), rel=1e-6)


def test_small_groups_reject_nothing(spark, odd):
    verdicts = quality_rules.judge(odd).collect()
    assert len(verdicts) == odd.count()
    assert all(r.distance is None for r in verdicts) and not any(r.kept and r.base_failed for r in verdicts)
    kept = quality_rules.keep_documents(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in verdicts)


def test_empty_table(frame):
    none = frame.filter("doc_id < 0")
    assert quality_rules.judge(none).count() == 0 and quality_rules.keep_documents(none).count() == 0


@pytest.mark.parametrize("share", [0.35, 0.45])
def test_junk_of_nearly_half_a_group_goes(spark, share):
    rng = random.Random(21)
    rows = []
    for i in range(400):
        words = prose(rng, rng.randrange(60, 300))
        junk = i < share * 400
        rows.append((i, " ".join(w + "#$%|&"[: rng.randrange(3, 6)] if junk else w for w in words), "en", "s"))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame).collect()}
    assert [i for i in range(400) if kept[i] != (i >= share * 400)] == []
