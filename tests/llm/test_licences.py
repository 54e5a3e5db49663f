"""Notices, licence files and inheritance."""

import random
from collections import Counter
from math import log, sqrt

import pytest

from loadstone.llm import licences
from made_prose import prose

MIT = "Released under the MIT License."
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'


@pytest.fixture(scope="module")
def files():
    rng = random.Random(3)
    body = lambda: "\n".join(" ".join(prose(rng, 12)) for _ in range(6))
    return [
        (1, "a/LICENSE", MIT), (2, "a/x.py", body()), (3, "a/b/c/y.py", body()), (4, "a/b/NOTICE", APACHE + "\n"),
        (5, "a/b/z.py", "# " + MIT.upper() + "\n" + body()), (6, "d/x.py", body()), (7, "ab/x.py", body()), (8, None, MIT),
        (9, None, body()), (10, "a/b/empty", ""), (11, "a/none", None), (None, "a/b/c/noid", "words " + body()),
        (12, "top.txt", body()), (13, "", body()), (14, "a//odd", body()), (15, "a/b/COPYING", APACHE + "\nand more of it"),
    ]


SCHEMA = "doc_id long, path string, text string"


def test_nearest_directory_wins(spark, files):
    got = {(r.doc_id, r.path): (r.licence, r.how, r.source_path) for r in licences.scan(spark.createDataFrame(files, SCHEMA)).collect()}
    assert len(got) == len(files)
    assert got[1, "a/LICENSE"] == ("MIT", "notice", "a/LICENSE") and got[4, "a/b/NOTICE"][:2] == ("Apache-2.0", "notice")
    assert got[2, "a/x.py"] == ("MIT", "inherited", "a") and got[11, "a/none"] == ("MIT", "inherited", "a")
    assert got[3, "a/b/c/y.py"] == ("Apache-2.0", "inherited", "a/b") and got[10, "a/b/empty"] == ("Apache-2.0", "inherited", "a/b")
    assert got[5, "a/b/z.py"] == ("MIT", "notice", "a/b/z.py")
    assert got[None, "a/b/c/noid"] == ("Apache-2.0", "inherited", "a/b")
    assert got[8, None] == ("MIT", "notice", None) and got[9, None] == (None, None, None)
    for key in ((6, "d/x.py"), (7, "ab/x.py"), (12, "top.txt"), (13, "")):
        assert got[key] == (None, None, None)


def test_root_licence_covers_all_but_nearer_ones(spark, files):
    rows = [*files, (99, "LICENSE", "All rights reserved.")]
    got = {(r.doc_id, r.path): (r.licence, r.source_path) for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[6, "d/x.py"] == ("reserved", "") and got[12, "top.txt"] == ("reserved", "") and got[2, "a/x.py"] == ("MIT", "a")
    assert got[9, None] == (None, None)


def test_scores_equal_plain_cosines(spark, files):
    texts = [t for *_, t in files]
    n = sum(t is not None for t in texts)
    df = Counter(w for t in texts if t is not None for w in set(licences.terms(t)))
    vocabulary = {w for _, t in licences.TEMPLATES for w in licences.terms(t)}
    idf = lambda w: log((n + 1) / ((df[w] if w in vocabulary else 0) + 1)) + 1

    def cosine(left, right):
        a, b = ({w: c * idf(w) for w, c in Counter(licences.terms(t)).items()} for t in (left, right))
        norm = sqrt(sum(x * x for x in a.values())) * sqrt(sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0.0

    got = {(r.doc_id, r.path): r for r in licences.scan(spark.createDataFrame(files, SCHEMA)).collect()}
    for i, path, text in files:
        best = max(cosine(line, t) for line in (text or "").split("\n") for _, t in licences.TEMPLATES)
        row = got[i, path]
        assert (row.how == "notice") == (best >= licences.NOTICE_SCORE)
        if row.how == "notice":
            assert row.score == pytest.approx(best)


def test_odd_rows_and_empty_table(spark, odd):
    frame = odd.withColumnRenamed("source", "path")
    assert licences.scan(frame).count() == odd.count()
    assert licences.scan(frame.filter("doc_id < 0")).count() == 0


def test_wrapped_headers_are_notices(spark):
    rng = random.Random(4)
    body = "\n".join(" ".join(prose(rng, 12)) for _ in range(6))
    wanted, rows = {}, []
    for k, (name, text) in enumerate(licences.TEMPLATES):
        words = text.split()
        for step in (4, 9, 15):
            if len(words) > step:
                header = "".join(f" * {' '.join(words[i : i + step])}\n" + " *\n" * (i == step) for i in range(0, len(words), step))
                wanted[100 * k + step] = name
                rows.append((100 * k + step, f"f{k}/{step}/x", f"{body}\n/*\n{header} */\n{body}"))
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(wanted) > 15 and {i: (r.licence, r.how) for i, r in got.items()} == {i: (name, "notice") for i, name in wanted.items()}


def test_best_run_equals_all_runs():
    rng = random.Random(9)
    vocabulary = sorted({w for _, t in licences.TEMPLATES for w in licences.terms(t)})
    scorer = licences.Scorer(licences.TEMPLATES, {w: rng.randrange(50) for w in vocabulary}, 60)
    found = 0
    for _ in range(150):
        words = rng.choice(licences.TEMPLATES)[1].split()
        at = sorted(rng.randrange(len(words)) for _ in range(3))
        lines = [words[a:b] for a, b in zip([0, *at], [*at, len(words)])]
        lines.insert(rng.randrange(5), prose(rng, rng.randrange(4)))
        lines = [Counter(licences.terms(" ".join(x))) for x in lines]
        every = [scorer.best(sum(lines[a:b], Counter())) for a in range(5) for b in range(a + 1, 6)]
        best = min((x for x in every if x), default=(0, ""))
        got = scorer.notice(lines, 0.8)
        assert (got is not None and -got[0] >= 0.8) == (-best[0] >= 0.8)
        if -best[0] >= 0.8:
            found += 1
            assert got[0] == pytest.approx(best[0])
    assert found > 50


def test_a_notice_in_a_file_named_like_a_licence_holds_for_its_directory(spark):
    body = "\n".join("words of a long text that no template has anything in common with at all" for _ in range(40))
    rows = [
        (1, "p/LICENSE.txt", body + "\n" + MIT), (2, "p/q/x.py", body), (3, "r/readme", body + "\n" + MIT), (4, "r/x.py", body),
        (5, "s/copying", body + "\n" + APACHE), (6, "s/t/NOTICE-old", body + "\n" + MIT), (7, "s/t/u/x", body), (8, "s/x", body),
        (9, "v/licenses", body + "\n" + MIT), (10, "v/x", body),
    ]
    got = {r.doc_id: (r.licence, r.how, r.source_path) for r in licences.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2] == ("MIT", "inherited", "p") and got[4] == (None, None, None) and got[10] == (None, None, None)
    assert got[7] == ("MIT", "inherited", "s/t") and got[8] == ("Apache-2.0", "inherited", "s")


def test_the_query_has_inherited_rows(spark, sf_dir):
    from loadstone.llm.catalog import QUERIES

    rows = QUERIES["op10_license_scans"](spark, sf_dir.replace("sf0.001", "sf0.01")).collect()
    assert {r.how for r in rows} == {"notice", "inherited", None}
    assert sum(r.how == "inherited" for r in rows) >= 5
