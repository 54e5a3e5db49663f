"""Deletion of repeated runs against a plain dictionary of windows; winnowing guarantees on random lines."""

import random
import re

import pytest

from loadstone.llm.line_dedup import drop_repeats


def windows(lines, numbers, window, long_words):
    """(lines, numbers) of every window that counts: whole ones, and shorter ones with enough words."""
    for size in range(1, window + 1):
        for k in range(len(numbers) - size + 1):
            chosen = numbers[k : k + size]
            seq = tuple(lines[n] for n in chosen)
            if size == window or sum(len(re.findall("[^ \t-\r]+", x)) for x in seq) >= long_words:
                yield seq, chosen


def plain(rows, window=3, emptied=True, long_words=50):
    """rows: (id, text); one result per row."""
    texts = {(i, t) for i, t in rows if i is not None and t is not None}
    solid = {key: [k for k, line in enumerate(key[1].split("\n")) if re.search("[^ \t-\r]", line)] for key in texts}
    smallest, out = {}, []
    for key, numbers in solid.items():
        for seq, _ in windows(key[1].split("\n"), numbers, window, long_words):
            smallest[seq] = min(smallest.get(seq, key[0]), key[0])
    for i, t in rows:
        gone = set()
        if (i, t) in texts:
            own = set()
            for seq, chosen in windows(t.split("\n"), solid[i, t], window, long_words):
                if smallest[seq] < i or seq in own:
                    gone.update(chosen)
                own.add(seq)
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        if emptied or not gone or re.search("[^ \t-\r]", left):
            out.append((i, left, 0 if t is None else t.count("\n") + 1, len(gone)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(6)
    pool = [f"line {k}" for k in range(40)]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 6))]
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, 30)
            lines += pool[at : at + rng.randrange(1, 9)] + rng.choice([[], [""], ["same line"], [f"own {i} {rng.random()}"]])
        rows.append((i, "\n".join(lines)))
    rows += [(200, "same line\n" * 40), (201, "same line\n" * 40), (202, rows[3][1])]
    return rows


@pytest.mark.parametrize("window, long_words", [(2, 50), (3, 50), (5, 50), (3, 4), (4, 7), (3, 2)])
def test_equals_plain(spark, lined, window, long_words):
    frame = spark.createDataFrame(lined, "doc_id long, text string")
    got = drop_repeats(frame, window=window, long_words=long_words)
    expected = plain(lined, window, long_words=long_words)
    assert sum(r[3] for r in expected) > 100
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_emptied_documents_go(spark, lined):
    frame = spark.createDataFrame(lined, "doc_id long, text string")
    got = drop_repeats(frame, counts=False, emptied=False)
    expected = [r[:2] for r in plain(lined, emptied=False)]
    assert len(expected) < len(lined)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_documents(frame, documents):
    got = drop_repeats(frame).select("doc_id", "text", "n_lines", "n_deleted")
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain([(i, t) for i, t, *_ in documents])


def test_odd_rows(odd):
    got = drop_repeats(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_deleted"]
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_deleted").collect()], key=repr) == plain(rows)


def test_empty_table(frame):
    assert drop_repeats(frame.filter("doc_id < 0")).count() == 0


def test_columns_called_like_the_inner_ones(frame):
    from pyspark.sql import functions as F

    names = ["_parts", "_places", "_row", "_gone", "_id", "_hash", "_starts", "doc", "parts", "places", "numbers", "gone", "row", "left", "id"]
    clashing = frame.select("*", *[F.lit(n).alias(n) for n in names])
    got, expected = drop_repeats(clashing), drop_repeats(frame)
    assert got.columns == [*clashing.columns, "n_lines", "n_deleted"]
    key = ("doc_id", "text", "n_lines", "n_deleted")
    assert sorted((tuple(r[k] for k in key) for r in got.collect()), key=repr) == sorted((tuple(r[k] for k in key) for r in expected.collect()), key=repr)
    assert all(r[n] == n for r in got.collect() for n in names)


def test_long_passages_of_one_or_two_lines(spark):
    long = " ".join(f"w{k}" for k in range(55))
    first, second = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(25))
    short = "a short line"
    rows = [
        (1, f"{long}\n{short}\n{first}\n{second}"), (2, long), (3, f"own\n{long}\n{short}"), (4, f"{first}\n\n{second}\nrest"),
        (5, f"{first}\n{short}\n{second}"), (6, short), (7, f"{long}\n{long}"),
    ]
    got = {r.doc_id: r.text for r in drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "own", 4: "\nrest", 5: rows[4][1], 6: short, 7: ""}
