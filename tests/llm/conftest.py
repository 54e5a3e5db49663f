import random

import pytest

from made_prose import WORDS, prose


@pytest.fixture(autouse=True)
def shared(spark, tmp_path_factory):
    """A shared folder of this run, as a cluster would name one."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def documents():
    """Prose with exact and near copies, shared passages, repeated lines, empty texts and clashing ids."""
    rng = random.Random(3)
    passage, common = " ".join(prose(rng, 60)), " ".join(prose(rng, 9))
    base = prose(rng, 120)
    rows = []
    for i in range(140):
        kind = i % 7
        if kind == 0:  # near copies of one text, some too far apart to link
            text = list(base)
            for _ in range(rng.randrange(0, 7)):
                text[rng.randrange(len(text))] = rng.choice(WORDS) + "x"
            text = " ".join(text)
        elif kind == 1:
            text = " ".join(prose(rng, 20)) + " " + passage + " " + " ".join(prose(rng, 20))
        elif kind == 2 and i > 20:
            text = rows[rng.randrange(len(rows))][1]
        elif kind == 3:
            text = common + "\n" + "\n".join(" ".join(prose(rng, rng.randrange(1, 9))) for _ in range(rng.randrange(0, 12)))
        elif kind == 4:
            text = rng.choice([None, "", " \t\n", "One two", "one TWO", "a b c d", "\n\n"])
        else:
            text = "\n".join(" ".join(prose(rng, rng.randrange(1, 15))) for _ in range(rng.randrange(1, 20)))
            if kind == 6:
                text = text.upper() + "\n" + text
        rows.append((i * 3 % 140, text, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None])))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def frame(spark, documents):
    return spark.createDataFrame(documents, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, repeated rows, ids with several texts, and columns named like internal ones."""
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (1, line, "en", "s", 7, "x", 0), (1, line, "en", "s", 7, "x", 0), (2, line, None, None, None, None, None),
        (2, "another text of the same id", "en", "s", 1, "y", 1), (None, line, "en", "s", 1, "y", 1),
        (3, None, "en", "s", 1, "y", 1), (4, "", None, "s", 1, "y", 1), (None, None, None, None, None, None, None),
        (5, "\n".join([line] * 4), "en", "s", 1, "y", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA + ", block long, id string, sequence_id int")
