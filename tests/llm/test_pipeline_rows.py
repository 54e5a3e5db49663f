"""The n-gram stage of the pipeline on ids that occur with several texts."""

import random

import corpus_pipeline
from made_prose import prose


def test_ngram_stage_decides_per_row(spark):
    rng = random.Random(13)
    text, own, other = (" ".join(prose(rng, 80)) for _ in range(3))
    rows = [
        (1, text, "a"), (2, text + " end", "b"), (2, own, "c"), (3, other, "d"), (3, other, "e"), (4, other + " end", "f"),
        (5, "", "g"), (5, "", "h"), (None, text, "i"), (6, None, "j"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.ngram_join_stage(spark, frame, "")
    assert got.columns == frame.columns
    left = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert left == sorted([(1, text), (2, own), (3, other), (5, ""), (5, ""), (0, text), (6, "")])


def test_ngram_stage_with_a_column_called_like_its_key(spark):
    from pyspark.sql import functions as F

    rows = [(1, "one two three four five six", "a"), (2, "one two three four five six", "b"), (3, "seven eight nine ten eleven", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *[F.lit(n).alias(n) for n in ("_key", "class", "first", "rows")])
    got = corpus_pipeline.ngram_join_stage(spark, frame, "").collect()
    assert sorted((r.doc_id, r._key, r["class"], r.rows) for r in got) == [(1, "_key", "class", "rows"), (3, "_key", "class", "rows")]
