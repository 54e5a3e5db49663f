"""The registered queries against their SQL, and against plain versions where there is none."""

import base64
from collections import defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from compare import differences
from loadstone.llm.catalog import QUERIES, SQL
from test_packing import check_cover
from tokenizers import Tokenizer


def test_every_operator_is_registered():
    import __spark_entry__

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, sf_dir, connection):
    assert differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) is None


def test_packing_covers_all_documents(spark, sf_dir):
    import zlib

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = []
    for r in QUERIES["op4_best_fit_packing"](spark, sf_dir).collect():
        import numpy as np

        ids = np.array([*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")[r.start : r.start + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        rows.append((r.doc_id, r.piece, r.start, r.length, ids.tobytes(), r.sequence_id, r.offset))
    check_cover(rows, list(texts.items()), tokenizer, 2048)
    used = len({r[5] for r in rows})
    assert used <= 1.02 * sum(r[3] for r in rows) / 2048 + 1


def test_token_counts(spark, sf_dir):
    import tiktoken

    def encoder(name):
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    first, second = encoder("byte_bpe_50k"), encoder("byte_bpe_multi_50k")
    expected, seen = defaultdict(lambda: (0, 0)), set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        if r.text in seen:
            continue
        seen.add(r.text)
        cleaned = "\n".join(dict.fromkeys(r.text.split("\n")))
        for name, tokens in (("byte_bpe_50k", first.encode_ordinary(cleaned)), ("byte_bpe_multi_50k", second.encode_ordinary(r.text))):
            docs, total = expected[r.source, r.lang, name]
            expected[r.source, r.lang, name] = (docs + 1, total + len(tokens))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in QUERIES["op7_token_counts"](spark, sf_dir).collect()}
    assert got == dict(expected)


def test_quality_classifier_on_labels(spark, sf_dir):
    rows = QUERIES["op2_quality_classifier"](spark, sf_dir)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    marks = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    clean = [r.kept for r in marks if r.quality == 1 and r.toxic == 0]
    assert sum(clean) >= 0.95 * len(clean)


def test_pipeline_equals_its_stages_done_plainly(spark, sf_dir):
    """Every stage against a brute-force version of it, on whole documents of the smallest table."""
    from test_line_dedup import plain as plain_lines
    from test_ngram_join import plain as plain_classes

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, frame, results = docs.columns, docs, []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, frame, sf_dir).collect()
        results.append(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            frame = spark.createDataFrame(rows, docs.schema)
            assert frame.columns == columns
    first, lined, unique, mixed, packed = results
    kept = {r.doc_id for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect() if r.kept}
    assert {r.doc_id for r in first} == kept
    assert sorted((r.doc_id, r.text) for r in lined) == sorted(x[:2] for x in plain_lines([(r.doc_id, r.text) for r in first], emptied=False))
    assert all(r.n_chars == len(r.text) for r in lined)
    classes = plain_classes([(r.doc_id, r.text) for r in lined])
    assert sorted(r.doc_id for r in unique) == sorted(i for i, _, c in classes if i == c)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in unique} and len(mixed) > 0.5 * len(unique)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_cover([tuple(r) for r in packed], [(r.doc_id, r.text) for r in mixed], tokenizer, 2048)
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length").collect()
    assert sorted(map(tuple, whole)) == sorted((r.doc_id, r.piece, r.start, r.length) for r in packed)
