"""The operators of this package as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm import conversations, cotraining, lexical, licences, line_dedup, mixing, neighbours, ngram_join, packing, quality_rules, simhash, sql, substrings, token_rollup, tokens
from loadstone.session import scratch_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(text: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if text is not None:
            SQL[function.__name__] = text
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(sql.REPEATS)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document once windows of 13 words seen in an earlier document are gone."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good, from its text and from its page, and whether it is kept.

    The number in a page's address is the id of its document.
    """
    pages = table(spark, sf_dir, "pages").select(
        F.expr("try_cast(regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([0-9]+)', 1) AS bigint)").alias("doc_id"), "url"
    )
    return cotraining.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), pages)


@_query()
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows found for every hundredth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    pieces = tokens.token_pieces(table(spark, sf_dir, "documents"))
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digest, ["doc_id", "piece"])


@_query(sql.NEAR)
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of each document: five-word shingles, Jaccard similarity of at least 0.8."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@_query(sql.outliers())
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of each document and the verdict of the base rules and of the robust distance."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("text_hash", "distance")


@_query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer version after four batches, two of them delivered twice.

    All documents come in under the first tokenizer; exact copies of an earlier document are
    deleted; documents with repeated lines are revised to the count of their distinct
    lines; then what is left comes in under a second tokenizer.
    """
    docs = table(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    texts = docs.select(
        "doc_id", "source", "lang", "text", F.md5("text").alias("same"),
        F.array_join(F.array_distinct(lines), "\n").alias("cleaned"), (F.size(F.array_distinct(lines)) < F.size(lines)).alias("repeats"),
    )
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    paths = {v: public_tokenizers.path(f"{v}.tiktoken") for v in (first, second)}
    counted = token_rollup.count_tokens(texts.drop("cleaned"), paths)
    revised = token_rollup.count_tokens(
        texts.filter("repeats").select("doc_id", F.col("cleaned").alias("text")), {"cleaned": paths[first]}
    )
    counted = settle(counted.join(revised, "doc_id", "left"))
    earliest = settle(counted.groupBy("same").agg(F.min("doc_id").alias("earliest")))
    counted = settle(counted.join(earliest, "same", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("earliest"), F.lit(False))))

    def batch(rows: DataFrame, op: str, version: str, new: str, old: str) -> DataFrame:
        return rows.selectExpr("source", "lang", f"'{version}' AS version", f"'{op}' AS op", f"{new} AS tokens", f"{old} AS old_tokens")

    deliveries = [
        ("1 insert", batch(counted, "insert", first, first, "NULL")),
        ("2 delete", batch(counted.filter("copy"), "delete", first, "NULL", first)),
        ("3 revise", batch(counted.filter("NOT copy AND cleaned IS NOT NULL"), "revise", first, "cleaned", first)),
        ("4 insert", batch(counted.filter("NOT copy"), "insert", second, second, "NULL")),
    ]
    rollup = token_rollup.TokenRollup(spark, scratch_path(spark, "rollup"))
    for name, changes in [*deliveries, deliveries[0], deliveries[2]]:
        rollup.apply(name, changes)
    return rollup.totals()


@_query(sql.RUNS)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text left of each document once runs of three lines seen earlier are gone."""
    kept = line_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query(sql.mixed())
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, probability and draw of each document, raked to evened shares of sources, languages and topics."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "tokens", "topic", F.round("probability", 6).alias("probability"), "sampled")


@_query(sql.licences())
def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of each document, found in its text or taken from the nearest directory above.

    The tables hold no paths; a document lies in one folder per digit of its id but the
    last: 4321 is 4/3/2/4321. One whose id ends with 0 is its folder's LICENSE.
    """
    docs = table(spark, sf_dir, "documents")
    digits = F.col("doc_id").cast("string")
    folders = F.regexp_replace(F.substring(digits, F.lit(1), F.length(digits) - 1), "(.)", "$1/")
    name = F.when(F.col("doc_id") % 10 == 0, "LICENSE").otherwise(digits)
    found = licences.scan(docs.withColumn("path", F.concat(folders, name)))
    return found.withColumn("score", F.round("score", 6))


@_query()
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of each document and the smallest id reachable over fingerprints at 2 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query(sql.SEARCH)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 highest-scoring documents of each benchmark item."""
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), 50)


@_query(sql.repairs())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and hash of the repaired rows of each damaged conversation."""
    turns = table(spark, sf_dir, "conversations")
    repair = conversations.Repair(conversations.damage(turns))
    report, hashes = settle(repair.report()), settle(conversations.digests(repair.repaired()))
    ids = turns.select("conv_id").distinct()
    report, hashes = report.withColumnRenamed("conv_id", "_conv"), hashes.withColumnRenamed("conv_id", "_hashed")
    rows = ids.join(report, ids["conv_id"].eqNullSafe(report["_conv"]), "left")
    rows = rows.join(hashes, rows["conv_id"].eqNullSafe(hashes["_hashed"]), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", *conversations.REPORT, "cost")]
    nothing = F.sha2(F.lit(""), 256)
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
