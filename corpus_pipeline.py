"""The corpus pipeline: from documents to packed sequences, each stage an operator of ``loadstone.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the
last return the columns of ``documents``. ``run`` writes each stage's result to the
shared folder and reads it back, so a stage that reads its input several times does
not compute the stages before it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.llm import line_dedup, mixing, ngram_join, packing, quality_rules, tokens
from loadstone.session import settle, tune


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language and source; the others go."""
    tune(spark)
    return quality_rules.keep_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of three lines seen earlier; documents that lose their last word go."""
    tune(spark)
    kept = line_dedup.drop_repeats(docs, counts=False, emptied=False)
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates, with the smallest id; rows are judged by id and text."""
    tune(spark)
    # A name that no column of the documents has.
    key = "_key" + "_" * max([len(c) for c in docs.columns])
    keyed = docs.select(*docs.columns, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")).alias(key))
    classes = settle(ngram_join.near_duplicates(keyed, key).filter(f"n_shingles > 0 AND {key} IS NOT NULL").groupBy(key).agg(
        F.min("component_id").alias("class"), F.count(F.lit(1)).alias("rows")
    ))
    ids = keyed.select(key, "doc_id").join(classes, key)
    first = settle(ids.groupBy("class").agg(F.min(F.struct("doc_id", key)).alias("first")))
    copies = settle(classes.join(first, "class").filter(F.col(key) != F.col(f"first.{key}")).select(key))
    repeated = settle(classes.filter("rows > 1").select(key))
    left = keyed.join(copies, key, "left_anti")
    once = left.join(repeated, key, "left_semi").dropDuplicates([key])
    return left.join(repeated, key, "left_anti").unionByName(once).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the probabilities of their source, language and topic."""
    tune(spark)
    return mixing.mix(docs).filter("sampled").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, placed in sequences of at most 2048 tokens."""
    tune(spark)
    return packing.pack(tokens.token_pieces(docs), ["doc_id", "piece"])


STAGES = [
    ("quality rules", quality_rules_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# The token ids of the last stage are not to be had in SQL; the tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
