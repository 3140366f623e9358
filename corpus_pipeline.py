"""The corpus pipeline: documents through five stages of starlift.llm, each written as Parquet and read again.

1. quality classifier: documents predicted as low quality go.
2. n-gram Jaccard join: of near copies (five-word shingles, similarity 0.8 or more) the first document by id stays.
3. benchmark decontamination: documents that hold a passage of a test item go.
4. mixing to target weights: every document stays and gets its place in the interleaved source blocks (column PLACE).
5. token-ID output: one row per sequence with its global slot, shard, offset and record. Sequences are numbered in the
   order of the mix and permuted within windows of WINDOW, so every window of slots has the mix of its documents.

The first four stages return the columns of ``documents`` unchanged (and the mix PLACE besides). Null texts count as empty, null ids are kept as
they are, an empty table passes through every stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlift.llm import decontaminate, mixing, ngram_join, quality_knn, token_counts, token_output
from starlift.llm.common import scratch_path

#: Target weights by source; sources not named weigh 1.
WEIGHTS: dict[str, float] = mixing.WEIGHTS
PLACE = "__mix_place"
#: Sequences that the token stage permutes among each other.
WINDOW = token_output.SHARD_SLOTS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_knn.score(docs, quality_knn.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.where(F.col("quality_score") >= quality_knn.THRESHOLD).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_near_copies(docs, words=5, threshold=(80, 100))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct("*").alias("doc"), F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"))
    return mixing.mix(rows, WEIGHTS, sort_rows=True).select("doc.*", F.col("mix_position").alias(PLACE))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.materialise(docs, token_counts.vocabulary_path("byte_bpe_50k.json"), place=PLACE, window=WINDOW)


STAGES = [("quality_classifier", quality), ("ngram_jaccard_join", near_copies), ("benchmark_decontamination", benchmark),
          ("mixing", mix), ("token_output", tokens)]

#: Classifier, alignment and tokenizer are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
