"""Training-corpus pipeline: documents through five stages to packed sequences.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes its result as
Parquet to the cluster's shared folder and gives the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionmart.llm import decontaminate, line_dedup, ngram_join, quality_rules
from sessionmart.llm.registry import packed
from sessionmart.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go; lines above the limits go from the others."""
    return quality_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later repeated runs go from the texts; a document that this leaves with too few words for the quality rules goes."""
    out = line_dedup.dedup_lines(docs)
    text = F.btrim("text", F.lit(quality_rules.SPACE))
    left = F.when(text == "", 0).otherwise(F.size(F.split(text, quality_rules.SPACES)))
    depleted = (F.col("removed_words") > 0) & (left < quality_rules.MIN_WORDS)
    return out.where(~depleted).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document with the smallest id of each class stays."""
    return ngram_join.keep_first(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a test item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packed(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_copies),
          ("benchmark_decontamination", benchmark_free), ("packing", sequences)]

#: SQL has no form for the word alignment and the packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
