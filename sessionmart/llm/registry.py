"""Queries of the package, by name; ``ORACLE`` has DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .chat_format import digests, format_conversations
from .decontaminate import matches
from .hard_negatives import mine
from .html_extract import extract
from .license_scan import labelled, scan
from .licenses import PHRASES, TEMPLATES
from .line_dedup import dedup_lines
from .ngram_join import near_duplicates
from .packing import pack
from .periodic_runs import digests as run_digests
from .periodic_runs import find_runs
from .quality_rules import judge
from .sharding import shard
from .toxicity import score
from .url_filter import filter_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by 5-word shingle Jaccard >= 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    return (pack(docs, tokenizer_file())
            .withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return (shard(table(spark, sf_dir, "documents"), 16)
            .withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int")))


#: Rules of the url query: (verdict, host and path prefix).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rule or by its host's trust."""
    return filter_urls(table(spark, sf_dir, "pages"), RULES).drop("trust", "distrust")


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one with control strings in its texts, read back from their formatted form."""
    marks = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return digests(format_conversations(rows, tokenizer_file()))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the verdict of the line frequencies."""
    return judge(table(spark, sf_dir, "documents")).drop("removed_lines", "row", "host")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later repeated runs of lines."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_words", "removed")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item or an edited copy of one, with the score and place."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return (extract(table(spark, sf_dir, "pages"))
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labelled rows that are not held out."""
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train_on=~held_out(F.col("doc_id")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, one positive at a time."""
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(rows, F.col("vec_id") % 50 == 0)


@query
def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents, by phrases and by notices found in their text blocks."""
    return labelled(scan(table(spark, sf_dir, "documents"), TEMPLATES, PHRASES))


def with_periods(docs: DataFrame) -> DataFrame:
    """The documents, those with a checksum that ends in 0 made periodic from a word on, as the checksum tells."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(F.col("h") / 10)
    return (docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
            .select("*", F.when(F.size("words") > 0, F.size("words")).alias("n"))
            .select("*", (g % F.col("n")).cast("int").alias("a"))
            .select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int").alias("p"))
            .select("doc_id", F.when(F.col("n").isNull(), F.col("text")).otherwise(F.array_join(F.concat(
                F.slice("words", F.lit(1), F.col("a")),
                F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")),
                                                 F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))),
                        F.lit(1), F.col("n") - F.col("a"))), " ")).alias("text")))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the periodic runs of all documents and of the documents without them."""
    return run_digests(find_runs(with_periods(table(spark, sf_dir, "documents"))))


ORACLE |= {"op1_ngram_jaccard_join": oracle.NEAR_DUPLICATES, "op2_url_filters": oracle.url_filters(RULES),
           "op3_chat_formatting": oracle.CHATS, "op5_quality_rules": oracle.QUALITY,
           "op11_hard_negatives": oracle.HARD_NEGATIVES, "op12_license_scans": oracle.license_scans(TEMPLATES, PHRASES)}
