"""From raw documents to token ids: stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all
but the last return the columns of ``documents``, further columns included.

Defined cases: null and empty texts are no language and leave at the first stage; rows
with a null id are kept by the stages that compare documents; rows that repeat an id and
text are one document and stay or go together; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestrata.llm import bpe, decontaminate, language_id, line_dedup, ngram_join
from homestrata.llm.batches import bounded_batches
from homestrata.sources.staging import stage

NEAR_WORDS, NEAR_SHARE = 5, (80, 100)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay unless they are far from every language that is learned from them."""
    bounded_batches(spark)
    model = language_id.fit(docs, "text", "lang")
    return docs.where(~language_id.predict(model, F.col("text"))["rejected"])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows leave the texts; ``n_chars`` follows."""
    left = line_dedup.drop_repeated_lines(docs, "doc_id", "text")
    return left.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets the one with the smallest id stays."""
    bounded_batches(spark)
    groups = ngram_join.join(docs, words=NEAR_WORDS, share=NEAR_SHARE)
    # by id and text: another text under the same id is another document
    copies = groups.where("component <> doc_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    copies = stage(copies.distinct(), "near-copies")
    same = (docs["doc_id"] == copies["_id"]) & (F.xxhash64(docs["text"]) == copies["_hash"])
    return docs.join(copies, same, "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    bounded_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    space = decontaminate.fit_space(docs, "text")
    for items in decontaminate.item_blocks(benchmark, "item_id", "text"):
        docs = docs.where(F.size(decontaminate.leaks_column(space, items, F.col("text"))) == 0)
    return docs


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text, as packed little-endian unsigned 32-bit integers,
    decoded again to prove that nothing is lost."""
    bounded_batches(spark)
    coded = bpe.encode(docs, round_trip=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", known_language),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokenize),
]

# Trained models and tokenizers have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
