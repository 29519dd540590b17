"""The corpus pipeline: five operators of plumbline.llm in a row, each on all rows that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's docs. All
stages but the last return the columns of docs; extra columns pass through. Null and empty texts: the classifier scores an empty
text and rejects it as a rule; what passes is one group for both kinds of de-duplication and has no words for the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, exact, mixing, quality, simhash
from plumbline.llm.frames import bound_batches, table
from plumbline.sources.tables import materialize

# The classifier's verdict cannot be stated in SQL; tests compare run() with the operators' brute-force versions.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality.good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of equal texts: the row with the largest doc_id."""
    bound_batches(spark)
    return exact.unique(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one of each near-duplicate class: the row with the smallest doc_id."""
    bound_batches(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to their target weights; a document comes as often as the mix takes it."""
    bound_batches(spark)
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts, and decode the ids to prove that nothing is lost.

    The ids are written in between: in one stage, each task would hold a Python worker for either step, twice the memory.
    """
    bound_batches(spark)
    done = bpe.decode(materialize(bpe.encode(docs.select("doc_id", "lang", "source", "text"), offsets=False), "encoded"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return done.select(
        "doc_id", "lang", "source", "n_tokens", F.col("packed_ids").alias("token_ids"), F.sha2("packed_ids", 256).alias("ids_sha256"),
        (F.col("decoded_bytes") == text).alias("restored"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("mixing", mix_sources),
    ("byte-level bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage{number}")
    return docs
