"""The corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, packing.

Every stage takes the documents its predecessor kept, and all but the last return documents. A stage's
result is written and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import exact_dedup, language_id, mixing, packing, simhash
from tidewell.llm._common import scratch, stored
from tidewell.llm.queries import TOKENIZER


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told, with that language; texts without a letter go."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints the document with the smallest id."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares, shard after shard; a document stands as often as the mix takes it."""
    return mixing.mixed_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 2048 tokens."""
    # the workers of a whole pipeline have held other models before, so they remember fewer words
    return packing.pack_documents(docs, TOKENIZER, remembered=250_000)


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mix_sources", mixed),
    ("pack_sequences", packed),
]

#: Cross-parsing, fingerprints and tokenization have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage stores on its way is deleted once its documents are written,
    and these once the next stage's are; the last stage's stay, as its rows are read from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        for name, stage in STAGES[:-2]:
            with scratch(spark):
                docs = stored(stage(spark, docs, sf_dir), name, kept=True)
        name, stage = STAGES[-2]
        mixed_docs = stored(stage(spark, docs, sf_dir), name, kept=True)
    return STAGES[-1][1](spark, mixed_docs, sf_dir)
