"""A corpus from raw documents to packed sequences: five stages, each on what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
:func:`run` writes as Parquet and reads again for the next.  All but the last
return the columns of ``documents``; ``n_chars`` follows a changed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.llm import exact_dedup, language_id, packing, simhash, suffix_dedup
from crawlframe.llm.components import stored
from crawlframe.llm.queries import VOCABULARY, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was recognised."""
    return language_id.accepted(docs, language_id.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two bits or fewer."""
    return simhash.keep_one(docs, width=3)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    return packing.pack_documents(docs, vocabulary=tokenizer_path(VOCABULARY), end_id=1, length=2048)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", remove_repeats),
    ("packing", pack),
]

#: The first stage is learned, fingerprints and byte runs are beyond SQL: tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
