"""From raw documents to token ids: the corpus operators as one pipeline.

Each stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables
and further columns of any name, with the results its operator states; stages before the last return
the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.llm import bpe, exact_dedup, mixing, ngram_join, quality
from loglathe.llm.common import stored
from loglathe.llm.queries import VOCABULARY
from loglathe.session import configure_session


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the quality classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken, the last time up to the words due."""
    mix = mixing.mixed(docs)
    return mix.withColumn("n_chars", F.length("text").cast(mix.schema["n_chars"].dataType))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again to verify that they give its text."""
    return bpe.encode(docs, VOCABULARY, verify=True)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("byte-pair encoding", to_tokens),
]

# The quality classifier is trained on the labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    configure_session(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
