"""A corpus from documents to token ids: five stages, each on what the one before has kept.

``run`` applies them to the table ``documents``; each stage's rows are written as Parquet to the
shared folder and read again as the next one's documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm import decontamination, line_dedup, ngram_join, toxicity
from bazaar.llm.common import stage
from bazaar.llm.queries import table, token_digests, toxicity_classifier


def counted(docs: DataFrame) -> DataFrame:
    """Documents whose number of characters is that of their text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier does not reject."""
    return toxicity.drop_toxic(docs, toxicity_classifier(spark, sf_dir))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that too many documents of their source share."""
    return counted(line_dedup.drop_boilerplate(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share with the benchmark."""
    return counted(decontamination.remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text that they give back."""
    return token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

# The classifier, the FM-index and the encoder are no SQL; tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
