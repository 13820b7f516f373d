"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siftline.llm import decontaminate, packing, passages, quality, simhash
from siftline.llm.queries import PACK_END_ID, WORD_BPE, table
from siftline.session import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; trained on the labels of other folds."""
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints stays, that of the smallest id."""
    return simhash.without_duplicates(docs)


def no_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that a smaller document has too are cut out."""
    return passages.without_passages(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark covers a twentieth or more go."""
    return decontaminate.without_documents(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their ids."""
    return packing.packed(docs, public_tokenizers.path(WORD_BPE), PACK_END_ID)


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each),
    ("substring dedup", no_passages),
    ("benchmark decontamination", no_benchmark),
    ("packing", sequences),
]

#: No SQL: the classifier is trained and the tokens come from a library; tests hold every
#: stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
