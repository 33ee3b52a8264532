"""From raw documents to packed sequences: each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellumark.llm import jaccard, packing, quality, substrings, toxicity
from vellumark.llm.scan import table
from vellumark.session import stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents of low quality go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that are likely toxic go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join on five words at 0.8: of each group of linked documents the smallest id stays."""
    return jaccard.one_of_each_group(docs, size=5, percent=80)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: repeated passages stay in the document with the smallest id."""
    return substrings.dedup(docs, counted=None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the pieces of all documents and their places."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_passages),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
