"""From raw documents to packed training sequences, as five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all that its predecessor kept. All
but the last return the columns of `documents`; `run` writes every stage's result as Parquet and
reads it again.

Null and empty texts go through as texts without words: the classifier scores them like others, equal
texts are one class, and packing gives each of those left one empty piece. Rows without a doc_id and
repeated rows are rows like others until near-dedup, which keeps the smallest of each class. Missing
languages and sources are values of their own. Extra columns stay until packing, whatever their names.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillstack.llm import credentials, mixing, neardup, packing, quality
from quillstack.llm.common import table
from quillstack.sources.workspace import Workspace


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the additive classifier does not reject, trained on the labelled ones among them."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return neardup.keep_first(docs, Workspace(spark))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the reported secrets masked."""
    return credentials.mask(docs, Workspace(spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents a sample with raked source, language and topic weights holds."""
    return mixing.sample(docs, Workspace(spark)).where("_kept").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces: their bins, documents and token ranges."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_class),
    ("secrets", secrets_masked),
    ("mixing", mixed),
    ("packing", packed),
]

# The classifier and the similarity search cannot be expressed in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.keep(stage(spark, docs, sf_dir), name)
    return docs
