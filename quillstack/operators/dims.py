"""Author and category dimensions and the terms made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.functions.text import slug
from quillstack.operators.skew import global_rank
from quillstack.sources.workspace import Workspace

# Taxonomy names and the slug prefix of author terms.
CATEGORY_TAXONOMY = "category"
COAUTHOR_TAXONOMY = "ssl_alp_coauthor"
COAUTHOR_SLUG_PREFIX = "ssl-alp-coauthor-"


def distinct_names(entries: DataFrame, column: str) -> DataFrame:
    """Distinct names in an array column over pages and responses."""
    return entries.select(F.explode(column).alias("name")).distinct()


def terms(ws: Workspace, authors: DataFrame, categories: DataFrame, counts: dict | None = None) -> DataFrame:
    """Author terms by name, then category terms: one id sequence over both."""
    counts = {} if counts is None else counts
    both = authors.select(F.lit(0).alias("kind"), "name").unionByName(
        categories.select(F.lit(1).alias("kind"), "name")
    )
    metrics = {"authors": F.count_if(F.col("kind") == 0), "categories": F.count_if(F.col("kind") == 1)}
    ranked = global_rank(ws, both, [F.col("kind"), F.col("name")], "term_id", "terms", 1, metrics, counts)
    author = F.col("kind") == 0
    return ranked.select(
        "term_id",
        F.when(author, COAUTHOR_TAXONOMY).otherwise(CATEGORY_TAXONOMY).alias("taxonomy"),
        F.when(author, F.concat(F.lit(COAUTHOR_SLUG_PREFIX), slug(F.col("name"))))
        .otherwise(slug(F.col("name")))
        .alias("slug"),
        F.lit("").alias("parent"),
        "name",
    )


def author_dim(term_table: DataFrame) -> DataFrame:
    """Author rows. Author terms come first in the sequence, so their ids are the author ids."""
    return term_table.where(F.col("taxonomy") == COAUTHOR_TAXONOMY).select(
        F.col("term_id").alias("author_id"),
        slug(F.col("name")).alias("login"),
        F.lit("").alias("email"),
        F.col("name").alias("display_name"),
        F.lit("").alias("first_name"),
        F.lit("").alias("last_name"),
    )


def category_dim(term_table: DataFrame) -> DataFrame:
    return term_table.where(F.col("taxonomy") == CATEGORY_TAXONOMY).select(
        "term_id", F.col("slug").alias("nicename"), "parent", "name"
    )
