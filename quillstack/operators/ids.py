"""Post ids: page numbers kept by their first claimant, new numbers for the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.functions.text import read_integer
from quillstack.operators.skew import global_rank
from quillstack.sources.workspace import Workspace

HIGHEST = 1 << 62


def post_ids(ws: Workspace, pages: DataFrame) -> DataFrame:
    """One id per page. The first page of a number keeps it; clashes and numbers that are
    no integers follow above the highest number, in page order. Numbers that leave no room
    above them count as no integers."""
    number = read_integer(F.col("page_no"))
    number = F.when(number < HIGHEST, number)
    claims = (
        pages.select("page_key", "page_order", number.alias("number"))
        .where("number is not null")
        .groupBy("number")
        .agg(F.min(F.struct("page_order", "page_key")).alias("f"))
        .select(
            F.col("f.page_key").alias("page_key"),
            F.col("f.page_order").alias("page_order"),
            F.col("number").alias("post_id"),
            F.lit(True).alias("claimed"),
        )
    )
    claims = ws.keep(claims, "claimed-ids")
    rest = pages.select("page_key", "page_order").join(claims.select("page_key"), "page_key", "left_anti")
    highest = F.coalesce(claims.agg(F.max("post_id")).scalar(), F.lit(0))
    others = global_rank(ws, rest, [F.col("page_order")], "post_id", "other-ids", highest + 1)
    return claims.unionByName(others.withColumn("claimed", F.lit(False)))
