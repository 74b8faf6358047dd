"""Duplicate pages: identity groups, canonical pages, orphans and the path map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.operators.skew import global_rank, lookup
from quillstack.sources.workspace import Workspace


def resolve_entries(ws: Workspace, entries: DataFrame, pages: DataFrame) -> DataFrame:
    """Contents entries with the identity of the page they link to."""
    return lookup(ws, entries, pages.select("path", "page_key"), "path", "inner")


def first_of_identity(copies: DataFrame, order: Column) -> DataFrame:
    """One row per identity: its first copy by `order`, and how many copies there are.

    A plain aggregation, so copies combine before the shuffle and no group is sorted whole.
    """
    keep = [c for c in copies.columns if c != "page_key"]
    first = copies.groupBy("page_key").agg(
        F.min(F.struct(order.alias("_order"), *keep)).alias("f"), F.count("*").alias("n_copies")
    )
    return first.select("page_key", *[F.col(f"f.{c}").alias(c) for c in keep], "n_copies")


def canonical_pages(resolved: DataFrame) -> DataFrame:
    """The first listed page of every identity; listings run newest first, so the last row."""
    last = resolved.groupBy("page_key").agg(
        F.max(F.struct("first_file", "first_pos", "entry_key", "path")).alias("f"),
        F.count("*").alias("n_copies"),
    )
    return last.select("page_key", "f.*", "n_copies")


def orphan_pages(unlisted: DataFrame, canonical: DataFrame) -> DataFrame:
    """Unlisted pages that are no copy of a listed one, one row per identity."""
    groups = first_of_identity(unlisted.select("page_key", "path"), F.col("path"))
    return groups.join(canonical.select("page_key"), "page_key", "left_anti")


def all_pages(canonical: DataFrame, orphans: DataFrame) -> DataFrame:
    listed = canonical.withColumn("is_orphan", F.lit(False))
    return listed.unionByName(orphans.withColumn("is_orphan", F.lit(True)), allowMissingColumns=True)


def page_order(
    ws: Workspace, pages: DataFrame, metrics: Mapping[str, Column] | None = None, counts: dict | None = None
) -> DataFrame:
    """Number pages: listed ones in reverse listing order, then orphans by path."""
    order = [
        F.col("is_orphan"),
        F.col("first_file").desc_nulls_last(),
        F.col("first_pos").desc_nulls_last(),
        F.col("path"),
    ]
    return global_rank(ws, pages, order, "page_order", "page-order", 1, metrics, counts)


def mark_canonical(ws: Workspace, resolved: DataFrame, ordered: DataFrame) -> DataFrame:
    """Entries with their page's order; `kept` marks the entry that became the page."""
    pages = ordered.where("not is_orphan").select("page_key", "page_order", F.col("entry_key").alias("first_entry"))
    marked = lookup(ws, resolved.select("entry_key", "page_key"), pages, "page_key", "inner", staged=True)
    return marked.select("entry_key", "page_key", "page_order", (F.col("entry_key") == F.col("first_entry")).alias("kept"))


def response_parents(ws: Workspace, responses: DataFrame, marked: DataFrame) -> DataFrame:
    """Responses with their parent's identity and order, duplicates' responses included."""
    return lookup(ws, responses, marked, "entry_key", "inner")


def page_path_map(resolved: DataFrame, parents: DataFrame, unlisted: DataFrame) -> DataFrame:
    """Every known path and the page it leads to; unlisted documents win, then pages."""
    def ranked(df: DataFrame, prio: int) -> DataFrame:
        return df.select("path", "page_key", F.lit(prio).alias("prio"))

    rows = ranked(unlisted, 0).unionByName(ranked(resolved, 1)).unionByName(ranked(parents, 2))
    best = rows.groupBy("path").agg(F.min(F.struct("prio", "page_key")).alias("b"))
    return best.select("path", F.col("b.page_key").alias("page_key"))


def copies_of(ws: Workspace, copies: DataFrame, originals: DataFrame) -> DataFrame:
    """Copies with the path of their original (`path` and `original_path`)."""
    firsts = originals.select("page_key", F.col("path").alias("original_path"))
    return lookup(ws, copies.select("page_key", "path"), firsts, "page_key", "inner")
