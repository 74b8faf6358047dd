"""Contents listings: their links, threading, index and unlisted documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.functions.html import attribute, visible
from quillstack.functions.text import html_unescape, listed_path, read_integer, strip_tags
from quillstack.operators.skew import carry_forward

# How listing links are marked, and how responses are.
LISTING_LINK = (
    r"""(?is)<a\b(?=[^>]*\btarget\s*=\s*(?:"NotesView"|'NotesView'|NotesView[\s>]))[^>]*>"""
    r""".*?</a\s*>(?:\s*<(?!a\b)[^>]*>)*[^<]*"""
)
RESPONSE_MARK = "---------- Respond:"


def listing_links(listings: DataFrame) -> DataFrame:
    """Every listing link in document order: text, href and the number that follows it.

    The number is the first text after the link; responses have none.
    """
    links = listings.select(
        "contents_file",
        F.posexplode(F.regexp_extract_all(visible(F.col("html")), F.lit(LISTING_LINK), F.lit(0))).alias("pos", "_item"),
    )
    anchor = F.regexp_extract("_item", r"(?is)^(.*?)</a\s*>", 1)
    tail = F.regexp_extract("_item", r"(?is)</a\s*>(.*)$", 1)
    return links.select(
        "contents_file",
        F.col("pos").cast("bigint").alias("pos"),
        html_unescape(strip_tags(anchor)).alias("title"),
        attribute(F.regexp_extract(anchor, r"(?s)^<[^>]*>", 0), "href").alias("href"),
        read_integer(html_unescape(strip_tags(tail))).alias("page_number"),
    )


def entry_key(title: Column, number: Column, href: Column) -> Column:
    """Key of a contents entry: its title and number; without a readable number, its title and link.

    Pages of one title without numbers stay apart that way, and none is lost.
    """
    link = F.concat(F.lit("link:"), F.md5(F.coalesce(href, F.lit(""))))
    return F.md5(F.concat(F.md5(title), F.lit("|"), F.coalesce(number.cast("string"), link)))


def thread_listing(links: DataFrame) -> DataFrame:
    """Listing rows with their kind and, for responses, the last page above in the same file."""
    is_response = F.col("title").startswith(RESPONSE_MARK)
    page = F.struct(F.col("title").alias("title"), F.col("page_number").alias("number"), F.col("href").alias("href"))
    threaded = carry_forward(links, "contents_file", "pos", F.when(~is_response, page), "_page")
    parent = F.when(is_response, F.col("_page"))
    return threaded.select(
        "contents_file",
        "pos",
        "title",
        "href",
        "page_number",
        is_response.alias("is_response"),
        parent["title"].alias("parent_title"),
        parent["number"].alias("parent_number"),
        F.when(
            F.col("_page").isNotNull(), entry_key(F.col("_page")["title"], F.col("_page")["number"], F.col("_page")["href"])
        ).alias("entry_key"),
    )


def orphan_responses(threaded: DataFrame) -> DataFrame:
    """Responses that lead their listing file: they have no parent and are left out."""
    return threaded.where("is_response and entry_key is null").select("contents_file", "pos", "title", "href")


def contents_index(links: DataFrame, root_dir: str) -> DataFrame:
    """One entry per (title, number), or per link where there is no number: the first sighting
    gives its URL and its place."""
    key = entry_key(F.col("title"), F.col("page_number"), F.col("href"))
    pages = links.where(~F.col("title").startswith(RESPONSE_MARK)).withColumn("entry_key", key)
    first = F.min(F.struct("contents_file", "pos", "href")).alias("f")
    entries = pages.groupBy("entry_key", "title", "page_number").agg(first, F.count("*").alias("n_sightings"))
    return entries.select(
        "entry_key",
        "title",
        "page_number",
        F.col("f.href").alias("href"),
        listed_path(root_dir, F.col("f.href")).alias("path"),
        F.col("f.contents_file").alias("first_file"),
        F.col("f.pos").alias("first_pos"),
        "n_sightings",
    )


def entry_responses(threaded: DataFrame, root_dir: str) -> DataFrame:
    """Distinct response links per entry (by their raw href), at their first position."""
    first = F.min(F.struct("contents_file", "pos")).alias("f")
    found = (
        threaded.where("is_response and entry_key is not null")
        .groupBy("entry_key", "parent_title", "parent_number", "href")
        .agg(first)
    )
    return found.select(
        "entry_key",
        "parent_title",
        "parent_number",
        "href",
        listed_path(root_dir, F.col("href")).alias("path"),
        F.col("f.contents_file").alias("first_file"),
        F.col("f.pos").alias("first_pos"),
    )


def listed_paths(links: DataFrame, root_dir: str) -> DataFrame:
    """Paths of all listing links, ignored responses included."""
    return links.select(listed_path(root_dir, F.col("href")).alias("path")).distinct()


def unlisted_documents(documents: DataFrame, listed: DataFrame) -> DataFrame:
    """Documents no listing links to. Join narrow columns here, before any extraction."""
    return documents.join(listed.select("path"), "path", "left_anti")


def path_collisions(entries: DataFrame, responses: DataFrame) -> DataFrame:
    """Response paths that are also a page's path, or responses of several entries."""
    pages = entries.select("path").distinct().withColumn("is_page", F.lit(True))
    by_path = responses.groupBy("path").agg(
        F.count("*").alias("n_responses"),
        (F.min("entry_key") != F.max("entry_key")).alias("several_parents"),
    )
    return (
        by_path.join(pages, "path", "left")
        .where("is_page or several_parents")
        .select("path", F.coalesce("is_page", F.lit(False)).alias("is_page"), "several_parents", "n_responses")
    )
