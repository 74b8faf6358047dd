"""Feed tables: channel, posts, their terms, comments and media items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.config import FeedConfig
from quillstack.functions.dates import post_date, post_date_gmt, rfc822, upload_month
from quillstack.functions.text import extension, file_stem, slug
from quillstack.operators.dims import CATEGORY_TAXONOMY, COAUTHOR_SLUG_PREFIX, COAUTHOR_TAXONOMY
from quillstack.operators.skew import global_rank, lookup
from quillstack.sources.workspace import Workspace


def channel(pages: DataFrame, config: FeedConfig) -> DataFrame:
    """The one-row feed header; an unset publication date is the newest post's."""
    newest = F.concat(rfc822(F.max("created")), F.lit("+0000"))
    date = F.lit(config.pub_date) if config.pub_date else newest
    return with_authors(pages).agg(date.alias("pub_date"), F.count("*").alias("n_posts")).select(
        F.lit(config.title).alias("title"),
        F.lit(config.base_url).alias("link"),
        F.lit("Logbook").alias("description"),
        "pub_date",
        F.lit("en-GB").alias("language"),
        F.lit("1.2").alias("wxr_version"),
        F.lit(config.base_network_url).alias("base_site_url"),
        F.lit(config.base_url).alias("base_blog_url"),
        F.lit(config.generator).alias("generator"),
        "n_posts",
    )


def first_author(authors: Column) -> Column:
    return F.try_element_at(authors, F.lit(1))


def post_guid(post_id: Column, config: FeedConfig) -> Column:
    return F.concat(F.lit(f"{config.base_url}?p="), post_id.cast("string"))


def uploaded_path(name: Column, created: Column) -> Column:
    """Where the target site will store a media file: year/month/name."""
    return F.concat(upload_month(created), file_stem(name), extension(name))


def media_urls(manifest: DataFrame, config: FeedConfig) -> DataFrame:
    url = F.concat(F.lit(config.base_media_url), uploaded_path(F.col("archive_name"), F.col("created")))
    return manifest.select(F.col("file_hash").alias("key"), url.alias("url"))


def page_urls(ws: Workspace, targets: DataFrame, ids: DataFrame, config: FeedConfig) -> DataFrame:
    """Link keys with their page's URL. `targets` has one row per key (`key, target_key`)."""
    by_page = ids.select(
        F.col("page_key").alias("target_key"), post_guid(F.col("post_id"), config).alias("url")
    )
    return lookup(ws, targets, by_page, "target_key", "inner").select("key", "url")


def _item_columns(rows: DataFrame, config: FeedConfig) -> DataFrame:
    """The constants and dates all items share, by item type."""
    is_post = F.col("post_type") == "post"
    return (
        rows.withColumn("pub_date", rfc822(F.col("created")))
        .withColumn("description", F.lit(""))
        .withColumn("excerpt", F.lit(""))
        .withColumn("post_date", post_date(F.col("created")))
        .withColumn("post_date_gmt", post_date_gmt(F.col("created"), config.time_zone))
        .withColumn("comment_status", F.when(is_post, "open").otherwise("closed"))
        .withColumn("ping_status", F.lit("closed"))
        .withColumn("status", F.when(is_post, "publish").otherwise("inherit"))
        .withColumn("menu_order", F.lit(0))
        .withColumn("post_password", F.lit(""))
        .withColumn("is_sticky", F.lit(0))
    )


def with_authors(pages: DataFrame) -> DataFrame:
    """Pages that become posts: those with at least one author."""
    return pages.where(F.size("authors") > 0)


def post_index(pages: DataFrame, ids: DataFrame, page_refs: DataFrame) -> DataFrame:
    """What other rows need to know of each post: its page, order, id, creator and number of page links."""
    urls = page_refs.groupBy("page_key").agg(F.count(F.lit(1)).alias("n_urls"))
    rows = with_authors(pages).select(
        "page_key", "page_order", slug(first_author(F.col("authors"))).alias("creator")
    )
    found = rows.join(ids.select("page_key", "post_id"), "page_key").join(urls, "page_key", "left")
    return found.withColumn("n_urls", F.coalesce("n_urls", F.lit(0).cast("bigint")))


def posts(pages: DataFrame, bodies: DataFrame, index: DataFrame, config: FeedConfig) -> DataFrame:
    """Post rows of all pages with authors; `bodies` are the rewritten ones, by `body_id`."""
    rows = pages.select("page_key", "body_id", "title", "created").join(index, "page_key").join(bodies, "body_id")
    return _item_columns(
        rows.select(
            "page_key",
            "page_order",
            "title",
            F.lit("").alias("link"),
            "creator",
            post_guid(F.col("post_id"), config).alias("guid"),
            F.coalesce("content", F.lit("")).alias("content"),
            "post_id",
            slug(F.col("title")).alias("post_name"),
            F.lit(0).cast("bigint").alias("post_parent"),
            F.lit("post").alias("post_type"),
            "created",
        ),
        config,
    )


def post_terms(pages: DataFrame, index: DataFrame) -> DataFrame:
    """Category and author terms of every post, in the order of its lists."""
    rows = pages.select("page_key", "categories", "authors").join(index.select("page_key", "post_id"), "page_key")
    categories = rows.select("post_id", F.posexplode("categories").alias("pos", "name")).select(
        "post_id",
        F.lit(CATEGORY_TAXONOMY).alias("domain"),
        "pos",
        slug(F.col("name")).alias("nicename"),
        "name",
    )
    authors = rows.select("post_id", F.posexplode("authors").alias("pos", "name")).select(
        "post_id",
        F.lit(COAUTHOR_TAXONOMY).alias("domain"),
        "pos",
        F.concat(F.lit(COAUTHOR_SLUG_PREFIX), slug(F.col("name"))).alias("nicename"),
        "name",
    )
    return categories.unionByName(authors)


def thread_comments(ws: Workspace, responses: DataFrame, index: DataFrame) -> DataFrame:
    """Responses that become comments: with authors, on a page that became a post."""
    posts_ = index.select("page_key", "page_order", "post_id", "n_urls")
    return lookup(ws, with_authors(responses), posts_, "page_key", "inner", staged=True)


def number_comments(ws: Workspace, threaded: DataFrame, counts: dict | None = None) -> DataFrame:
    """Comment ids over all posts in order; narrow rows only, bodies are not sorted."""
    metrics = {"comments": F.count(F.lit(1)), "comment_urls": F.sum("n_urls")}
    order = [F.col(c) for c in ("page_order", "first_file", "first_pos", "path")]
    return global_rank(ws, threaded, order, "comment_id", "comment-ids", 1, metrics, {} if counts is None else counts)


def comments(
    ws: Workspace, numbered: DataFrame, bodies: DataFrame, authors: DataFrame, config: FeedConfig
) -> DataFrame:
    """Comment rows. `numbered` has `body_id` and `first_author`; several authors are
    named ahead of the body."""
    dim = authors.select(F.col("display_name").alias("first_author"), "author_id")
    rows = lookup(ws, numbered, dim, "first_author", "left", staged=True).join(bodies, "body_id")
    names = F.concat(F.lit("[Authors: "), F.array_join("authors", ", "), F.lit("]\n\n"))
    body = F.coalesce("content", F.lit(""))
    return rows.select(
        "comment_id",
        "post_id",
        "path",
        F.col("first_author").alias("author"),
        F.lit("").alias("author_email"),
        F.lit("").alias("author_url"),
        F.lit("").alias("author_ip"),
        post_date(F.col("created")).alias("comment_date"),
        post_date_gmt(F.col("created"), config.time_zone).alias("comment_date_gmt"),
        F.when(F.size("authors") > 1, F.concat(names, body)).otherwise(body).alias("content"),
        F.lit(1).alias("approved"),
        F.lit("").alias("comment_type"),
        F.lit(0).cast("bigint").alias("comment_parent"),
        F.col("author_id").alias("user_id"),
    )


def shown_media(ws: Workspace, media_refs: DataFrame, index: DataFrame) -> DataFrame:
    """Each media file and kind with the first post that shows it, and that post's author."""
    shown = lookup(ws, media_refs, index, "page_key", "inner", staged=True)
    first = F.min(F.struct("page_order", "kind_rank", "post_id", "creator")).alias("f")
    return shown.groupBy("kind", "file_hash").agg(first).select(
        "kind",
        "file_hash",
        F.col("f.page_order").alias("page_order"),
        F.col("f.kind_rank").alias("kind_rank"),
        F.col("f.post_id").alias("post_parent"),
        F.col("f.creator").alias("creator"),
    )


def attachment_items(
    ws: Workspace, shown: DataFrame, ids: DataFrame, manifest: DataFrame, config: FeedConfig
) -> DataFrame:
    """One item per media file and kind, owned by the first post that shows it.

    Ids continue after the highest post id: by post, attachments before images, then hash.
    """
    files = manifest.select("file_hash", "archive_name", "created")
    order = [F.col("page_order"), F.col("kind_rank"), F.col("file_hash")]
    start = F.coalesce(ids.agg(F.max("post_id")).scalar(), F.lit(0)) + 1
    ranked = global_rank(ws, shown.join(files, "file_hash"), order, "post_id", "item-ids", start)
    name = F.col("archive_name")
    media_url = F.concat(F.lit(config.base_source_media_url), name)
    return _item_columns(
        ranked.select(
            "page_order",
            "kind",
            "kind_rank",
            "file_hash",
            name.alias("title"),
            F.concat(F.lit(config.base_url), slug(name)).alias("link"),
            "creator",
            media_url.alias("guid"),
            F.lit("").alias("content"),
            "post_id",
            slug(name).alias("post_name"),
            "post_parent",
            F.lit("attachment").alias("post_type"),
            "created",
            media_url.alias("attachment_url"),
            uploaded_path(name, F.col("created")).alias("attached_file"),
        ),
        config,
    )


def feed_items(post_rows: DataFrame, item_rows: DataFrame) -> DataFrame:
    """All items: each post, then the media it is the first to show.

    `page_order, item_rank, file_hash` give the feed's order.
    """
    own = post_rows.drop("page_key").withColumn("item_rank", F.lit(0))
    media = item_rows.withColumn("item_rank", F.col("kind_rank") + 1).drop("kind_rank", "kind")
    return own.unionByName(media, allowMissingColumns=True)
