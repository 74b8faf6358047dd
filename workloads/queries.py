"""One query per operator, each over whole tables or the logbook derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.config import FeedConfig
from quillstack.functions import text as T
from quillstack.functions.dates import epoch_seconds, parse_created, post_date
from quillstack.functions.html import link_tags, link_target, strip_top_links, tag_name
from quillstack.operators import extract, links, listing, media, urls
from quillstack.operators.skew import carry_forward, lookup
from quillstack.plans.archive import ArchivePlan
from quillstack.plans.feed import FeedPlan
from quillstack.sources import archive as store
from quillstack.sources import versions
from quillstack.sources.files import scan_contents as read_contents
from quillstack.sources.files import scan_documents as read_documents
from quillstack.sources.files import scan_media as read_media
from quillstack.sources.files import write_texts
from quillstack.sources.workspace import Workspace
from workloads.logbook import CONFIG, Logbook, table

FEED = FeedConfig(title="Derived logbook", site_id=22)
Query = Callable[[SparkSession, str], DataFrame]


def _joined(column: str, out: str | None = None):
    return F.array_join(column, "|").alias(out or column)


def _logbook(make: Callable[[Logbook], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(Logbook(spark, sf_dir))


def _archive(make) -> Query:
    return lambda spark, sf_dir: make(Logbook(spark, sf_dir).plan)


def _feed(make) -> Query:
    return lambda spark, sf_dir: make(FeedPlan.of(Logbook(spark, sf_dir).plan, FEED))


# --- tables as given ----------------------------------------------------------------------


def scan_documents(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("html_md5"))


def extract_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id")
    tags = pages.select("page_id", F.posexplode(link_tags(F.col("html"))).alias("pos", "tag"))
    target = link_target(F.col("tag"))
    return tags.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), tag_name(F.col("tag")).alias("element"), target.alias("href")
    ).where("href is not null")


def decode_urls(spark, sf_dir):
    """Every text percent-encoded and decoded back, once intact and once with broken escapes."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    encoded = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    return docs.select(
        "doc_id",
        T.percent_decode(encoded).alias("decoded"),
        T.percent_decode(F.concat(encoded, F.lit("%zz+%2"))).alias("decoded_broken"),
    )


def normalise_paths(spark, sf_dir):
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1)
    pages = table(spark, sf_dir, "pages", "page_id").select("page_id", "url", path.alias("path"))
    up = F.concat("path", F.lit("/../../../../y"))
    return pages.select(
        "page_id",
        T.normalise_path(F.col("path")).alias("plain"),
        T.normalise_path(F.concat("path", F.lit("/./a//../b/"))).alias("dotted"),
        T.normalise_path(up).alias("above_root"),
        T.normalise_path(F.concat(F.lit("x/../.."), F.col("path"))).alias("relative"),
        T.resolve_path(F.col("path"), F.lit("../c%20d")).alias("sibling"),
    )


def filter_urls(spark, sf_dir):
    """Each page's URL and the view and navigation URLs a crawler would find beside it."""
    base = F.regexp_extract("url", r"^([a-z]+://[^/]+/[a-z]+/\d+)", 1)
    found = [
        F.col("url"),
        *[
            F.concat(base, F.lit(tail))
            for tail in (
                "?OpenDocument",
                "?Navigate&to=Next",
                "?OpenDocument&Click=1",
                "/By%20Category?OpenView",
                "/By%20Author?OpenView&ResortAscending=2",
                "/By%20Author?OpenView",
            )
        ],
    ]
    crawl = table(spark, sf_dir, "pages", "page_id").select("page_id", F.explode(F.array(*found)).alias("url"))
    return urls.filter_urls(crawl, ("example.com", "example.org"), "/en/")


def slugs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text"))
    pages = table(spark, sf_dir, "pages", "page_id").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("kind", "id", T.slug(F.col("text")).alias("slug"))


def decode_text(spark, sf_dir):
    """Texts stored in UTF-8 and in a one-byte charset come back the same."""
    docs = table(spark, sf_dir, "documents", "doc_id")
    wide = F.col("text").rlike(r"[^\x00-\x7f\xa0-\xff]")
    utf8, latin = F.encode("text", "UTF-8"), F.expr("encode(regexp_replace(text, '[^\\\\x00-\\\\xff]', ''), 'ISO-8859-1')")
    return docs.select(
        "doc_id",
        T.decode_bytes(utf8).alias("from_utf8"),
        T.decode_bytes(F.when(wide, utf8).otherwise(latin)).alias("from_latin"),
    )


def parse_dates(spark, sf_dir):
    """Event times written the way logbook pages show them, parsed back; odd ones to NULL."""
    events = table(spark, sf_dir, "events", "event_id").select("event_id", "ts")
    date = F.date_format("ts", "M/d/yyyy")
    padded = parse_created(F.date_format("ts", "MM/dd/yyyy"), F.date_format("ts", "'Mon 'hh:mm a"))
    short = parse_created(date, F.concat(F.lit("05/04/2013 "), F.lower(F.date_format("ts", "h:mm a"))))
    return events.select(
        "event_id",
        post_date(padded).alias("padded"),
        post_date(short).alias("short"),
        epoch_seconds(padded).alias("epoch"),
        post_date(parse_created(F.date_format("ts", "yyyy-MM-dd"), F.lit("Mon 01:00 PM"))).alias("odd"),
    )


def thread_pages(spark, sf_dir):
    """Conversations as threads: every turn with the user turn it answers and that turn's text."""
    turns = table(spark, sf_dir, "conversations")
    is_user = F.col("role") == "user"
    threaded = carry_forward(
        turns.select("conv_id", "turn", "role"), "conv_id", "turn", F.when(is_user, F.col("turn")), "parent_turn"
    )
    key = lambda turn: F.concat_ws("/", "conv_id", turn)
    parents = turns.where(is_user).select(key("turn").alias("parent"), F.md5("text").alias("parent_md5"))
    keyed = threaded.withColumn("parent", F.when(F.col("parent_turn").isNotNull(), key("parent_turn")))
    return lookup(Workspace(spark), keyed, parents, "parent", "left").select("conv_id", "turn", "role", "parent_turn", "parent_md5")


# --- the derived logbook ------------------------------------------------------------------


def clean_filenames(lb: Logbook) -> DataFrame:
    titles = lb.base.selectExpr("concat('/lb/', title, ' [v1].PDF') as path")
    paths = lb.media.select("path").unionByName(titles)
    name = T.clean_filename(F.col("path"))
    return paths.select("path", name.alias("name"), T.extension(name).alias("extension"))


def classify_links(lb: Logbook) -> DataFrame:
    rows = extract.explode_links(lb.plan.documents)
    return rows.select("page_path", F.col("pos").cast("bigint").alias("pos"), "kind", "href")


def link_keys(lb: Logbook) -> DataFrame:
    rows = extract.explode_links(lb.plan.documents).where("kind = 'page'")
    return rows.select("page_path", F.col("pos").cast("bigint").alias("pos"), "ref_path", "ref_hash")


def split_names(lb: Logbook) -> DataFrame:
    kept = T.split_names(F.col("authors"))
    blank = T.split_names(F.col("authors"), keep_blank=True)
    return lb.base.select(
        "doc_id",
        F.array_join(F.transform(kept, T.percent_decode), "|").alias("names"),
        F.size(blank).cast("bigint").alias("n_with_blank"),
    )


def media_hash(lb: Logbook) -> DataFrame:
    return media.hash_media(lb.media).select("path", "file_hash", "n_bytes")


def media_type(lb: Logbook) -> DataFrame:
    return lb.media.select("path", T.media_type(F.col("content")).alias("mime"))


def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every logbook page as bytes, five of six kinds damaged, with web pages and binary files."""
    lb = Logbook(spark, sf_dir)
    kind = "cast(regexp_extract(path, '([0-9]+)[?]', 1) as bigint) % 6"
    pages = lb.pages.selectExpr(
        "path",
        f"""encode(case {kind}
            when 1 then replace(html, 'Logbook Entry', 'Logbook Index')
            when 2 then replace(html, 'align="center"', '')
            when 3 then replace(html, 'Logbook Entry', '')
            when 4 then replace(html, 'width="100%" border="1"', 'width="100%"')
            when 5 then replace(html, '<font size="2">Date</font>', '')
            else html end, 'UTF-8') as content""",
    )
    web = table(spark, sf_dir, "pages", "page_id").selectExpr("concat('web/', page_id) as path", "encode(html, 'UTF-8') as content")
    binary = lb.base.selectExpr("concat('bin/', doc_id) as path", "concat(X'0001', encode(text, 'UTF-8')) as content")
    return pages.unionByName(web).unionByName(binary)


def validate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = extract.decode_documents(damaged_files(spark, sf_dir))
    return extract.page_metadata(files, CONFIG).select("path", "reject_reason")


def page_metadata(lb: Logbook) -> DataFrame:
    return extract.page_metadata(lb.pages, CONFIG).select(
        "path", "title", "page_no", _joined("authors"), _joined("categories"),
        post_date(F.col("created")).alias("created"), "reject_reason",
    )


def page_body(lb: Logbook) -> DataFrame:
    return extract.split_document(lb.pages).select("path", "content")


def clean_body(lb: Logbook) -> DataFrame:
    cut = extract.split_document(lb.pages)
    return cut.select("path", strip_top_links(F.col("content")).alias("content"))


def rejected(lb: Logbook) -> DataFrame:
    """The logbook with some documents gone and some binary: what the archive could not take."""
    doc_id = F.regexp_extract("path", r"/(\d+)\?OpenDocument$", 1).cast("bigint")
    pages = lb.pages.where(doc_id % 7 != 3).withColumn("html", F.when(doc_id % 13 != 4, F.col("html")))
    return ArchivePlan(lb.spark, lb.listings, pages, lb.media, CONFIG, lb.ws).rejected


def path_collisions(lb: Logbook) -> DataFrame:
    """Entries and responses addressed by their text's hash, so that copies collide."""
    rows = lb.base.select(
        F.md5("text").alias("path"), "is_response", F.md5(F.col("doc_id").cast("string")).alias("entry_key")
    )
    found = listing.path_collisions(rows.where("not is_response"), rows.where("is_response"))
    return found


def scan_contents(lb: Logbook) -> DataFrame:
    """Listings written one per file, read back by a file name pattern, their links extracted."""
    folder = lb.ws.path("listing-files")
    lb.listings.select("html").write.option("maxRecordsPerFile", 1).text(folder)
    found = listing.listing_links(read_contents(lb.spark, folder, "part-*.txt"))
    return found.select("pos", "title", "href", "page_number")


def document_files(lb: Logbook) -> DataFrame:
    """Pages written one per file in nested folders, found by a file name pattern and read for their metadata."""
    folder = lb.ws.path("document-files")
    write_texts(lb.spark, lb.pages.select("html"), folder)
    found = extract.decode_documents(read_documents(lb.spark, folder, "part-*.txt"))
    return extract.page_metadata(found, CONFIG).select(
        "title", "page_no", _joined("authors"), _joined("categories"), post_date(F.col("created")).alias("created"),
        "reject_reason", "content",
    )


def media_files(lb: Logbook) -> DataFrame:
    """Texts written one per file and scanned as media: their hashes, sizes and types."""
    folder = lb.ws.path("media-files")
    write_texts(lb.spark, lb.documents.select("text"), folder)
    return media.hash_media(read_media(lb.spark, folder, "part-*.txt")).select("file_hash", "n_bytes", "mime")


def scan_archive(lb: Logbook) -> DataFrame:
    """The archive written as XML and read back, one row per stored page."""
    folder = lb.ws.path("stored")
    lb.plan.write(folder)
    stored = store.scan_archive(lb.spark, folder)
    pages = store.stored_pages(stored)
    count = lambda df, name: df.groupBy("page_key").agg(F.count("*").alias(name))
    refs = count(store.stored_links(stored), "n_links")
    responses = count(store.stored_responses(stored), "n_responses")
    return (
        pages.join(refs, "page_key", "left")
        .join(responses, "page_key", "left")
        .select(
            "page_key", "page_order", "is_orphan", "title", "page_no", _joined("authors"), _joined("categories"),
            post_date(F.col("created")).alias("created"), "content",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("n_responses", F.lit(0)).alias("n_responses"),
        )
    )


def feed_from_archive(lb: Logbook) -> DataFrame:
    folder = lb.ws.path("stored")
    lb.plan.write(folder)
    return FeedPlan.load(lb.spark, folder, FEED).summary


def write_feed(feed: FeedPlan) -> DataFrame:
    """The feed written as XML parts, its items read back with their place in the feed."""
    folder = feed.ws.path("feed")
    feed.write(folder)
    reader = feed.spark.read.schema(
        "post_id bigint, title string, creator string, guid string, post_type string, content string, page_order bigint"
    )
    return reader.format("xml").option("rowTag", "item").option("ignoreSurroundingSpaces", "false").load(f"{versions.current(feed.spark, folder)}/item").select(
        "post_id", "title", "creator", "guid", "post_type", F.coalesce("content", F.lit("")).alias("content"), "page_order"
    )


def archive_pages(lb: Logbook) -> DataFrame:
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    per_part = lb.plan.archived.select(
        F.col("_key").alias("page_key"),
        size("attachments.attachment").alias("n_attachments"),
        size("images.image").alias("n_images"),
        size("urls.url").alias("n_urls"),
        size("responses.response").alias("n_responses"),
        "created",
        F.length("content").cast("bigint").alias("n_chars"),
    )
    sums = [F.sum(c).alias(c) for c in per_part.columns if c.startswith("n_") and c != "n_chars"]
    return per_part.groupBy("page_key").agg(*sums, F.max("created").alias("created"), F.max("n_chars").alias("n_chars"))


def _ranked_pages(plan) -> DataFrame:
    return plan.ordered.select("page_key", "path", "is_orphan", "page_order")


def _rewritten(kind: str) -> Callable[[FeedPlan], DataFrame]:
    """Page bodies with only one kind of key replaced."""

    def make(feed: FeedPlan) -> DataFrame:
        page, files = feed.page_url_map, feed.media_url_map
        nothing = files.where(F.lit(False))
        targets = links.url_targets(page, nothing) if kind == "page" else links.url_targets(nothing, files)
        pages = feed.pages.select("page_key", "body_id")
        return pages.join(feed.rewritten(pages, targets), "body_id").select("page_key", "content")

    return make


def _posts(feed: FeedPlan) -> DataFrame:
    return feed.posts.drop("created")


def _items(feed: FeedPlan) -> DataFrame:
    return feed.items.drop("created")


def _feed_items(feed: FeedPlan) -> DataFrame:
    return feed.feed_items.select(
        "page_order", "item_rank", "file_hash", "title", "link", "pub_date", "creator", "guid", "content", "post_id",
        "post_name", "post_parent", "post_type", "status", "attachment_url", "attached_file",
    )


def registry() -> dict[str, Query]:
    return {
        # tables as given
        "scan_documents": scan_documents,
        "extract_links": extract_links,
        "decode_urls": decode_urls,
        "normalise_paths": normalise_paths,
        "filter_urls": filter_urls,
        "slugs": slugs,
        "decode_text": decode_text,
        "parse_created": parse_dates,
        "thread_pages": thread_pages,
        # listings
        "scan_contents": _logbook(scan_contents),
        "document_files": _logbook(document_files),
        "media_files": _logbook(media_files),
        "listing_links": _logbook(lambda lb: listing.listing_links(lb.listings)),
        "thread_listing": _archive(lambda p: p.threaded.drop("entry_key")),
        "orphan_responses": _archive(lambda p: listing.orphan_responses(p.threaded)),
        "contents_index": _archive(lambda p: p.entries.drop("entry_key")),
        "entry_responses": _archive(lambda p: p.responses.drop("entry_key")),
        "unlisted_documents": _archive(lambda p: p.unlisted.select("path")),
        "path_collisions": _logbook(path_collisions),
        # extraction
        "validate_pages": validate_pages,
        "rejected": _logbook(rejected),
        "page_metadata": _logbook(page_metadata),
        "page_body": _logbook(page_body),
        "clean_body": _logbook(clean_body),
        "split_names": _logbook(split_names),
        "classify_links": _logbook(classify_links),
        "link_keys": _logbook(link_keys),
        "page_key": _archive(lambda p: p.documents.select("path", "page_key")),
        "clean_filenames": _logbook(clean_filenames),
        "media_hash": _logbook(media_hash),
        "media_type": _logbook(media_type),
        # canonical pages
        "canonical_pages": _archive(lambda p: p.canonical.select("page_key", "path", "n_copies")),
        "orphan_pages": _archive(lambda p: p.orphans),
        "all_pages": _archive(lambda p: p.ordered.select("page_key", "path", "is_orphan", "n_copies")),
        "page_order": _archive(_ranked_pages),
        "page_path_map": _archive(lambda p: p.path_map),
        "duplicate_report": _archive(lambda p: p.duplicates),
        # links, media and stored pages
        "resolve_links": _archive(
            lambda p: p.page_refs.where("target_key is not null").select(
                "page_path", F.col("pos").cast("bigint").alias("pos"), "ref_path", "ref_key", "target_key"
            )
        ),
        "dangling_links": _archive(lambda p: p.dangling.withColumn("pos", F.col("pos").cast("bigint"))),
        "resolve_media": _archive(
            lambda p: p.media_refs.select(
                "page_path", F.col("pos").cast("bigint").alias("pos"), "kind", "ref_path", "file_hash"
            )
        ),
        "unresolved_media": _archive(
            lambda p: p.unresolved_media.select("page_path", F.col("pos").cast("bigint").alias("pos"), "kind", "ref_path")
        ),
        "merged_links": _archive(lambda p: p.merged.drop("target_key", "page_order", "created")),
        "page_media": _archive(lambda p: p.merged_media.select("page_key", "kind", "kind_rank", "file_hash", "src_path")),
        "media_manifest": _archive(
            lambda p: p.manifest.select(
                "file_hash", "src_path", "archive_name", post_date(F.col("created")).alias("created"), "n_refs"
            )
        ),
        "keyed_body": _archive(lambda p: p.bodies),
        "archive_pages": _logbook(archive_pages),
        "scan_archive": _logbook(scan_archive),
        "run_summary": _archive(lambda p: p.summary),
        # feed
        "author_dim": _feed(lambda f: f.authors),
        "category_dim": _feed(lambda f: f.category_rows),
        "terms": _feed(lambda f: f.terms),
        "post_ids": _feed(lambda f: f.ids.drop("page_order")),
        "posts": _feed(_posts),
        "post_terms": _feed(lambda f: f.post_terms.withColumn("pos", F.col("pos").cast("bigint"))),
        "comments": _feed(lambda f: f.comments),
        "comment_bodies": _feed(
            lambda f: f.comment_bodies.withColumnRenamed("body_id", "path")
        ),
        "rewrite_links": _feed(_rewritten("page")),
        "rewrite_media": _feed(_rewritten("media")),
        "attachment_items": _feed(_items),
        "channel": _feed(lambda f: f.channel),
        "feed_items": _feed(_feed_items),
        "skipped_targets": _feed(lambda f: f.skipped_targets),
        "feed_summary": _feed(lambda f: f.summary),
        "feed_from_archive": _logbook(feed_from_archive),
        "write_feed": _feed(write_feed),
    }
