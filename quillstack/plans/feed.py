"""Phase 2: from the archive to the tables of the publishing feed."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.config import FeedConfig
from quillstack.operators import dims, feed, ids, links
from quillstack.operators.report import one_row, rows
from quillstack.operators.skew import lookup
from quillstack.plans.archive import ArchivePlan
from quillstack.sources import archive as store
from quillstack.sources import versions
from quillstack.sources.workspace import Workspace

SUMMARY = (
    "posts", "comments", "urls_raw", "urls_distinct", "media_items", "images", "attachments", "authors", "categories"
)


class FeedPlan:
    """The feed's tables, made from an archive plan or from a stored archive.

    pages      page_key, body_id, page_order, title, page_no, authors, categories, created
    responses  page_key, body_id, path, first_file, first_pos, authors, created
    bodies     body_id, content: keyed bodies of both
    body_keys  body_id, pos, key: the link keys in each body and their places
    page_refs  page_key, ref_key, target_key: links between pages
    media_refs page_key, kind, kind_rank, file_hash
    manifest   file_hash, archive_name, created
    """

    def __init__(
        self,
        spark: SparkSession,
        pages: DataFrame,
        responses: DataFrame,
        bodies: DataFrame,
        body_keys: DataFrame,
        page_refs: DataFrame,
        media_refs: DataFrame,
        manifest: DataFrame,
        authors: DataFrame,
        categories: DataFrame,
        config: FeedConfig = FeedConfig(),
        ws: Workspace | None = None,
    ):
        self.spark = spark
        self.pages = pages
        self.responses = responses
        self.bodies = bodies
        self.body_keys = body_keys
        self.page_refs = page_refs
        self.media_refs = media_refs
        self.manifest = manifest
        self.author_names = authors
        self.category_names = categories
        self.config = config
        self.ws = ws or Workspace(spark)
        self.counts: dict[str, int] = {}

    @classmethod
    def of(cls, plan: ArchivePlan, config: FeedConfig = FeedConfig()) -> FeedPlan:
        """Continue straight from the archive's tables; each is made only when a result needs it."""
        return _FromPlan(plan, config)

    @classmethod
    def load(
        cls, spark: SparkSession, folder: str, config: FeedConfig = FeedConfig(), strict: bool = False
    ) -> FeedPlan:
        """Continue from a stored archive. The XML is parsed once into a columnar table.

        Damaged page rows are left out (`store.damaged_rows` lists them); `strict` fails on them.
        """
        ws, archive = Workspace(spark), versions.current(spark, folder)
        stored = ws.keep(store.scan_archive(spark, folder, strict), "stored")
        refs = ws.keep(store.stored_links(stored), "stored-links")
        page_refs = refs.where("kind = 'page'").select(
            "page_key", "ref_key", F.regexp_replace("target", r"\.xml$", "").alias("target_key")
        )
        media_refs = refs.where("kind <> 'page'").select(
            "page_key", "kind", F.when(F.col("kind") == "attachment", 0).otherwise(1).alias("kind_rank"),
            F.col("ref_key").alias("file_hash"),
        )
        pages = store.stored_pages(stored).withColumn("body_id", F.col("page_key"))
        response_id = F.concat_ws("|", "page_key", "first_file", "first_pos", "path")
        responses = store.stored_responses(stored).withColumn("body_id", response_id)
        bodies = pages.select("body_id", "content").unionByName(responses.select("body_id", "content"))
        bodies = ws.keep_by(bodies, "stored-bodies", "body_id")
        return cls(
            spark,
            pages.drop("content"),
            responses.drop("content"),
            bodies,
            ws.keep(links.body_keys(bodies), "body-keys"),
            page_refs,
            media_refs,
            ws.keep(store.scan_manifest(spark, folder), "manifest"),
            store.read_names(spark, f"{archive}/authors", "author"),
            store.read_names(spark, f"{archive}/categories", "category"),
            config,
            ws,
        )

    # --- numbers and dimensions -----------------------------------------------------------

    @cached_property
    def ids(self) -> DataFrame:
        return ids.post_ids(self.ws, self.pages)

    @cached_property
    def post_index(self) -> DataFrame:
        index = feed.post_index(self.pages, self.ids, self.page_refs)
        return self.ws.keep(index, "post-index", {"posts": rows(), "urls_distinct": F.sum("n_urls")}, self.counts)

    @cached_property
    def terms(self) -> DataFrame:
        return dims.terms(self.ws, self.author_names, self.category_names, self.counts)

    @cached_property
    def authors(self) -> DataFrame:
        return dims.author_dim(self.terms)

    @cached_property
    def category_rows(self) -> DataFrame:
        return dims.category_dim(self.terms)

    # --- bodies ---------------------------------------------------------------------------

    @cached_property
    def page_url_map(self) -> DataFrame:
        """Link keys and the URLs of the posts they lead to."""
        targets = self.page_refs.groupBy(F.col("ref_key").alias("key")).agg(
            F.min("target_key").alias("target_key")
        )
        return feed.page_urls(self.ws, targets, self.ids, self.config)

    @cached_property
    def media_url_map(self) -> DataFrame:
        return feed.media_urls(self.manifest, self.config)

    @cached_property
    def url_targets(self) -> DataFrame:
        return self.ws.keep(links.url_targets(self.page_url_map, self.media_url_map), "url-targets")

    def rewritten(self, owners: DataFrame, targets: DataFrame | None = None) -> DataFrame:
        """Bodies of the given pages or responses with their keys replaced by URLs."""
        targets = self.url_targets if targets is None else targets
        wanted = self.bodies.join(owners.select("body_id"), "body_id", "left_semi")
        return links.rewrite_bodies(wanted, links.body_urls(self.ws, self.body_keys, targets))

    @cached_property
    def threaded_comments(self) -> DataFrame:
        """Comments-to-be without their bodies: post, place, date and authors."""
        found = feed.thread_comments(self.ws, self.responses.drop("page_order"), self.post_index)
        return found.withColumn("first_author", feed.first_author(F.col("authors")))

    @cached_property
    def numbered_comments(self) -> DataFrame:
        return feed.number_comments(self.ws, self.threaded_comments, self.counts)

    @cached_property
    def comment_bodies(self) -> DataFrame:
        return self.rewritten(self.numbered_comments)

    # --- result tables --------------------------------------------------------------------

    @cached_property
    def posts(self) -> DataFrame:
        bodies = self.rewritten(feed.with_authors(self.pages))
        return feed.posts(self.pages, bodies, self.post_index, self.config)

    @cached_property
    def post_terms(self) -> DataFrame:
        return feed.post_terms(self.pages, self.post_index)

    @cached_property
    def comments(self) -> DataFrame:
        return feed.comments(self.ws, self.numbered_comments, self.comment_bodies, self.authors, self.config)

    @cached_property
    def shown_media(self) -> DataFrame:
        """Each media file and kind with the first post that shows it."""
        shown = feed.shown_media(self.ws, self.media_refs, self.post_index)
        kind = lambda k: F.count_if(F.col("kind") == k)
        metrics = {"media_items": rows(), "images": kind("image"), "attachments": kind("attachment")}
        return self.ws.keep(shown, "shown-media", metrics, self.counts)

    @cached_property
    def items(self) -> DataFrame:
        return feed.attachment_items(self.ws, self.shown_media, self.ids, self.manifest, self.config)

    @cached_property
    def channel(self) -> DataFrame:
        return feed.channel(self.pages, self.config)

    @cached_property
    def feed_items(self) -> DataFrame:
        return feed.feed_items(self.posts, self.items)

    @cached_property
    def skipped_targets(self) -> DataFrame:
        """Links to pages that have an id but, for want of an author, no post."""
        bare = self.pages.where(F.size("authors") == 0).select(F.col("page_key").alias("target_key"))
        flagged = lookup(self.ws, self.page_refs, bare, "target_key", "inner", staged=True)
        return flagged.select("page_key", "ref_key", "target_key")

    @cached_property
    def summary(self) -> DataFrame:
        """Counts of the feed. `urls_raw` counts a post's links again for each of its comments.

        They are counted as the tables are written, so only tables that are not there yet start a job.
        """
        for name in ("post_index", "numbered_comments", "shown_media", "terms"):
            getattr(self, name)
        counts = self.counts | {"urls_raw": self.counts["urls_distinct"] + self.counts["comment_urls"]}
        return one_row(self.spark, counts, SUMMARY)

    def write(self, folder: str) -> None:
        """Replace the feed under `folder` as a whole: one set of XML part files per table.

        Items come in feed order, by `page_order`, `item_rank` and `file_hash`, which are written too,
        in numbered parts of at most `max_part_bytes`.
        """
        comments = self.comments.drop("path")
        tables = {
            "channel": self.channel.drop("n_posts"),
            "author": self.authors,
            "term": self.terms.where(F.col("taxonomy") == dims.COAUTHOR_TAXONOMY),
            "category": self.category_rows,
            "post_term": self.post_terms,
            "comment": comments,
        }

        order = ("page_order", "item_rank", "file_hash")
        items = self.ws.keep(self.feed_items.drop("created"), "items")

        def write(target: str) -> None:
            store.write_xml_parts(self.ws, items, f"{target}/item", "items", "item", order, self.config.max_part_bytes)
            for name, table in tables.items():
                store.write_xml(table, f"{target}/{name}", f"{name}s", name)

        versions.replace(self.spark, folder, write)


class _FromPlan(FeedPlan):
    """A feed plan whose inputs are an archive plan's tables, each made when first asked for."""

    def __init__(self, plan: ArchivePlan, config: FeedConfig):
        self.spark = plan.spark
        self.plan = plan
        self.config = config
        self.ws = plan.ws
        self.counts = {}

    pages = property(lambda self: self.plan.pages.withColumn("body_id", F.col("path")))
    responses = property(lambda self: self.plan.page_responses.withColumn("body_id", F.col("path")))
    page_refs = property(lambda self: self.plan.merged_page_links)
    media_refs = property(
        lambda self: self.plan.merged_media.select("page_key", "kind", "kind_rank", "file_hash")
    )
    manifest = property(lambda self: self.plan.manifest)
    author_names = property(lambda self: self.plan.authors)
    category_names = property(lambda self: self.plan.categories)

    # Renamed columns keep their table's buckets.
    bodies = property(lambda self: self.plan.bodies.withColumnRenamed("path", "body_id"))

    @cached_property
    def body_keys(self) -> DataFrame:
        return self.ws.keep(links.body_keys(self.bodies), "body-keys")
