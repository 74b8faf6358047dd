"""Phase 1: from listings, documents and media files to the linked, deduplicated archive."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.config import ArchiveConfig
from quillstack.functions.dates import epoch_seconds
from quillstack.operators import canon, dims, extract, links, listing, media
from quillstack.operators.report import one_row, rows
from quillstack.operators.skew import lookup
from quillstack.sources import archive as store
from quillstack.sources.workspace import Workspace

SUMMARY = (
    "listing_files", "listed_pages", "responses", "unlisted_documents", "pages", "distinct_pages", "orphans",
    "media_items", "images", "attachments", "internal_urls", "media_files", "dangling_links", "authors",
    "categories", "rejected",
)


class ArchivePlan:
    """The tables of the archive build; each is made when first asked for.

    listings   contents_file, html
    documents  path, html (NULL for a binary file)
    media      path, content, or path, uri, file_hash, n_bytes, head of a file scan

    Narrow tables that several later steps read are written once to the run's workspace.
    Bodies are cut from the documents once, when the first result needs them, and stored
    bucketed by path, so that no later join moves them again.
    """

    def __init__(
        self,
        spark: SparkSession,
        listings: DataFrame,
        documents: DataFrame,
        media_files: DataFrame,
        config: ArchiveConfig = ArchiveConfig(),
        ws: Workspace | None = None,
    ):
        self.spark = spark
        self.listings = listings
        self.source_documents = documents
        self.media_files = media_files
        self.config = config
        self.ws = ws or Workspace(spark)
        self.counts: dict[str, int] = {}

    def _keep(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        """`df` as a written table; `metrics` are counted on the way into `counts`."""
        return self.ws.keep(df, name, metrics, self.counts)

    # --- listings -------------------------------------------------------------------------

    @cached_property
    def listing_links(self) -> DataFrame:
        found = listing.listing_links(self.listings)
        return self._keep(found, "listing-links", listing_files=F.count_if(F.col("pos") == 0))

    @cached_property
    def threaded(self) -> DataFrame:
        return listing.thread_listing(self.listing_links)

    @cached_property
    def entries(self) -> DataFrame:
        found = listing.contents_index(self.listing_links, self.config.root_dir)
        return self._keep(found, "entries", listed_pages=rows())

    @cached_property
    def responses(self) -> DataFrame:
        found = listing.entry_responses(self.threaded, self.config.root_dir)
        return self._keep(found, "responses", responses=rows())

    # --- documents ------------------------------------------------------------------------

    @cached_property
    def documents(self) -> DataFrame:
        """All documents with their metadata, identity, links and reject reason."""
        return self.ws.keep(extract.extract_documents(self.source_documents, self.config), "documents")

    @cached_property
    def valid(self) -> DataFrame:
        return self.documents.where("reject_reason is null")

    @cached_property
    def unlisted(self) -> DataFrame:
        paths = listing.listed_paths(self.listing_links, self.config.root_dir)
        found = listing.unlisted_documents(self.valid.select("path", "page_key"), paths)
        return self._keep(found, "unlisted", unlisted_documents=rows())

    @cached_property
    def rejected(self) -> DataFrame:
        """Documents, listings and media files that cannot be read, and listed paths without a document."""
        bad = self.documents.where("reject_reason is not null").select("path", "reject_reason")
        wanted = self.entries.select("path").unionByName(self.responses.select("path")).distinct()
        missing = wanted.join(self.documents.select("path"), "path", "left_anti")
        listings = self.listings.where("html is null").select(F.col("contents_file").alias("path"))
        unread = self.hashed_media.where("file_hash is null").select("path")
        rejected = (
            bad.unionByName(missing.withColumn("reject_reason", F.lit("missing document")))
            .unionByName(listings.withColumn("reject_reason", F.lit("unreadable contents listing")))
            .unionByName(unread.withColumn("reject_reason", F.lit("unreadable media file")))
        )
        return self._keep(rejected, "rejected", rejected=rows())

    # --- canonical pages ------------------------------------------------------------------

    @cached_property
    def resolved(self) -> DataFrame:
        entries = self.entries.select("entry_key", "path", "first_file", "first_pos")
        return self.ws.keep(canon.resolve_entries(self.ws, entries, self.valid), "resolved")

    @cached_property
    def canonical(self) -> DataFrame:
        return canon.canonical_pages(self.resolved)

    @cached_property
    def orphans(self) -> DataFrame:
        return canon.orphan_pages(self.unlisted, self.canonical)

    @cached_property
    def ordered(self) -> DataFrame:
        """Canonical pages and orphans with their order number."""
        orphan = F.col("is_orphan")
        metrics = {
            "pages": F.sum(F.when(orphan, F.col("n_copies")).otherwise(1)),
            "distinct_pages": rows(),
            "orphans": F.sum(F.when(orphan, F.col("n_copies"))),
        }
        return canon.page_order(self.ws, canon.all_pages(self.canonical, self.orphans), metrics, self.counts)

    @cached_property
    def parents(self) -> DataFrame:
        """Responses that have a readable document, with their parent's identity and order."""
        marked = self.ws.keep(canon.mark_canonical(self.ws, self.resolved, self.ordered), "marked")
        found = canon.response_parents(self.ws, self.responses, marked)
        return self.ws.keep(found.join(self.valid.select("path"), "path", "left_semi"), "parents")

    @cached_property
    def path_map(self) -> DataFrame:
        return canon.page_path_map(self.resolved, self.parents, self.unlisted)

    @cached_property
    def collisions(self) -> DataFrame:
        return self._keep(listing.path_collisions(self.resolved, self.responses), "collisions", path_collisions=rows())

    @cached_property
    def owners(self) -> DataFrame:
        """The documents that reach the archive: canonical pages and their responses."""
        pages = self.ordered.select("path", "page_key", "page_order", "is_orphan", F.lit(0).alias("role"))
        responses = self.parents.where("kept").select(
            "path", "page_key", "page_order", F.lit(False).alias("is_orphan"), F.lit(1).alias("role"),
            "first_file", "first_pos",
        )
        return pages.unionByName(responses, allowMissingColumns=True)

    # --- links and media ------------------------------------------------------------------

    @cached_property
    def details(self) -> DataFrame:
        """The archived documents with all that is known of them, short of their bodies."""
        docs = self.valid.drop("page_key", "reject_reason")
        return self.ws.keep(lookup(self.ws, self.owners, docs, "path", "inner", staged=True), "details")

    @cached_property
    def links(self) -> DataFrame:
        """Links of the archived documents, one row each, with their owner's place."""
        place = ["page_key", "page_order", "role", "first_file", "first_pos", "created"]
        rows = self.details.select(F.col("path").alias("page_path"), *place, F.explode("links").alias("l"))
        return rows.select("page_path", *place, "l.*").where("kind <> 'other'")

    @cached_property
    def hashed_media(self) -> DataFrame:
        return self.ws.keep(media.hash_media(self.media_files), "media")

    @cached_property
    def refs(self) -> DataFrame:
        """Links with what they lead to: a page (`target_key`) or a file (`file_hash`)."""
        pages = links.resolve_links(self.ws, self.links, self.path_map)
        found = links.resolve_media(self.ws, pages, self.hashed_media)
        is_page, is_media = F.col("kind") == "page", F.col("kind").isin(*links.MEDIA_KINDS)
        return self._keep(
            found,
            "refs",
            dangling_links=F.count_if(is_page & F.col("target_key").isNull()),
            missing_media=F.count_if(is_media & F.col("file_hash").isNull()),
        )

    @cached_property
    def media_refs(self) -> DataFrame:
        return self.refs.where(F.col("kind").isin(*links.MEDIA_KINDS)).withColumn("ref_key", F.col("file_hash"))

    @cached_property
    def page_refs(self) -> DataFrame:
        return self.refs.where("kind = 'page'").withColumn("ref_key", F.col("link_key"))

    @cached_property
    def dangling(self) -> DataFrame:
        return links.dangling_links(self.refs)

    @cached_property
    def unresolved_media(self) -> DataFrame:
        return self.media_refs.where("ref_key is null").select("page_path", "pos", "kind", "href", "ref_path")

    @cached_property
    def merged(self) -> DataFrame:
        """References of each page with its responses' merged in, one per (page, kind, key)."""
        key = F.coalesce("file_hash", F.when(F.col("target_key").isNotNull(), F.col("link_key")))
        of_kind = lambda k: F.count_if(F.col("kind") == k)
        return self._keep(
            links.merge_links(self.refs.withColumn("ref_key", key)),
            "merged",
            media_items=F.count_if(F.col("kind") != "page"),
            images=of_kind("image"),
            attachments=of_kind("attachment"),
            internal_urls=of_kind("page"),
        )

    @cached_property
    def merged_page_links(self) -> DataFrame:
        return self.merged.where("kind = 'page'").select("page_key", "ref_key", "target_key")

    @cached_property
    def merged_media(self) -> DataFrame:
        return media.page_media(self.merged.drop("target_key"))

    @cached_property
    def manifest(self) -> DataFrame:
        return self._keep(media.media_manifest(self.merged_media), "manifest", media_files=rows())

    # --- pages, responses and bodies ------------------------------------------------------

    @cached_property
    def pages(self) -> DataFrame:
        return self.details.where("role = 0").select(
            "page_key", "page_order", "is_orphan", "path", "title", "page_no", "authors", "categories", "created"
        )

    @cached_property
    def page_responses(self) -> DataFrame:
        return self.details.where("role = 1").select(
            "page_key", "page_order", "path", "first_file", "first_pos", "authors", "created"
        )

    @cached_property
    def bodies(self) -> DataFrame:
        """Keyed bodies of all archived documents by path, cut once and stored bucketed by path."""
        wanted = self.source_documents.join(self.details.select("path"), "path", "left_semi")
        own = self.valid.select("path", "links")
        keyed = links.keyed_bodies(extract.document_bodies(wanted), own, self.media_refs)
        return self.ws.keep_by(keyed, "bodies", "path")

    # --- dimensions -----------------------------------------------------------------------

    def _names(self, column: str) -> DataFrame:
        kept = self.details if self.config.include_orphans else self.details.where("not is_orphan")
        return self._keep(dims.distinct_names(kept, column), column, **{column: rows()})

    @cached_property
    def authors(self) -> DataFrame:
        return self._names("authors")

    @cached_property
    def categories(self) -> DataFrame:
        return self._names("categories")

    # --- results --------------------------------------------------------------------------

    @cached_property
    def parts(self) -> DataFrame:
        """Which stored row each response goes to (`part`): the page's own, '' ...

        unless the page has more than `responses_per_part`; then one per listing stretch.
        """
        size = self.config.responses_per_part
        kept = self.parents.where("kept").select("path", "page_key", "first_file", "first_pos")
        counts = kept.groupBy("page_key").agg(F.count("*").alias("n"))
        large = counts.where(F.col("n") > size).select("page_key", F.lit(True).alias("is_large"))
        place = F.concat("first_file", F.lit(":"), F.floor(F.col("first_pos") / size).cast("string"))
        placed = lookup(self.ws, kept, large, "page_key", "left", staged=True)
        rows = placed.select("path", "page_key", F.when(F.col("is_large"), place).otherwise("").alias("part"))
        return self.ws.keep(rows, "parts")

    @cached_property
    def archived(self) -> DataFrame:
        """Nested page rows in the stored form.

        A page is one row. Where it has more responses than `responses_per_part`, they go to
        further rows of the same key, cut by listing position, so that no row grows without
        bound; every row lists the links its own bodies use.
        """
        authors = F.struct(F.col("authors").alias("author"))
        response = F.struct(
            "first_file", "first_pos",
            F.struct(
                F.col("path").alias("_path"), F.col("first_file").alias("_file"), F.col("first_pos").alias("_pos"),
                epoch_seconds(F.col("created")).alias("created"), authors.alias("authors"), "content",
            ).alias("r"),
        )
        responses = (
            self.page_responses.join(self.parts, ["path", "page_key"])
            .join(self.bodies, "path")
            .groupBy("page_key", "part")
            .agg(F.array_sort(F.collect_list(response)).alias("rs"))
            .select("page_key", "part", F.struct(F.col("rs.r").alias("response")).alias("responses"))
        )
        own = self.pages.join(self.bodies, "path").select(
            "page_key", F.lit("").alias("part"), "page_order", "is_orphan", "path", "title",
            F.col("page_no").alias("page"), epoch_seconds(F.col("created")).alias("created"),
            authors.alias("authors"), F.struct(F.col("categories").alias("category")).alias("categories"), "content",
        )
        rest = responses.join(self._part_links(), ["page_key", "part"], "full")
        return own.join(rest, ["page_key", "part"], "full").select(
            F.col("page_key").alias("_key"), F.col("part").alias("_part"), F.col("page_order").alias("_order"),
            F.col("is_orphan").alias("_orphan"), F.col("path").alias("_path"), "title", "page", "created",
            "authors", "categories", "content", "attachments", "images", "urls", "responses",
        )

    def _part_links(self) -> DataFrame:
        """Links of each stored row as arrays of (stored name, key)."""
        keyed = ("page_path", "page_key", "kind", "ref_key")
        pages = self.page_refs.where("target_key is not null").select(
            *keyed, F.concat("target_key", F.lit(".xml")).alias("target")
        )
        names = self.manifest.select(F.col("file_hash").alias("ref_key"), F.col("archive_name").alias("target"))
        shown = self.media_refs.where("ref_key is not null").select(*keyed)
        files = lookup(self.ws, shown, names, "ref_key", "inner", staged=True)
        place = self.parts.select(F.col("path").alias("page_path"), "page_key", "part")
        rows = pages.unionByName(files).join(place, ["page_path", "page_key"], "left")
        distinct = rows.select(
            "page_key", F.coalesce("part", F.lit("")).alias("part"), "kind", "ref_key", "target"
        ).distinct()
        ref = F.struct(F.col("target").alias("_path"), F.col("ref_key").alias("_VALUE"))
        of_kind = lambda k: F.array_sort(F.collect_list(F.when(F.col("kind") == k, ref)))
        # Bounded: a group is one part, the links of one page's text or of one part's responses.
        return distinct.groupBy("page_key", "part").agg(
            F.struct(of_kind("attachment").alias("attachment")).alias("attachments"),
            F.struct(of_kind("image").alias("image")).alias("images"),
            F.struct(of_kind("page").alias("url")).alias("urls"),
        )

    @cached_property
    def duplicates(self) -> DataFrame:
        """Copies and what they copy: pages by path, media by the file first stored."""
        firsts = self.ordered.where("not is_orphan").select("entry_key")
        entries = self.resolved.join(firsts, "entry_key", "left_anti")
        copies = entries.unionByName(self.unlisted, allowMissingColumns=True)
        pages = canon.copies_of(self.ws, copies, self.ordered).where("path <> original_path")
        originals = self.manifest.select(
            "file_hash", F.col("src_path").alias("original_path"), "first_page_key", "first_kind"
        )
        shown = self.merged_media.select("file_hash", "page_key", "kind", "src_path")
        files = lookup(self.ws, shown, originals, "file_hash", "inner", staged=True)
        again = files.where("page_key <> first_page_key or kind <> first_kind")
        return pages.select(F.lit("page").alias("kind"), "path", "original_path", "page_key").unionByName(
            again.select("kind", F.col("src_path").alias("path"), "original_path", "page_key")
        )

    @cached_property
    def summary(self) -> DataFrame:
        """The run's counts in one row; `pages` and `orphans` count equal orphans each.

        They are counted as the tables are written, so only tables that are not there yet start a job.
        """
        for name in ("listing_links", "entries", "responses", "unlisted", "ordered", "refs", "merged", "manifest"):
            getattr(self, name)
        for name in ("authors", "categories", "rejected"):
            getattr(self, name)
        return one_row(self.spark, self.counts, SUMMARY)

    @property
    def problems(self) -> dict[str, DataFrame]:
        """What the lenient mode leaves out or cannot resolve, by name; stored beside the archive."""
        return {
            "rejected": self.rejected,
            "collisions": self.collisions,
            "dangling": self.dangling,
            "unresolved_media": self.unresolved_media,
            "orphan_responses": listing.orphan_responses(self.threaded),
        }

    def verify(self) -> None:
        """In strict mode, fail on anything the lenient mode reports in a table.

        All of it was counted as those tables were written, which the archive stores as well.
        """
        if not self.config.strict:
            return
        for name in ("rejected", "collisions", "refs"):
            getattr(self, name)
        fatal = {
            "rejected documents": "rejected",
            "path collisions": "path_collisions",
            "dangling links": "dangling_links",
            "missing media": "missing_media",
        }
        for name, count in fatal.items():
            if self.counts[count]:
                raise ValueError(f"the archive has {name}")

    def write(self, folder: str, copy_media: bool = False) -> None:
        """Replace the stored archive under `folder`; `copy_media` stores every file of the manifest once as well.

        Copying needs media from a file scan, which knows where they are.
        """
        self.verify()
        files = media.media_sources(self.manifest, self.hashed_media) if copy_media else None
        store.write_archive(
            folder, self.archived, self.authors, self.categories, self.manifest, self.problems, files
        )
