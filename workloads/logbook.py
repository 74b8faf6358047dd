"""A logbook derived from `documents`: its listings, HTML pages and media files.

Every document becomes one entry. Copies of a text are copies of a page (same title,
names and date, all taken from the text's hash); a third of the links lead to one page, a third of the images to one file.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.config import ArchiveConfig
from quillstack.plans.archive import ArchivePlan
from quillstack.sources.workspace import Workspace

ROOT = "/lb/nb.nsf"
FOLDER = f"{ROOT}/By Author"
LISTING_ROWS = 4096
CONFIG = ArchiveConfig(root_dir=ROOT)


def table(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """A given table. A file may be a single row group, which one task would read; a table that heavy
    text work follows on is spread by `spread_by` if its scan has fewer tasks than there are cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    few = spread_by and df.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism
    return df.repartition(F.col(spread_by)) if few else df


def _escape(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


NAME = "case when {0} = 3 then 'J%C3%B6rg K%2E 3' else concat('Author ', {0}) end"


class Logbook:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.ws = Workspace(spark)
        self.source = table(spark, sf_dir, "documents")
        self.documents = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "text", "lang")

    @cached_property
    def base(self) -> DataFrame:
        """One row per document with the fields its page is rendered from, a plain projection."""
        rows = self.documents.withColumn("rep", F.expr("cast(conv(left(md5(text), 7), 16, 10) as bigint)"))
        rows = rows.withColumn("n", self.source.agg(F.count("*")).scalar())
        one, two = NAME.format("rep % 17"), NAME.format("rep % 5")
        return rows.selectExpr(
            "doc_id",
            "rep",
            "text",
            "lang",
            "doc_id % 4 >= 2 as is_response",
            "substring_index(text, '\\n', 1) as title",
            f"""case when rep % 41 = 0 then ''
                when rep % 11 = 0 then concat({one}, ', ,', {two}, ',')
                when doc_id % 2 = 0 then concat({one}, ', ', {two})
                else concat({two}, ', ', {one}) end as authors""",
            "concat('Cat ', rep % 7, case when rep % 3 = 0 then ', Misc & more' else '' end) as categories",
            "timestampadd(MINUTE, cast((rep % 5000000) * 37 as int), timestamp_ntz'2015-01-01 00:00:00') as created",
            "case when doc_id % 8 = 4 then doc_id - 4 else doc_id end as list_no",
            """case when doc_id % 50 = 0 then concat(doc_id, '.5')
                when doc_id % 8 = 4 then cast(doc_id - 4 as string) else cast(doc_id as string) end as page_no""",
            "doc_id % 20 <> 9 and not (doc_id < 16 and doc_id % 4 < 2) as is_listed",
            "doc_id >= 16 and (doc_id - doc_id % 4 + 1) % 20 <> 9 and doc_id % 12 in (1, 2, 3) as is_twice",
            """case when doc_id % 20 = 5 then concat('missing', doc_id) when doc_id % 3 = 0 then '17'
                else cast((doc_id * 7 + 1) % n as string) end as link_to""",
            "(doc_id * 3) % n as note_of",
            "case when doc_id % 3 = 0 then 0 else (doc_id * 5) % n end as image_of",
        )

    @cached_property
    def listing_rows(self) -> DataFrame:
        """Listing entries as a table: main listings L*, and a second listing M* of some."""
        rows = self.base.select("doc_id", "title", "is_response", "list_no", "is_listed", "is_twice")
        block = f"lpad(cast(cast(floor(doc_id / {LISTING_ROWS}) as bigint) as string), 6, '0')"
        main = rows.where("is_listed and not (is_twice and doc_id % 12 = 2)").selectExpr(
            "*", f"concat('L', cast(floor(doc_id / 4) as bigint) % 4, '-', {block}) as contents_file"
        )
        second = rows.where("is_listed and is_twice").selectExpr("*", f"concat('M0-', {block}) as contents_file")
        return main.unionByName(second).selectExpr(
            "contents_file",
            "doc_id as pos",
            "case when is_response then concat('---------- Respond: ', title) else title end as title",
            "concat('By%20Author/', doc_id, '?OpenDocument') as href",
            "case when not is_response then list_no end as page_number",
        )

    @cached_property
    def listings(self) -> DataFrame:
        """Rendered listings. A file holds at most `LISTING_ROWS` entries by construction."""
        link = f"""concat(
            '<tr><td>',
            case when page_number is null then concat('<a href="', href, '" target="NotesView">')
                 else concat('<a target="NotesView" href="', href, '"><b>') end,
            {_escape("title")},
            case when page_number is null then '</a></td><td></td></tr>'
                 else concat('</b></a></td><td><font size="2"><b>', page_number, '</b></font></td></tr>') end)"""
        items = self.listing_rows.select("contents_file", F.struct("pos", F.expr(link).alias("item")).alias("r"))
        files = items.groupBy("contents_file").agg(F.array_sort(F.collect_list("r")).alias("rs"))
        head = '<html><body><a href="/lb?OpenView">All</a><table>'
        return files.select(
            "contents_file",
            F.concat(F.lit(head), F.array_join("rs.item", ""), F.lit("</table></body></html>")).alias("html"),
        )

    @cached_property
    def bodies(self) -> DataFrame:
        """Entry bodies as written on the page (`doc_id, body`)."""
        body = f"""concat(
            '<p>', {_escape("text")}, '</p>',
            case when doc_id % 6 = 1 then '<a class="x" href="' else '<a href="' end,
            case when doc_id % 4 = 1 then '' else '../By%20Author/' end, link_to, '?OpenDocument">see also</a>',
            '<p><a href="', case when doc_id % 25 = 24 then concat(doc_id, '/$FILE/lost.txt')
                else concat(note_of, '/$FILE/note%20', note_of, '.TXT') end, '">file</a></p>',
            '<img border="0" src="', case when doc_id % 30 = 7 then concat(note_of, '/$FILE/note%20', note_of, '.TXT')
                else concat(image_of, '/Body/0.1A?OpenElement&amp;FieldElemFormat=gif') end, '">',
            '<a href="#top">top</a><a href="http://example.org/x">elsewhere</a>')"""
        return self.base.withColumn("body", F.expr(body))

    @cached_property
    def pages(self) -> DataFrame:
        """Rendered entries: `path, html`."""
        html = f"""concat(
            '<html><body><form><div align="center"><b><font size="4">Logbook Entry</font></b></div>',
            '<table width="100%" border="1"><tr><td width="1%" bgcolor="#EFEFEF"><font size="2">Page</font><b>',
            page_no, '</b><br><font size="2">Created</font><br><i>Mon ', date_format(created, 'hh:mm a'),
            '</i></td><td><font size="2">Title</font><font size="2">', {_escape("title")},
            '</font><font size="2">Author</font><font size="2">', authors,
            '</font><font size="2">Category</font><font size="2">', {_escape("categories")},
            '</font><font size="2">Date</font><font size="2">', date_format(created, 'MM/dd/yyyy'),
            '</font><table><tr><td>nested</td></tr></table></td></tr></table>',
            body, '</form></body></html>')"""
        return self.bodies.selectExpr(f"concat('{FOLDER}/', doc_id, '?OpenDocument') as path", f"{html} as html")

    @cached_property
    def media(self) -> DataFrame:
        """Media files: each text as an attachment, and an image per document."""
        notes = self.base.selectExpr(
            f"concat('{FOLDER}/', doc_id, '/$FILE/note ', doc_id, '.TXT') as path", "encode(text, 'UTF-8') as content"
        )
        images = self.base.selectExpr(
            f"concat('{FOLDER}/', doc_id, '/Body/0.1A?OpenElement&FieldElemFormat=gif') as path",
            "encode(concat('GIF89a', lang, rep % 97), 'UTF-8') as content",
        )
        return notes.unionByName(images)

    @cached_property
    def plan(self) -> ArchivePlan:
        return ArchivePlan(self.spark, self.listings, self.pages, self.media, CONFIG, self.ws)
