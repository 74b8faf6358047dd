"""Documents: validity, metadata, body and links, all as projections over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.config import ArchiveConfig
from quillstack.functions import html as H
from quillstack.functions import text as T
from quillstack.functions.dates import parse_created, post_date

# The layout marks of a logbook page.
HEADING = "Logbook Entry"
HEADING_DIV = r"""(?is)<div\b[^>]*\balign\s*=\s*["']?center["'\s>].*?</div\s*>"""
HEADING_TEXT = r"(?is)<b\b[^>]*>.*?<font\b[^>]*>(.*?)</font\s*>"
META_TABLE = (
    r"""(?is)<table\b(?=[^>]*\swidth\s*=\s*["']?100%["'\s>])(?=[^>]*\sborder\s*=\s*["']?1["'\s>])[^>]*>"""
)
FIRST_CELL = (
    r"""(?is)<td\b(?=[^>]*\sbgcolor\s*=\s*["']?#EFEFEF["'\s>])(?=[^>]*\swidth\s*=\s*["']?1%["'\s>])[^>]*>"""
)
FONT_OPEN = r"""(?is)<font\b[^>]*\ssize\s*=\s*["']?2["'\s>].*"""
FONT_TAG = r"""(?is)<font\b[^>]*\ssize\s*=\s*["']?2["'\s>].*?</font\s*>"""
NESTED_FONT = r"(?is)<font\b(?:(?!</?font\b).)*+<font\b"
FONT_PIECE = r"(?is)<font\b[^>]*>|</font\s*>|(?:(?!</?font\b).)+|."
PAGE_NUMBER = r"(?is)</font\s*>\s*<(\w+)\b[^>]*>(.*?)</\1\s*>"
CREATED_TEXT = r"(?is)</font\s*>.*?</font\s*>\s*<br\s*/?>\s*<(\w+)\b[^>]*>(.*?)</\1\s*>"
# The pattern begins with its one fixed character, so that a search tries it only where that stands.
DOCUMENT_END = r"(?is)<(?:/form\s*>\s*<)?/body\s*>\s*(?:</html\s*>)?\s*$"


def decode_documents(files: DataFrame) -> DataFrame:
    """File bytes to text; binary files keep no text."""
    binary = T.is_binary(F.col("content"))
    return files.withColumn("html", F.when(~binary, T.decode_bytes(F.col("content")))).drop("content")


def text_of(html: Column) -> Column:
    return T.html_unescape(T.strip_tags(html))


def _kind(token: Column) -> Column:
    """What a table token is: a metadata table, a number cell, how its tag begins, or empty for hidden parts."""
    names = lambda word: F.contains(F.lower(token), F.lit(word))
    return T.let(
        H.tag_word(token),
        lambda word: F.when(word == "", "")
        .when(names("<table") & token.rlike(META_TABLE), "meta")
        .when(names("<td") & token.rlike(FIRST_CELL), "number")
        .otherwise(word),
    )


def _table_range(kinds: Column) -> Column:
    """Places of the first metadata table's opening and closing tags among the table tokens.

    The tables in it are counted along, so its own closing tag is the one at which none is open.
    -1: there is no such table (`start`), or nothing closes it (`end`).
    """
    begin = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

    def step(acc: Column, kind: Column) -> Column:
        opens = kind.isin("meta", "<table") & ((acc["start"] >= 0) | (kind == "meta"))
        closes = (kind == "</table") & (acc["start"] >= 0)
        depth = acc["depth"] + opens.cast("int") - closes.cast("int")
        return F.struct(
            (acc["i"] + 1).alias("i"),
            depth.alias("depth"),
            F.when((acc["start"] < 0) & opens, acc["i"]).otherwise(acc["start"]).alias("start"),
            F.when((acc["end"] < 0) & closes & (depth == 0), acc["i"]).otherwise(acc["end"]).alias("end"),
        )

    return F.aggregate(kinds, begin, step)


def _cell_ranges(kinds: Column) -> Column:
    """Places of the number cell (`first` to `first_end`) and of the cell after it, among a table's inner tokens.

    A cell ends at its closing tag, at the next cell or row of its own table, or with the table;
    what nested tables hold is passed over. `phase`: 0 before the number cell, 1 in it, 2 after it, 3 in
    the next cell, 4 past both.
    """
    names = ("i", "depth", "phase", "first", "first_end", "second", "second_end")
    begin = F.struct(*[F.lit(0 if n in names[:3] else -1).alias(n) for n in names])

    def step(acc: Column, kind: Column) -> Column:
        phase, i = acc["phase"], acc["i"]
        own = acc["depth"] == 0
        cell, end = own & kind.isin("number", "<td", "<th"), own & kind.isin("</td", "</th")
        row = own & kind.isin("<tr", "</tr", "</table")
        table = (phase > 0) & kind.isin("meta", "<table")
        depth = acc["depth"] + table.cast("int") - ((phase > 0) & ~own & (kind == "</table")).cast("int")
        new = (
            F.when(phase == 0, (kind == "number").cast("int"))
            .when((phase == 1) & cell, 3)
            .when((phase == 1) & end, 2)
            .when((phase == 2) & cell, 3)
            .when((phase == 3) & (cell | end), 4)
            .when(row, 4)
            .otherwise(phase)
        )
        at = lambda field, when: F.when(when & (acc[field] < 0), i).otherwise(acc[field])
        return F.struct(
            (i + 1).alias("i"),
            depth.alias("depth"),
            new.alias("phase"),
            at("first", (phase == 0) & (new == 1)).alias("first"),
            at("first_end", (phase == 1) & (new > 1)).alias("first_end"),
            at("second", (phase < 3) & (new == 3)).alias("second"),
            at("second_end", (phase == 3) & (new == 4)).alias("second_end"),
        )

    return F.aggregate(kinds, begin, step)


def _between(gaps: Column, tokens: Column, start: Column, end: Column) -> Column:
    """The text after the token at `start` up to the one at `end`; -1 is the text's begin or end."""
    last = F.when(end < 0, F.size(tokens)).otherwise(end)
    return T.interleave(F.slice(gaps, start + 2, last - start), F.slice(tokens, start + 2, last - start - 1))


def _outer_fonts(cell: Column) -> Column:
    """Contents of the outermost font tags of size 2, whatever font tags they hold."""
    start = F.struct(
        F.lit(0).alias("depth"), F.lit("").alias("text"), F.expr("cast(array() as array<string>)").alias("done")
    )

    def step(acc: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)^<font\b"), piece.rlike(r"(?i)^</font\b")
        inside = acc["depth"] > 0
        depth = F.when(inside, acc["depth"] + opens.cast("int") - closes.cast("int")).otherwise(
            piece.rlike(FONT_OPEN).cast("int")
        )
        ends = inside & (depth == 0)
        text = F.when(inside & ~ends, F.concat(acc["text"], piece)).otherwise("")
        done = F.when(ends, F.concat(acc["done"], F.array(acc["text"]))).otherwise(acc["done"])
        return F.struct(depth.alias("depth"), text.alias("text"), done.alias("done"))

    return F.aggregate(F.regexp_extract_all(cell, F.lit(FONT_PIECE), F.lit(0)), start, step, lambda acc: acc["done"])


def _without_end(body: Column) -> Column:
    """A body without the document's closing tags, however many blanks stand between and after them."""
    return F.regexp_replace(body, DOCUMENT_END, "")


def split_document(documents: DataFrame) -> DataFrame:
    """Cut each document into heading, metadata cells and body; say why it cannot be cut.

    Adds `reject_reason`, `_first` and `_second` (the number cell and the one after it, NULL where they
    are missing) and `content` (the body as written). Whole texts are cut once, at table tags; tags in
    comments and scripts do not count. A metadata table that nothing closes holds all that follows.
    """
    cut = documents.withColumn("_tokens", H.table_tokens(F.col("html"))).withColumn("_gaps", H.table_gaps(F.col("html")))
    tokens, gaps = F.col("_tokens"), F.col("_gaps")
    cut = cut.withColumn("_kinds", F.transform(tokens, _kind)).withColumn("_table", _table_range(F.col("_kinds")))
    start, end = F.col("_table")["start"], F.col("_table")["end"]
    # Hidden parts are the tokens without a kind.
    shown = F.zip_with(tokens, "_kinds", lambda t, kind: F.when(kind == "", "").otherwise(t))
    cut = cut.withColumn("_shown", shown)
    before = F.regexp_extract(_between(gaps, F.col("_shown"), F.lit(-1), start), HEADING_DIV, 0)
    after = F.regexp_extract(_between(gaps, F.col("_shown"), start, F.lit(-1)), HEADING_DIV, 0)
    cut = cut.withColumn("_heading", T.let(before, lambda b: F.when((b != "") | (start < 0), b).otherwise(after)))
    heading_text = text_of(F.regexp_extract("_heading", HEADING_TEXT, 1))
    inner = F.slice("_kinds", start + 2, F.when(end < 0, F.size("_kinds")).otherwise(end) - start - 1)
    cut = (
        cut.withColumn("_heading_text", heading_text)
        .withColumn(
            "reject_reason",
            F.when(F.col("html").isNull(), "binary file")
            .when(F.col("_heading") == "", "no centred heading")
            .when(F.col("_heading_text") == "", "empty heading")
            .when(F.col("_heading_text") != HEADING, "other heading")
            .when(start < 0, "no metadata table"),
        )
        .withColumn("_cells", F.when(F.col("reject_reason").isNull(), _cell_ranges(inner)))
    )
    # Places among the table's inner tokens count from the one after its opening tag.
    place = lambda name: F.col("_cells")[name] + start + 1
    stop = lambda name: F.when(F.col("_cells")[name] < 0, end).otherwise(place(name))
    cell = lambda name: F.when(
        F.col("_cells")[name] >= 0, _between(gaps, F.col("_shown"), place(name), stop(f"{name}_end"))
    )
    body = F.when(end < 0, "").otherwise(_between(gaps, tokens, end, F.lit(-1)))
    return (
        cut.withColumn("_first", cell("first"))
        .withColumn("_second", cell("second"))
        .withColumn("content", F.when(F.col("reject_reason").isNull(), body))
        .withColumn("content", _without_end(F.col("content")))
        .drop("_tokens", "_gaps", "_shown", "_kinds", "_table", "_heading", "_heading_text", "_cells", "html")
    )


def page_metadata(documents: DataFrame, config: ArchiveConfig = ArchiveConfig()) -> DataFrame:
    """Title, page number, authors, categories and creation time of each document.

    Documents whose table lacks a field get a reject reason, never silent NULLs.
    """
    cells = split_document(documents)
    first, second = F.col("_first"), F.col("_second")
    plain = F.regexp_extract_all(second, F.lit(FONT_TAG), F.lit(0))
    fonts = F.when(second.rlike(NESTED_FONT), _outer_fonts(second)).otherwise(plain)
    # Number, created text, then the font tags: labels and values of title, authors, categories, date.
    found = F.array(F.regexp_extract(first, PAGE_NUMBER, 2), F.regexp_extract(first, CREATED_TEXT, 2))
    none = F.expr("cast(array() as array<string>)")
    fields = cells.withColumn("_f", F.transform(F.concat(found, F.coalesce(fonts, none)), text_of))
    field = lambda i: F.get("_f", F.lit(i))
    names = lambda i: F.transform(T.split_names(field(i), config.keep_blank_names), T.percent_decode)
    out = (
        fields.withColumn("page_no", field(0))
        .withColumn("title", field(3))
        .withColumn("authors", names(5))
        .withColumn("categories", names(7))
        .withColumn("created", parse_created(field(9), field(1)))
    )
    broken = F.when(F.col("_first").isNull(), "no number cell").when(
        F.size("_f") < 10, "missing metadata field"
    ).when(F.col("created").isNull(), "bad creation time")
    return out.withColumn("reject_reason", F.coalesce("reject_reason", broken)).drop(
        "_first", "_second", "_f"
    )


def page_key(title: Column, authors: Column, categories: Column, created: Column) -> Column:
    """Identity of a page: title, authors and categories as sets, creation time.

    Hashing every part first keeps the parts apart whatever characters they hold.
    """
    as_set = lambda names: F.array_join(
        F.transform(F.array_sort(F.array_distinct(names)), F.md5), ","
    )
    parts = [F.md5(title), as_set(authors), as_set(categories), post_date(created)]
    return F.md5(F.concat(*[x for part in parts for x in (part, F.lit("|"))][:-1]))


def document_links(path: Column, content: Column) -> Column:
    """Links of a body in document order, as an array of structs; `pos` counts the body's link tokens.

    Page links carry their key (the hash of the resolved path); media get theirs by a join.
    """
    tags = F.transform(
        H.link_tokens(content),
        lambda tag, i: F.struct(
            i.alias("pos"), H.tag_name(tag).alias("element"), F.when(H.is_link_tag(tag), H.link_target(tag)).alias("href")
        ),
    )
    kinds = F.transform(
        F.filter(tags, lambda t: t["href"].isNotNull()),
        lambda t: F.struct(
            t["pos"].alias("pos"),
            F.coalesce(H.link_kind(t["element"], t["href"]), F.lit("other")).alias("kind"),
            t["href"].alias("href"),
        ),
    )
    return T.let(
        T.dirname(path),
        lambda folder: F.transform(
            kinds,
            lambda t: F.struct(
                t["pos"].alias("pos"),
                t["kind"].alias("kind"),
                t["href"].alias("href"),
                F.when(t["kind"] != "other", T.resolve_in(folder, t["href"])).alias("ref_path"),
            ),
        ),
    )


def document_bodies(documents: DataFrame) -> DataFrame:
    """The cleaned body of each document: `path, content`, NULL for rejected ones.

    Callers join it to the valid paths. A filter here would repeat the extraction, because
    the optimizer moves it below the projections by copying them into it.
    """
    cut = split_document(documents)
    return cut.select("path", H.strip_top_links(F.col("content")).alias("content"))


def extract_documents(documents: DataFrame, config: ArchiveConfig = ArchiveConfig()) -> DataFrame:
    """What is known of each document short of its body: metadata, identity key and links."""
    pages = page_metadata(documents, config).withColumn("content", H.strip_top_links(F.col("content")))
    return (
        pages.withColumn(
            "page_key", page_key(F.col("title"), F.col("authors"), F.col("categories"), F.col("created"))
        )
        .withColumn("links", document_links(F.col("path"), F.col("content")))
        .drop("content")
    )


def explode_links(extracted: DataFrame) -> DataFrame:
    """One row per link: `page_path, pos, kind, href, ref_path, ref_hash`."""
    rows = extracted.select(F.col("path").alias("page_path"), F.explode("links").alias("l"))
    return rows.select("page_path", "l.*").withColumn(
        "ref_hash", F.when(F.col("kind") == "page", F.md5("ref_path"))
    )
