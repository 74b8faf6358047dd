"""HTML rules as Column expressions: tags, attributes and their rewriting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstack.functions.text import html_unescape, interleave, let

# Tags with quoted attributes are read to their real end; ones with odd quotes to the first ">".
# All alternatives share their first character, so that a search tries them only where it stands.
TAG_REST = r"""\b(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+>)"""
HIDDEN_REST = r"!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>"
HIDDEN = rf"(?is)<(?:{HIDDEN_REST})"
LINK_TOKEN = rf"(?is)<(?:{HIDDEN_REST}|(?:a|img){TAG_REST})"
HIDDEN_START = r"<(?:!--|(?i:script|style)\b)"
# Tags that decide where tables, rows and cells begin and end, and the parts in which no tag counts.
TABLE_TOKEN = rf"(?is)<(?:{HIDDEN_REST}|/?(?:table|tr|td|th){TAG_REST})"
TOP_LINK = (
    r"""(?s)<[aA]\b(?=[^>]*\s(?i:href)\s*=\s*(?:"[^">]*#top"|'[^'>]*#top'|[^\s>"']*#top[\s>]))[^>]*>top</[aA]\s*>"""
)


def attribute_pattern(name: str) -> str:
    return rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute as written, without its quotes; NULL when absent."""
    quoted = F.regexp_extract(tag, attribute_pattern(name), 1)
    return let(
        quoted,
        lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substring(v, F.lit(2), F.length(v) - 2)).when(v != "", v),
    )


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute with its entities resolved; NULL when absent."""
    return html_unescape(raw_attribute(tag, name))


def tag_name(tag: Column) -> Column:
    """Element of a link tag: its names are `a` and `img` only."""
    return F.when(F.lower(F.substring(tag, 2, 1)) == "a", "a").otherwise("img")


def link_target(tag: Column) -> Column:
    """What a link tag points to: `href` of ``a``, `src` of ``img``; NULL when it has none."""
    is_a = tag_name(tag) == "a"
    return html_unescape(F.when(is_a, raw_attribute(tag, "href")).otherwise(raw_attribute(tag, "src")))


def with_attribute(tag: Column, name: str, value: Column) -> Column:
    """The tag with one attribute set, its name lower-cased and its value double-quoted."""
    parts = F.split(tag, attribute_pattern(name), 2)
    before = F.regexp_replace(F.get(parts, 0), r"(?i)^<(?:a|img)", "")
    return F.concat(F.lit("<"), tag_name(tag), before, F.lit(f' {name}="'), value, F.lit('"'), F.get(parts, 1))


def strip_top_links(html: Column) -> Column:
    """The text without its "top" links, at any depth."""
    return F.when(F.contains(html, F.lit("#top")), F.regexp_replace(html, TOP_LINK, "")).otherwise(html)


def link_kind(element: Column, target: Column) -> Column:
    """page, attachment or image; NULL for links that are left alone."""
    return (
        F.when((element == "a") & target.endswith("OpenDocument"), "page")
        .when((element == "a") & F.contains(target, F.lit("$FILE")), "attachment")
        .when((element == "img") & target.isNotNull(), "image")
    )


def visible(html: Column) -> Column:
    """The text without its comments, scripts and styles."""
    return F.when(html.rlike(HIDDEN_START), F.regexp_replace(html, HIDDEN, "")).otherwise(html)


def table_tokens(html: Column) -> Column:
    """Table, row and cell tags and all hidden parts in document order, as text."""
    return F.regexp_extract_all(html, F.lit(TABLE_TOKEN), F.lit(0))


def table_gaps(html: Column) -> Column:
    """The texts before, between and after the table tokens."""
    return F.split(html, TABLE_TOKEN, -1)


def tag_word(token: Column) -> Column:
    """How a tag begins, in lower case: ``<td``, ``</td``; empty for hidden parts."""
    first = F.lower(F.regexp_extract(token, r"^</?[A-Za-z]+", 0))
    return let(first, lambda word: F.when(word.isin("<script", "<style"), "").otherwise(word))


def link_tokens(html: Column) -> Column:
    """All ``a`` and ``img`` tags and all hidden parts in document order, as text."""
    return F.regexp_extract_all(html, F.lit(LINK_TOKEN), F.lit(0))


def with_link_tokens(html: Column, tokens: Column) -> Column:
    """The text with its link tokens replaced, one by one in their order."""
    return interleave(F.split(html, LINK_TOKEN, -1), tokens)


def is_link_tag(token: Column) -> Column:
    """Whether a link token is a tag and no comment, script or style."""
    return F.lower(F.substring(token, 2, 1)).isin("a", "i")


def link_tags(html: Column) -> Column:
    """All visible ``a`` and ``img`` tags in document order, as text."""
    return F.filter(link_tokens(html), is_link_tag)
