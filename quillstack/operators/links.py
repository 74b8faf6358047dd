"""Links: resolution through the path map, merging into pages, rewriting in bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.functions.html import is_link_tag, link_tokens, tag_name, with_attribute, with_link_tokens
from quillstack.functions.text import dense, let
from quillstack.operators.skew import lookup
from quillstack.sources.workspace import Workspace

MEDIA_KINDS = ("attachment", "image")
KEY_IN_BODY = r"(?:href|src)=\"([0-9a-f]{32})\""


def resolve_links(ws: Workspace, links: DataFrame, path_map: DataFrame) -> DataFrame:
    """Links with the page they lead to (`target_key`) and their key; NULL when no page has the path."""
    targets = path_map.select(F.col("path").alias("page_ref"), F.col("page_key").alias("target_key"))
    asked = links.withColumn("page_ref", F.when(F.col("kind") == "page", F.col("ref_path")))
    found = lookup(ws, asked, targets, "page_ref", "left")
    return found.withColumn("link_key", F.md5("page_ref")).drop("page_ref")


def resolve_media(ws: Workspace, links: DataFrame, media: DataFrame) -> DataFrame:
    """Links with the hash of the file they show (`file_hash`), NULL when the file is missing."""
    files = media.select(F.col("path").alias("media_ref"), "file_hash")
    asked = links.withColumn("media_ref", F.when(F.col("kind").isin(*MEDIA_KINDS), F.col("ref_path")))
    return lookup(ws, asked, files, "media_ref", "left").drop("media_ref")


def dangling_links(resolved: DataFrame) -> DataFrame:
    return resolved.where("kind = 'page' and target_key is null").select("page_path", "pos", "href", "ref_path")


def merge_links(refs: DataFrame, by: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """References of a page and its responses, one per (page, kind, key).

    The page's own reference wins, then the earliest response's; within one document the
    last. `refs` carry `role` (0 page, 1 response) and the response's place.
    """
    rank = F.struct("role", "first_file", "first_pos", (-F.col("pos")).alias("neg_pos"))
    payload = [c for c in ("ref_path", "target_key", "page_order", "created") if c in refs.columns]
    first = F.min(F.struct(rank.alias("rank"), *payload, "page_path")).alias("f")
    return (
        refs.where("ref_key is not null")
        .groupBy(*by, "kind", "ref_key")
        .agg(first, F.count("*").alias("n_refs"))
        .select(
            *by,
            "kind",
            "ref_key",
            *[F.col(f"f.{c}").alias(c) for c in payload],
            F.col("f.page_path").alias("owner_path"),
            (F.col("f.rank.role") == 1).alias("from_response"),
            "n_refs",
        )
    )


def _sparse(pos: str, value: Column) -> Column:
    return F.struct(F.col(pos).cast("int").alias("pos"), value.alias("value"))


def _link_attribute(tag: Column, value: Column) -> Column:
    is_a = tag_name(tag) == "a"
    return F.when(is_a, with_attribute(tag, "href", value)).otherwise(with_attribute(tag, "src", value))


def page_keys(links: Column) -> Column:
    """From a document's links array: the places of its page links and their keys."""
    pages = F.filter(links, lambda t: t["kind"] == "page")
    return F.transform(pages, lambda t: F.struct(t["pos"].alias("pos"), F.md5(t["ref_path"]).alias("value")))


def keyed_bodies(bodies: DataFrame, links: DataFrame, media_refs: DataFrame) -> DataFrame:
    """Bodies with each resolvable link's target replaced by its key.

    `bodies` (path, content) are joined by their unique path, so they are shuffled once. A body is cut
    at its link tokens, each tag gets the key of its place, and the parts are joined again.
    """
    # Bounded: a group is the media tags of one document's own text.
    media = media_refs.where("ref_key is not null").groupBy(F.col("page_path").alias("path")).agg(
        F.collect_list(_sparse("pos", F.col("ref_key"))).alias("media_keys")
    )
    own = links.select("path", page_keys(F.col("links")).alias("page_keys")).join(media, "path", "left")
    none = F.expr("cast(array() as array<struct<pos int, value string>>)")
    keys = F.concat("page_keys", F.coalesce("media_keys", none))
    keyed = lambda tag, key: F.when(key.isNull(), tag).otherwise(_link_attribute(tag, key))
    body = F.col("content")
    tokens = let(link_tokens(body), lambda t: F.zip_with(t, dense(F.size(t), keys), keyed))
    return bodies.join(own, "path").select("path", with_link_tokens(body, tokens).alias("content"))


def body_keys(bodies: DataFrame) -> DataFrame:
    """The link keys in each body: `body_id, pos, key`; `pos` counts the body's link tokens."""
    tags = bodies.select("body_id", F.posexplode(link_tokens(F.col("content"))).alias("pos", "tag"))
    keys = tags.where(is_link_tag(F.col("tag"))).select("body_id", "pos", F.regexp_extract("tag", KEY_IN_BODY, 1).alias("key"))
    return keys.where("key <> ''")


def url_targets(page_urls: DataFrame, media_urls: DataFrame) -> DataFrame:
    """The URLs that link keys stand for, one row per key: `key, page_url, media_url`."""
    none = F.lit(None).cast("string")
    pages = page_urls.select("key", F.col("url").alias("page_url"), none.alias("media_url"))
    both = pages.unionByName(media_urls.select("key", none.alias("page_url"), F.col("url").alias("media_url")))
    return both.groupBy("key").agg(F.max("page_url").alias("page_url"), F.max("media_url").alias("media_url"))


URL = "struct<key:string,page:string,media:string>"


def body_urls(ws: Workspace, keys: DataFrame, targets: DataFrame) -> DataFrame:
    """Per body, the URLs of its keys by their places: `body_id, urls`."""
    found = lookup(ws, keys, targets, "key", "inner")
    url = F.struct("key", "page_url", "media_url").cast(URL)
    # Bounded: a group is the keys of one body's own text.
    return found.groupBy("body_id").agg(F.collect_list(_sparse("pos", url)).alias("urls"))


def _with_url(tag: Column, url: Column) -> Column:
    """A tag with its key replaced: page keys only right after ``<a``, media keys in any place."""
    quoted = lambda name, value: F.concat(F.lit(f'{name}="'), value, F.lit('"'))
    swap = lambda name, new: F.replace(tag, quoted(name, url["key"]), quoted(name, new))
    is_page = url["page"].isNotNull() & tag.startswith(quoted("<a href", url["key"]))
    return (
        F.when(is_page, swap("href", url["page"]))
        .when(url["media"].isNull(), tag)
        .when(tag_name(tag) == "a", swap("href", url["media"]))
        .otherwise(swap("src", url["media"]))
    )


def rewrite_bodies(bodies: DataFrame, urls: DataFrame) -> DataFrame:
    """Bodies with their keys replaced by URLs; bodies without keys pass unchanged."""
    joined = bodies.join(urls, "body_id", "left")
    new = lambda tag, url: F.when(url.isNull(), tag).otherwise(_with_url(tag, url))
    body = F.col("content")
    tokens = let(link_tokens(body), lambda t: F.zip_with(t, dense(F.size(t), F.col("urls"), URL), new))
    content = F.when(F.col("urls").isNull(), body).otherwise(with_link_tokens(body, tokens))
    return joined.withColumn("content", F.coalesce(content, F.lit(""))).drop("urls")
