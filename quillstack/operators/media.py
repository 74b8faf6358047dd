"""Media files: hash, type and the deduplicated manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.functions.text import clean_filename, extension, media_type


def hash_media(media: DataFrame) -> DataFrame:
    """Content hash, type and size of every file, each read once.

    `media` holds either contents (`path, content`) or what a scan has hashed (`path, uri, file_hash,
    n_bytes, head`).
    """
    if "file_hash" in media.columns:
        return media.select("path", "file_hash", media_type(F.col("head")).alias("mime"), "n_bytes", "uri")
    return media.select(
        "path",
        F.md5("content").alias("file_hash"),
        media_type(F.col("content")).alias("mime"),
        F.length("content").cast("bigint").alias("n_bytes"),
    )


def archive_name(file_hash: Column, path: Column) -> Column:
    return F.concat(file_hash, extension(clean_filename(path)))


def page_media(merged: DataFrame) -> DataFrame:
    """Media of each page: attachments, then images."""
    kinds = F.when(F.col("kind") == "attachment", 0).when(F.col("kind") == "image", 1)
    return (
        merged.withColumn("kind_rank", kinds)
        .where("kind_rank is not null")
        .withColumnRenamed("ref_key", "file_hash")
        .withColumnRenamed("ref_path", "src_path")
    )


def media_manifest(media_refs: DataFrame) -> DataFrame:
    """One row per content hash: the first reference by page order, attachments first."""
    first = F.min(
        F.struct("page_order", "kind_rank", "src_path", "kind", "page_key", "created")
    ).alias("f")
    manifest = media_refs.groupBy("file_hash").agg(first, F.count("*").alias("n_refs"))
    return manifest.select(
        "file_hash",
        F.col("f.src_path").alias("src_path"),
        archive_name(F.col("file_hash"), F.col("f.src_path")).alias("archive_name"),
        F.col("f.created").alias("created"),
        F.col("f.page_key").alias("first_page_key"),
        F.col("f.kind").alias("first_kind"),
        "n_refs",
    )


def media_sources(manifest: DataFrame, hashed: DataFrame) -> DataFrame:
    """One stored file for each name of the manifest: `uri, file_hash, name`."""
    stored = hashed.where("file_hash is not null").groupBy("file_hash").agg(F.min("uri").alias("uri"))
    names = manifest.select("file_hash", F.col("archive_name").alias("name"))
    return stored.join(names, "file_hash").select("uri", "file_hash", "name")
