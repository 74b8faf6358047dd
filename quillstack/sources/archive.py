"""The stored archive: nested page rows as XML, name lists and the media manifest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from quillstack.functions.dates import epoch_seconds, from_epoch
from quillstack.operators.skew import running_total
from quillstack.sources import ranges, versions
from quillstack.sources.workspace import Workspace

# Characters XML 1.0 has no form for.
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"

#: Column with the text of a row that cannot be read.
DAMAGED = "_damaged"

NAMES = "struct<{0}:array<string>>"
REFS = "struct<{0}:array<struct<_path:string,_VALUE:string>>>"
RESPONSE = (
    "struct<_path:string,_file:string,_pos:bigint,created:bigint,"
    "authors:struct<author:array<string>>,content:string>"
)
PAGE_SCHEMA = (
    "_key string, _part string, _order bigint, _orphan boolean, _path string, title string, page string, "
    f"created bigint, authors {NAMES.format('author')}, categories {NAMES.format('category')}, content string, "
    f"attachments {REFS.format('attachment')}, images {REFS.format('image')}, urls {REFS.format('url')}, "
    f"responses struct<response:array<{RESPONSE}>>"
)
MANIFEST_SCHEMA = (
    "file_hash string, src_path string, archive_name string, created bigint, first_page_key string, "
    "first_kind string, n_refs bigint"
)


def xml_safe(column: Column, kind: DataType) -> Column:
    """A column whose texts hold only characters that XML can carry; others become U+FFFD."""
    if isinstance(kind, StringType):
        return F.regexp_replace(column, NOT_XML, "\ufffd")
    if isinstance(kind, ArrayType):
        return F.transform(column, lambda x: xml_safe(x, kind.elementType))
    if isinstance(kind, StructType):
        fields = F.struct(*[xml_safe(column.getField(f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(column.isNotNull(), fields)
    return column


def write_xml(df: DataFrame, path: str, root: str, row: str, *folders: str) -> None:
    """Write rows as XML parts; `folders` are columns that name folders. Sorted tasks keep their order."""
    texts = [f for f in df.schema if f.name not in folders]
    safe = df.select(*folders, *[xml_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in texts])
    writer = safe.write.mode("overwrite").format("xml").partitionBy(*folders)
    writer.option("rootTag", root).option("rowTag", row).option("ignoreSurroundingSpaces", "false").save(path)


#: Bytes of an XML part beside its rows: the declaration and the root tags.
PART_FRAME = 256
#: Most bytes that a column adds to its row beside its text and twice its name: tag signs, indent, line end.
COLUMN_FRAME = 16


def xml_bytes(df: DataFrame) -> Column:
    """At least the bytes that each row of flat columns takes in an XML part."""
    sizes = []
    for f in df.schema:
        text = F.col(f"`{f.name}`").cast("string")
        # A character that is written as a reference takes up to six bytes instead of one.
        escaped = F.octet_length(text) + 5 * F.regexp_count(text, F.lit("[&<>\"'\r]"))
        # What XML cannot carry becomes a character of three bytes.
        replaced = 2 * F.regexp_count(text, F.lit(NOT_XML))
        sizes.append(F.coalesce(escaped + replaced, F.lit(0)) + 2 * len(f.name) + COLUMN_FRAME)
    return sum(sizes, F.lit(0)).cast("bigint")


def write_xml_parts(
    ws: Workspace, df: DataFrame, path: str, root: str, row: str, order: Sequence[str], max_bytes: int
) -> None:
    """Write rows in order as XML parts of at most `max_bytes` each, or of one row that is larger.

    Parts are the folders `part=<number>`, each with one file. Half the limit cuts the running total of
    the rows' sizes into stretches; rows of more than half are parts of their own, and each is the last
    of its stretch, so no part is over the limit and their numbers follow the rows' order.
    """
    half = max(1, (max_bytes - PART_FRAME) // 2)
    keys = [F.col(c) for c in order]
    sized = df.select(*order, xml_bytes(df).alias("_size"))
    placed = running_total(ws, sized, keys, F.col("_size"), "_before", "part-sizes")
    part = 2 * F.floor(F.col("_before") / half) + (F.col("_size") > half).cast("bigint")
    numbered = placed.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)], F.lpad(part.cast("string"), 12, "0").alias("part"))
    same = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(c)) for i, c in enumerate(order)])
    rows = df.join(numbered, same).drop(*[f"_k{i}" for i in range(len(order))])
    write_xml(rows.repartition("part").sortWithinPartitions("part", *order), path, root, row, "part")


def _read_xml(spark: SparkSession, path: str, row: str, schema: str, strict: bool = True) -> DataFrame:
    """Rows of XML files. A row that is no sound XML fails a strict read; else its text is in `DAMAGED`."""
    schema = schema if strict else f"{schema}, {DAMAGED} string"
    reader = spark.read.schema(schema).format("xml").option("rowTag", row)
    reader = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED)
    return reader.option("ignoreSurroundingSpaces", "false").load(path)


def write_names(names: DataFrame, path: str, row: str) -> None:
    """A dimension list: one element per name."""
    write_xml(names.select(F.col("name").alias("name")), path, f"{row}s", row)


def read_names(spark: SparkSession, path: str, row: str) -> DataFrame:
    return _read_xml(spark, path, row, "name string")


def write_archive(
    folder: str,
    pages: DataFrame,
    authors: DataFrame,
    categories: DataFrame,
    manifest: DataFrame,
    problems: dict[str, DataFrame],
    media: DataFrame | None = None,
) -> None:
    """Replace the stored archive: pages, name lists, manifest and, as Parquet, the run's problems.

    With `media` (uri, file_hash, name), the files themselves are copied too, into `files`, and the
    copies are listed in `copies`.

    All of it becomes visible at once, when every table is written; until then, and if one fails,
    readers get the archive that was there before.
    """

    def write(target: str) -> None:
        write_xml(pages, f"{target}/pages", "pages", "page")
        write_names(authors, f"{target}/authors", "author")
        write_names(categories, f"{target}/categories", "category")
        write_xml(manifest.withColumn("created", epoch_seconds(F.col("created"))), f"{target}/media", "files", "file")
        for name, table in problems.items():
            table.write.mode("overwrite").parquet(f"{target}/problems/{name}")
        if media is not None:
            copies = ranges.copied(media.repartition("file_hash"), versions.make_folder(spark, f"{target}/files"))
            copies.write.mode("overwrite").parquet(f"{target}/copies")

    spark = pages.sparkSession
    versions.replace(spark, folder, write)


def scan_archive(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    """Stored pages, one row per `page` element; a page with very many responses has several.

    Rows of damaged files that cannot be read are left out (see `damaged_rows`); `strict` fails on them.
    """
    rows = _read_xml(spark, f"{versions.current(spark, folder)}/pages", "page", PAGE_SCHEMA, strict)
    # The reader wants a second column beside the record, also where none is asked for; every page has a key.
    return rows if strict else rows.where(F.col(DAMAGED).isNull() & F.col("_key").isNotNull()).drop(DAMAGED)


def damaged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What a scan of the stored pages leaves out: `file, record`."""
    rows = _read_xml(spark, f"{versions.current(spark, folder)}/pages", "page", PAGE_SCHEMA, False)
    found = rows.withColumn("file", F.input_file_name()).where(F.col(DAMAGED).isNotNull() | F.col("_key").isNull())
    return found.select("file", F.coalesce(DAMAGED, F.lit("")).alias("record"))


def scan_manifest(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read_xml(spark, f"{versions.current(spark, folder)}/media", "file", MANIFEST_SCHEMA)
    return rows.withColumn("created", from_epoch(F.col("created")))


def _list(column: str):
    return F.coalesce(F.col(column), F.expr("cast(array() as array<string>)"))


def stored_pages(stored: DataFrame) -> DataFrame:
    """Page rows of an archive scan."""
    return stored.where("_part = ''").select(
        F.col("_key").alias("page_key"),
        F.col("_order").alias("page_order"),
        F.col("_orphan").alias("is_orphan"),
        F.col("_path").alias("path"),
        "title",
        F.col("page").alias("page_no"),
        _list("authors.author").alias("authors"),
        _list("categories.category").alias("categories"),
        from_epoch(F.col("created")).alias("created"),
        F.coalesce("content", F.lit("")).alias("content"),
    )


def stored_responses(stored: DataFrame) -> DataFrame:
    rows = stored.select(F.col("_key").alias("page_key"), F.explode("responses.response").alias("r"))
    return rows.select(
        "page_key",
        F.col("r._path").alias("path"),
        F.col("r._file").alias("first_file"),
        F.col("r._pos").alias("first_pos"),
        _list("r.authors.author").alias("authors"),
        from_epoch(F.col("r.created")).alias("created"),
        F.coalesce(F.col("r.content"), F.lit("")).alias("content"),
    )


def stored_links(stored: DataFrame) -> DataFrame:
    """Distinct links of the stored pages: `page_key, kind, ref_key, target`."""
    def rows(column: str, kind: str) -> DataFrame:
        r = stored.select(F.col("_key").alias("page_key"), F.explode(column).alias("r"))
        return r.select(
            "page_key", F.lit(kind).alias("kind"), F.col("r._VALUE").alias("ref_key"), F.col("r._path").alias("target")
        )

    return (
        rows("urls.url", "page")
        .unionByName(rows("attachments.attachment", "attachment"))
        .unionByName(rows("images.image", "image"))
        .distinct()
    )
