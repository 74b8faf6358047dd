"""File sources: contents listings, documents and media as (path, bytes) tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.functions.text import basename, decode_bytes, join_path, normalise_path
from quillstack.sources import ranges, versions
from quillstack.sources.workspace import Workspace

# Fixed value: how mirrored document files are named.
DOCUMENT_GLOB = "*?OpenDocument*"
DOCUMENT_NAME = r"(?s).OpenDocument"
#: Larger files are not read: a row holds 2 GiB less a few bytes, and the path needs room too.
MAX_FILE_BYTES = (1 << 31) - (1 << 20)
#: Larger media files are hashed as streams, so that no task needs the memory for one whole.
WHOLE_BYTES = 64 << 20
#: Larger listings and documents are not read, as decoding can double their size.
MAX_TEXT_BYTES = 1 << 30
#: A file's size by the listing: a scan that asks for some sizes opens no other file.
SIZE = "_metadata.file_size"
#: Most folders that a task lists, and most files that a task reads, before dealing them by hash makes that uneven.
TASK_FOLDERS = 1000
TASK_FILES = 4096


def file_path(uri: Column) -> Column:
    """Path part of a file URI. File names are taken as they are: Spark does not encode them."""
    return F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*(?=/))?", "")


def _files(spark: SparkSession, folder: str, glob: str, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)


class Listing(NamedTuple):
    """Files of local or mounted folders as a kept table `uri, n_bytes, modified`, with what its tasks have counted."""

    files: DataFrame
    n_files: int
    total_bytes: int

    def dealt(self, files: DataFrame) -> DataFrame:
        """Some of the files, over as many tasks as reading all of them needs."""
        spark = files.sparkSession
        split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        least = min(self.n_files, spark.sparkContext.defaultParallelism)
        return files.repartition(max(1, least, -(-self.n_files // TASK_FILES), -(-self.total_bytes // split)), "uri")


def _listed(spark: SparkSession, folder: str, glob: str) -> Listing | None:
    """What Spark's own recursive scan of a folder finds; None if that is no local or mounted folder or the session skips bad files.

    Spark's scan holds every file's status and its place in a task in the driver. Here the tasks list one level
    of folders after another, each into a kept table, and the driver gets their counts only.
    """
    folders = versions.local_folders(spark, folder)
    if not folders or "true" in [spark.conf.get(f"spark.sql.files.ignore{kind}Files") for kind in ("Missing", "Corrupt")]:
        return None
    ws = Workspace(spark)
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    wanted = ~F.col("is_folder") & (F.col("n_bytes") > 0) & basename(F.col("uri")).rlike(rf"(?s)\A(?:{pattern})\z")
    metrics = {
        "folders": F.count_if("is_folder"),
        "files": F.count_if(wanted),
        "bytes": F.sum(F.when(wanted, F.col("n_bytes"))),
    }
    level, n_folders = spark.createDataFrame([(f.rstrip("/"),) for f in folders], "uri string"), len(folders)
    files, sums = None, dict.fromkeys(metrics, 0)
    while n_folders:
        counts: dict[str, int] = {}
        tasks = max(min(n_folders, spark.sparkContext.defaultParallelism), -(-n_folders // TASK_FOLDERS))
        found = ws.keep(ranges.entries(level.repartition(tasks, "uri")), "listing", metrics, counts)
        if counts["files"] or files is None:
            own = found.where(wanted).select("uri", "n_bytes", "modified")
            files = own if not sums["files"] else files.unionByName(own)
        sums = {k: n + counts[k] for k, n in sums.items()}
        level, n_folders = found.where("is_folder").select("uri"), counts["folders"]
    return Listing(files, sums["files"], sums["bytes"])


def read_files(
    spark: SparkSession, folder: str, glob: str, recursive: bool = True, max_bytes: int | None = None
) -> DataFrame:
    """Files under a folder: `path, content, n_bytes, modified`. Columns not used are not read.

    Files over `max_bytes` (`MAX_FILE_BYTES` unless given) keep their row but have no content, as one
    value cannot hold it: such a document or listing is rejected as unreadable.
    """
    max_bytes = MAX_FILE_BYTES if max_bytes is None else max_bytes
    columns = {
        "path": file_path(F.col("path")),
        "content": F.col("content"),
        "n_bytes": F.col("length"),
        "modified": F.col("modificationTime"),
    }
    rows = lambda df, **other: df.select(*[c.alias(k) for k, c in (columns | other).items()])
    if not recursive or not (listing := _listed(spark, folder, glob)):
        files = _files(spark, folder, glob, recursive)
        large = rows(files.where(F.col(SIZE) > max_bytes), content=F.lit(None).cast("binary"))
        return rows(files.where(F.col(SIZE) <= max_bytes)).unionByName(large)
    content = ranges.reader()(F.when(F.col("n_bytes") <= max_bytes, F.col("uri")))
    return listing.dealt(listing.files).select(file_path(F.col("uri")).alias("path"), content.alias("content"), "n_bytes", "modified")


def scan_contents(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Contents listings matching a file name pattern: `contents_file` (the path), `html`."""
    files = read_files(spark, folder, glob, recursive=False, max_bytes=MAX_TEXT_BYTES)
    return files.select(F.col("path").alias("contents_file"), decode_bytes(F.col("content")).alias("html"))


def scan_documents(spark: SparkSession, folder: str, glob: str = DOCUMENT_GLOB) -> DataFrame:
    """All documents under the root folder: `path, content`."""
    return read_files(spark, folder, glob, max_bytes=MAX_TEXT_BYTES).select("path", "content")


def scan_media(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files that pages show: `path, uri, file_hash, n_bytes, head`. Documents are left out.

    All are hashed as streams in local and mounted folders; in other stores those up to `WHOLE_BYTES` as values of
    one scan. A larger file that cannot be read has no hash, a smaller one ends the run.
    """
    named = lambda column: ~basename(file_path(F.col(column))).rlike(DOCUMENT_NAME)
    if listing := _listed(spark, folder, glob):
        media = listing.files.where(named("uri"))
        small = ranges.hashed(listing.dealt(media.where(F.col("n_bytes") <= WHOLE_BYTES)), strict=True)
        large = media.where(F.col("n_bytes") > WHOLE_BYTES).select("uri")
    else:
        media = _files(spark, folder, glob, True).where(named("path"))
        small = media.where(F.col(SIZE) <= WHOLE_BYTES).select(
            F.col("path").alias("uri"), F.md5("content").alias("file_hash"), F.col("length").alias("n_bytes"),
            F.substring("content", 1, ranges.HEAD_BYTES).alias("head"),
        )
        large = media.where(F.col(SIZE) > WHOLE_BYTES).select(F.col("path").alias("uri"))
    # Few files but long work: as many tasks as a shuffle has.
    found = small.unionByName(ranges.hashed(large.repartition("uri")))
    return found.withColumn("path", file_path(F.col("uri")))


def in_archive(files: DataFrame, folder: str, root_dir: str) -> DataFrame:
    """Rebase file paths from the scanned folder to the archive's root directory."""
    relative = F.expr(f"substring(path, {len(folder.rstrip('/')) + 2})")
    return files.withColumn("path", normalise_path(join_path(F.lit(root_dir), relative)))


def write_texts(spark: SparkSession, texts: DataFrame, folder: str) -> None:
    """Write every text of the one column `texts` as a file `part-*.txt` with a line end, in folders below a new one.

    NULL is an empty text. Spark's own writer starts a `chmod` process for every local file and moves the
    files one by one in the driver, so in local and mounted folders the tasks write them as streams.
    """
    name = texts.columns[0]
    target = versions.make_folder(spark, folder)
    if target.startswith("file:"):
        lines = texts.select(F.concat(F.coalesce(name, F.lit("")).cast("binary"), F.lit(b"\n")).alias("line"))
        ranges.written(lines, target).write.format("noop").mode("overwrite").save()
    else:
        part = F.substring(F.md5(name), 1, 2).alias("part")
        writer = texts.select(part, name).write.mode("append").partitionBy("part")
        writer.option("maxRecordsPerFile", 1).text(target)
