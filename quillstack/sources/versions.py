"""Folders that are replaced as a whole: every write is a version of its own, one file names the current one.

A reader resolves the name once and then reads that version only, so it never sees half of a new
write; a write that fails leaves the old version current. The version before the current one stays
for readers that still hold it, older ones are deleted when a new one is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER = "CURRENT"
PREFIX = "version-"


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, folder: str) -> str:
    """Make a folder; returns its path with its scheme, as tasks need it."""
    files, path = _files(spark, folder), _path(spark, folder)
    files.mkdirs(path)
    return files.makeQualified(path).toString()


def local_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders a path or pattern names, with their scheme and none twice; empty if one is no local or mounted folder."""
    found = _files(spark, pattern).globStatus(_path(spark, pattern)) or []
    names = [status.getPath().toString() for status in found if status.isDirectory()]
    if len(names) < len(found) or not all(name.startswith("file:") for name in names):
        return []
    # A pattern may name a folder and one in it.
    return [name for name in names if not any(name.startswith(f"{other.rstrip('/')}/") for other in names if other != name)]


def current(spark: SparkSession, folder: str) -> str:
    """The folder of the current version."""
    folder = folder.rstrip("/")
    if not _files(spark, folder).exists(_path(spark, f"{folder}/{POINTER}")):
        raise FileNotFoundError(f"nothing has been published in {folder}")
    return f"{folder}/{spark.read.text(f'{folder}/{POINTER}').first()[0]}"


def publish(spark: SparkSession, folder: str, version: str) -> None:
    """Make a written version the current one: the pointer file is replaced in one rename."""
    folder, jvm = folder.rstrip("/"), spark._jvm
    files = _files(spark, folder)
    pointer, fresh = _path(spark, f"{folder}/{POINTER}"), _path(spark, f"{folder}/.{POINTER}-{version}")
    before = current(spark, folder).rsplit("/", 1)[1] if files.exists(pointer) else None
    out = files.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(pointer), overwrite)
    for status in files.listStatus(_path(spark, folder)):
        name = status.getPath().getName()
        if name.startswith(PREFIX) and name not in (version, before):
            files.delete(status.getPath(), True)


def replace(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """Write a new version with `write(its folder)` and, if that succeeds, make it current; returns its folder."""
    version = f"{PREFIX}{uuid.uuid4().hex}"
    target = f"{folder.rstrip('/')}/{version}"
    write(target)
    publish(spark, folder, version)
    return target
