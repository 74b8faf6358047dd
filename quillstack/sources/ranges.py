"""Files of any size, read and copied as streams of bounded ranges inside the tasks; many small ones listed, read and written.

A streamed file is never one value: a task holds `RANGE_BYTES` of it at a time. Local and mounted files and
the stores that Arrow's file systems know can be read so; a file in another store has no hash and is
reported as unreadable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_BYTES = 1 << 20
#: Leading bytes that are kept of each file, for its media type.
HEAD_BYTES = 1 << 12
#: Most files that `written` puts into one folder.
FOLDER_FILES = 1000
#: Rows of a batch that holds names or leading bytes, and bytes of one that holds whole files, unless one file has more.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def _tools():
    """Functions for the tasks; defined inside, so that they travel with them."""
    import hashlib
    import re

    range_bytes, head_bytes, folder_files = RANGE_BYTES, HEAD_BYTES, FOLDER_FILES

    def located(uri: str):
        """File system and path of a URI as Spark gives it, with its file name not encoded."""
        from pyarrow import fs

        scheme, authority, path = re.match(r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(.*)$", uri).groups()
        if scheme in (None, "file"):
            return fs.LocalFileSystem(), path
        system, base = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
        return system, base.rstrip("/") + path

    def pieces(uri: str):
        system, path = located(uri)
        with system.open_input_stream(path, compression=None) as stream:
            while piece := stream.read(range_bytes):
                yield piece

    def digest(uri: str, strict: bool = False):
        """Hash, size and leading bytes of a file; nothing if it cannot be read, unless `strict`."""
        seen, size, head = hashlib.md5(usedforsecurity=False), 0, b""
        try:
            for piece in pieces(uri):
                seen.update(piece)
                size += len(piece)
                head += piece[: head_bytes - len(head)]
        except (OSError, pa.ArrowException):
            if strict:
                raise
            return None, None, None
        return seen.hexdigest(), size, head

    def copy(uri: str, target: str, scratch: str, file_hash: str) -> int:
        """Copy a file under its final name in one move; a copy that breaks off leaves no file there."""
        system, final = located(target)
        _, partial = located(scratch)
        seen, size = hashlib.md5(usedforsecurity=False), 0
        try:
            with system.open_output_stream(partial, compression=None) as out:
                for piece in pieces(uri):
                    seen.update(piece)
                    size += len(piece)
                    out.write(piece)
            if seen.hexdigest() != file_hash:
                raise OSError(f"{uri} changed while it was archived")
            system.move(partial, final)
        except BaseException:
            if system.get_file_info(partial).type.name == "File":
                system.delete_file(partial)
            raise
        return size

    def write(values, target: str, scratch: str) -> int:
        """Every value as a file `<number>/part-<number>.txt` of the folder `target`, which appears in one move.

        Returns their number. Without values there is no folder; one that is there already stays.
        """
        system, final = located(target)
        _, partial = located(scratch)
        n = 0
        try:
            for n, value in enumerate(values, 1):
                folder = f"{partial}/{(n - 1) // folder_files:06d}"
                if (n - 1) % folder_files == 0:
                    system.create_dir(folder)
                with system.open_output_stream(f"{folder}/part-{n:09d}.txt", compression=None) as out:
                    out.write(value)
            if n and system.get_file_info(final).type.name == "NotFound":
                try:
                    system.move(partial, final)
                except OSError:
                    # Another attempt of the same task was first: its files are the same.
                    if system.get_file_info(final).type.name != "Directory":
                        raise
        finally:
            if system.get_file_info(partial).type.name == "Directory":
                system.delete_dir(partial)
        return n

    return digest, copy, write


def entries(folders: DataFrame) -> DataFrame:
    """What local or mounted `folders (uri)` hold: `uri, is_folder, n_bytes, modified`.

    As in Spark's own listing, links are followed, and hidden names, names that are not UTF-8 and what is
    gone or may not be looked at are left out.
    """
    batch_rows = BATCH_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import errno
        import itertools
        import os

        names, types = ["uri", "is_folder", "n_bytes", "modified"], [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", "UTC")]

        def hidden(name: str, is_folder: bool) -> bool:
            if is_folder and name.startswith(("_metadata", "_common_metadata")):
                return False
            return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")

        def rows():
            for uri in (u for batch in batches for u in batch.column(0).to_pylist()):
                with os.scandir(uri.removeprefix("file:") or "/") as found:
                    for entry in found:
                        try:
                            entry.name.encode()
                            is_folder, stat = entry.is_dir(), entry.stat()
                        except (UnicodeEncodeError, FileNotFoundError, PermissionError):
                            continue
                        except OSError as error:
                            if error.errno == errno.ELOOP:
                                continue
                            raise
                        if not hidden(entry.name, is_folder):
                            yield f"{uri}/{entry.name}", is_folder, stat.st_size, stat.st_mtime_ns // 1_000_000 * 1000

        for some in itertools.batched(rows(), batch_rows):
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*some, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return folders.select("uri").mapInArrow(run, "uri string, is_folder boolean, n_bytes bigint, modified timestamp")


def reader() -> Callable[[Column], Column]:
    """Function of the URI of a local or mounted file that gives its bytes; of NULL, NULL. Not asked for, nothing is read."""
    batch_bytes = BATCH_BYTES

    def read(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def array(values):
            if len(values) > 1 or values[0] is None:
                return pa.array(values, pa.binary())
            ends = pa.array([0, len(values[0])], pa.int32()).buffers()[1]
            return pa.Array.from_buffers(pa.binary(), 1, [None, ends, pa.py_buffer(values[0])])  # a large one is not copied

        for uris in columns:
            values, size = [], 0
            for uri in uris.to_pylist():
                value = None
                if uri is not None:
                    with open(uri.removeprefix("file:"), "rb") as file:
                        value = file.read()
                if values and size + len(value or b"") > batch_bytes:
                    yield array(values)
                    values, size = [], 0
                values.append(value)
                size += len(value or b"")
            if values:
                yield array(values)

    # So that no filter on the bytes reads each file once more.
    return F.arrow_udf(read, "binary").asNondeterministic()


def hashed(files: DataFrame, strict: bool = False) -> DataFrame:
    """`uri, file_hash, n_bytes, head` of `files (uri)`; the hash is NULL where a file cannot be read, unless `strict`."""
    schema = "uri string, file_hash string, n_bytes bigint, head binary"
    digest, _, _ = _tools()
    batch_rows = BATCH_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import itertools

        types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
        uris = (u for batch in batches for u in batch.column(0).to_pylist())
        for some in itertools.batched(((u, *digest(u, strict)) for u in uris), batch_rows):
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*some, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["uri", "file_hash", "n_bytes", "head"])

    return files.select("uri").mapInArrow(run, schema)


def copied(files: DataFrame, folder: str) -> DataFrame:
    """Copy `files (uri, file_hash, name)` into an existing `folder`: `name, file_hash, n_bytes`, as the copies are made.

    Each copy is written under a name of its task's attempt and moved when it is whole and has its hash,
    so a task that is tried again, or twice at a time, leaves one whole file.
    """
    _, copy, _ = _tools()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            names, hashes, sizes = [], [], []
            for uri, file_hash, name in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                names.append(name)
                hashes.append(file_hash)
                sizes.append(copy(uri, f"{folder}/{name}", f"{folder}/.{name}-{attempt}", file_hash))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(hashes, pa.string()), pa.array(sizes, pa.int64())],
                ["name", "file_hash", "n_bytes"],
            )

    rows = files.select("uri", "file_hash", F.col("name"))
    return rows.mapInArrow(run, "name string, file_hash string, n_bytes bigint")


def written(texts: DataFrame, folder: str) -> DataFrame:
    """Write every value of the one binary column `texts` as a file below an existing `folder`: `n_files` per task.

    A task's files are written to a hidden folder of its attempt, which is moved to the task's own when all
    are there, so a task that is tried again, or twice at a time, leaves each file once.
    """
    _, _, write = _tools()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        values = (v for batch in batches for v in batch.column(0).to_pylist())
        n = write(values, f"{folder}/task-{task.partitionId():06d}", f"{folder}/.attempt-{task.taskAttemptId()}")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n_files"])

    return texts.mapInArrow(run, "n_files bigint")
